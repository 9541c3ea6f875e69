"""Joins and running totals that hold up when one key has a third of all rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    spread_by: Sequence[str],
    salts: int,
    how: str = "left",
) -> DataFrame:
    """Join a table of at most one row per key (`small`) to a table with hot keys.

    The rows of a hot key are spread over ``salts`` slices by a hash of ``spread_by``; the
    lookup row is copied into each slice, so a hot key is never one task and the result is
    the same as of the plain join. There is no broadcast hint: the lookup grows with the
    number of clients or campaigns, so Spark broadcasts it only when its size is under
    ``spark.sql.autoBroadcastJoinThreshold``, planned or measured at run time.
    """
    slices = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))
    return salted.join(slices, [*on, "_salt"], how).drop("_salt")


def lookup_of_many(
    big: DataFrame, small: DataFrame, on: Sequence[str], spread_by: Sequence[str], rows: int, how: str = "left"
) -> DataFrame:
    """`lookup` in a table about as long as the big one. Keys with over ``rows`` rows alone are spread, over slices of
    so many, and only their lookup rows are copied."""
    many = big.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > rows)
    # At most one key for every ``rows`` rows of the big table.
    many = F.broadcast(many.select(*(F.col(k).alias(f"_hot_{k}") for k in on), F.ceil(F.col("n") / rows).cast("int").alias("_slices")))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in on))

    def sliced(frame: DataFrame) -> DataFrame:
        found = frame.join(many, same, "left").drop(*(f"_hot_{k}" for k in on))
        return found.withColumn("_slices", F.coalesce("_slices", F.lit(1)))

    salted = sliced(big).withColumn("_salt", F.pmod(F.xxhash64(*spread_by), "_slices").cast("int")).drop("_slices")
    copied = sliced(small).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1))).drop("_slices")
    return salted.join(copied, [*on, "_salt"], how).drop("_salt")


def row_counts(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every key of either frame, once, with its rows on each side: keys, left_rows, right_rows.
    Partial sums before the shuffle, so a hot key is one row per map task."""
    tagged = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return tagged.groupBy(*keys).agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))


# The list of hot keys is sent to all tasks, so it is the heaviest so many. A key that isn't on it has at most that
# share of all rows: an ordinary task.
MOST_HOT = 8_192

# Rows of a hot key in counts finer than the key. Counts below a this-many-th of a slice are left out before the
# shuffle: a key can have that many of them and still be an ordinary task.
FINER = 1_024


def hot_keys(counts: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """Keys with at least ``rows`` rows on either side of `row_counts` (which may be finer than
    ``keys``), the heaviest MOST_HOT of them, and into how many slices of about ``rows`` rows each side is
    to be cut.
    """
    # A null key joins nothing, so it is never cut. Told by the totals, not by a filter on the
    # keys: that would be pushed below the counts and split them off from their other uses.
    no_null = reduce(Column.__and__, (F.col(k).isNotNull() for k in keys))
    totals = (
        counts.filter(F.greatest("left_rows", "right_rows") * FINER >= rows)
        .groupBy(*keys)
        .agg(
            F.sum("left_rows").alias("l"),
            F.sum("right_rows").alias("r"),
            F.bool_and(no_null).alias("joins"),
        )
        .filter(F.col("joins") & ((F.col("l") >= rows) | (F.col("r") >= rows)))
        .orderBy((F.col("l") + F.col("r")).desc(), *keys)
        .limit(MOST_HOT)
    )
    slices = lambda n: F.greatest(F.lit(1), F.ceil(F.col(n) / F.lit(rows))).cast("int")
    return totals.select(*keys, slices("l").alias("left_slices"), slices("r").alias("right_slices"))


# Hash of the keys, and the first key of a join: nearly all rows are sorted and told apart by this number alone, where
# names that begin alike would be compared to their ends.
HASH = "_hash"


def with_hash(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frame if HASH in frame.columns else frame.withColumn(HASH, F.hash(*keys))


def fan_out(
    base: DataFrame,
    unique: DataFrame | None,
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    hot: DataFrame | None,
) -> DataFrame:
    """``base LEFT JOIN unique LEFT JOIN left LEFT JOIN right``, all on ``keys``, row for row and
    with no key in one task. ``unique`` has one row per key; left and right may have many. A ``unique`` that is
    grouped by `HASH` and the keys lies where it is joined.

    Ordinary keys are joined by themselves, all joins on one shuffle. Each hot key is joined in (left slice x right
    slice) cells. A left row stands in the cells of its slice, a right row likewise, base and
    unique rows in every cell. A cell left empty on a side that was cut is dropped: the key has
    its rows of that side in other cells. Where it is known that no key is hot (None), there are no cells.

    What a row says decides its slice, never where it lies, so a task that runs again cuts as it did before, in
    whatever order its rows come. Exact copies of a row are counted, dealt over the slices as
    numbers, and become rows again behind the joins.
    """
    keys = list(keys)
    base, left, right = with_hash(base, keys), with_hash(left, keys), with_hash(right, keys)
    unique = unique if unique is None else with_hash(unique, keys)

    def joined(on: list[str], first: DataFrame, *others: DataFrame | None) -> DataFrame:
        for other in others:
            first = first if other is None else first.join(other, on, "left")
        return first

    if hot is None:
        return joined([HASH, *keys], base, unique, left, right).drop(HASH)
    # At most MOST_HOT rows (see `hot_keys`); mostly none, and then the joins to it vanish.
    hot = F.broadcast(hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys}))
    same = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys))
    n_left, n_right = F.col("left_slices"), F.col("right_slices")
    sliced = ["left_slices", "right_slices"]

    def of_hot(frame: DataFrame) -> DataFrame:
        return frame.join(hot, same).drop(*(f"_hot_{k}" for k in keys))

    def everywhere(frame: DataFrame) -> DataFrame:
        """Rows of hot keys, in every cell of their key."""
        return of_hot(frame).withColumn("_cell", F.explode(F.sequence(F.lit(0), n_left * n_right - 1)))

    def in_slices(frame: DataFrame, mine: Column, cells: Callable[[Column], Column], copies: str) -> DataFrame:
        """Rows of hot keys in the cells of their slice, copies as a number."""
        rows = of_hot(frame)
        counted = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
        # n copies over so many slices: slice number (start + i) has n / slices of them, the first ones one more.
        start = F.pmod(F.xxhash64(*frame.columns), mine)
        dealt = counted.withColumn("_i", F.explode(F.sequence(F.lit(0), F.least("_n", mine.cast("long")).cast("int") - 1)))
        share = F.floor(F.col("_n") / mine) + F.when(F.col("_i") < F.col("_n") % mine, 1).otherwise(0)
        dealt = dealt.withColumns({"_slice": F.pmod(start + F.col("_i"), mine).cast("int"), copies: share.cast("long")})
        placed = dealt.withColumn("_cell", F.explode(cells(F.col("_slice"))))
        return placed.select(*frame.columns, "_cell", copies)

    def again(frame: DataFrame, copies: str) -> DataFrame:
        """Each row as often as it was counted; rows without a partner stay."""
        return frame.withColumn("_again", F.explode(F.sequence(F.lit(1).cast("long"), F.coalesce(copies, F.lit(1))))).drop("_again")

    ordinary = lambda frame: frame.join(hot, same, "left_anti")
    cold = joined([HASH, *keys], ordinary(base), unique, ordinary(left), ordinary(right))

    in_left = in_slices(left, n_left, lambda at: F.sequence(at * n_right, (at + 1) * n_right - 1), "_left")
    in_right = in_slices(right, n_right, lambda at: F.sequence(at, (n_left - 1) * n_right + at, n_right), "_right")
    cells = joined([HASH, *keys, "_cell"], everywhere(base), None if unique is None else everywhere(unique).drop(*sliced), in_left, in_right)
    empty = ((n_left > 1) & F.col("_left").isNull()) | ((n_right > 1) & F.col("_right").isNull())
    whole = again(again(cells.filter(~empty), "_left"), "_right").drop("_cell", "_left", "_right", *sliced)
    return cold.unionByName(whole).drop(HASH)


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[str],
    order: Sequence[str],
    value: str,
    out: str,
) -> DataFrame:
    """Running sum of ``value`` within ``keys``, in ``(*buckets, *order)`` order.

    One window over a key would put a hot key into one task. Here a window runs only inside a
    finest bucket (say a block of sequence numbers within a second within a day), and what came
    before the bucket is the running total of the bucket totals, found the same way one level
    up. So the rows are shuffled once, and each window holds one bucket's rows or totals.
    """
    rows_to_here = lambda w: w.rowsBetween(W.unboundedPreceding, W.currentRow)
    if not buckets:
        return df.withColumn(out, F.sum(value).over(rows_to_here(W.partitionBy(*keys).orderBy(*order))))
    bucket = [*keys, *buckets]
    totals = df.groupBy(*bucket).agg(F.sum(value).alias("_total"))
    through = running_total(totals, keys, buckets[:-1], buckets[-1:], "_total", "_through")
    before = through.select(*bucket, (F.col("_through") - F.col("_total")).alias("_before"))
    within = F.sum(value).over(rows_to_here(W.partitionBy(*bucket).orderBy(*order)))
    return (
        df.withColumn("_within", within)
        .join(before, bucket, "left")
        .withColumn(out, F.col("_before") + F.col("_within"))
        .drop("_before", "_within")
    )
