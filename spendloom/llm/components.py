"""Connected components of a graph given as pairs, by contraction over written tables.

Each round maps every node to a neighbour (or itself), replaces the ends of all links by what they
are mapped to and drops links that became loops. Rounds alternate between the smallest neighbour,
which ends stars at once, and the neighbour of smallest hash, which shortens chains by a fixed share
whatever their order. Rounds grow with the logarithm of the number of nodes. Nothing is collected;
per-key work is a minimum with map-side partial sums, and joins on hot nodes can be split.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import dropped, written


def components(links: DataFrame) -> DataFrame:
    """id, component (smallest id reachable) of every node of links(a, b), written. Loops are allowed."""
    given = links = written(links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).distinct())
    to = links.select(F.col("a").alias("id")).union(links.select("b")).distinct().withColumn("root", F.col("id"))
    links = links.where("a != b")
    step, used = 0, [given]
    while not links.isEmpty():
        both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        if step % 2 == 0:
            near = both.groupBy("a").agg(F.min("b").alias("n"))
            mapped = near.select(F.col("a").alias("was"), F.least("a", "n").alias("now"))
        else:
            rank = lambda c: F.xxhash64(F.col(c), F.lit(step))
            near = both.groupBy("a").agg(F.min_by("b", rank("b")).alias("n"))
            mapped = near.select(
                F.col("a").alias("was"), F.when(rank("n") < rank("a"), F.col("n")).otherwise(F.col("a")).alias("now")
            )
        mapped = written(mapped)
        one, two = (mapped.select(F.col("was").alias(c), F.col("now").alias(f"to_{c}")) for c in ("a", "b"))
        moved = links.join(one, "a").join(two, "b").where("to_a != to_b")
        links = written(
            moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct()
        )
        used += [mapped, links]
        to = to.join(mapped, F.col("root") == F.col("was"), "left").select("id", F.coalesce("now", "root").alias("root"))
        step += 1
    to = written(to)
    dropped(*used)
    least = to.groupBy("root").agg(F.min("id").alias("component"))
    out = written(to.join(least, "root").select("id", "component"))
    dropped(to)
    return out


def merged(classes: DataFrame | None, links: DataFrame) -> DataFrame:
    """The classes (id, component), or None, and what links(a, b) join of them, written. Ids without a class are one each.

    Classes become single nodes first, so the contraction takes time with the new links, not with all that is known.
    """
    if classes is None:
        return components(links)
    ends = links.select("a", "b")
    for end in "ab":
        of = classes.select(F.col("id").alias(end), F.col("component").alias("class"))
        ends = ends.join(of, end, "left").withColumn(end, F.coalesce("class", end)).drop("class")
    found = components(ends)
    # Nodes that had no class are their own; those that had one are its smallest id, which is in `classes` itself.
    fresh = found.join(classes, "id", "left_anti").select("id", F.col("id").alias("component"))
    to = found.select(F.col("id").alias("component"), F.col("component").alias("to"))
    both = classes.select("id", "component").unionByName(fresh)
    out = written(both.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component")))
    dropped(found)
    return out


# Leaders of a bucket, by round; the last number holds for all further ones. Most buckets are done with the second.
LEADERS = (1, 256, 2_048)


def shared_buckets(rows: DataFrame) -> DataFrame:
    """Buckets that hold two ids or more. rows: bucket, id."""
    ends = rows.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return ends.where("low < high").select("bucket")


def _classed(members: DataFrame, known: DataFrame | None) -> DataFrame:
    """Members with the class that they are known to be in, their own id where none is."""
    if known is None:
        return members.withColumn("class", F.col("id"))
    return members.join(known, "id", "left").withColumn("class", F.coalesce("component", "id")).drop("component")


def _open(members: DataFrame) -> DataFrame:
    """Members of buckets that hold two classes or more."""
    ends = members.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
    return members.join(ends.where("low < high").select("bucket"), "bucket")


def unsettled(members: DataFrame, known: DataFrame | None) -> DataFrame:
    """Members of buckets that aren't all of one known class. known: id, component, or None."""
    return members if known is None else _open(_classed(members, known)).drop("class")


def _ranked(members: DataFrame, known: DataFrame | None) -> DataFrame:
    """Members with the number of members that share buckets with them: the middle of a group has most."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    ranks = members.join(sizes, "bucket").groupBy("id").agg(F.sum("size").alias("rank"))
    return _classed(members.join(ranks, "id"), known).select("bucket", "id", "mark", "rank", "class")


def _leaders(members: DataFrame, number: int, salt: int) -> DataFrame:
    slot = F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(number)) if number > 1 else F.lit(0)
    best = F.max(F.struct("rank", "id", "class", "mark"))
    chosen = members.groupBy("bucket", slot.alias("slot")).agg(best.alias("l"))
    return chosen.select("bucket", F.col("l.id").alias("a"), F.col("l.class").alias("a_class"), F.col("l.mark").alias("a_mark"))


# Shares of all buckets whose members meet at once where marks are large.
SHARES = 4
# Ids of a block, and the sum of their marks, about. Leading blocks of a bucket by round; the last number holds for all
# further ones.
BLOCK, BLOCK_MARKS, LEADING = 512, 4_000_000, (4, 16, 64, 256)


def blocks(members: DataFrame) -> DataFrame:
    """id, class, rank, block, own: each id in one block of about BLOCK. Marks are sizes.

    Ids whose largest bucket is small go together to the largest one that other ids of their buckets have, so that a
    group has few blocks and all of them are full. A class that fills a block there has blocks of its own, and `own` is that class; it
    is null in blocks of several classes.
    """
    sizes = members.groupBy("bucket").agg(F.count("*").alias("size"))
    largest = members.join(sizes, "bucket").groupBy("id").agg(F.max(F.struct("size", "bucket")).alias("first"))
    near = written(members.select("bucket", "id", "class", "rank", "mark").join(largest, "id"))
    tops = near.groupBy("bucket").agg(F.max("first").alias("top"))
    homes = near.join(tops, "bucket").groupBy("id", "class", "rank", "mark", "first").agg(F.max("top").alias("home"))
    together = F.when(F.col("first.size") < BLOCK, F.col("first.bucket")).otherwise(F.col("class"))
    homes = homes.select("id", "class", "rank", "mark", together.alias("together"), F.col("home.bucket").alias("home"))
    # How many blocks it takes.
    share = F.lit(1 / BLOCK) + F.col("mark") / BLOCK_MARKS
    counted = homes.groupBy("home", "class").agg(F.sum(share).alias("n"))
    mixed = counted.where(F.col("n") < 1).groupBy("home").agg(F.sum("n").alias("mixed"))
    many = F.col("n") >= 1
    slots = F.ceil(F.when(many, F.col("n")).otherwise(F.col("mixed")))
    slot = F.pmod(F.xxhash64(F.when(many, F.col("id")).otherwise(F.col("together"))), slots)
    own = F.when(many, F.col("class"))
    return homes.join(counted, ["home", "class"]).join(mixed, "home", "left").select(
        "id", "class", "rank", F.xxhash64("home", many, own, slot).alias("block"), own.alias("own")
    )


def _leading(in_bucket: DataFrame, number: int, salt: int) -> DataFrame:
    slot = F.pmod(F.xxhash64("block", F.lit(salt)), F.lit(number))
    chosen = in_bucket.groupBy("bucket", slot.alias("slot")).agg(F.max(F.struct("rank", "block", "own")).alias("l"))
    return chosen.select("bucket", F.col("l.block").alias("leader"), F.col("l.own").alias("leader_own"))


def block_classes(members: DataFrame, compared: Callable[[DataFrame], DataFrame], classes: DataFrame) -> DataFrame:
    """Classes (id, component) and further ones that are linked through pairs of one bucket.

    members: bucket, id, mark, rank, class. compared: (a, b) that link the classes of rows(pair, block, id, class): of
    each pair the ids of two blocks (or of one) are all compared to each other's.

    Rows are made for ids of blocks that meet, not for pairs of ids, so a bucket of n open ids makes n * n / BLOCK of
    them at most. In each round all blocks of a bucket meet a bounded number of leading ones, which then step back; blocks
    of the same one class don't meet, and a bucket of one class is done.
    """
    step = 0
    while not members.isEmpty():
        placed = written(blocks(members))
        in_bucket = members.select("bucket", "id").join(placed, "id").groupBy("bucket", "block", "own").agg(F.max("rank").alias("rank"))
        in_bucket = written(in_bucket)
        leading = _leading(in_bucket, LEADING[min(step, len(LEADING) - 1)], step)
        meets = in_bucket.join(leading, "bucket").where(F.coalesce(F.col("own") != F.col("leader_own"), F.lit(True)))
        pairs = meets.select(F.least("block", "leader").alias("x"), F.greatest("block", "leader").alias("y")).distinct()
        ends = pairs.select(F.xxhash64("x", "y").alias("pair"), F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
        links = written(compared(ends.join(placed.select("block", "id", "class"), "block")))
        if not links.isEmpty():
            classes = merged(classes, links)
        rest = members.join(placed.select("id", "block"), "id")
        rest = rest.join(leading.select("bucket", F.col("leader").alias("block")), ["bucket", "block"], "left_anti")
        rest = _classed(rest.drop("class", "block"), classes).select("bucket", "id", "mark", "rank", "class")
        before, members = members, written(_open(rest))
        dropped(before, placed, in_bucket)
        step += 1
    return classes


def _meeting(members: DataFrame, number: int, salt: int, may: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs (a, b) of members and their bucket's leaders that are of different classes and may be linked."""
    leaders = _leaders(members, number, salt)
    meets = members.join(leaders, "bucket").where((F.col("class") != F.col("a_class")) & may(F.col("a_mark"), F.col("mark")))
    return meets.select(F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b")).distinct()


def bucket_classes(
    members: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    may: Callable[[Column, Column], Column],
    compared: Callable[[DataFrame], DataFrame] | None = None,
    known: DataFrame | None = None,
    further: tuple[Callable[[DataFrame], DataFrame], Callable[[Column, Column], Column]] | None = None,
) -> DataFrame:
    """id, component of the ids that are linked through pairs of one bucket, or as known (id, component) before.

    members: bucket, id, mark, each pair of bucket and id once, and only buckets of two or more; a table that is `written` is
    emptied once it is ranked.
    verified: (a, b, linked) of pairs (a, b); those that aren't linked may be left out. may: whether marks allow that two
    ids are linked. further: what the first leader leaves open (bucket, id, mark, rank, class) with other marks, which may be larger, and
    whether those allow a link: pairs that they rule out are never made.

    In each round a bucket's members are compared to a bounded number of leaders, so the pairs are in
    proportion to its size; leaders then step back, and a bucket whose members are all in one class is
    done. The others go on, with more leaders, so no pair of a bucket stays open unless its ids are
    already connected or their marks rule it out. The first leader is the member that shares most
    buckets, the middle of a group, which most others are linked to. With `compared`, all after it is
    done in blocks of ids, as `block_classes` says.
    """
    spark = members.sparkSession
    given, classes, step = members, known, 0
    members = written(_ranked(given, known))
    dropped(given)
    while not members.isEmpty():
        number = LEADERS[min(step, len(LEADERS) - 1)]
        if step == 0 or further is None:
            met, pairs = [], _meeting(members, number, step, may)
        else:  # marks are large: a share of the buckets is shuffled at a time
            slot = F.pmod(F.xxhash64("bucket"), F.lit(SHARES))
            met = [written(_meeting(members.where(slot == i), number, step, may)) for i in range(SHARES)]
            pairs = reduce(DataFrame.unionByName, met).distinct()
        found = written(verified(pairs))
        dropped(*met)
        links = found.where("linked").select("a", "b")
        past = classes
        if classes is None or not links.isEmpty():
            classes = merged(classes, links)
        # No mark decides who leads.
        leaders = _leaders(members.withColumn("mark", F.lit(0)), number, step)
        rest = members.join(leaders.select("bucket", F.col("a").alias("id")), ["bucket", "id"], "left_anti")
        rest = _classed(rest.drop("class"), classes).select("bucket", "id", "mark", "rank", "class")
        before, members = members, written(_open(rest))
        dropped(before, found)
        if past is not None and past is not known and past is not classes:
            dropped(past)
        if compared is not None:
            return block_classes(members, compared, classes)
        if step == 0 and further is not None and not members.isEmpty():
            before, members, may = members, written(further[0](members)), further[1]
            dropped(before)
        step += 1
    return spark.createDataFrame([], "id long, component long") if classes is None else classes
