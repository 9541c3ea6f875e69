"""Which decisions a ceiling lets through, in order, when a client's log is larger than a task.

Decisions come one after the other; one is accepted if its request has none yet and the approved total
stays within the ceiling. What is accepted lowers the room, so each depends on all before it. It is decided in
rounds that each settle a stretch of a client's log at once, by running totals:

* With room R a decision is small if it takes at most R / 2. As long as the small ones accepted in this round
  add up to R / 2 or less, the next small one fits for certain.
* So the stretch ends at the first decision, small or large, that leaves less than R / 2: the small one that
  brings the sum over R / 2, or the first large one that still fits. Everything before is settled.

Each round halves the room at least, so there are at most as many as the ceiling has binary digits, however long the
log is. A client whose open decisions are few enough for a task is folded there, one by one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.operators.joins import lookup, running_total
from spendloom.sources.scratch import written

# Decisions of a client that one task folds.
MOST = 100_000
# Decisions per block of a running total, by sequence number.
BLOCK = 4_096

ORDER = ["at", "seq"]
OPEN = ["client", "request_id", "at", "seq", "cents"]
SETTLED = "client string, request_id string, at timestamp_ntz, seq bigint, cents bigint"


def with_blocks(rows: DataFrame) -> DataFrame:
    """Day, second and block of sequence numbers: the buckets of a running total in order of (at, seq)."""
    return rows.withColumns({"_day": F.to_date("at"), "_second": F.date_trunc("second", "at"), "_block": F.floor(F.col("seq") / BLOCK)})


def running(rows: DataFrame, value: str, out: str) -> DataFrame:
    """Running sum of ``value`` per client in order of (at, seq). No window holds more than a block."""
    total = running_total(with_blocks(rows), ["client"], ["_day", "_second", "_block"], ORDER, value, out)
    return total.drop("_day", "_second", "_block")


def before(a: str, b: str) -> Column:
    """Whether the decision named by prefix a comes before that of prefix b."""
    at, seq = (F.col(f"{a}at"), F.col(f"{b}at")), (F.col(f"{a}seq"), F.col(f"{b}seq"))
    return (at[0] < at[1]) | ((at[0] == at[1]) & (seq[0] < seq[1]))


def _firsts(rows: DataFrame, prefix: str) -> DataFrame:
    """The first of the rows of each client and request. Two numbers after one another, which hash aggregates
    take the least of."""
    earliest = rows.groupBy("client", "request_id").agg(F.min("at").alias("at"))
    among = rows.select("client", "request_id", "at", "seq").join(earliest, ["client", "request_id", "at"])
    return among.groupBy("client", "request_id", F.col("at").alias(f"{prefix}at")).agg(F.min("seq").alias(f"{prefix}seq"))


def _round(pending: DataFrame, room: DataFrame, salts: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One stretch of each client: accepted decisions, what is still open, the room that is left."""
    rows = lookup(pending, room, ["client"], ["seq"], salts, "inner")
    small = rows.where(F.col("cents") * 2 <= F.col("room"))
    # A request is decided by its first small decision; those after it, of any size, come too late.
    marked = rows.join(_firsts(small, "f_"), ["client", "request_id"], "left")
    late = F.coalesce(before("f_", ""), F.lit(False))
    alive = marked.where(~late).withColumn("is_small", F.col("cents") * 2 <= F.col("room"))
    # Kept, because every level of the running total reads it.
    alive = written(alive.select(*OPEN, "room", "is_small", F.when(F.col("is_small"), F.col("cents")).otherwise(0).alias("adds")))
    summed = written(running(alive, "adds", "sum").drop("adds"))
    ends = F.when(F.col("is_small"), F.col("sum") * 2 > F.col("room")).otherwise(F.col("sum") + F.col("cents") <= F.col("room"))
    hits = summed.where(ends)
    first_at = hits.groupBy("client").agg(F.min("at").alias("e_at"))
    end = hits.join(first_at, "client").where(F.col("at") == F.col("e_at")).groupBy("client", "e_at").agg(F.min("seq").alias("e_seq"))
    placed = lookup(summed, end, ["client"], ["seq"], salts)
    at_end = (F.col("at") == F.col("e_at")) & (F.col("seq") == F.col("e_seq"))
    within = F.col("e_at").isNull() | before("", "e_") | at_end
    accepted = written(placed.where(within & (F.col("is_small") | F.coalesce(at_end, F.lit(False)))).select(*OPEN))
    taken = accepted.groupBy("client").agg(F.sum("cents").alias("_taken"))
    left = room.join(taken, "client", "left").select("client", (F.col("room") - F.coalesce("_taken", F.lit(0))).alias("room"))
    # Open: what comes after the stretch, fits by itself, and has no decision yet. Without an end nothing is.
    after = lookup(lookup(pending, end, ["client"], ["seq"], salts, "inner"), left, ["client"], ["seq"], salts, "inner")
    after = after.where(before("e_", "") & (F.col("cents") <= F.col("room")))
    done = accepted.select("client", "request_id")
    return accepted, written(after.join(done, ["client", "request_id"], "left_anti").select(*OPEN)), written(left)


def _fold(key: tuple, table: pa.Table) -> pa.Table:
    """The open decisions of one client, at most MOST, one by one."""
    table = table.sort_by([("at", "ascending"), ("seq", "ascending")])
    room, decided, kept = table["room"][0].as_py() if table.num_rows else 0, set(), []
    for i, (request, cents) in enumerate(zip(table["request_id"].to_pylist(), table["cents"].to_pylist(), strict=True)):
        if request not in decided and cents <= room:
            decided.add(request)
            room -= cents
            kept.append(i)
    return table.take(pa.array(kept, pa.int64())).select(OPEN)


def accepted(candidates: DataFrame, ceilings: DataFrame, salts: int = 16, most: int = MOST) -> DataFrame:
    """The accepted ones of ``candidates`` (client, request_id, at, seq, cents above 0), in order of (at, seq).
    ``ceilings``: client, room (cents)."""
    pending, room, parts = written(candidates.select(*OPEN)), ceilings.select("client", "room"), []
    while True:
        sizes = pending.groupBy("client").agg(F.count("*").alias("n"))
        large = sizes.where(F.col("n") > most).select("client")
        if large.isEmpty():
            break
        is_large = pending.join(large, "client", "left_semi")
        few = pending.join(large, "client", "left_anti")
        made, rest, left = _round(is_large, room.join(large, "client", "left_semi"), salts)
        parts.append(made)
        others = room.join(large, "client", "left_anti")
        pending, room = written(few.unionByName(rest)), written(others.unionByName(left))
    open_rows = lookup(pending, room, ["client"], ["seq"], salts, "inner")
    out = open_rows.groupBy("client").applyInArrow(_fold, SETTLED)
    for part in parts:
        out = out.unionByName(part)
    return out
