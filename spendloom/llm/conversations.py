"""Repair of conversations: the cheapest edits that make their roles alternate, by iterative deepening A*.

Rows are read in order of turn (null first; rows of a turn by role, then MD5 of the text). A state is the number
of rows read and what may come next: nothing said yet (START), after the system's row (SYSTEM), after a user's
(USER), after an assistant's (ASSISTANT). The depth-first search tries the edits in ASCII order, Delete,
Insert, Keep, Rerole, under a bound on the cost. Every state that failed is entered in a table with a lower bound
of what is missing from it; the next bound is the one of the start. The first path accepted is the cheapest
and among those the least in ASCII order.

Equal rows of a turn are one entry with a count. A conversation of more than WHOLE entries is cut into blocks, so
that no task holds one: each block is searched from each state to each state, and the blocks' costs and the
order of their paths decide which belong together (no path of a block begins another of the same start and cost, so
the least of the whole is made of the least of each block). Only the digest of a repaired conversation is made in
one pass over its rows, which are streamed; SHA-256 knows no other way.

Results in special cases: a null id, turn, role or text is one space where it is text; rows with a null
conv_id are a conversation, whose conv_id is null. A role's first character counts; an empty role has none and
can't be kept. Ties of turn are ordered as above; repeated rows are duplicates. A conversation
without rows after damage, like one whose rows all go, has cost 0 or that of its deletions, no audit or only D, and
the hash of the empty string. An empty table gives no rows; long texts are only hashed and streamed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import written

START, SYSTEM, USER, ASSISTANT = range(4)
# What follows a kept or inserted row of each initial; a role that may not come is missing.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# The only role of the two that may come next, and the state after it.
TURN = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
ACCEPTED = (START, ASSISTANT)
DELETE, INSERT, REROLE, UNFINISHED = 4, 3, 3, 3
# Entries of a conversation that is searched as a whole, and of a block of a longer one.
WHOLE, BLOCK = 64, 64
FINE, TRUNCATED, DROPPED = range(3)
# More than any path costs.
NEVER = 1 << 60

WHITE = "\x20\x09\x0a\x0b\x0c\x0d"


def _said(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, copies of the rows that are left after damage."""
    kind = F.crc32(F.concat_ws(":", _said("conv_id"), _said("turn")).cast("binary")) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        _said("role").alias("role"), _said("text").alias("text"), kind.alias("kind"),
    ).where("kind != 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def entries(rows: DataFrame) -> DataFrame:
    """Distinct rows of conversations with their copies and faults, in order of `place`, written.

    conv_id, turn, role, text_md5, copies, blank, truncated, place, duplicate, rows numbered over the whole table.
    A range partitioning by all that orders them splits even a conversation that has a third of all rows.
    """
    bare = F.rtrim("text", F.lit(WHITE))
    slim = rows.select(
        "conv_id", "turn", "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), "copies",
        (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
    )
    once = slim.groupBy("conv_id", "turn", "role", "text_md5", "blank", "truncated").agg(F.sum("copies").alias("copies"))
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text_md5"]
    placed = written(
        once.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    )
    same = ["conv_id", "role", "text_md5"]
    first = placed.groupBy(*same).agg(F.min("place").alias("place")).select("place", F.lit(False).alias("duplicate"))
    return written(
        placed.join(first, "place", "left").withColumn("duplicate", F.coalesce("duplicate", F.lit(True)))
    )


def _faults(found: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated of every conversation that has rows left."""
    extra = F.when(F.col("blank"), 0).otherwise(F.col("copies") - F.when(F.col("duplicate"), 0).otherwise(1))
    turns = found.groupBy("conv_id", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(extra).alias("duplicate"),
        F.sum((~F.col("blank") & ~F.col("duplicate") & F.col("truncated")).cast("long")).alias("truncated"),
    )
    spread = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    return turns.groupBy("conv_id").agg(F.coalesce(spread, F.lit(0)).alias("gaps"), *sums)


class Search:
    """Cheapest edits of a run of rows: (initial, kind, copies), where `kind` rows that are DROPPED must go.

    goal: a state in which the last row must leave the search, or None: the conversation ends here, rows may be
    inserted behind it and the state must be accepted.
    """

    def __init__(self, rows: list[tuple[str, int, int]], goal: int | None) -> None:
        self._rows, self._goal = rows, goal
        # Cost that no path from a row on can avoid; the table raises it for states that failed.
        self._least = [0] * (len(rows) + 1)
        for i in range(len(rows) - 1, -1, -1):
            _, kind, copies = rows[i]
            forced = DELETE * copies if kind == DROPPED else min(DELETE, UNFINISHED) if kind == TRUNCATED else 0
            self._least[i] = self._least[i + 1] + forced
        self._missing: dict[tuple[int, int], int] = {}
        self._path: list[str] = []

    def _bound(self, i: int, state: int) -> int:
        return self._missing.get((i, state), self._least[i])

    def _edits(self, i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        """(edit, cost, rows read, state after) in ASCII order."""
        after = TURN[state][1]
        if i == len(self._rows):
            if self._goal is None:
                yield "I", INSERT, i, after
            return
        initial, kind, copies = self._rows[i]
        yield "D" * copies, DELETE * copies, i + 1, state
        yield "I", INSERT, i, after
        if kind != DROPPED:
            end = UNFINISHED if kind == TRUNCATED else 0
            kept = NEXT.get(initial, {}).get(state)
            if kept is not None:
                yield "K", end, i + 1, kept
            yield "R", REROLE + end, i + 1, after

    def _descend(self, i: int, state: int, left: int) -> bool:
        """Whether a path from here costs at most `left`; it is then the rest of the path."""
        if i == len(self._rows) and (state in ACCEPTED if self._goal is None else state == self._goal):
            return True
        best = None
        for edit, cost, row, after in self._edits(i, state):
            if cost + self._bound(row, after) <= left:
                self._path.append(edit)
                if self._descend(row, after, left - cost):
                    return True
                self._path.pop()
            missing = cost + self._bound(row, after)
            best = missing if best is None else min(best, missing)
        # Failed: more than `left` is missing, at least what the best of the edits lacks.
        self._missing[i, state] = NEVER if best is None else max(self._bound(i, state), best)
        return False

    def _reachable(self, state: int) -> bool:
        """Whether there is a path at all: what has begun can't be unsaid, and only a row brings a system's turn."""
        if self._goal == START:
            return state == START
        if self._goal == SYSTEM:
            return state == SYSTEM or (state == START and any(r == "s" and k != DROPPED for r, k, _ in self._rows))
        return True

    def run(self, state: int) -> tuple[int, str] | None:
        """Cost and audit of the cheapest path from a state, or None where there is none."""
        if not self._reachable(state):
            return None
        self._path = []
        while not self._descend(0, state, bound := self._bound(0, state)):
            pass
        return bound, "".join(self._path)


def repaired(rows: list[tuple[str, int, int]], audit: str, state: int) -> list[tuple[int | None, str | None]]:
    """(row or None where inserted, new role or None where the row keeps its own), in order."""
    out, i, gone = [], 0, 0
    for edit in audit:
        role, after = TURN[state]
        if edit == "I":
            out.append((None, role))
            state = after
        elif edit == "D":
            gone += 1
            if gone == rows[i][2]:
                i, gone = i + 1, 0
        else:
            out.append((i, role if edit == "R" else None))
            state = after if edit == "R" else NEXT[rows[i][0]][state]
            i += 1
    return out


def _expanded(entry: dict) -> list[tuple[str, int, int]]:
    """An entry as rows of a search: the first copy by its fault, the others as duplicates."""
    initial, copies = entry["role"][:1], entry["copies"]
    if entry["blank"] or entry["duplicate"]:
        return [(initial, DROPPED, copies)]
    first = (initial, TRUNCATED if entry["truncated"] else FINE, 1)
    return [first] if copies == 1 else [first, (initial, DROPPED, copies - 1)]


def _clash(a: str, b: str) -> bool:
    return a + b not in ("su", "ua", "au")


def _illegal(rows: list[tuple[str, int, int]]) -> int:
    """Neighbours whose initials may not follow each other."""
    initials = [r[0] for r in rows]
    return sum(n - 1 for _, _, n in rows) + sum(map(_clash, initials, initials[1:]))


_STATES = (START, SYSTEM, USER, ASSISTANT)
_LONGS, _STRINGS = pa.list_(pa.int64()), pa.list_(pa.string())
# Paths of a block: of a whole conversation one, else one per start and goal, at start * 4 + goal.
_SEARCHED = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("whole", pa.bool_()), ("illegal", pa.int64()),
     ("first", pa.string()), ("last", pa.string()), ("costs", _LONGS), ("audits", _STRINGS)]
)
SEARCHED = (
    "conv_id long, block long, whole boolean, illegal long, first string, last string, costs array<long>, audits array<string>"
)


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rows = [x for e in r["entries"] for x in _expanded(e)]
            if r["whole"]:
                paths = [Search(rows, None).run(START)]
            else:
                goals = [Search(rows, goal) for goal in _STATES]
                paths = [search.run(start) for start in _STATES for search in goals]
            out.append(
                {"conv_id": r["conv_id"], "block": r["block"], "whole": r["whole"], "illegal": _illegal(rows),
                 "first": rows[0][0], "last": rows[-1][0], "costs": [NEVER if p is None else p[0] for p in paths],
                 "audits": [None if p is None else p[1] for p in paths]}
            )
        yield pa.RecordBatch.from_pylist(out, _SEARCHED)


_CHOSEN = pa.schema(
    [("conv_id", pa.int64()), ("block", pa.int64()), ("start", pa.int32()), ("goal", pa.int32()),
     ("tail", pa.string()), ("total", pa.int64()), ("illegal", pa.int64())]
)
CHOSEN = "conv_id long, block long, start int, goal int, tail string, total long, illegal long"


def _chosen(table: pa.Table) -> pa.Table:
    """Which path each block of a conversation takes: costs from the last block back, then the least path forward.

    Takes 16 costs and ranks per block of BLOCK entries.
    """
    table = table.sort_by("block")
    n = table.num_rows
    costs, ranks = (table[c].combine_chunks().flatten().to_numpy().reshape(n, 4, 4) for c in ("costs", "ranks"))
    tails = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
    to_go = np.array([INSERT * len(tails[s]) for s in _STATES], np.int64)
    ahead = np.empty((n, 4), np.int64)
    for k in range(n - 1, -1, -1):
        ahead[k] = to_go
        to_go = np.minimum((costs[k] + to_go).min(axis=1), NEVER)
    first, last, blocks = (table[c].to_pylist() for c in ("first", "last", "block"))
    illegal = sum(table["illegal"].to_pylist()) + sum(map(_clash, last, first[1:]))
    conv_id, state, out = table["conv_id"][0].as_py(), START, []
    for k, block in enumerate(blocks):
        through = costs[k, state] + ahead[k]
        goal = int(min(np.flatnonzero(through == through.min()), key=ranks[k, state].__getitem__))
        out.append(
            {"conv_id": conv_id, "block": block, "start": state, "goal": goal, "tail": tails[goal] if k == n - 1 else "",
             "total": int(to_go[START]), "illegal": illegal}
        )
        state = goal
    return pa.Table.from_pylist(out, _CHOSEN)


_PIECES = pa.schema([(c, pa.int64()) for c in ("conv_id", "block", "seq", "place")] + [("role", pa.string())])
PIECES = "conv_id long, block long, seq long, place long, role string"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of repaired conversations, of blocks whose audit is known."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rows, places = [], []
            for e in r["entries"]:
                more = _expanded(e)
                rows += more
                places += [e["place"]] * len(more)
            for seq, (i, role) in enumerate(repaired(rows, r["audit"], r["start"])):
                out.append((r["conv_id"], r["block"], seq, None if i is None else places[i], role))
        columns = zip(*out, strict=True) if out else [[]] * len(_PIECES)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _PIECES, strict=True)], schema=_PIECES
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each conversation, newline-joined; they come in order, a conversation in one task."""
    current, running = None, None

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([current[0]], pa.int64()), pa.array([running.hexdigest()])], names=["conv_id", "repaired_sha256"]
        )

    for batch in batches:
        for conv_id, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if running is None or current != (conv_id,):
                if running is not None:
                    yield done()
                current, running = (conv_id,), hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(piece.encode())
    if running is not None:
        yield done()


def searched_blocks(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks (conv_id, block, whole, entries) and their paths (SEARCHED), both written."""
    spans = found.groupBy("conv_id").agg(F.min("place").alias("from_place"), F.max("place").alias("to_place"))
    spans = spans.withColumnRenamed("conv_id", "of_conv")
    placed = found.join(spans, F.col("conv_id").eqNullSafe(F.col("of_conv")))
    whole = F.col("to_place") - F.col("from_place") < WHOLE
    block = F.when(whole, F.lit(0)).otherwise(F.expr(f"(place - from_place) div {BLOCK}"))
    entry = F.struct("place", "role", "copies", "blank", "duplicate", "truncated")
    blocks = written(
        placed.withColumns({"whole": whole, "block": block.cast("long")})
        .groupBy("conv_id", "block", "whole")
        .agg(F.sort_array(F.collect_list(entry)).alias("entries"))
    )
    return blocks, written(blocks.mapInArrow(_searched, SEARCHED))


def plans(paths: DataFrame) -> DataFrame:
    """conv_id, block, start, audit, total, illegal of every block: the way the conversation takes through it."""
    one = paths.where("whole").select(
        "conv_id", "block", F.lit(START).alias("start"), F.col("audits")[0].alias("audit"),
        F.col("costs")[0].alias("total"), "illegal",
    )
    cut = paths.where("not whole")
    # Among the paths of a start the rank of each goal's audit; only numbers go to the conversation's task.
    goals = F.sequence(F.lit(0), F.lit(3))
    rank = F.flatten(
        F.transform(goals, lambda s: F.transform(goals, lambda g: F.size(F.filter(
            F.slice("audits", s * 4 + 1, 4), lambda a: a < F.col("audits")[s * 4 + g]))))
    )
    slim = cut.select("conv_id", "block", "illegal", "first", "last", "costs", rank.alias("ranks"))
    way = slim.groupBy("conv_id").applyInArrow(_chosen, CHOSEN)
    way = way.select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), "start", "goal", "tail", "total",
                     F.col("illegal").alias("all_illegal"))
    joined = cut.join(way, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block")))
    audit = F.concat(F.col("audits")[F.col("start") * 4 + F.col("goal")], F.col("tail"))
    return one.unionByName(
        joined.select("conv_id", "block", "start", audit.alias("audit"), "total", F.col("all_illegal").alias("illegal"))
    )


def repaired_rows(rows: DataFrame, found: DataFrame, blocks: DataFrame, chosen: DataFrame) -> DataFrame:
    """conv_id, block, seq, role, text of the repaired conversations."""
    of = chosen.select(F.col("conv_id").alias("of_conv"), F.col("block").alias("of_block"), "start", "audit")
    known = blocks.join(of, F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block")))
    pieces = known.select("conv_id", "block", "start", "audit", "entries").mapInArrow(_pieces, PIECES)
    pieces = written(pieces)
    inserted = pieces.where("place is null").select("conv_id", "block", "seq", "role", F.lit("").alias("text"))
    kept = pieces.where("place is not null").withColumnRenamed("role", "new_role").withColumnRenamed("conv_id", "of_conv")
    # The texts of rows that stay, one of equal rows each.
    stay = found.join(kept, "place").select(
        F.coalesce(F.col("conv_id"), F.lit(0)).alias("id"), F.col("conv_id").isNull().alias("no_id"),
        F.coalesce(F.col("turn"), F.lit(0)).alias("at"), F.col("turn").isNull().alias("no_turn"),
        "role", "text_md5", "block", "seq", "new_role",
    )
    texts = rows.select(
        F.coalesce(F.col("conv_id"), F.lit(0)).alias("id"), F.col("conv_id").isNull().alias("no_id"),
        F.coalesce(F.col("turn"), F.lit(0)).alias("at"), F.col("turn").isNull().alias("no_turn"),
        "role", F.md5(F.col("text").cast("binary")).alias("text_md5"), "text",
    )
    key = ["id", "no_id", "at", "no_turn", "role", "text_md5"]
    full = stay.join(texts.groupBy(*key, "text").agg(F.count("*").alias("_n")), key)
    return inserted.unionByName(
        full.select(
            F.when(~F.col("no_id"), F.col("id")).alias("conv_id"), "block", "seq",
            F.coalesce("new_role", "role").alias("role"), "text",
        )
    )


def digests(pieces: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 of the conversations that have rows."""
    lines = pieces.select("conv_id", F.concat("role", F.lit(":"), "text").alias("line"), "block", "seq")
    ordered = lines.repartition("conv_id").sortWithinPartitions("conv_id", "block", "seq")
    return ordered.select("conv_id", "line").mapInArrow(_digests, "conv_id long, repaired_sha256 string")


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation."""
    rows = damaged(conversations)
    found = entries(rows)
    blocks, paths = searched_blocks(found)
    chosen = written(plans(paths))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "")
    parts = chosen.groupBy("conv_id").agg(F.max("total").alias("cost"), F.max("illegal").alias("illegal"), audit.alias("audit"))
    numbers, strings = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), ("audit", "repaired_sha256")
    everyone = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).groupBy("conv_id").agg(F.count("*").alias("_n"))
    made = [everyone, _faults(found), parts, digests(repaired_rows(rows, found, blocks, chosen))]
    # The tables have at most one row per conversation: they are laid on one another instead of joined.
    stacked = made[0].drop("_n")
    for part in made[1:]:
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    out = stacked.groupBy("conv_id").agg(*[F.max(c).alias(c) for c in (*numbers, *strings)])
    empty = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
