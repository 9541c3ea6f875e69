"""Near-equal embeddings by sorted projection passes.

Vectors of one label are linked when their cosine is at least LEAST. Each pass gives every vector a
code of random hyperplane signs, orders the vectors by (label, code) and compares each one with the
window before it. Passes have hyperplanes of their own; their number grows with the logarithm of the table, so
that where hyperplanes halve the vectors of a label, a pair at the least cosine is missed by all with a
chance of at most MISS. In a dense label they seldom do, so misses are estimated per label, from the vectors that
exactly one and exactly two passes linked to any other (Chao's lower bound of those that none has linked). Labels
with an estimate above MISS of their linked vectors get as many passes again, with codes and windows
twice as long, until none is left, or the window is as long as the label. Verified pairs are united into
components.

A window is bounded, a group of near-equal vectors is not. So all pairs inside a component are then
compared in blocks of BLOCK x BLOCK vectors: one task takes two blocks, and returns numbers of links
per vector, never the pairs. Equal vectors count once there and are counted by their number.

Results in special cases: a vector that is null, empty, zero or has null or non-finite components,
and any vector without a label, links with nothing: 0 links, its own component, kept. Equal vectors
of a label link with each other. Vectors of different lengths don't link. Rows that repeat a vec_id
count as vectors of their own for links and share the component of that id; a null vec_id is linked
with nothing. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import written
from spendloom.llm.components import components

LEAST = 0.98
# Of the first round of passes; each further one doubles bits and window.
CODE_BITS, WINDOW, BLOCK = 48, 48, 256
MISS = 0.001
SEED = 20_240_131


def passes(rows: int) -> int:
    """How many passes miss a pair at the least cosine with a chance of at most MISS: a pass finds it if
    the signs agree until about WINDOW vectors are left, which takes each plane to halve them."""
    agree = 1 - math.acos(LEAST) / math.pi
    found = agree ** max(1.0, math.log2(max(2, rows) / WINDOW) + 1)
    return max(2, math.ceil(math.log(MISS) / math.log(1 - found)))


def _planes(width: int, number: int, bits: int) -> np.ndarray:
    return np.random.default_rng((SEED, number, width)).standard_normal((width, bits))


def _unit(rows: pa.Array) -> list[np.ndarray | None]:
    """Vectors of length one, in double precision; None where a vector links with nothing."""
    out = []
    for row in rows.to_pylist():
        v = None
        if row and None not in row:
            x = np.array(row, float)
            with np.errstate(over="ignore", invalid="ignore"):
                top = np.abs(x).max()
                if np.isfinite(top) and top > 0:
                    x = x / top
                    v = x / math.sqrt(float(x @ x))
        out.append(v)
    return out


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row with its unit vector; null where it links with nothing."""
    for batch in batches:
        ids, labels = batch.column(0), batch.column(1)
        able = zip(_unit(batch.column(2)), ids.is_valid().to_pylist(), labels.is_valid().to_pylist(), strict=True)
        data = [v.astype("<f8").tobytes() if v is not None and i and y else None for v, i, y in able]
        yield pa.RecordBatch.from_arrays([ids, labels, pa.array(data, pa.binary())], names=["vec_id", "label", "unit"])


def _coded(turns: range, bits: int):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch.column(2).to_pylist()
            widths = np.array([len(u) for u in units])
            alike = [(at, np.frombuffer(b"".join(units[i] for i in at), "<f8").reshape(len(at), -1))
                     for at in (np.flatnonzero(widths == width) for width in np.unique(widths))]
            for turn in turns:
                codes = np.zeros((len(units), bits // 8), np.uint8)
                for at, x in alike:
                    codes[at] = np.packbits(x @ _planes(x.shape[1], turn, bits) > 0, axis=1)
                turned = pa.array(np.full(len(units), turn, np.int32))
                yield pa.RecordBatch.from_arrays(
                    [turned, batch.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), batch.column(0), batch.column(2)],
                    names=["turn", "label", "code", "id", "unit"],
                )

    return code


def _dots(one: list[bytes], two: list[bytes]) -> np.ndarray:
    """Cosines of unit vectors; pairs of different width give -1."""
    out = np.full((len(one), len(two)), -1.0)
    for width in {len(x) for x in one} & {len(x) for x in two}:
        i = [k for k, x in enumerate(one) if len(x) == width]
        j = [k for k, x in enumerate(two) if len(x) == width]
        a = np.frombuffer(b"".join(one[k] for k in i), "<f8").reshape(len(i), -1)
        b = np.frombuffer(b"".join(two[k] for k in j), "<f8").reshape(len(j), -1)
        out[np.ix_(i, j)] = a @ b.T
    return out


def _neighbours(rows: list[tuple], since: int, window: int) -> list[tuple[int, int, int, int]]:
    """Linked pairs (a, b, turn, label) of sorted rows (turn, label, id, unit): those from `since` on
    with the window before."""
    out = []
    for at in range(since, len(rows), BLOCK):
        end, low = min(len(rows), at + BLOCK), max(0, at - window)
        near = _dots([r[3] for r in rows[at:end]], [r[3] for r in rows[low:end]]) >= LEAST
        for i, j in zip(*np.nonzero(near), strict=True):
            x, y = rows[at + i], rows[low + j]
            if 0 < at + i - low - j <= window and x[:2] == y[:2]:
                out.append((min(x[2], y[2]), max(x[2], y[2]), *x[:2]))
    return out


_LINKS = "a long, b long, turn int, label int"
_PAIRS = _LINKS + ", edge long, position long, id long, unit binary"
_SCHEMA = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("turn", pa.int32()), ("label", pa.int32()),
                     ("edge", pa.int64()), ("position", pa.int64()), ("id", pa.int64()), ("unit", pa.binary())])


def _rows(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(*(batch.column(c).to_pylist() for c in ("turn", "label", "id", "unit")), strict=True))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)


def _windows(window: int):
    """Linked neighbours within a sorted partition, and its first and last rows for the seams."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker, tail, head = TaskContext.get().partitionId(), [], []
        seam = lambda rows, edge, first: _batch(
            [(None, None, turn, label, edge, first + i, id_, unit) for i, (turn, label, id_, unit) in enumerate(rows)]
        )
        for batch in batches:
            rows = tail + _rows(batch)
            yield _batch([(*link, None, None, None, None) for link in _neighbours(rows, len(tail), window)])
            head = head if len(head) == window else (head + rows[len(tail) :])[:window]
            tail = rows[-window:]
        yield seam(head, worker, window)
        yield seam(tail, worker + 1, 0)

    return compare


def _seam(window: int):
    """Linked neighbours across the end of one partition and the begin of the next: two windows of rows."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("position")
        sorted_rows = list(rows[["turn", "label", "id", "unit"]].itertuples(index=False, name=None))
        links = _neighbours(sorted_rows, int((rows["position"] < window).sum()), window)
        types = {"a": "int64", "b": "int64", "turn": "int32", "label": "int32"}
        return pd.DataFrame(links, columns=list(types)).astype(types)

    return compare


def _passed(rows: DataFrame, turns: range, window: int, bits: int, parts: int) -> DataFrame:
    """Linked pairs (a, b, turn, label) of rows(id, label, unit) found by these passes."""
    ordered = (
        rows.mapInArrow(_coded(turns, bits), "turn int, label int, code binary, id long, unit binary")
        .withColumn("tie", F.xxhash64("turn", "id"))  # equal codes lie in another order in each pass
        .repartitionByRange(parts, "turn", "label", "code", "tie")
        .sortWithinPartitions("turn", "label", "code", "tie")
        .select("turn", "label", "id", "unit")
    )
    compared = written(ordered.mapInArrow(_windows(window), _PAIRS))
    seams = compared.where("edge is not null").groupBy("edge")
    return compared.where("edge is null").select("a", "b", "turn", "label").unionByName(
        seams.applyInPandas(_seam(window), _LINKS)
    )


def _linked(single: DataFrame) -> DataFrame:
    """Pairs (a, b) of linked vectors of single(id, label, unit), as many as unite their components."""
    parts = max(1, int(single.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rest, found, times = single.select("id", "label", "unit"), None, None
    sizes = rest.groupBy("label").agg(F.count("*").alias("size"))
    done, window, bits = 0, WINDOW, CODE_BITS
    while count := rest.count():
        number = passes(count)
        # A partition far longer than a window, or its neighbours on both sides would have to meet.
        few = max(1, min(parts, count * number // (16 * window)))
        links = written(_passed(rest, range(done, done + number), window, bits, few))
        pairs = links.select("a", "b").distinct()
        found = pairs if found is None else found.unionByName(pairs)
        ends = links.select("label", "turn", F.explode(F.array("a", "b")).alias("id")).distinct()
        often = ends.groupBy("label", "id").agg(F.count("*").alias("n"))
        often = often if times is None else often.unionByName(times).groupBy("label", "id").agg(F.sum("n").alias("n"))
        times = written(often)
        once, twice = (F.sum(F.when(F.col("n") == n, 1.0).otherwise(0.0)) for n in (1, 2))
        missed = (once * (once - 1) / (2 * (twice + 1))).alias("missed")
        misses = times.groupBy("label").agg(missed, F.count("*").alias("met"))
        open_labels = misses.where(F.col("missed") > MISS * (F.col("met") + F.col("missed"))).join(sizes, "label")
        more = open_labels.where(F.col("size") > window)
        rest = written(rest.join(more, "label", "left_semi").select("id", "label", "unit"))
        done, window, bits = done + number, 2 * window, 2 * bits
    return found if found is not None else single.select(F.col("id").alias("a"), F.col("id").alias("b"))


def _block_links(group: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a component's vectors of one label, or inside one block. group:
    component, label, one, two (the blocks)."""
    rows = rows.sort_values(["id", "key"])
    one, two = (rows[rows["block"] == block] for block in group[2:])
    linked = _dots(list(one["unit"]), list(two["unit"])) >= LEAST
    if group[2] == group[3]:
        np.fill_diagonal(linked, False)
        n = linked @ two["copies"].to_numpy()
        return pd.DataFrame({"key": one["key"].to_numpy(), "n": n})
    return pd.DataFrame(
        {
            "key": np.concatenate([one["key"], two["key"]]),
            "n": np.concatenate([linked @ two["copies"].to_numpy(), one["copies"].to_numpy() @ linked]),
        }
    )


def near_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row of vectors(vec_id, embedding, label)."""
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"), F.col("embedding")
    )
    marked = written(rows.mapInArrow(_marked, "vec_id long, label int, unit binary"))
    usable = marked.where("unit is not null")
    # Equal vectors once; the smallest id stands for them. An id may have several vectors: key tells them apart.
    distinct = usable.groupBy("label", "unit").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    single = written(distinct.withColumn("key", F.xxhash64("label", "unit")))
    parted = written(components(_linked(single).distinct()))
    grouped = single.join(parted, "id")
    # Blocks of a component: by hash, so many that they hold about BLOCK vectors each.
    sizes = parted.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    grouped = grouped.join(sizes, "component").withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
    every = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda other: F.struct(F.least("block", other).alias("one"), F.greatest("block", other).alias("two")),
    )
    met = grouped.select("component", "label", "block", "id", "key", "unit", "copies", F.explode(every).alias("pair"))
    met = met.select("*", "pair.one", "pair.two").drop("pair")
    counted = met.groupBy("component", "label", "one", "two").applyInPandas(_block_links, "key long, n long")
    links = counted.groupBy("key").agg(F.sum("n").alias("n"))
    known = single.join(links, "key", "left").join(parted, "id", "left")
    known = known.select(
        "label", "unit", "id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    linked = usable.join(known, ["label", "unit"]).select("vec_id", "label", "n_links", "component_id")
    others = marked.where("unit is null").select(
        "vec_id", "label", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(others).select(
        "vec_id", "n_links", "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept")
    )
