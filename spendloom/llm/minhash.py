"""Near-duplicate documents by DartMinHash signatures over weighted word shingles.

A text is a weighted set: its shingles of WORDS lower-case words, each weighing as often as it occurs
(a text of fewer words is one shingle of all it has; a text without words is one shingle of itself,
an empty text has none). Likeness is the generalised Jaccard similarity, sum of minima by sum of
maxima of the weights.

Signature: the plane of weight and time over each shingle is divided into unit cells. A cell holds a
Poisson number of darts, drawn from a hash of shingle and cell; each has a place, an arrival time and
one of COORDINATES numbers. A set keeps the darts that lie below its weights, and per coordinate the
earliest. Two sets agree in a coordinate with a chance equal to their likeness. Darts are thrown only
up to the time at which all coordinates are expected to be met, and later only for sets that miss
one, so the work per document is its length plus COORDINATES * log(COORDINATES).

Links: signatures are cut into BANDS bands of ROWS coordinates; documents that agree in a band are
candidates, and those with a likeness of at least LEAST are linked, checked over whole texts. Within a
bucket all documents are compared to a leader, and what that leaves open in blocks, as `block_classes` says: no pair stays
open unless its documents are already in one class, and no group is expanded into all its pairs. Documents of two blocks are
compared as a product of matrices.

Results in special cases: equal texts are always in one class (also empty ones; null counts as
empty); texts are told apart by a 64-bit hash; repeated rows are copies of each other; a null doc_id is
never the id of a class that has others. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import fresh, texts, with_text_hash, written
from spendloom.llm.components import bucket_classes, shared_buckets

WORDS, LEAST = 5, 0.8
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS

_WORD = re.compile(r"\w+")
_U = np.uint64
# Chance of at most n darts in a unit cell.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(14)])


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < 500_000 and len(word) <= 64:
            self[word] = value
        return value


_HASHES = _WordHashes()


def _mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers well spread."""
    h = (h ^ (h >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> _U(33))


def shingles(text: str, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a text as 64-bit numbers, ascending, and how often each occurs."""
    found = _WORD.findall(text.lower()) or ([text] if text else [])
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    h = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
    n = min(words, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = _mixed(out ^ h[i : len(h) - n + 1 + i]) + _U(i + 1)
    return np.unique(out, return_counts=True)


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], coordinates: int = COORDINATES) -> np.ndarray:
    """One row per weighted set (64-bit elements, weights > 0); empty sets get zeros."""
    out = np.zeros((len(sets), coordinates), np.uint64)
    totals = np.array([float(w.sum()) for _, w in sets])
    todo = np.flatnonzero(totals > 0)
    until = (coordinates * math.log(coordinates) + 2 * coordinates) / np.maximum(totals, 1e-300)
    while len(todo):
        owner, when, value = _darts([sets[i] for i in todo], until[todo])
        key = owner * coordinates + (_mixed(value) % _U(coordinates)).astype(np.int64)
        order = np.argsort(-when, kind="stable")  # the earliest last, so that it stays
        found = np.zeros(len(todo) * coordinates, np.uint64)
        met = np.zeros(len(found), bool)
        found[key[order]] = value[order]
        met[key] = True
        out[todo] = found.reshape(len(todo), coordinates)
        # A set that misses a coordinate throws again, for twice the time.
        todo = todo[~met.reshape(len(todo), coordinates).all(axis=1)]
        until[todo] *= 2
    return out


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For counts (2, 3): which entry (0, 0, 1, 1, 1) and its number there (0, 1, 0, 1, 2)."""
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - (np.cumsum(counts) - counts)[which]


def _darts(sets: list[tuple[np.ndarray, np.ndarray]], until: np.ndarray) -> tuple[np.ndarray, ...]:
    """Owner, arrival and value of the darts that the sets keep up to a time."""
    element = np.concatenate([e for e, _ in sets])
    weight = np.concatenate([np.asarray(w, float) for _, w in sets])
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    which, unit = _spread(np.ceil(weight).astype(np.int64))
    cell = _mixed(element[which] + unit.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    covered, owner = weight[which] - unit, owner[which]
    which, t = _spread(np.ceil(until[owner]).astype(np.int64))
    seed = _mixed(cell[which] ^ _mixed(t.astype(np.uint64) + _U(1)))
    covered, owner = covered[which], owner[which]
    which, d = _spread(np.searchsorted(_POISSON, (seed >> _U(11)).astype(float) * 2.0**-53, side="right"))
    h = _mixed(seed[which] + (d + 1).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    when = t[which] + (h >> _U(32)).astype(float) * 2.0**-32
    place = (h & _U(0xFFFFFFFF)).astype(float) * 2.0**-32
    kept = (place < covered[which]) & (when < until[owner[which]])
    return owner[which][kept], when[kept], _mixed(h[kept])


def bands(rows: np.ndarray, band_rows: int = ROWS) -> np.ndarray:
    """Per signature one 64-bit number per band."""
    parts = rows.reshape(len(rows), -1, band_rows)
    out = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64), parts.shape[:2]).copy()
    for i in range(band_rows):
        out = _mixed(out ^ parts[:, :, i]) + _U(1)
    return out.view(np.int64)


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            part = batch.slice(at, 64)
            sets = [shingles(t) for t in part.column(1).to_pylist()]
            full = np.array([len(s[0]) > 0 for s in sets])
            sig = bands(signatures(sets))
            rows = [s if f else None for s, f in zip(sig, full, strict=True)]
            columns = [part.column(0), part.column(2), pa.array(rows, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "mark", "bands"])


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted sets as bytes: the distinct elements, then their counts."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            rows = [
                e.astype("<u8").tobytes() + n.astype("<u4").tobytes()
                for e, n in map(shingles, part.column(1).to_pylist())
            ]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(rows, pa.binary())], names=["id", "elements"])


def _opened(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 12
    return np.frombuffer(data, "<u8", n), np.frombuffer(data, "<u4", n, 8 * n).astype(np.int64)


def likeness(one: tuple[np.ndarray, np.ndarray], two: tuple[np.ndarray, np.ndarray]) -> float:
    """Generalised Jaccard similarity of two weighted sets."""
    total = one[1].sum() + two[1].sum()
    if not total:
        return 0.0
    _, i, j = np.intersect1d(one[0], two[0], assume_unique=True, return_indices=True)
    shared = np.minimum(one[1][i], two[1][j]).sum()
    return float(shared / (total - shared))


def _compared(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, leader = None, None
        for batch in batches:
            found = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, leader = a, _opened(x.as_py())
                found.append(likeness(leader, _opened(y.as_py())))
            found = np.array(found)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found >= least)], names=["a", "b", "linked"])

    return compare


# Columns of a matrix of elements at a time.
COLUMNS = 1 << 14


def _units(sets: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """An element of weight n as n elements of weight one: their numbers and whose they are."""
    element, weight = (np.concatenate([s[i] for s in sets]) for i in (0, 1))
    owner = np.repeat(np.arange(len(sets)), [len(e) for e, _ in sets])
    which, unit = _spread(weight)
    return _mixed(element[which] + unit.astype(np.uint64) * _U(0x9E3779B97F4A7C15)), owner[which]


def likenesses(one: list[tuple[np.ndarray, np.ndarray]], two: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
    """Generalised Jaccard similarity of each of some weighted sets with each of others, or of their own (but itself)."""
    x, of_x = _units(one)
    if two is None:
        two, (y, of_y), (elements, n) = one, (x, of_x), np.unique(x, return_counts=True)
        elements = elements[n > 1]
    else:
        y, of_y = _units(two)
        elements = np.intersect1d(x, y)
    shared = np.zeros((len(one), len(two)))
    for low in range(0, len(elements), COLUMNS):
        some, sides = elements[low : low + COLUMNS], []
        for units, owner, n in ((x, of_x, len(one)), (y, of_y, len(two))):
            at = np.minimum(np.searchsorted(some, units), len(some) - 1)
            here = some[at] == units
            side = np.zeros((n, len(some)), np.float32)
            side[owner[here], at[here]] = 1
            sides.append(side)
        shared += sides[0] @ sides[1].T
    totals = [np.array([float(w.sum()) for _, w in sets]) for sets in (one, two)]
    return shared / np.maximum(totals[0][:, None] + totals[1] - shared, 1e-300)


def _links(of_pair: list[tuple[int, int, int, bytes]], least: float) -> list[tuple[int, int]]:
    """Ids that link the classes of two blocks (or of one), no more than it takes. of_pair: block, id, class, set."""
    first = of_pair[0][0]
    one = [r for r in of_pair if r[0] == first]
    two = [r for r in of_pair if r[0] != first]
    root = {r[2]: r[2] for r in of_pair}

    def top(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    out = []
    like = likenesses([_opened(r[3]) for r in one], [_opened(r[3]) for r in two] if two else None)
    two = two or one
    for i, j in np.argwhere(like >= least):
        a, b = top(one[i][2]), top(two[j][2])
        if a != b:
            root[a] = b
            out.append((one[i][1], two[j][1]))
    return out


def _compared_blocks(least: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, of_pair = None, []
        for batch in batches:
            found = []
            for pair, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if pair != last and of_pair:
                    found += _links(of_pair, least)
                    of_pair = []
                last = pair
                of_pair.append(tuple(row))
            yield _link_batch(found)
        yield _link_batch(_links(of_pair, least) if of_pair else [])

    return compare


def _link_batch(found: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b"])


def near_classes(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """id, component of every text (by its 64-bit hash) that has a near copy with another text."""
    slim = texts(docs).select(F.xxhash64("text").alias("id"), "text")
    sized = slim.withColumn("mark", F.length("text").cast("long"))
    signed = sized.mapInArrow(_banded, "id long, mark long, bands array<long>").where("bands is not null")
    rows = written(signed.select("id", "mark", F.explode("bands").alias("bucket")).distinct())
    members = written(rows.join(shared_buckets(rows), "bucket"))
    wanted = members.select("id").distinct()
    sets = slim.join(wanted, "id", "left_semi").dropDuplicates(["id"]).mapInArrow(_shingled, "id long, elements binary")
    sets = written(sets)
    one, two = (sets.select(F.col("id").alias(c), F.col("elements").alias(f"of_{c}")) for c in ("a", "b"))

    def verified(pairs: DataFrame) -> DataFrame:
        both = pairs.join(two, "b").join(one, "a").select("a", "b", "of_a", "of_b")
        return both.mapInArrow(_compared(least), "a long, b long, linked boolean")

    def compared(rows: DataFrame) -> DataFrame:
        rows = rows.join(sets, "id").select("pair", "block", "id", "class", "elements")
        rows = rows.repartition("pair").sortWithinPartitions("pair")
        return rows.mapInArrow(_compared_blocks(least), "a long, b long")

    return bucket_classes(members, verified, lambda x, y: F.lit(True), compared=compared)


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """doc_id, class_id (smallest doc_id among its copies and near copies), kept (is that one)."""
    classes = near_classes(docs, least)
    rows = texts(docs).select("doc_id", F.xxhash64("text").alias("id"))
    rows = rows.join(classes, "id", "left").select("doc_id", F.coalesce("component", "id").alias("class"))
    first = rows.groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return rows.join(first, "class").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def one_per_class(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """The rows of docs that are the first of their class: by doc_id (null last), then by the hash of the text.

    Of rows that are equal in both one stays. All columns stay.
    """
    classes = near_classes(docs, least)
    marked, h = with_text_hash(docs)
    rows = marked.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(h).alias("id"))
    rows = rows.join(classes, "id", "left").withColumn("class", F.coalesce("component", "id"))
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "id")
    first = written(rows.groupBy("class").agg(F.min(order).alias("first")).select("first.doc_id", "first.id"))
    names = {c: fresh(marked, f"_{c}") for c in first.columns}
    first = first.select(*[F.col(c).alias(n) for c, n in names.items()])
    key = F.col("doc_id").cast("long").eqNullSafe(F.col(names["doc_id"])) & (F.col(h) == F.col(names["id"]))
    turn = fresh(marked, "_turn")
    same = Window.partitionBy(names["doc_id"], names["id"]).orderBy(names["id"])
    kept = marked.join(first, key).withColumn(turn, F.row_number().over(same)).where(F.col(turn) == 1)
    return kept.select(*docs.columns)
