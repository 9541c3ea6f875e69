"""Token ids of a corpus in binary shards, compressed by Re-Pair grammars.

A shard holds consecutive documents in ascending doc_id order. Its ids are one sequence in which the
most frequent pairs of neighbours are replaced by new symbols, in rounds, until none is left that occurs
LEAST times; the rules (left and
right symbol of each new one) and the number of ids that every symbol expands to are stored with what
is left. Symbols never cross the end of a document, so each document is a stretch of the shard's
symbols, and one document (or any range of ids of it) is decoded without the rest of its shard.

A file of the format is Parquet with one row per shard:

  shard long                  number, ascending with doc_id
  base int                    symbols below it are ids; base + i is made by rule i
  rules binary                left and right symbol of each rule, unsigned 32-bit little-endian pairs
  spans binary                ids per rule after full expansion, unsigned 32-bit
  symbols binary              the sequence, unsigned little-endian, in as few bytes as the largest symbol takes
  symbol_bytes int            bytes of a symbol: 2, 3 or 4
  doc_ids array<long>, first array<long> (first symbol of each document), n_tokens array<long>

Files are written by Spark's committer, so that a lost executor leaves no half shard.

Results in special cases: a null text is an empty one; an empty text has only its end id; rows with
equal doc_id are ordered by text, repeated rows are written as often as they occur; null doc_ids come
first and stay null; an empty table gives no shards. A document is never split between shards, and a
very long one makes a long shard.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendloom.llm.common import crc32, scratch, texts, written
from spendloom.llm.tokens import encoder

END_ID = 1
BASE = 49_408
# Ids after which a shard is closed, and slots in which pairs are first counted together.
SHARD_IDS, SLOT_BITS = 1 << 20, 20
# A pair must occur this often to be worth a rule.
LEAST = 8

SHARDS = (
    "shard long, base int, rules binary, spans binary, symbols binary, symbol_bytes int, "
    "doc_ids array<long>, first array<long>, n_tokens array<long>"
)
_ARROW = pa.schema(
    [("shard", pa.int64()), ("base", pa.int32()), ("rules", pa.binary()), ("spans", pa.binary()),
     ("symbols", pa.binary()), ("symbol_bytes", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
     ("first", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64()))]
)


def _odd(at: np.ndarray, equal: np.ndarray) -> np.ndarray:
    """Places of equal pairs that overlap the one before: a run is paired from its left end."""
    run = at[equal]
    begins = np.ones(len(run), bool)
    begins[1:] = run[1:] != run[:-1] + 1
    start = run[begins][np.cumsum(begins) - 1] if len(run) else run
    odd = np.zeros(len(at), bool)
    odd[equal] = (run - start) % 2 == 1
    return odd


def _slots(pair: np.ndarray, salt: int) -> np.ndarray:
    mixed = (pair ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - SLOT_BITS)


def _kinds(kinds: np.ndarray, pair: np.ndarray, slot: np.ndarray, salt: int) -> np.ndarray:
    """Per pair the number of its kind, or of another one if it isn't among the (sorted) kinds."""
    of_kind = _slots(kinds, salt).astype(np.int64)
    number = np.zeros(1 << SLOT_BITS, np.int32)
    number[of_kind] = np.arange(len(kinds))
    kind = number[slot]
    lost = of_kind[number[of_kind] != np.arange(len(kinds))]
    if len(lost):  # slots of two kinds or more
        several = np.zeros(1 << SLOT_BITS, bool)
        several[lost] = True
        search = np.flatnonzero(several[slot])
        kind[search] = np.minimum(np.searchsorted(kinds, pair[search]), len(kinds) - 1)
    return kind


def compress(ids: np.ndarray, ends: np.ndarray, base: int = BASE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """symbols, first symbol of each document, rules (n x 2), ids per rule.

    ends: position after each document's last id. Pairs across documents are never replaced. Rounds go on
    until no pair occurs LEAST times. A round replaces every pair that does, each place by the pair that
    is more frequent than its neighbours (by powers of two; among equals a hash decides, so that
    long repeats are halved and not eaten from one end); a pair left with fewer than LEAST places waits.
    The most frequent pair keeps all of its places, so every round makes a rule. A pair that is rare stays
    rare, so later rounds only look at frequent pairs and at those with a new symbol.
    """
    symbols = ids.astype(np.uint32)
    last = np.zeros(len(symbols), bool)
    last[ends - 1] = True
    rules, size, turn = [], np.ones(base, np.int64), 0
    active = ~last  # the pair of this place and the next may be frequent
    while True:
        at = np.flatnonzero(active)
        pair = symbols[at].astype(np.uint64) << np.uint64(32) | symbols[at + 1]
        odd = _odd(at, symbols[at] == symbols[at + 1])
        # A slot holds all places of its pairs: where it has few, its pairs are rare.
        slot = _slots(pair, turn).astype(np.int64)
        counted = slot[~odd] if odd.any() else slot
        full = np.bincount(counted, minlength=1 << SLOT_BITS) >= LEAST
        likely = np.flatnonzero(full[slot])
        at, pair, odd, slot = at[likely], pair[likely], odd[likely], slot[likely]
        kinds, count = np.unique(pair[~odd], return_counts=True)
        kinds, count = kinds[count >= LEAST], count[count >= LEAST]
        if not len(kinds):
            break
        kind = _kinds(kinds, pair, slot, turn)
        often = np.flatnonzero(kinds[kind] == pair)
        at, odd, kind = at[often], odd[often], kind[often]
        rank = np.empty(len(kinds), np.int32)
        rank[np.lexsort((_slots(kinds, turn + 1), -np.frexp(count)[1]))] = np.arange(len(kinds))
        none = np.int32(len(kinds))
        ranks = np.full(len(symbols) + 2, none)
        ranks[at + 1] = np.where(odd, none, rank[kind])
        here = ranks[at + 1]
        wins = (here < ranks[at]) & (here < ranks[at + 2])
        made = np.bincount(kind[wins], minlength=len(kinds)) >= LEAST
        wins &= made[kind]
        number = len(size) + np.cumsum(made) - 1
        parts = np.stack([kinds[made] >> np.uint64(32), kinds[made] & np.uint64(0xFFFFFFFF)], 1).astype(np.int64)
        rules.append(parts)
        size = np.concatenate([size, size[parts].sum(axis=1)])
        where = at[wins]
        symbols[where] = number[kind[wins]]
        last[where] = last[where + 1]
        active[:] = False
        active[at] = True
        active[where] = True
        stay = np.ones(len(symbols), bool)
        stay[where + 1] = False
        stay = np.flatnonzero(stay)
        moved = where - np.arange(len(where))  # places of the new symbols once the others close up
        symbols, last, active = symbols[stay], last[stay], active[stay]
        active[np.maximum(moved - 1, 0)] = True
        active &= ~last
        turn += 1
    first = np.concatenate([[0], np.flatnonzero(last)[:-1] + 1]) if len(symbols) else np.empty(0, np.int64)
    return symbols.astype(np.int64), first, np.concatenate([np.empty((0, 2), np.int64), *rules]), size[base:]


class Grammar:
    """Rules of a shard, each expanded once, for decoding stretches of its symbols."""

    def __init__(self, rules: np.ndarray, spans: np.ndarray, base: int) -> None:
        self._base = base
        # Where the expansion of each symbol lies in `_ids`: first the ids themselves, then rule by rule.
        self._size = np.concatenate([np.ones(base, np.int64), spans])
        self._at = np.cumsum(self._size) - self._size
        self._ids = np.empty(int(self._size.sum()), "<u4")
        self._ids[:base] = np.arange(base)
        depth = np.zeros(len(self._size), np.int64)
        while (deeper := depth[rules].max(axis=1, initial=0) + 1).any() and (deeper != depth[base:]).any():
            depth[base:] = deeper
        for level in range(1, int(depth.max(initial=0)) + 1):  # its parts are of lower levels, expanded before
            at = np.flatnonzero(depth[base:] == level)
            left, right = rules[at].T
            for part, to in ((left, self._at[base + at]), (right, self._at[base + at] + self._size[left])):
                size = self._size[part]
                within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                self._ids[np.repeat(to, size) + within] = self._ids[np.repeat(self._at[part], size) + within]

    def sizes(self, symbols: np.ndarray) -> np.ndarray:
        return self._size[symbols]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        size = self._size[symbols]
        shift = self._at[symbols] - (np.cumsum(size) - size)
        return self._ids[np.repeat(shift, size) + np.arange(int(size.sum()))]

    def id_range(self, symbols: np.ndarray, start: int, length: int) -> np.ndarray:
        """ids start .. start + length of a document; only symbols that reach into it are expanded."""
        ends = np.cumsum(self._size[symbols])
        lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + length, "left") + 1
        before = int(ends[lo - 1]) if lo else 0
        return self.expand(symbols[lo:hi])[start - before : start - before + length]


def _narrow(symbols: np.ndarray, each: int) -> bytes:
    return symbols.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :each].tobytes()


def _widened(data: bytes, each: int) -> np.ndarray:
    whole = np.zeros((len(data) // each, 4), np.uint8)
    whole[:, :each] = np.frombuffer(data, np.uint8).reshape(-1, each)
    return whole.reshape(-1).view("<u4").astype(np.int64)


def _shard(number: int, doc_ids: list, data: list[bytes]) -> pa.RecordBatch:
    lengths = np.array([len(x) // 4 for x in data], np.int64)
    ids = np.frombuffer(b"".join(data), "<u4")
    symbols, first, rules, spans = compress(ids, np.cumsum(lengths))
    each = max(2, (int(symbols.max(initial=0)).bit_length() + 7) // 8)
    row = (number, BASE, rules.astype("<u4").tobytes(), spans.astype("<u4").tobytes(),
           _narrow(symbols, each), each, doc_ids, first, lengths)
    return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _ARROW, strict=True)], schema=_ARROW)


def _sharder(path: str):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        end = np.array([END_ID], "<u4").tobytes()
        encode = encoder(path, spaces_matter=False).encode
        doc_ids, data, size = [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                doc_ids.append(doc_id)
                data.append(ids + end)
                size += len(ids) // 4 + 1
                if size >= SHARD_IDS:
                    yield _shard(number, doc_ids, data)
                    number, doc_ids, data, size = number + 1, [], [], 0
        if doc_ids:
            yield _shard(number, doc_ids, data)

    return shards


def write_tokens(docs: DataFrame, tokenizer: str, path: str) -> None:
    """Shards of all documents in ascending doc_id order."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = texts(docs).repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(_sharder(tokenizer), SHARDS).write.parquet(path)


def _opened(row: dict) -> tuple[Grammar, np.ndarray]:
    rules = np.frombuffer(row["rules"], "<u4").astype(np.int64).reshape(-1, 2)
    spans = np.frombuffer(row["spans"], "<u4").astype(np.int64)
    return Grammar(rules, spans, row["base"]), _widened(row["symbols"], row["symbol_bytes"])


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document of a shard its ids' number and crc32, of the decoded ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            grammar, symbols = _opened(row)
            ends = np.cumsum(grammar.sizes(symbols))
            first = np.array(row["first"], np.int64)
            start = np.where(first > 0, ends[first - 1], 0) if len(first) else first
            counts = np.diff(np.append(start, ends[-1] if len(ends) else 0))
            data = memoryview(grammar.expand(symbols).tobytes())
            crcs = [crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(start.tolist(), counts.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * len(crcs), pa.int64()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                names=["shard", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """shard, doc_id, within (ids before it in its shard), n_tokens, ids_crc32 of every document."""
    files = spark.read.schema(SHARDS).parquet(path)
    return files.mapInArrow(_read, "shard long, doc_id long, within long, n_tokens long, ids_crc32 long")


def token_index(docs: DataFrame, tokenizer: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from files written and read back."""
    spark = docs.sparkSession
    path = scratch(spark)
    write_tokens(docs, tokenizer, path)
    read = written(read_tokens(spark, path))
    # Ids before each shard: sums over the shards of a writer, then over the writers.
    writer = F.shiftright("shard", 32)
    shards = read.groupBy("shard", writer.alias("writer")).agg(F.sum("n_tokens").alias("n"))
    earlier = Window.partitionBy("writer").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("of_writer", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    writers = shards.groupBy("writer").agg(F.sum("n").alias("n"))
    before = Window.orderBy("writer").rowsBetween(Window.unboundedPreceding, -1)
    writers = writers.select("writer", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("of_all"))
    shards = shards.join(writers, "writer").select("shard", (F.col("of_writer") + F.col("of_all")).alias("before"))
    return read.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32"
    )
