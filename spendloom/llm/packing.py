"""Harmonic packing of documents into fixed-length sequences.

A length s belongs to class k when exactly k such pieces fit into a sequence: s in
(capacity/(k+1), capacity/k]. Every worker fills the sequences of each class with k pieces,
independently of the other workers and of the other classes. A document is cut into full sequences
and a rest; a rest that sits badly in its class is cut at the largest reciprocal capacity//(k+1),
so that the piece fills its class exactly. What a worker can't fill into whole sequences (fewer
than k pieces per class) is gathered for a block of workers and laid end to end.

Results in special cases: a null text is an empty one; an empty text has only its end id; repeated
rows are packed as often as they occur; an empty table gives no rows; a null doc_id stays null. A
very long text becomes many full sequences. Partitions must be repeatable (a file scan), as ids of
sequences derive from them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import crc32, texts, written
from spendloom.llm.tokens import encoder

CAPACITY = 2048
END_ID = 1
# Slots of a sequence that may stay empty per class; smaller rests than SMALL are not cut further.
SLACK, SMALL = CAPACITY // 48, CAPACITY // 32
# Workers whose leftovers are laid together: at most this times 10,000 pieces and 2 MB of ids.
BLOCK = 32

PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, items int, block long, ids binary"
)
PIECES = PACKED.split(", items")[0]


def cut_lengths(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(length, class) of the pieces of n ids, in order."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if rest <= SMALL * capacity // CAPACITY or capacity - k * rest <= SLACK * capacity // CAPACITY:
            out.append((rest, k))
            break
        out.append((capacity // (k + 1), k + 1))
        rest -= capacity // (k + 1)
    return out


class _Bins:
    """The open sequences of one worker: per class the pieces so far, fewer than its k."""

    def __init__(self, worker: int) -> None:
        self._next = worker << 40
        self._open: dict[int, list[tuple]] = {}
        self._block = worker // BLOCK

    def add(self, piece: tuple, k: int) -> list[tuple]:
        pieces = self._open.setdefault(k, [])
        pieces.append(piece)
        if len(pieces) < k:
            return []
        del self._open[k]
        out, offset = [], 0
        for p in pieces:
            out.append((*p[:5], self._next, offset, k, self._block, None))
            offset += p[2]
        self._next += 1
        return out

    def rest(self) -> list[tuple]:
        return [(*p[:5], None, None, k, self._block, p[5]) for k, ps in self._open.items() for p in ps]


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
    arrays = [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("items", pa.int32()), ("block", pa.int64()), ("ids", pa.binary())]
)


def _packer(path: str, capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = _Bins(TaskContext.get().partitionId())
        end = np.array([END_ID], "<u4").tobytes()
        encode = encoder(path, spaces_matter=True).encode
        for batch in batches:
            out = []
            for doc_id, data in zip(batch.column(0).to_pylist(), encode(batch.column(1)), strict=True):
                data += end
                start, n = 0, len(data) // 4
                for length, k in cut_lengths(n, capacity):
                    piece = data[4 * start : 4 * (start + length)]
                    out += bins.add((doc_id, start, length, crc32(piece), n, piece), k)
                    start += length
            yield _batch(out, _ARROW)
        yield _batch(bins.rest(), _ARROW)

    return pack


def _lay(capacity: int):
    def lay(key: tuple, table: pa.Table) -> pa.Table:
        """Leftover pieces of a block of workers end to end, cut at the ends of sequences."""
        rest = table.to_pylist()
        rest.sort(key=lambda p: (p["items"], p["doc_id"] is None, p["doc_id"] or 0, p["start"], p["ids_crc32"]))
        sequence, offset, out = (1 << 62) + (key[0].as_py() << 32), 0, []
        for p in rest:
            at = 0
            while at < p["length"]:
                length = min(p["length"] - at, capacity - offset)
                ids = p["ids"][4 * at : 4 * (at + length)]
                out.append((p["doc_id"], p["start"] + at, length, crc32(ids), p["doc_tokens"], sequence, offset))
                at, offset = at + length, offset + length
                if offset == capacity:
                    sequence, offset = sequence + 1, 0
        return pa.Table.from_batches([_batch(out, pa.schema(list(_ARROW)[:7]))])

    return lay


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    The pieces of a document cover its ids (those of the tokenizer, then END_ID) without overlap;
    the pieces of a sequence lie gapless from 0 to at most `capacity`.
    """
    packed = texts(docs).mapInArrow(_packer(tokenizer, capacity), PACKED)
    packed = written(packed)
    whole = packed.where(F.col("sequence_id").isNotNull()).select(*_ARROW.names[:7])
    rest = packed.where(F.col("sequence_id").isNull())
    return whole.unionByName(rest.groupBy("block").applyInArrow(_lay(capacity), PIECES))
