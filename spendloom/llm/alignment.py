"""How the tokens of two tokenizers line up: inverted bitmaps of linked id pairs.

A text, with a space before it, is encoded by A (byte-level BPE) and B (pieces with a mark for the space).
Where tokens of both end, the bytes are cut into groups; all A and B tokens of a group are linked. Texts are
cut at spaces that no token of either crosses; as both end a token there, groups don't cross segments, and
each distinct segment is aligned once and kept by its worker.

Documents are numbered in blocks. For every id pair of a block there is a row of bitmaps over its
documents, one per plane: plane k has the documents whose number of links of the pair has bit k set. A
bitmap is written as a list of positions where that is shorter. The OR of the planes, popcounted and added over
blocks, is the number of documents that hold the pair; popcounts times 2^k add up to its links. The counts go
back to the rows by a join on the pair, and the postings in the bitmaps hand each document its scores.

A block has at most BLOCK documents and a bounded number of links, so no pair, however common, has more than a
row per block, and no task holds more than a block at a time.

Results in special cases: a text that is null, empty, or whose tokens don't spell the space and the
text (one with the mark character in it) has no tokens, zeros and an empty groups_sha256. Repeated rows are
documents of their own and are counted each; a null doc_id stays null; an empty table gives no rows. Long texts
are aligned whole; one beyond a block's bound is a block of its own.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import portions, texts, written

MARK = "▁"
# Documents per block, and links after which a block ends early.
BLOCK, LINKS = 4_096, 1 << 22
# Before a space that follows neither white space nor the mark, tokens of A and of B end.
SAFE = re.compile(rf"(?<=[^\s{MARK}])(?= )")
UNSAFE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}▁] "
# Segments that a worker keeps, and the characters of the longest.
KEPT, LONGEST = 500_000, 64
LIST, BITS = 0, 1


def byte_of_character() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for: printable ones for themselves,
    the others, in order, for those from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _with(rows: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """`rows`, of which `used` are in use, with more behind them; doubled where they don't fit."""
    while used + len(more) > len(rows):
        rows = np.concatenate([rows, np.zeros_like(rows)])
    rows[used : used + len(more)] = more
    return rows


class Aligner:
    """Groups and links of segments. Memory: about KEPT segments of up to LONGEST characters, one portion of texts."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        known, added = byte_of_character(), {t.content for t in self._a.get_added_tokens_decoder().values()}
        entries = {i: t.encode() if t in added else bytes(map(known.__getitem__, t)) for t, i in self._a.get_vocab().items()}
        bytes_a = [entries.get(i, b"") for i in range(max(entries) + 1)]
        bytes_b = []
        for i in range(self._b.vocab_size()):
            piece = self._b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace(MARK, " ").encode())
        self._bytes = bytes_a, bytes_b
        self._lengths = [np.array([len(x) for x in t], np.int64) for t in self._bytes]
        # Ids as text with what comes behind them: in a group, between A and B, after a group.
        n, m = len(bytes_a), len(bytes_b)
        self._said = np.array([f"{i}{c}" for c, k in ((",", n), ("|", n), (",", m), (";", m)) for i in range(k)], object)
        self._space = self._b.piece_to_id(MARK)
        self._number: dict[str, int] = {}
        self.groups: list[str] = []
        # Per segment: tokens of A (-1 where tokens don't spell it), of B, groups, links, where its links begin.
        self.sizes = np.zeros((1 << 16, 5), np.int64)
        self.links, self._used = np.zeros(1 << 18, np.int64), 0

    def _forget(self) -> None:
        """Keep the first half of the segments: frequent ones come early."""
        half = len(self.groups) // 2
        self._used = int(self.sizes[half, 4])
        self._number = {x: i for x, i in self._number.items() if i < half}
        del self.groups[half:]

    def _spelled(self, segments: list[bytes], ids: list[list[int]], side: int) -> np.ndarray:
        """Whether the tokens of each segment spell it."""
        known = self._bytes[side]
        if b"".join(map(known.__getitem__, chain.from_iterable(ids))) == b"".join(segments):
            sizes = np.fromiter((len(x) for x in segments), np.int64, len(segments))
            own = self._lengths[side][np.fromiter(chain.from_iterable(ids), np.int64)]
            counts = np.fromiter(map(len, ids), np.int64, len(ids))
            ends = np.concatenate([[0], np.cumsum(own)])[np.cumsum(counts)]
            if (ends == np.cumsum(sizes)).all():
                return np.ones(len(segments), bool)
        return np.array([b"".join(map(known.__getitem__, x)) == y for x, y in zip(ids, segments, strict=True)])

    def _add(self, segments: list[str], a: list[list[int]], b: list[list[int]]) -> None:
        """Groups of segments that have the ids a and b. All are laid end to end, and bytes count through."""
        data = [x.encode() for x in segments]
        spelled = self._spelled(data, a, 0) & self._spelled(data, b, 1)
        if not spelled.all():
            a, b = ([x if ok else [] for x, ok in zip(ids, spelled.tolist(), strict=True)] for ids in (a, b))
        n_a, n_b = (np.fromiter(map(len, ids), np.int64, len(ids)) for ids in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (a, b))
        ends_a, ends_b = (np.cumsum(own[ids]) for own, ids in zip(self._lengths, (ids_a, ids_b), strict=True))
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        in_a, in_b = (np.bincount(g, minlength=len(cuts)) for g in (group_a, group_b))
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        # Links: every A token with each B token of its group.
        times = in_b[group_a]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        links = np.repeat(ids_a << 32, times) | ids_b[np.repeat(first_b[group_a], times) + inside]
        owner_a = np.repeat(np.arange(len(a)), n_a)
        n_links = np.bincount(owner_a, times, len(a)).astype(np.int64)
        n_groups = np.bincount(owner_a, ends_a == cuts[group_a], len(a)).astype(np.int64)
        # Words of the digest, group by group: A tokens, then B tokens.
        n, m = map(len, self._bytes)
        words = np.empty(len(ids_a) + len(ids_b), np.int64)
        words[np.arange(len(ids_a)) + first_b[group_a]] = ids_a + n * (ends_a == cuts[group_a])
        words[np.arange(len(ids_b)) + (first_a + in_a)[group_b]] = 2 * n + ids_b + m * (ends_b == cuts[group_b])
        said, stops = self._said[words].tolist(), np.cumsum(n_a + n_b).tolist()
        self.groups += ["".join(said[i:j])[:-1] for i, j in zip([0, *stops], stops, strict=False)]
        at = self._used + np.cumsum(n_links) - n_links
        rows = np.stack([np.where(spelled, n_a, -1), n_b, n_groups, n_links, at], axis=1)
        self.sizes = _with(self.sizes, len(self.groups) - len(a), rows)
        self.links = _with(self.links, self._used, links)
        self._used += len(links)

    def numbers(self, segments: list[str]) -> list[int]:
        """Places of segments, each without the space that it begins with."""
        out = list(map(self._number.get, segments))
        new = [i for i, x in enumerate(out) if x is None]
        for at in range(0, len(new), 10_000):
            part = [segments[i] for i in new[at : at + 10_000]]
            spaced, first = [" " + x for x in part], len(self.groups)
            a = [x.ids for x in self._a.encode_batch_fast(spaced, add_special_tokens=False)]
            b = [x or [self._space] for x in self._b.encode(part, num_threads=1)]
            self._add(spaced, a, b)
            for place, (i, segment) in enumerate(zip(new[at : at + 10_000], part, strict=True), first):
                out[i] = place
                if len(segment) <= LONGEST:
                    self._number[segment] = place
        return out

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many segments each text has, and their places, of texts that are not empty."""
        if len(self.groups) > KEPT:
            self._forget()
        lists = pc.split_pattern(texts, " ")
        starts = pc.starts_with(texts, " ")
        if pc.any(odd := pc.or_(starts, pc.match_substring_regex(texts, UNSAFE))).as_py():
            lists = lists.to_pylist()
            for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)).tolist():
                lists[i] = [x[1:] for x in SAFE.split(" " + texts[i].as_py())]
            lists = pa.array(lists, pa.list_(pa.string()))
        coded = lists.flatten().dictionary_encode()
        place = np.array(self.numbers(coded.dictionary.to_pylist()), np.int64)
        return pc.list_value_length(lists).to_numpy(), place[coded.indices.to_numpy()]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


def packed_bitmap(positions: np.ndarray, size: int) -> bytes:
    """Ascending positions below `size` as a list of 16-bit numbers or as bits, whichever is shorter."""
    if 2 * len(positions) <= (size + 7) // 8:
        return bytes([LIST]) + positions.astype("<u2").tobytes()
    bits = np.zeros(size, np.uint8)
    bits[positions] = 1
    return bytes([BITS]) + np.packbits(bits, bitorder="little").tobytes()


def positions_of(bitmap: bytes) -> np.ndarray:
    if bitmap[0] == LIST:
        return np.frombuffer(bitmap, "<u2", offset=1).astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(bitmap, np.uint8, offset=1), bitorder="little"))


def planes(positions: np.ndarray, times: np.ndarray, size: int) -> list[bytes]:
    """Bitmaps of the bits of `times`, lowest first."""
    return [packed_bitmap(positions[times >> k & 1 == 1], size) for k in range(int(times.max()).bit_length())]


class _Block:
    """Documents and links of one block."""

    def __init__(self, number: int) -> None:
        self.number, self.documents = number, 0
        self._pairs: list[np.ndarray] = []
        self._where: list[np.ndarray] = []
        self._times: list[np.ndarray] = []
        self.links = 0

    def add(self, pairs: np.ndarray, where: np.ndarray, documents: int) -> None:
        """Links of the next documents; `where` counts from the first of them."""
        # Each document's equal pairs become one entry, so what is kept is small.
        order = np.lexsort((where, pairs))
        pairs, where = pairs[order], where[order]
        first = np.flatnonzero(np.r_[True, (pairs[1:] != pairs[:-1]) | (where[1:] != where[:-1])]) if len(pairs) else []
        self._pairs.append(pairs[first])
        self._where.append(where[first] + self.documents)
        self._times.append(np.diff(np.r_[first, len(pairs)]).astype(np.int64))
        self.documents += documents
        self.links += len(first)

    def rows(self) -> Iterator[tuple[int, int, int, list[bytes], int, int]]:
        """(a, b, block, planes, documents, links) of every pair."""
        pairs, where, times = map(np.concatenate, (self._pairs, self._where, self._times))
        order = np.argsort(pairs, kind="stable")
        pairs, where, times = pairs[order], where[order], times[order]
        starts = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]]).tolist() if len(pairs) else []
        totals = np.add.reduceat(times, starts).tolist() if starts else []
        most = np.maximum.reduceat(times, starts).tolist() if starts else []
        data = where.astype("<u2").tobytes()
        for s, e, pair, total, top in zip(starts, [*starts[1:], len(pairs)], pairs[starts].tolist(), totals, most, strict=True):
            if top == 1 and 2 * (e - s) <= (self.documents + 7) // 8:  # nearly all rows
                maps = [b"\x00" + data[2 * s : 2 * e]]
            else:
                maps = planes(where[s:e], times[s:e], self.documents)
            yield pair >> 32, pair & 0xFFFFFFFF, self.number, maps, e - s, total


_MADE = pa.schema(
    [(c, pa.int64()) for c in ("a", "b", "block", "slot", "doc_id", "n_a", "n_b", "n_groups", "n_links")]
    + [("groups_sha256", pa.string()), ("planes", pa.list_(pa.binary()))]
)
MADE = (
    "a long, b long, block long, slot long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, planes array<binary>"
)


def _table(**columns: list | np.ndarray) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _MADE], schema=_MADE
    )


def _indexed(path_a: str, path_b: str, most: int, links: int):
    """Rows of documents (with slot) and of pairs (with planes), block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 20
        block = _Block(made)
        for batch in batches:
            for start, end in portions(pc.binary_length(batch.column(1)), 1 << 22):
                for at in range(start, end, most):
                    part = batch.slice(at, min(most, end - at))
                    if block.documents + part.num_rows > most or block.links > links:
                        yield from _pair_rows(block)
                        made += 1
                        block = _Block(made)
                    yield _documents(part, block, aligner(path_a, path_b))
        yield from _pair_rows(block)

    return run


def _documents(part: pa.RecordBatch, block: _Block, align: Aligner) -> pa.RecordBatch:
    """Rows of a portion's documents; adds their links to the block."""
    n, first = part.num_rows, block.documents
    full = np.flatnonzero(pc.binary_length(part.column(1)).to_numpy())
    sums, digests = np.zeros((n, 4), np.int64), [""] * n
    pairs = where = np.empty(0, np.int64)
    if len(full):
        sizes, places = align.cut(part.column(1).take(pa.array(full)))
        starts = np.cumsum(sizes) - sizes
        each = align.sizes[places]
        spelled = np.minimum.reduceat(each[:, 0], starts) >= 0
        sums[full] = np.add.reduceat(each[:, :4], starts, axis=0) * spelled[:, None]
        order = places.tolist()
        for d, s, k, ok in zip(full.tolist(), starts.tolist(), sizes.tolist(), spelled.tolist(), strict=True):
            if ok:
                text = ";".join(map(align.groups.__getitem__, order[s : s + k]))
                digests[d] = hashlib.sha256(text.encode()).hexdigest()
        kept = np.repeat(spelled, sizes)
        count, begins = each[kept, 3], each[kept, 4]
        ends = np.cumsum(count)
        inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - count, count)
        pairs, where = align.links[np.repeat(begins, count) + inside], np.repeat(np.repeat(full, sizes)[kept], count)
    block.add(pairs, where, n)
    return _table(
        block=np.full(n, block.number), slot=np.arange(first, first + n), doc_id=part.column(0),
        n_a=sums[:, 0], n_b=sums[:, 1], n_groups=sums[:, 2], n_links=sums[:, 3], groups_sha256=digests,
    )


def _pair_rows(block: _Block) -> Iterator[pa.RecordBatch]:
    rows = []
    for row in block.rows() if block.documents else ():
        rows.append(row)
        if len(rows) == 10_000:
            yield _pair_batch(rows)
            rows = []
    if rows:
        yield _pair_batch(rows)


def _pair_batch(rows: list[tuple]) -> pa.RecordBatch:
    a, b, block, maps, documents, links = zip(*rows, strict=True)
    # The popcounts travel in the columns of a document's counts: documents in n_a, links in n_links.
    return _table(a=list(a), b=list(b), block=list(block), planes=list(maps), n_a=list(documents), n_links=list(links))


def index(
    docs: DataFrame, path_a: str, path_b: str, most: int = BLOCK, links: int = LINKS
) -> tuple[DataFrame, DataFrame]:
    """Documents (block, slot, doc_id, n_a, n_b, n_groups, n_links, groups_sha256) and postings (a, b, block,
    planes, documents, links), written. Blocks have up to `most` documents, BLOCK or fewer."""
    made = written(texts(docs).mapInArrow(_indexed(path_a, path_b, most, links), MADE))
    documents = made.where(F.col("slot").isNotNull()).drop("a", "b", "planes")
    postings = made.where(F.col("slot").isNull()).select(
        "a", "b", "block", "planes", F.col("n_a").alias("documents"), F.col("n_links").alias("links")
    )
    return documents, postings


def pair_counts(postings: DataFrame) -> DataFrame:
    """a, b, documents (that hold the pair linked), links, best (whether no pair of that a is in more documents)."""
    counts = postings.groupBy("a", "b").agg(F.sum("documents").alias("documents"), F.sum("links").alias("links"))
    top = counts.groupBy("a").agg(F.max("documents").alias("most"))
    return counts.join(top, "a").withColumn("best", F.col("documents") == F.col("most")).drop("most")


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per document of a batch's postings: links of best pairs, counts over links."""
    for batch in batches:
        block, planes_, count, best = (batch.column(i) for i in range(4))
        count, best = count.to_numpy(), best.to_numpy(zero_copy_only=False)
        flat, owner = planes_.flatten(), pc.list_parent_indices(planes_).to_numpy()
        size = pc.binary_length(flat).to_numpy()
        plane = np.arange(len(owner)) - np.searchsorted(owner, owner)
        found = [positions_of(x) for x in flat.to_pylist()]
        each = np.fromiter(map(len, found), np.int64, len(found)) if len(size) else np.empty(0, np.int64)
        slot = np.concatenate(found) if found else np.empty(0, np.int64)
        row = np.repeat(owner, each)
        times = np.repeat(1 << plane, each)
        key = block.to_numpy()[row] * BLOCK + slot
        keys, code = np.unique(key, return_inverse=True)
        sums = [np.zeros(len(keys), np.int64) for _ in range(2)]
        np.add.at(sums[0], code, times * best[row])
        np.add.at(sums[1], code, times * count[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys // BLOCK), pa.array(keys % BLOCK), pa.array(sums[0]), pa.array(sums[1])],
            names=["block", "slot", "n_best", "count_sum"],
        )


def align(docs: DataFrame, path_a: str, path_b: str, most: int = BLOCK, links: int = LINKS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every document."""
    documents, postings = index(docs, path_a, path_b, most, links)
    counts = pair_counts(postings).select("a", "b", F.col("documents").alias("count"), "best")
    known = postings.select("a", "b", "block", "planes").join(counts, ["a", "b"])
    # Rows of a block meet in one task, where the postings of a batch add up before they are shuffled on.
    near = known.select("block", "planes", "count", "best").repartition("block")
    sums = near.mapInArrow(_scored, "block long, slot long, n_best long, count_sum long")
    scores = sums.groupBy("block", "slot").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")]
    return documents.join(scores, ["block", "slot"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", *zero, "groups_sha256"
    )
