"""SentencePiece encoding and decoding by a Viterbi search that words with a common prefix share.

White space is marked, a mark is put before the text, and the text falls into marked words: no piece has
a mark after another character, so words are encoded one by one. The distinct words of a portion of
texts are sorted, which puts them in the order of a depth-first walk through their trie. The walk keeps
the forward states of the path to the current node: for every prefix the best piece that ends there. The
next word takes over the states of the prefix it shares with the last one and computes the others only.

The model merges pieces by rank (BPE), so the sum of piece scores isn't what it maximises, and a search for
the largest sum gives other ids than the library. The search therefore scores a path by its pairs of
neighbours: 0 if merging their text leaves them as they are, minus infinity if not. A sequence of pieces is
the model's own exactly if all its pairs are, so the best path is the model's encoding, and every prefix has one
state. Characters that no piece has are spelled as their bytes.

Results in special cases: a null text is an empty one, which has no ids and is decoded as empty; equal
texts have equal ids; null doc_ids stay null; repeated rows are encoded as often as they occur; an
empty table gives no rows. Texts come back as they were, but for the mark character itself, which comes
back as a space. Very long words are searched like others, in time proportional to their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import crc32, texts
from spendloom.llm.tokens import SegmentEncoder

MARK = "▁"


class Pieces:
    """The vocabulary of a model file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids = [0] * 256
        for i in range(model.vocab_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes_of.append(b"")
            else:
                self.rank[piece], self.ids[piece] = model.get_score(i), i
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        # How long pieces are by their last three characters; others have two at most.
        self.reach: dict[str, int] = {}
        for piece in self.rank:
            self.reach[piece[-3:]] = max(len(piece), self.reach.get(piece[-3:], 0))

    def merged(self, text: str) -> list[str]:
        """Pieces of a short text by merging: best rank first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            found = [(-self.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.rank]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def spelled(self, piece: str) -> list[int]:
        """Ids of a piece; the bytes of a character that isn't one."""
        i = self.ids.get(piece)
        return [i] if i is not None else [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]


class PrefixSearch:
    """Encodes sorted words, sharing the forward states of common prefixes."""

    def __init__(self, pieces: Pieces, limit: int = 300_000) -> None:
        self._pieces = pieces
        self._limit = limit
        # Whether two neighbours stay as they are; by their text and where it is cut.
        self._stays: dict[tuple[str, str], bool] = {}
        self._id_bytes: dict[str, bytes] = {}

    def _pair_stays(self, a: str, b: str) -> bool:
        known = self._stays.get((a, b))
        if known is None:
            if len(self._stays) > self._limit:
                self._stays.clear()
            known = self._stays[(a, b)] = self._pieces.merged(a + b) == ([a, b] if a else [b])
        return known

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of words in ascending order, as little-endian 32-bit bytes."""
        rank, reach, stays, pair_stays = self._pieces.rank, self._pieces.reach, self._stays, self._pair_stays
        # last[i]: the piece that ends at i on the best path to i.
        last, before, out = [""], "", []
        for word in words:
            same, end = 0, min(len(word), len(before))
            while same < end and word[same] == before[same]:
                same += 1
            del last[same + 1 :]
            for i in range(same + 1, len(word) + 1):
                far = i - reach.get(word[i - 3 : i], 2) if i > 2 else 0
                for j in range(far if far > 0 else 0, i):
                    piece = word[j:i]
                    if piece in rank or j == i - 1:
                        known = stays.get((last[j], piece))
                        if known or (known is None and pair_stays(last[j], piece)):
                            last.append(piece)
                            break
            before = word
            out.append(self._path(last, len(word)))
        return out

    def _path(self, last: list[str], i: int) -> bytes:
        path = []
        while i:
            piece = last[i]
            data = self._id_bytes.get(piece)
            if data is None:
                data = self._id_bytes[piece] = np.array(self._pieces.spelled(piece), "<u4").tobytes()
            path.append(data)
            i -= len(piece)
        return b"".join(reversed(path))


class PieceEncoder(SegmentEncoder):
    """Ids of texts; words of a portion are looked up once and searched in sorted order."""

    run, safe = f"^ |[ {MARK}] ", re.compile(f"(?<=[^ {MARK}])(?= )")

    def __init__(self, path: str, limit: int = 500_000) -> None:
        self.pieces = Pieces(path)
        self._search = PrefixSearch(self.pieces)
        self._spaces_matter, self._limit, self._known = True, limit, {}

    def _ids(self, segments: list[str]) -> list[bytes]:
        marked = [s.replace(" ", MARK) for s in segments]
        order = sorted(range(len(marked)), key=marked.__getitem__)
        out = [b""] * len(marked)
        for i, ids in zip(order, self._search.encode([marked[i] for i in order]), strict=True):
            out[i] = ids
        return out

    def _head_ids(self, heads: list[str]) -> list[bytes]:
        return self._ids([" " + h for h in heads])

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        for text, ids in zip(texts, super().encode(texts), strict=True):
            yield ids if len(text.as_buffer()) else b""


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, text_sha256, ids (little-endian unsigned 32-bit) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = pa.array(list(coder.encode(part.column(2))), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids], names=["doc_id", "text_sha256", "ids"])

    slim = texts(docs).select("doc_id", F.sha2("text", 256).alias("text_sha256"), "text")
    return slim.mapInArrow(run, "doc_id long, text_sha256 string, ids binary")


def decoded(ids: bytes, bytes_of: list[bytes]) -> str:
    """The text of ids; the mark before it is taken away."""
    text = b"".join(map(bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """doc_id, text_sha256, n_tokens, ids_crc32 and the decoded text of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bytes_of = encoder(model).pieces.bytes_of
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = part.column(2).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([crc32(x) for x in ids], pa.int64()),
                        pa.array([decoded(x, bytes_of) for x in ids], pa.string()),
                    ],
                    names=["doc_id", "text_sha256", "n_tokens", "ids_crc32", "text"],
                )

    return encoded.mapInArrow(run, "doc_id long, text_sha256 string, n_tokens long, ids_crc32 long, text string")


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, decoded_sha256, same (whether the text came back) of every document."""
    back = decode(encode(docs, model), model).withColumn("decoded_sha256", F.sha2("text", 256))
    return back.select(
        "doc_id", "n_tokens", "ids_crc32", "decoded_sha256", (F.col("decoded_sha256") == F.col("text_sha256")).alias("same")
    )
