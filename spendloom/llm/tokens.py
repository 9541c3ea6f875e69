"""Token ids of whole texts with the tokenizers library, one call per distinct segment of a batch.

A text is cut where no token of the tokenizer can cross: before a space that follows a character
other than white space. The ids of a segment don't depend on its surroundings, so they are asked
for once and kept; most words of a corpus come again and again. A new segment of
Latin letters and ASCII signs falls into words at once, so the tokenizer's model is asked for these, without its other steps.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from itertools import accumulate, chain, islice
from operator import attrgetter
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

if TYPE_CHECKING:
    from tokenizers.models import Model

# White space before a space: the space may then belong to a run, and isn't a safe cut.
_RUN = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}] "
_SAFE = re.compile(r"(?<=\S)(?= )")
# Letters and signs without an apostrophe behind, in one line or more: each run is a word by itself. These letters are
# composed, and each has one lower-case letter.
_LETTERS, _SIGNS = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+", r"[!-&(-/:-@\[-`{-~]"
_PLAIN = re.compile(rf"({_LETTERS})({_SIGNS}*)((?:\n{_LETTERS}{_SIGNS}*)*)")
_LINE = re.compile(rf"\n({_LETTERS})({_SIGNS}*)")
_ID = attrgetter("id")
# Characters by which byte-level vocabularies write bytes that aren't printable.
_BYTES = dict(zip([*range(33), *range(127, 161), 173], map(chr, range(256, 256 + 68)), strict=True))
# Texts are encoded in portions of about so many bytes.
PORTION = 1 << 22


class SegmentEncoder:
    """Ids of texts. Memory: at most `limit` segments of up to 64 characters, and one portion of texts."""

    run, safe = _RUN, _SAFE
    # The tokenizer's model, where it can be asked for the ids of a word.
    _model: Model | None = None

    def __init__(self, path: str, spaces_matter: bool, limit: int = 1_000_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True
        if spaces_matter and not self._tokenizer.normalizer and isinstance(self._tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel):
            self._model = self._tokenizer.model
        self._spaces_matter = spaces_matter
        self._limit = limit
        # Ids by segment, without the space that it begins with, as little-endian 32-bit bytes.
        self._known: dict[str, bytes] = {}

    def _ids(self, segments: list[str]) -> list[bytes]:
        found = [x.ids for x in self._tokenizer.encode_batch_fast(segments, add_special_tokens=False)]
        data = np.fromiter(chain.from_iterable(found), "<u4").tobytes()
        ends = list(accumulate(4 * len(x) for x in found))
        return [data[i:j] for i, j in zip([0, *ends], ends, strict=False)]

    def _space(self, word: str) -> str:
        """A word after a space as the model gets it."""
        return f"\u0120{word}"

    def _lower(self, letters: str) -> str:
        return letters

    def _line_end(self) -> bytes:
        return array("I", map(_ID, self._model.tokenize("\u010a"))).tobytes()

    def _word_ids(self, segments: list[str]) -> list[bytes | None]:
        """Ids of segments after a space that are plain words and signs; None for others."""
        out: list[bytes | None] = [None] * len(segments)
        if self._model is None:
            return out
        tokenize, line_end, signs_of, known = self._model.tokenize, self._line_end(), {"": b""}, self._known.get

        def letters(word: str) -> str:
            return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)

        def ids(word: str) -> bytes:
            return array("I", map(_ID, tokenize(word))).tobytes()

        def of_signs(signs: str) -> bytes:
            if signs not in signs_of:
                signs_of[signs] = ids(signs)
            return signs_of[signs]

        for i, plain in enumerate(map(_PLAIN.fullmatch, segments)):
            if plain is None:
                continue
            word, signs, lines = plain.groups()
            word = self._lower(word)
            # The word may be known as a segment of its own.
            found = known(word) if word != segments[i] else None
            found = found or ids(self._space(letters(word)))
            if signs:
                found += of_signs(signs)
            if lines:
                for word, signs in _LINE.findall(lines):
                    found += line_end + ids(letters(self._lower(word))) + of_signs(signs)
            out[i] = found
        return out

    def _head_ids(self, heads: list[str]) -> list[bytes]:
        """Ids of the first segments of texts, which have no space before them."""
        return self._ids(heads)

    def _looked_up(self, segments: list[str]) -> list[bytes]:
        """Ids of segments after a space; those not known are asked for, and kept unless they are long."""
        if len(self._known) > self._limit:  # frequent segments come early: keep the first half
            self._known = dict(islice(self._known.items(), self._limit // 2))
        out = list(map(self._known.get, segments))
        new = [i for i, x in enumerate(out) if x is None]
        space = " " * self._spaces_matter
        for at in range(0, len(new), 10_000):
            part = new[at : at + 10_000]
            found = self._word_ids([segments[i] for i in part])
            rest = [n for n, x in enumerate(found) if x is None]
            for n, ids in zip(rest, self._ids([space + segments[part[n]] for n in rest]), strict=True):
                found[n] = ids
            for i, ids in zip(part, found, strict=True):
                out[i] = ids
                if len(segments[i]) <= 64:
                    self._known[segments[i]] = ids
        return out

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """First segment of each text and the end of the last, and the segments of all texts."""
        lists = pc.split_pattern(texts, " ")
        if self._spaces_matter and pc.any(runs := pc.match_substring_regex(texts, self.run)).as_py():
            lists = lists.to_pylist()
            for i in np.flatnonzero(runs.to_numpy(zero_copy_only=False)).tolist():
                head, *rest = self.safe.split(texts[i].as_py())
                lists[i] = [head, *[x[1:] for x in rest]]
            lists = pa.array(lists, pa.list_(pa.string()))
        sizes = pc.list_value_length(lists).to_numpy()
        return np.concatenate([[0], np.cumsum(sizes)]), lists.flatten()

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of each text (not null) as little-endian unsigned 32-bit bytes, in order."""
        size = np.cumsum(pc.binary_length(texts).to_numpy())
        start = 0
        while start < len(texts):
            before = size[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(size, before + PORTION)))
            data, stops = self._portion(texts[start:end])
            for i, j in zip([0, *stops], stops, strict=False):
                yield data[i:j]
            start = end

    def _portion(self, texts: pa.Array) -> tuple[bytes, list[int]]:
        """Ids of all texts together and where each text ends. Returned as a whole, so that nothing else of a
        portion is kept while its ids are used."""
        bounds, segments = self._cut(texts)
        coded = segments.dictionary_encode()
        code = coded.indices.to_numpy().astype(np.int64)
        heads = coded.dictionary.take(coded.indices.take(pa.array(bounds[:-1])))
        found = self._looked_up(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        code[bounds[:-1]] = len(found) + np.arange(len(texts))  # the first segment has no space before it
        found += self._head_ids(heads.to_pylist())
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        shift = np.cumsum(size) - size
        each = size[code]
        ends = np.cumsum(each)
        ids = flat[np.repeat(shift[code] - (ends - each), each) + np.arange(ends[-1])]
        return ids.tobytes(), (4 * ends[bounds[1:] - 1]).tolist()


class WordEndEncoder(SegmentEncoder):
    """For a vocabulary whose last piece of a word is marked: many segments are encoded in one call and
    told apart by these marks. A segment of letters is one word, one with a stop behind is two."""

    mark, stops = "</w>", frozenset(".,;:!?")

    def __init__(self, path: str) -> None:
        super().__init__(path, spaces_matter=False)
        self._model = self._tokenizer.model
        pieces = self._tokenizer.get_vocab()
        self._ends_word = np.zeros(max(pieces.values()) + 1, bool)
        self._ends_word[[i for piece, i in pieces.items() if piece.endswith(self.mark)]] = True

    def _space(self, word: str) -> str:
        return word

    def _lower(self, letters: str) -> str:
        return letters.lower()

    def _line_end(self) -> bytes:
        return b""

    def _words_of(self, segment: str) -> int:
        """Words of a segment; 0 where that isn't plain."""
        if segment.isalpha():
            return 1 if segment.lower().isalpha() else 0
        return 2 if segment[-1:] in self.stops and segment[:-1].isalpha() and segment[:-1].lower().isalpha() else 0

    def _ids(self, segments: list[str]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(segments)
        words = list(map(self._words_of, segments))
        plain = [i for i, n in enumerate(words) if n]
        rows = [plain[i : i + 500] for i in range(0, len(plain), 500)]
        texts = [[segments[i] for i in row] for row in rows]
        found = self._tokenizer.encode_batch_fast(texts, is_pretokenized=True, add_special_tokens=False)
        for row, x in zip(rows, found, strict=True):
            ids = np.array(x.ids, "<u4")
            ends = np.flatnonzero(self._ends_word[ids]) + 1
            last = np.cumsum([words[i] for i in row])
            if len(ends) == last[-1]:  # else some segment isn't what it looks like, and all go one by one
                data, stops = ids.tobytes(), (4 * ends[last - 1]).tolist()
                for i, a, b in zip(row, [0, *stops], stops, strict=False):
                    out[i] = data[a:b]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, super()._ids([segments[i] for i in rest]), strict=True):
            out[i] = ids
        return out


_ENCODERS: dict[tuple[str, bool], SegmentEncoder] = {}


def encoder(path: str, spaces_matter: bool) -> SegmentEncoder:
    """One per Python worker, so that tasks of the same worker share what is known."""
    key = (path, spaces_matter)
    if key not in _ENCODERS:
        _ENCODERS[key] = SegmentEncoder(path, True) if spaces_matter else WordEndEncoder(path)
    return _ENCODERS[key]
