"""Language of whole texts: unigram piece models that sum over all segmentations.

The vocabulary is that of a public piece model; its scores aren't used. A text falls into words at white
space, each marked as the vocabulary marks the start of a word, so no piece crosses two words. Every
language has a probability per piece. A forward pass over a word adds up the probabilities of all ways
to cut it into pieces: state i is the sum, over the pieces that end at character i, of the piece's
probability times the state where it starts. The likelihood of a text is the product over its words, and
the prediction is the language with the largest posterior; score is that posterior.

Learning: the probabilities of a language are expected counts of its pieces under all segmentations of its
training words (forward and backward sums), repeated ROUNDS times from equal probabilities, and
smoothed. Words are counted and expectations added in Spark; what reaches the driver is one number per piece
and language. At most about FIT_ROWS training documents of each language teach, taken by a threshold on the hash
of their ids; the prior counts all of them. A character that no piece has is the unknown piece.

Results in special cases: a null text, or one without a letter, is `und` with score 0, and so is every text if
no document teaches; equal texts get equal results whatever their ids; ties go to the language that sorts
first; repeated rows are scored as often as they occur; a null doc_id stays null, isn't held out and may teach;
an empty table gives no rows. Long texts are scored whole, long words in time proportional to their length.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import portions, written

MARK = "▁"
UNKNOWN = 0
# About so many training documents of each language teach.
FIT_ROWS = 4_000
ROUNDS = 3
# Added to each expected count.
SMOOTHING = 0.05
# Words of up to this length are summed side by side, so many at once, longer ones alone and rescaled on the way.
SHORT, PART = 32, 4_096
# Texts are scored in portions of about so many bytes.
PORTION = 1 << 23
NO_LANGUAGE = "und"


class Vocabulary:
    """Pieces by their text, and which texts begin a piece."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.vocab_size()
        # A text that only begins a piece has no number.
        self.pieces: dict[str, int | None] = {}
        for i in range(self.size):
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                piece = model.id_to_piece(i)
                self.pieces[piece] = i
                for end in range(1, len(piece)):
                    self.pieces.setdefault(piece[:end], None)
        self.longest = max(map(len, self.pieces), default=1)


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per Python worker."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def _lattice(words: list[str], vocab: Vocabulary) -> np.ndarray:
    """Edges (end, word, start, piece) of up to PART words of up to SHORT characters, sorted by end, then word.
    Each character is at least an unknown piece."""
    get, codes = vocab.pieces.get, []
    add = codes.append
    for w, word in enumerate(words):
        n = len(word)
        for start in range(n):
            where = w << 30 | start << 24
            if get(word[start]) is None:
                add(start + 1 << 44 | where | UNKNOWN)
            for end in range(start + 1, n + 1):
                piece = get(word[start:end], -1)
                if piece is None:
                    continue
                if piece < 0:
                    break
                add(end << 44 | where | piece)
    code = np.sort(np.array(codes, np.int64))
    return np.stack([code >> 44, code >> 30 & 0x3FFF, code >> 24 & 0x3F, code & 0xFFFFFF], axis=1)


def _sums(edges: np.ndarray, p: np.ndarray, states: np.ndarray, at: int, come: int) -> None:
    """Fill states[:, at] of the words that have edges there; column `come` is where an edge leads back to."""
    if len(edges):
        values = p * states[edges[:, 1], edges[:, come]]
        starts = np.flatnonzero(np.r_[True, edges[1:, 1] != edges[:-1, 1]])
        states[edges[starts, 1], at] = np.add.reduceat(values, starts)


def forward(words: list[str], p: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Log probability of every word in every language, all segmentations summed. p: piece x language."""
    out = np.zeros((len(words), p.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) <= SHORT]
    for at in range(0, len(short), PART):
        part = short[at : at + PART]
        chosen = [words[i] for i in part]
        lengths = np.array([len(w) for w in chosen])
        states = np.zeros((len(part), lengths.max() + 1, p.shape[1]))
        states[:, 0] = 1.0
        edges = _lattice(chosen, vocab)
        bounds = np.searchsorted(edges[:, 0], np.arange(lengths.max() + 2))
        for end in range(1, lengths.max() + 1):
            rows = edges[bounds[end] : bounds[end + 1]]
            _sums(rows, p[rows[:, 3]], states, end, 2)
        out[part] = np.log(states[np.arange(len(part)), lengths])
    for i, w in enumerate(words):
        if len(w) > SHORT:
            out[i] = _long_forward(w, p, vocab)
    return out


def _long_forward(word: str, p: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """The same for one word of any length; the states within reach of a piece are kept, rescaled together."""
    reach = vocab.longest + 1
    window = np.zeros((reach, p.shape[1]))
    window[0], scale = 1.0, np.zeros(p.shape[1])
    known = vocab.pieces
    for end in range(1, len(word) + 1):
        total, alone = np.zeros(p.shape[1]), known.get(word[end - 1])
        for start in range(max(0, end - reach + 1), end):
            piece = known.get(word[start:end]) if start < end - 1 else (UNKNOWN if alone is None else alone)
            if piece is not None:
                total += window[start % reach] * p[piece]
        window[end % reach] = total
        if end % 8 == 0:
            window /= total
            scale += np.log(total)
    return np.log(window[len(word) % reach]) + scale


def expected(words: list[str], counts: np.ndarray, langs: np.ndarray, p: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Expected uses of each piece per language in words of at most SHORT characters, each of one language."""
    lengths = np.array([len(w) for w in words])
    edges, n, longest = _lattice(words, vocab), len(words), lengths.max()
    own = p[edges[:, 3], langs[edges[:, 1]]]
    ahead, back = np.zeros((n, longest + 1)), np.zeros((n, longest + 1))
    ahead[:, 0] = 1.0
    bounds = np.searchsorted(edges[:, 0], np.arange(longest + 2))
    for end in range(1, longest + 1):
        rows = slice(bounds[end], bounds[end + 1])
        _sums(edges[rows], own[rows], ahead, end, 2)
    back[np.arange(n), lengths] = 1.0
    order = np.lexsort((edges[:, 1], edges[:, 2]))
    turned, own_turned = edges[order], own[order]
    bounds = np.searchsorted(turned[:, 2], np.arange(longest + 2))
    for start in range(longest - 1, -1, -1):
        rows = slice(bounds[start], bounds[start + 1])
        _sums(turned[rows], own_turned[rows], back, start, 0)
    w = edges[:, 1]
    share = counts[w] * ahead[w, edges[:, 2]] * own * back[w, edges[:, 0]] / ahead[w, lengths[w]]
    cell = edges[:, 3] * p.shape[1] + langs[w]
    return np.bincount(cell, share, p.size).reshape(p.shape)


@dataclass(frozen=True)
class Model:
    """Languages in ascending order, their log priors, and the probability of each piece in each. key: of this model."""

    languages: list[str]
    prior: np.ndarray
    pieces: np.ndarray
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def marked_words(text: str) -> list[str]:
    return [MARK + w for w in text.split()]


def _kept_out() -> F.Column:
    """Whether a document is kept out of learning: crc32(doc_id as text) mod 5 is 0."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 5 == 0, F.lit(False))


def _word_counts(rows: DataFrame) -> DataFrame:
    """lang, word, n over the training documents; words beyond SHORT characters teach nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found.setdefault(lang, Counter()).update(w for w in marked_words(text) if len(w) <= SHORT)
            rows = [(lang, w, n) for lang, words in found.items() for w, n in words.items()]
            columns = list(zip(*rows, strict=True)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                names=["lang", "word", "n"],
            )

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expectations(words: DataFrame, languages: list[str], p: np.ndarray, path: str) -> np.ndarray:
    """Expected piece counts of all training words. Collects one number per piece and language at most."""
    number = {lang: i for i, lang in enumerate(languages)}

    def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(p.shape)
        for batch in batches:
            for at in range(0, batch.num_rows, PART):
                part = batch.slice(at, PART)
                langs = np.array([number[x] for x in part.column(0).to_pylist()])
                counts = part.column(2).to_numpy().astype(float)
                total += expected(part.column(1).to_pylist(), counts, langs, p, vocabulary(path))
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(piece, pa.int64()), pa.array(lang, pa.int64()), pa.array(total[piece, lang])],
            names=["piece", "lang_no", "n"],
        )

    parts = words.select("lang", "word", "n").mapInArrow(expect, "piece long, lang_no long, n double")
    out = np.zeros(p.shape)
    for r in parts.groupBy("piece", "lang_no").agg(F.sum("n").alias("n")).collect():
        out[r.piece, r.lang_no] = r.n
    return out


def _chosen(docs: DataFrame) -> tuple[DataFrame, list[str], np.ndarray]:
    """text and lang of the documents that teach, the languages, and how many documents each has."""
    known = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~_kept_out())
    found = sorted((r.lang, r.n) for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect())
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    part = F.lit(0.0)
    for lang, n in found:
        part = F.when(F.col("lang") == lang, min(1.0, FIT_ROWS / n)).otherwise(part)
    return known.where(place < part).select("text", "lang"), [x for x, _ in found], np.array([n for _, n in found], float)


def train(docs: DataFrame, path: str) -> Model | None:
    """The model learned from the documents that aren't held out; None if there are none."""
    rows, languages, n = _chosen(docs)
    if not languages:
        return None
    words = written(_word_counts(rows))
    vocab = vocabulary(path)
    p = np.full((vocab.size, len(languages)), 1 / vocab.size)
    for _ in range(ROUNDS):
        counts = _expectations(words, languages, p, path) + SMOOTHING
        p = counts / counts.sum(axis=0)
    return Model(languages, np.log(n / n.sum()), p)


class Scorer:
    """Log likelihoods of texts; keeps those of about `limit` words."""

    def __init__(self, model: Model, path: str, limit: int = 500_000) -> None:
        self._model, self._vocab, self._limit = model, vocabulary(path), limit
        self._number: dict[str, int] = {}
        self._values = np.zeros((1 << 16, len(model.languages)))

    def _rows(self, words: list[str]) -> np.ndarray:
        """Log likelihoods of distinct words."""
        if len(self._number) > self._limit:  # frequent words come early: keep the first half
            self._number = dict(islice(self._number.items(), self._limit // 2))
        number = list(map(self._number.get, words))
        new = [i for i, x in enumerate(number) if x is None]
        found = forward([MARK + words[i] for i in new], self._model.pieces, self._vocab)
        first = len(self._number)
        while first + len(new) > len(self._values):
            self._values = np.concatenate([self._values, np.zeros_like(self._values)])
        self._values[first : first + len(new)] = found
        for k, i in enumerate(new):
            number[i] = first + k
        out = self._values[number]
        # Long words are not kept; those after them move up.
        kept = [k for k, i in enumerate(new) if len(words[i]) < SHORT]
        self._values[first : first + len(kept)] = found[kept]
        self._number.update((words[new[k]], first + j) for j, k in enumerate(kept))
        return out

    def log_likelihoods(self, texts: pa.Array) -> np.ndarray:
        """Text x language. Texts are not null and at least one."""
        lists = pc.utf8_split_whitespace(texts)
        sizes = pc.list_value_length(lists).to_numpy()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        # The ends of a text that begins or ends with white space give empty words.
        values = self._rows(words) if words else np.zeros((0, len(self._model.languages)))
        values[[i for i, w in enumerate(words) if not w]] = 0.0
        starts = np.cumsum(sizes) - sizes
        # A text has at least one word, if only an empty one, so every sum is over its own words.
        return np.add.reduceat(values[coded.indices.to_numpy()], starts, axis=0)

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        z = self.log_likelihoods(texts) + self._model.prior
        best = z.argmax(axis=1)
        top = z[np.arange(len(z)), best]
        return [self._model.languages[i] for i in best], 1 / np.exp(z - top[:, None]).sum(axis=1)


_SCORERS: dict[str, Scorer] = {}


def scorer(model: Model, path: str) -> Scorer:
    """One per Python worker and model, so that tasks share what is known; the last model's only."""
    if model.key not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.key] = Scorer(model, path)
    return _SCORERS[model.key]


def languages(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    model = train(docs, path)
    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).select("doc_id", _kept_out().alias("held_out"), "text", F.col("text").rlike(r"\p{L}").alias("_letters"))
    if model is None:
        none = F.lit(NO_LANGUAGE).alias("lang_pred"), F.lit(0.0).alias("score")
        return slim.select("doc_id", "held_out", *none)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end in portions(pc.binary_length(batch.column(2)), PORTION):
                part = batch.slice(start, end - start)
                has = pc.fill_null(part.column(3), False)
                names = np.full(part.num_rows, NO_LANGUAGE, object)
                value, where = np.zeros(part.num_rows), has.to_numpy(zero_copy_only=False)
                if where.any():
                    names[where], value[where] = scorer(model, path).predict(part.column(2).filter(has))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(value)],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    return slim.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")
