"""Sums over segmentations against plain recursion; languages of planted and given texts."""

import functools
import math

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from llm import odd_rows
from spendloom.llm import language

PATH = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["▁the", "▁ensttion", "▁漢x", "▁", "▁Çouelle.", "▁aaaaaaa", "▁😀ñ"]


def _segmentations(word, vocab):
    """All ways to cut a word, as lists of piece numbers."""

    @functools.cache
    def rest(i):
        if i == len(word):
            return [[]]
        out = []
        for j in range(i + 1, len(word) + 1):
            piece = vocab.pieces.get(word[i:j])
            if piece is None and j == i + 1:
                piece = language.UNKNOWN
            if piece is not None:
                out += [[piece, *r] for r in rest(j)]
        return out

    return rest(0)


@pytest.fixture(scope="module")
def vocab():
    return language.vocabulary(PATH)


@pytest.fixture(scope="module")
def p(vocab):
    values = np.random.default_rng(1).random((vocab.size, 3))
    return values / values.sum(axis=0)


def test_forward_sums_all_segmentations(vocab, p):
    got = language.forward(WORDS, p, vocab)
    for word, row in zip(WORDS, got):
        for g in range(3):
            total = math.fsum(math.prod(p[k, g] for k in cut) for cut in _segmentations(word, vocab))
            assert row[g] == pytest.approx(math.log(total), rel=1e-12)


def test_long_words_are_summed_too(vocab, p, monkeypatch):
    word = "▁" + "thenandñaaaaaa漢the" * 2
    alone = language._long_forward(word, p, vocab)
    monkeypatch.setattr(language, "SHORT", 60)
    assert alone == pytest.approx(language.forward([word], p, vocab)[0], rel=1e-12)
    long = "▁" + "xyzthe" * 2_000
    assert np.isfinite(language._long_forward(long, p, vocab)).all()


def test_expected_counts_equal_enumeration(vocab, p):
    counts, langs = np.arange(1.0, len(WORDS) + 1), np.arange(len(WORDS)) % 3
    got = language.expected(WORDS, counts, langs, p, vocab)
    want = np.zeros(p.shape)
    for word, n, g in zip(WORDS, counts, langs):
        cuts = _segmentations(word, vocab)
        weight = [math.prod(p[k, g] for k in cut) for cut in cuts]
        for cut, w in zip(cuts, weight):
            for k in cut:
                want[k, g] += n * w / sum(weight)
    assert np.allclose(got, want, rtol=1e-10)


def test_rounds_make_the_training_words_likelier(spark, vocab):
    words = spark.createDataFrame([("a", "▁the", 5), ("a", "▁than", 2), ("b", "▁die", 4)], "lang string, word string, n long")
    p, before = np.full((vocab.size, 2), 1 / vocab.size), -math.inf
    for _ in range(3):
        now = sum(n * language.forward([w], p, vocab)[0, g] for g, w, n in ((0, "▁the", 5), (0, "▁than", 2), (1, "▁die", 4)))
        assert now > before
        before = now
        counts = language._expectations(words, ["a", "b"], p, PATH) + 1e-9
        p = counts / counts.sum(axis=0)


def _labelled(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s") for i, t, lang in rows], "doc_id long, text string, lang string, score string")


def test_predictions(spark):
    rng = np.random.default_rng(5)
    syllables = {"x": ["the", "tion", "an", "er"], "y": ["über", "sch", "keit", "en"]}
    text = lambda lang: " ".join("".join(rng.choice(syllables[lang], 3)) for _ in range(12))
    rows = [(i, text("xy"[i % 2]), "xy"[i % 2]) for i in range(200)]
    rows += [(300, None, "x"), (301, "", "x"), (302, " 12 ... \n", "y"), (303, "ü", None), (None, text("x"), "x"),
             (304, odd_rows.LONG, None), (305, "verylong" * 20_000, None), (0, rows[0][1], None), (306, "  " + rows[1][1] + "\n", None)]
    got = language.languages(_labelled(spark, rows).repartition(3), PATH).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for i, t, lang in rows:
        r = by[i]
        assert 0 <= r.score <= 1 and r.lang_pred in ("x", "y", "und")
        if lang and t and any(c.isalpha() for c in t):
            assert r.lang_pred == lang
    assert [by[i].lang_pred for i in (300, 301, 302)] == ["und"] * 3 and by[302].score == 0.0
    assert by[303].lang_pred == "y" and by[306].lang_pred == "y"
    import zlib

    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)


def test_scorer_equals_the_sum_over_words(vocab, p):
    texts = ["the than the", " ñandú  漢字\nx ", "a", odd_rows.prose(4, 300)]
    model = language.Model(["a", "b", "c"], np.log(np.full(3, 1 / 3)), p)
    for limit in (3, 500_000):
        scorer = language.Scorer(model, PATH, limit)
        for _ in range(2):
            got = scorer.log_likelihoods(pa.array(texts))
            for t, row in zip(texts, got):
                want = language.forward(language.marked_words(t), p, vocab).sum(axis=0)
                assert row == pytest.approx(want, rel=1e-9)


def test_nothing_learned_and_empty_table(spark):
    none = language.languages(_labelled(spark, [(1, "the", None), (2, None, "x")]), PATH).collect()
    assert {(r.lang_pred, r.score) for r in none} == {("und", 0.0)}
    assert language.languages(odd_rows.empty(spark), PATH).count() == 0
