"""Secret scans, fingerprints and the two classifiers."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import pytest
import regex
import xxhash
from pyspark.sql import functions as F

from llm import odd_rows
from spendloom.llm import common, fingerprints, quality_rules, secret_scan, toxicity

KEY = "AKIA" + "Z" * 16
SECRETS = [
    (101, f"x password = hunter2hunter2 y {KEY} z {'0a' * 20}"),
    (102, "Token: short1 and API_KEY=\"abcdefgh12\" apikey:abcdefgh"),
    (103, "token=secret: abcdefghij  token=secret=abcdefgh12"),
    (104, f"😀 né SECRET:{'q' * 9} {KEY}{KEY} AKIA AKIA1 {'f' * 31} {'f' * 32}"),
    (105, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36 + " postgres://me:pass@host xoxb-1234567890ab"),
    (106, "ſecret=abcdefghijk toKen=abcdefghij"),  # letters of other alphabets aren't letters in either case
    (107, "passwd password token secret AKI"),
]
PATTERNS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}


def _base_spans(text):
    found = []
    for n, (kind, (pattern, group, least)) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text, re.A):
            if len(m[group]) >= least:
                found.append((m.start(), n, m.end(), kind))
    return [(k, a, b) for a, _, b, k in sorted(found)]


def test_secrets_equal_a_plain_scan(spark):
    texts = SECRETS + odd_rows.odd_texts()
    rows = secret_scan.secrets(odd_rows.table(spark, texts)).collect()
    assert len(rows) == len(texts)
    expect, got = [], []
    for doc_id, text in texts:
        spans = _base_spans(text or "")
        shown = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        counts = [sum(s[0] == k for s in spans) for k in PATTERNS]
        expect.append((str(doc_id), *counts, hashlib.sha256(shown.encode()).hexdigest()))
    for r in rows:
        got.append((str(r.doc_id), r.n_assign, r.n_access, r.n_hex, r.base_sha256))
    assert sorted(got) == sorted(expect)
    more = {k.split(":")[0] for r in rows if r.doc_id == 105 for k in r.spans.split(",")}
    assert {"private_key", "repository_token", "basic_login", "chat_token"} <= more
    assert secret_scan.secrets(odd_rows.empty(spark)).count() == 0


def test_every_match_passes_its_trigram_query():
    for rule in (*secret_scan.BASE_RULES, *secret_scan.MORE_RULES):
        for _, text in SECRETS:
            for m in re.finditer(rule.regex, text, re.A):
                assert not rule.words or any(w in m[0].lower() for w in rule.words)


def test_index_intersects_and_unites(spark):
    rules = (secret_scan.Rule("two", "x", ("abcd", "wxyz")), secret_scan.Rule("one", "y", ("bcd",)))
    rows = spark.createDataFrame(
        [(1, 0, "ABCD"), (2, 0, "abc bcd"), (3, 0, "abcwxyz"), (4, 1, "bcd"), (5, 1, "wxy")], "id long, block long, text string"
    )
    found = secret_scan.candidates(secret_scan.postings(rows, rules), rules).collect()
    assert {r.id: set(r.kinds) for r in found} == {1: {"two", "one"}, 2: {"two", "one"}, 3: {"two"}, 4: {"one"}}


def test_secrets_are_masked_and_rows_stay(spark):
    texts = SECRETS + odd_rows.odd_texts()
    docs = odd_rows.table(spark, texts)
    out = secret_scan.without_secrets(docs)
    assert out.columns == docs.columns and out.count() == len(texts)
    got = {r.doc_id: r.text for r in out.collect()}
    assert got[101] == "x [secret] y [secret] z [secret]" and got[107] == SECRETS[6][1] and got[9] == odd_rows.LONG
    assert secret_scan.secrets(out, ()).filter("n_access + n_hex + n_assign > 0").count() == 0


# ---------------------------------------------------------------- fingerprints


def _edits(texts):
    order = sorted({(i, t or "") for i, t in texts}, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for n, (i, t) in enumerate(order):
        after, half = order[(n + 1) % len(order)][1], len(t) // 2
        out[i, t] = t[: len(t) - half] + after[:half]
    return out


def test_fingerprints(spark):
    texts = odd_rows.odd_texts() + [(50 + i, odd_rows.prose(20 + i, 90)) for i in range(6)]
    docs = odd_rows.table(spark, texts)
    rows = fingerprints.fingerprints(docs.repartition(3)).collect()
    edits = _edits(texts)
    assert len(rows) == len(texts)
    sha = {(str(i), len(t)): hashlib.sha256(e.encode()).hexdigest() for (i, t), e in edits.items()}
    assert all(r.edited_sha256 == sha[str(r.doc_id), r.n_chars] for r in rows)
    # The fingerprint of an edited text is that of a document with this text.
    again = spark.createDataFrame([(n, e) for n, e in enumerate(sorted(set(edits.values())))], "doc_id long, text string")
    of_text = {}
    for r, (_, e) in zip(sorted(fingerprints.fingerprints(again).collect(), key=lambda r: r.doc_id), enumerate(sorted(set(edits.values())))):
        of_text[hashlib.sha256(e.encode()).hexdigest()] = r.fingerprint
    assert all(of_text[r.edited_sha256] == r.edited_fingerprint for r in rows)
    same = {r.fingerprint for r in rows if r.doc_id in (3, 4)}
    assert len(same) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert {r.near_next for r in rows if r.doc_id == 6} == {1.0}  # an empty text before an empty one
    prose = [r for r in rows if r.doc_id and r.doc_id >= 50 and r.doc_id < 55]
    assert sum(r.near_edited for r in prose) > sum(r.near_next for r in prose)
    assert fingerprints.fingerprints(odd_rows.empty(spark)).count() == 0
    alone = fingerprints.fingerprints(odd_rows.table(spark, [(1, "one two")])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def _fingerprint(text):
    """Plain version: consistent weighted sampling term by term."""

    def uniform(h, shift):
        return ((h >> shift & (1 << 21) - 1) + 0.5) / (1 << 21)

    weights = Counter(regex.findall(r"[\p{L}\p{N}]+", text.lower()) or ([text] if text else []))
    out = []
    for j in range(fingerprints.SAMPLES):
        least = None
        for word, w in weights.items():
            term = xxhash.xxh64_intdigest(word.encode(), 42)
            seed = xxhash.xxh64_intdigest(struct.pack("<Q", term), 42)
            one, two = (xxhash.xxh64_intdigest(struct.pack("<i", n), seed) for n in (j, j + fingerprints.SAMPLES))
            r = -math.log(uniform(one, 0) * uniform(one, 21))
            c = -math.log(uniform(two, 0) * uniform(two, 21))
            b = uniform(one, 42)
            t = math.floor(math.log(w) / r + b)
            key = math.log(c) - r * (t - b) - r
            sample = (int((key + 512) * (1 << 20)), (term ^ t * fingerprints.STEP) & 0xFFFFFFFF)
            least = sample if least is None else min(least, sample)
        out.append("--------" if least is None else f"{least[1]:08x}")
    return "".join(out)


def test_fingerprints_equal_a_plain_sampler(spark):
    texts = [(0, "a b a"), (1, ""), (2, "!!! ???"), (3, "w" * 500 + " x")] + [(10 + i, odd_rows.prose(i, 30 + i)) for i in range(20)]
    texts += [(40, " ".join(["often"] * 3_000 + odd_rows.words(4, 50)))]
    edits = _edits(texts)
    for r in fingerprints.fingerprints(odd_rows.table(spark, texts)).collect():
        text = dict(texts)[r.doc_id]
        assert r.fingerprint == _fingerprint(text)
        assert r.edited_fingerprint == _fingerprint(edits[r.doc_id, text])


@pytest.mark.parametrize("reach", [0.5, 6.0])
def test_samples_beyond_reach_are_taken_again(spark, monkeypatch, reach):
    """Terms that can't give a sample are left out; texts that lose one by it are sampled over all terms."""
    texts = [(0, "a b a"), (1, ""), (2, "!!! ???")] + [(10 + i, odd_rows.prose(i, 30 + i)) for i in range(6)]
    monkeypatch.setattr(fingerprints, "REACH", reach)
    edits = _edits(texts)
    rows = fingerprints.fingerprints(odd_rows.table(spark, texts)).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = dict(texts)[r.doc_id]
        assert r.fingerprint == _fingerprint(text)
        assert r.edited_fingerprint == _fingerprint(edits[r.doc_id, text])


def test_samples_collide_as_often_as_weights_agree(spark):
    """Share of equal samples over many pairs against the generalised Jaccard similarity."""
    rng = random.Random(2)
    rows, true = [], 0.0
    for pair in range(120):
        weights = [(w, rng.choice([0, 1, 2, 5]), rng.choice([0, 1, 2, 5])) for w in range(40)]
        true += sum(min(a, b) for _, a, b in weights) / sum(max(a, b) for _, a, b in weights) / 120
        rows += [(pair, 0, pair * 1000 + w, a, b) for w, a, b in weights]
    terms = spark.createDataFrame(rows, "doc_id long, h long, term long, own int, changed int")
    near = fingerprints._sampled(terms, ["own", "changed"]).select(
        fingerprints.likeness(fingerprints._samples("own"), fingerprints._samples("changed")).alias("n")
    )
    assert abs(near.agg(F.avg("n")).first()[0] - true) < 0.04


def test_likeness_of_a_pair_is_near_its_true_value(spark):
    """Pairs of likeness 0.6 seldom read 0.8 or more, and those of 0.9 seldom below 0.8."""
    rows = []
    for pair in range(400):
        same = 6 if pair % 2 else 9  # of ten terms in either
        rows += [(pair, 0, pair * 1000 + w, 1, int(w < same * 10)) for w in range(100)]
    terms = spark.createDataFrame(rows, "doc_id long, h long, term long, own int, changed int")
    near = fingerprints._sampled(terms, ["own", "changed"]).select(
        "doc_id", fingerprints.likeness(fingerprints._samples("own"), fingerprints._samples("changed")).alias("n")
    ).collect()
    low, high = ([r.n for r in near if r.doc_id % 2 == odd] for odd in (1, 0))
    assert sum(n >= 0.8 for n in low) <= 0.01 * len(low) and sum(n < 0.8 for n in high) <= 0.03 * len(high)
    for found, true in ((low, 0.6), (high, 0.9)):
        assert (sum((n - true) ** 2 for n in found) / len(found)) ** 0.5 < 0.08


# ---------------------------------------------------------------- classifiers


def _labelled(spark, n=260):
    """Toxic texts hold an insult, poor ones are noise; every fifth row has no label."""
    rng = random.Random(4)
    docs, labels = [], []
    for i in range(n):
        text = odd_rows.prose(500 + i, rng.randint(20, 120))
        toxic, poor = i % 6 == 0, i % 4 == 1
        if toxic:
            w = text.split(" ")
            w[rng.randrange(len(w))] = rng.choice(["numbskullish", "dunderhead"])
            text = " ".join(w)
        if poor:
            text = " ".join(x + "###" for x in text.upper().split())
        docs.append((i, text))
        if i % 5:
            labels.append((i, int(not poor), int(toxic)))
    labels += [(None, 1, 1), (2, None, None), (3, 7, 7)]
    return odd_rows.table(spark, docs + odd_rows.odd_texts()[:4]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), n


@pytest.mark.parametrize("run, truth", [
    (toxicity.toxicity, lambda i: i % 6 == 0), (quality_rules.quality, lambda i: i % 4 != 1),
])
def test_classifiers_on_held_out_rows(spark, run, truth):
    docs, labels, n = _labelled(spark)
    rows = run(docs, labels).collect()
    assert len(rows) == n + 4 and all(0 <= r.score <= 1 for r in rows)
    for r in rows:
        out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2
        assert r.held_out == out
    held = [r for r in rows if r.held_out and r.doc_id >= 20]
    right = sum(r.predicted == truth(r.doc_id) for r in held)
    assert right / len(held) > 0.95


@pytest.mark.parametrize("run", [toxicity.toxicity, quality_rules.quality])
def test_classifiers_without_anything_to_learn(spark, run):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = odd_rows.table(spark, odd_rows.odd_texts())
    rows = run(docs, none).collect()
    assert len(rows) == len(odd_rows.odd_texts()) and {round(r.score, 6) for r in rows} == {0.5}
    assert run(odd_rows.empty(spark), none).count() == 0
    _, labels, _ = _labelled(spark, 30)
    one_kind = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))
    assert run(odd_rows.empty(spark), one_kind).count() == 0


def test_toxic_rows_go_and_columns_stay(spark):
    docs, labels, n = _labelled(spark)
    kept = toxicity.without_toxic(docs, docs, labels)
    ids = {r.doc_id for r in kept.collect()}
    assert kept.columns == docs.columns
    assert sum(i in ids for i in range(n) if i % 6 == 0) <= 2 and sum(i in ids for i in range(n) if i % 6) >= 0.97 * n * 5 / 6


@pytest.mark.parametrize("caps", [(24_000, 8_000), (60, 60), (300, 40)])
def test_scores_keep_the_share_of_labels_under_any_cap(spark, monkeypatch, caps):
    """One in six is toxic, half of them show it: others are toxic by one in eleven, whatever is fitted."""
    monkeypatch.setattr(toxicity, "FIT_ROWS", caps)
    docs = [(i, odd_rows.prose(900 + i, 60) + (" numbskullish" if i % 12 == 0 else "")) for i in range(720)]
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(720)] + [(9_000 + i, 1) for i in range(720)], "doc_id long, toxic int")
    scores = {r.doc_id: r.score for r in toxicity.toxicity(odd_rows.table(spark, docs), labels.where("doc_id < 9000")).collect()}
    plain = [s for i, s in scores.items() if i % 12]
    assert abs(sum(plain) / len(plain) - 1 / 11) < 0.05 and sum(x >= toxicity.THRESHOLD for x in plain) < 0.05 * len(plain)
    # Labels of documents that aren't there don't count.
    assert toxicity._documents_by_label(odd_rows.table(spark, docs), labels, "toxic") == toxicity._documents_by_label(
        odd_rows.table(spark, docs), labels.where("doc_id < 9000"), "toxic"
    )


def test_samples_are_taken_where_rows_lie(spark):
    """A threshold, no best rows of every partition: about as many as asked for, the same however rows are dealt."""
    rows = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    labels = spark.range(40_000).select(F.col("id").alias("doc_id"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    counted = toxicity._documents_by_label(rows, labels, "toxic")
    taken = [common.training_rows(rows.repartition(n), labels, "toxic", (3_000, 1_000), counted) for n in (1, 40)]
    got = [{(r.doc_id, r.label) for r in t.select("doc_id", "label").collect()} for t in taken]
    assert got[0] == got[1]
    sizes = [sum(y == label for _, y in got[0]) for label in (0, 1)]
    assert abs(sizes[0] - 3_000) < 250 and abs(sizes[1] - 1_000) < 150
    assert "TakeOrdered" not in taken[1]._jdf.queryExecution().executedPlan().toString()
    assert taken[0].sparkSession.range(5).select(F.col("id").alias("doc_id")).where(common.chosen(1.0)).count() == 5


def test_rules_are_columns(spark):
    """Scores of the compiled expression equal those of the fitted rules."""
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.random((400, len(quality_rules.NAMES)))
    y = ((x[:, 1] > 0.4) & (x[:, 4] < 0.7)).astype(float)
    model = quality_rules.fit(x, y)
    z = model.bias + sum(w * r.holds(x) for r, w in zip(model.rules, model.weights, strict=True))
    frame = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in quality_rules.NAMES))
    got = [r.s for r in frame.select(model.column().alias("s")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-z))) and ((np.array(got) > 0.5) == y).mean() > 0.97
    assert len(model.rules) < len(quality_rules.grown_rules(x, y))
