"""The pipeline stage by stage: each stage's input against its output, by brute force."""

import shutil
from collections import Counter, defaultdict
from itertools import combinations

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from llm import odd_rows
from spendloom.llm import minhash, secret_scan
from spendloom.llm.common import written

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    """Inputs and outputs of the stages on a small folder of tables with odd rows added."""
    folder = tmp_path_factory.mktemp("tables")
    shutil.copy(f"{TABLES}/labels.parquet", folder / "labels.parquet")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    odd = [(None if i is None else 10_000 + i, t) for i, t in odd_rows.odd_texts()]
    secret = [(20_000, "password = hunter2hunter2 " + odd_rows.prose(5, 60)), (20_001, "a pathetic moron, idiot and loser " + odd_rows.prose(6, 50))]
    more = odd_rows.table(spark, odd + secret).selectExpr("doc_id", "text", "lang", "kept as source", "n_chars")
    docs.unionByName(more).write.parquet(str(folder / "documents.parquet"))
    frames = [spark.read.parquet(str(folder / "documents.parquet"))]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], str(folder))))
    return [(f.columns, [r.asDict() for r in f.collect()]) for f in frames]


def test_all_but_the_last_keep_the_columns(run):
    assert all(columns == run[0][0] for columns, _ in run[:-1])


def test_toxic_documents_go_and_others_stay(run):
    before, after = (Counter((r["doc_id"], r["text"]) for r in run[i][1]) for i in (0, 1))
    gone = before - after
    assert not after - before and any(i == 20_001 for i, _ in gone) and len(gone) < 0.25 * len(before)


def test_repeated_lines_go(run):
    def normal(line):
        return " ".join("".join(c if c.isalnum() else " " for c in line.lower()).split())

    lines = Counter()
    for key in {(r["doc_id"], r["text"]) for r in run[2][1]}:
        lines.update(set(filter(None, map(normal, key[1].split("\n")))))
    assert len(run[2][1]) == len(run[1][1]) and max(lines.values()) == 1
    assert set(lines) <= {normal(x) for r in run[1][1] for x in (r["text"] or "").split("\n")}


def test_one_of_each_class_stays(run):
    texts = {r["text"] or "" for r in run[2][1]}
    sets = {t: minhash.shingles(t) for t in texts}
    root = {t: t for t in texts}

    def top(t):
        while root[t] != t:
            t = root[t]
        return t

    for a, b in combinations(sorted(texts), 2):
        if minhash.likeness(sets[a], sets[b]) >= minhash.LEAST:
            root[top(a)] = top(b)
    groups = defaultdict(list)
    for r in run[2][1]:
        groups[top(r["text"] or "")].append(r["doc_id"])
    firsts = [min((i for i in ids if i is not None), default=None) for ids in groups.values()]
    assert sorted(map(str, firsts)) == sorted(str(r["doc_id"]) for r in run[3][1])


def test_secrets_are_masked(run, spark):
    assert Counter(r["doc_id"] for r in run[4][1]) == Counter(r["doc_id"] for r in run[3][1])
    left = spark.createDataFrame([(r["doc_id"], r["text"]) for r in run[4][1]], "doc_id long, text string")
    assert secret_scan.secrets(left, ()).filter("n_assign + n_access + n_hex > 0").count() == 0
    same = {r["doc_id"]: r["text"] for r in run[3][1]}
    assert sum(same[r["doc_id"]] != r["text"] for r in run[4][1]) < 0.5 * len(same)


def test_every_id_is_packed(run):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = Counter()
    for r in run[4][1]:
        want[r["doc_id"]] += len(tokenizer.encode(r["text"], add_special_tokens=False).ids) + 1
    got = Counter()
    for r in run[5][1]:
        got[r["doc_id"]] += r["length"]
    assert got == want


def test_registered(spark):
    names = {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and entry.queries()["pipeline"] is corpus_pipeline.run
