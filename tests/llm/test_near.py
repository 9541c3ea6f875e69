"""Near copies of documents, lines and vectors against brute force."""

import random
import uuid
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import odd_rows
from spendloom.llm import common, components, lines, minhash, vectors


def _smallest(ids, links):
    """Brute force: smallest id reachable."""
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return root


@pytest.mark.parametrize("links", [
    [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)], [(i, 99) for i in range(50)], [(3, 3)], [],
    [(random.Random(s).randrange(60), random.Random(-s).randrange(60)) for s in range(1, 50)],
])
def test_components(spark, links):
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {i for pair in links for i in pair}
    assert got == _smallest(ids, links)


def _edited(text, changes, seed):
    rng, w = random.Random(seed), text.split()
    for i in rng.sample(range(len(w)), changes):
        w[i] = f"new{seed}x{i}"
    return " ".join(w)


def _corpus():
    """Groups of near copies around and below the least likeness, and texts of their own."""
    base = [" ".join(odd_rows.words(100 + g, 160)) for g in range(6)]
    texts = [(1000 + g, b) for g, b in enumerate(base)]
    for g, b in enumerate(base):
        texts += [(100 * g + n, _edited(b, (0, 1, 2, 3, 5, 9)[n % 6], 50 * g + n)) for n in range(18)]
    texts += [(2000 + i, " ".join(odd_rows.words(900 + i, 80))) for i in range(40)]
    return texts + odd_rows.odd_texts()


def test_near_documents_equal_all_pairs(spark):
    texts = _corpus()
    sets = {t or "": minhash.shingles(t or "") for _, t in texts}
    distinct = sorted(sets)
    likes = {(a, b): minhash.likeness(sets[a], sets[b]) for a, b in combinations(distinct, 2)}
    sure = [p for p, x in likes.items() if x >= minhash.LEAST]
    assert sure and any(0.5 < x < 0.8 for x in likes.values())
    group = _smallest(distinct, sure)
    ids = {}
    for doc_id, t in texts:
        if doc_id is not None:
            ids.setdefault(group[t or ""], []).append(doc_id)
    rows = minhash.near_duplicates(odd_rows.table(spark, texts)).collect()
    assert len(rows) == len(texts)
    expect = sorted((str(i), str(min(ids.get(group[t or ""], [None])))) for i, t in texts)
    assert sorted((str(r.doc_id), str(r.class_id)) for r in rows) == expect
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)
    kept = minhash.one_per_class(odd_rows.table(spark, texts)).collect()
    assert len(kept) == len(set(group.values()))
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(min(ids.get(g, [None]))) for g in set(group.values()))


def test_empty_tables_have_no_classes(spark):
    assert minhash.near_duplicates(odd_rows.empty(spark)).count() == 0
    assert minhash.one_per_class(odd_rows.empty(spark)).count() == 0
    assert lines.dedup_lines(odd_rows.empty(spark)).count() == 0


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8, 0.95])
def test_collisions_estimate_weighted_likeness(share):
    rng = np.random.default_rng(5)
    pairs = []
    for _ in range(60):
        elements = rng.integers(0, 2**63, 300).astype(np.uint64)
        weights = rng.integers(1, 5, 300).astype(float)
        other = weights * np.where(rng.random(300) < share, 1, 0.3)
        pairs.append(((elements, weights), (elements, other)))
    expect = np.mean([np.minimum(a[1], b[1]).sum() / np.maximum(a[1], b[1]).sum() for a, b in pairs])
    one, two = (minhash.signatures([p[i] for p in pairs]) for i in (0, 1))
    assert abs((one == two).mean() - expect) < 0.03


def test_small_sets_meet_all_coordinates():
    tiny = [(np.array([7], np.uint64), np.array([0.01])), (np.array([7, 9], np.uint64), np.array([3, 1]))]
    assert (minhash.signatures(tiny) != 0).all()


# ---------------------------------------------------------------- lines


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def _kept(texts, hashes, linked):
    """Brute force: the first occurrence of each group of normal forms stays."""
    import re

    def normal(line):
        return " ".join(re.sub(r"[\W_]+", " ", line.lower()).split())

    order = sorted(set(texts), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1] or ""]))
    forms = {normal(x) for _, t in texts for x in (t or "").split("\n")} - {""}
    group = _smallest(forms, [p for p in combinations(sorted(forms), 2) if linked(*p)])
    seen, out = set(), {}
    for doc_id, t in order:
        stay = []
        for line in (t or "").split("\n"):
            n = normal(line)
            if not n or group[n] not in seen:
                stay.append(line)
                seen.add(group.get(n))
        out[doc_id, t] = "\n".join(stay)
    return out


def test_lines_equal_all_pairs(spark):
    long_line = " ".join(odd_rows.words(77, 120))
    near = [_edited(long_line, 1, s) for s in range(12)]
    texts = [
        (1, "Alpha beta, gamma!\nonly here one\n\nalpha BETA gamma"), (2, "alpha  beta gamma\n***\nonly here two\n***"),
        (3, long_line), *((20 + i, f"{x}\nown line {i}") for i, x in enumerate(near)), (4, "\n".join([long_line.upper()] * 3)),
        *odd_rows.odd_texts(),
    ]
    docs = odd_rows.table(spark, texts)
    forms = lines.line_table(lines.texts(docs).selectExpr("doc_id", "xxhash64(text) as h", "text"))
    sims = {r.line: r.sim for r in forms.join(lines.with_simhash(forms), "key").collect()}

    def linked(a, b):
        if a not in sims or b not in sims or (sims[a] ^ sims[b]).bit_count() > lines.DIFFER and sims[a] ^ sims[b] >= 0:
            return False
        if bin((sims[a] ^ sims[b]) & (2**64 - 1)).count("1") > lines.DIFFER:
            return False
        return 1 - _distance(a, b) / max(len(a), len(b)) >= lines.LEAST

    hashes = {r.text: r.h for r in lines.texts(docs).selectExpr("text", "xxhash64(text) as h").distinct().collect()}
    want = _kept(texts, hashes, linked)
    rows = lines.dedup_lines(docs).collect()
    assert sorted((str(r.doc_id), r.text) for r in rows) == sorted((str(i), want[i, t]) for i, t in texts)
    assert any(linked(*p) for p in combinations([x for x in sims if x.startswith(long_line.split()[0])], 2))
    again = lines.without_repeated_lines(docs)
    assert again.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in again.collect()) == sorted((str(i), want[i, t]) for i, t in texts)
    assert all(r.n_chars == len(r.text) for r in again.collect())


def test_buckets_of_one_known_class_go_no_further(spark):
    members = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (2, 10, 5), (2, 12, 5), (3, 13, 5), (3, 14, 5)], "bucket long, id long, mark int")
    known = spark.createDataFrame([(10, 10), (11, 10), (14, 14)], "id long, component long")
    got = {(r.bucket, r.id) for r in components.unsettled(members, known).collect()}
    assert got == {(2, 10), (2, 12), (3, 13), (3, 14)}
    assert components.unsettled(members, None).count() == 6


def test_passes_of_buckets_give_the_classes_of_one_pass(spark, monkeypatch):
    rng = random.Random(9)
    texts = []
    for i in range(40):
        line = "".join(rng.choice("abcdefgh ") for _ in range(90))
        for edits in (0, 1, 4):
            at = set(rng.sample(range(90), edits))
            texts.append("x" + "".join("z" if j in at else c for j, c in enumerate(line)) + "x")
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    kept = []
    for choices in (11, lines.BANDS):
        monkeypatch.setattr(lines, "PASS", choices)
        kept.append(sorted(r.doc_id for r in lines.dedup_lines(docs).collect() if r.n_kept))
    assert kept[0] == kept[1] and 40 <= len(kept[0]) < 50


def test_simhash_bits_are_majorities(spark):
    forms = spark.createDataFrame([(1, " ".join("abcdefghi")), (2, " ".join("aaaaaaabb"))], "key long, line string")
    got = {r.key: r.sim & (2**64 - 1) for r in lines.with_simhash(forms).collect()}
    hashes = {r.w: r.x & (2**64 - 1) for r in spark.createDataFrame([(c,) for c in "abcdefghi"], "w string").selectExpr("w", "xxhash64(w) as x").collect()}
    majority = sum(1 << b for b in range(64) if sum(hashes[c] >> b & 1 for c in "abcdefghi") > 4.5)
    assert got == {1: majority, 2: hashes["a"]}


def _letters_changed(line, changes, seed):
    rng, out = random.Random(seed), list(line)
    for i in rng.sample([i for i, c in enumerate(out) if c != " "], changes):
        out[i] = rng.choice([c for c in "abcdefghijklmnopqrstuvwxyz" if c != out[i]])
    return "".join(out)


def _found(spark, pairs):
    """Share of pairs that end in one class; every pair has an edit similarity of LEAST at least."""
    rows = [(2 * n + i, line) for n, pair in enumerate(pairs) for i, line in enumerate(pair)]
    assert all(1 - _distance(a, b) / max(len(a), len(b)) >= lines.LEAST for a, b in pairs)
    got = {r.id: r.component for r in lines.line_classes(spark.createDataFrame(rows, "key long, line string")).collect()}
    return sum(got.get(2 * n) == got.get(2 * n + 1) == 2 * n for n in range(len(pairs))) / len(pairs)


def test_lines_with_one_letter_changed_are_found(spark):
    bases = [" ".join(odd_rows.words(3_000 + 31 * n + i, n)) for n in (2, 3, 5, 8, 16, 30, 50) for i in range(24)]
    pairs = [(b, _letters_changed(b, 1, i)) for i, b in enumerate(bases) if len(b) >= lines.LEAST_CHARS]
    assert _found(spark, pairs) == 1.0


@pytest.mark.parametrize("share, least", [(0.02, 0.98), (0.05, 0.85)])
def test_lines_with_scattered_edits_are_found(spark, share, least):
    bases = [" ".join(odd_rows.words(5_000 + i, 8 + i % 40)) for i in range(120)]
    assert _found(spark, [(b, _letters_changed(b, max(1, int(len(b) * share)), i)) for i, b in enumerate(bases)]) >= least


# ---------------------------------------------------------------- vectors

VECTORS = "vec_id bigint, embedding array<float>, label int, unit string, component_id string"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, e, y, "u", "c") for i, e, y in rows], VECTORS)


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(11)
    rows, n = [], 0
    for y in (0, 1, 2):
        centre = rng.standard_normal(16)
        for spread in (0.0, 0.01, 0.05, 0.09):
            for _ in range(90):
                rows.append((n, (centre + spread * rng.standard_normal(16)).astype("f4").tolist(), y))
                n += 1
        for _ in range(60):
            rows.append((n, rng.standard_normal(16).astype("f4").tolist(), y))
            n += 1
    odd = [(n, None, 0), (n + 1, [], 0), (n + 2, [0.0] * 16, 0), (n + 3, [float("nan")] + [1.0] * 15, 0),
           (n + 4, [float("inf")] * 16, 1), (n + 5, [None] + [1.0] * 15, 1), (n + 6, rows[0][1], None),
           (n + 7, [1.0, 2.0], 2), (n + 8, [2.0, 4.0], 2)]
    got = {r.vec_id: r for r in vectors.near_vectors(_vectors(spark, rows + odd)).collect()}
    assert len(got) == len(rows) + len(odd)
    links = [(n + 7, n + 8)]
    for y in (0, 1, 2):
        mine = [(i, np.array(e)) for i, e, z in rows if z == y]
        x = np.stack([e / np.linalg.norm(e) for _, e in mine])
        links += [(mine[i][0], mine[j][0]) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)))]
    count = dict.fromkeys(got, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    assert {i: r.n_links for i, r in got.items()} == count
    root = _smallest(got, links)
    assert {i: r.component_id for i, r in got.items()} == root
    assert all(r.kept == (i == root[i]) for i, r in got.items())


@pytest.mark.parametrize("mean", [0.0, 0.8, 0.9])
def test_pairs_in_a_dense_label_are_found(spark, mean):
    """20,000 vectors around one direction, with 400 pairs at a cosine of 0.982."""
    rng, n, width = np.random.default_rng(7), 20_000, 64
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit(rng.standard_normal((1, width)))
    x = unit(np.sqrt(mean) * centre + np.sqrt(1 - mean) * unit(rng.standard_normal((n, width))))
    across = rng.standard_normal((400, width))
    across = unit(across - (across * x[:400]).sum(axis=1, keepdims=True) * x[:400])
    x = np.concatenate([x, 0.982 * x[:400] + np.sqrt(1 - 0.982**2) * across])
    rows = _vectors(spark, [(i, v.tolist(), 0) for i, v in enumerate(x)])
    got = {r.vec_id: r for r in vectors.near_vectors(rows).collect()}
    pairs, links = [], np.zeros(len(x), int)
    for low in range(0, len(x), 2_000):
        i, j = np.nonzero(x[low : low + 2_000] @ x.T >= 0.98)
        pairs += [(a, b) for a, b in zip((i + low).tolist(), j.tolist()) if a < b]
    for pair in pairs:
        links[list(pair)] += 1
    assert len(pairs) >= 400 and all(got[i].n_links <= k for i, k in enumerate(links))
    met = sum(got[a].component_id == got[b].component_id for a, b in pairs)
    assert met >= 0.999 * len(pairs), met


def test_no_vectors(spark):
    assert vectors.near_vectors(_vectors(spark, [])).count() == 0
    got = vectors.near_vectors(_vectors(spark, [(None, [1.0], 0), (1, [1.0], 0), (2, [3.0], 0)])).collect()
    assert {(r.vec_id, r.n_links, r.component_id, r.kept) for r in got} == {(None, 0, None, True), (1, 1, 1, True), (2, 1, 1, False)}


def test_rows_of_a_repeated_id_all_stay(spark):
    """One usable row of an id and others without a vector or a label."""
    rows = [(1, [1.0, 0.0], 0), (1, None, 0), (1, [0.0, 0.0], 0), (1, [1.0, 0.0], None), (2, [1.0, 0.01], 0), (3, None, None)]
    got = vectors.near_vectors(_vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in got) == [
        (1, 0, 1, True), (1, 0, 1, True), (1, 0, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True),
    ]


def test_vectors_of_a_repeated_id_have_links_of_their_own(spark):
    """Two vectors of one id in different directions, and one of another label."""
    rows = [(1, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 0.01], 0), (3, [1.0, 0.02], 0), (4, [0.01, 1.0], 0),
            (1, [1.0, 0.03], 1), (5, [1.0, 0.04], 1)]
    got = vectors.near_vectors(_vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.n_links) for r in got) == [(1, 1), (1, 1), (1, 2), (2, 2), (3, 2), (4, 1), (5, 1)]


def test_few_edits_are_tried_before_all(spark, monkeypatch):
    """Lines of about 300 to 3,000 characters with 1 to 5 % of their letters changed, and such with 12 %: at whichever number of
    edits the answer comes, it is the same."""
    bases = [" ".join(odd_rows.words(7_000 + i, n)) for i, n in enumerate((80, 120, 200, 800))]
    pairs = [(b, _letters_changed(b, int(len(b) * share), i)) for i, (b, share) in enumerate(zip(bases, (0.01, 0.04, 0.02, 0.05)))]
    assert _found(spark, pairs) == 1.0
    far = [(2 * n + i, x) for n, b in enumerate(bases) for i, x in enumerate((b, _letters_changed(b, int(len(b) * 0.12), n)))]
    forms = spark.createDataFrame(far, "key long, line string")
    for few in ((), (1, 5)):
        monkeypatch.setattr(lines, "FEW_EDITS", few)
        got = {r.id: r.component for r in lines.line_classes(forms).collect()}
        assert all(got.get(2 * n, 2 * n) != got.get(2 * n + 1, 2 * n + 1) for n in range(len(bases)))


def test_emptied_tables_take_no_room(spark, tmp_path):
    df = common.written(spark.range(100_000).selectExpr("xxhash64(id) as x"))
    folder = Path(df.inputFiles()[0].removeprefix("file:")).parent
    size = lambda: sum(f.stat().st_size for f in folder.iterdir())
    before = size()
    common.dropped(df, common.written(df.where("x is null")))
    assert before > 500_000 and size() < 5_000


def _rows_left(spark, folder):
    """Rows of the tables in a scratch folder, most last."""
    return sorted(spark.read.parquet(str(f)).count() for f in folder.iterdir())


def test_contraction_leaves_no_table_but_its_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 101)], "a long, b long")
    classes = components.components(links)
    assert {r.id: r.component for r in classes.collect()} == {i: 0 for i in range(51)} | {100: 100, 101: 100}
    left = _rows_left(spark, tmp_path)
    assert left[-1] == 53 and not any(left[:-1])


def test_line_classes_leave_no_table_but_their_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "scratch", lambda spark: f"{tmp_path}/{uuid.uuid4().hex}")
    bases = [" ".join(odd_rows.words(900 + i, 30)) for i in range(20)]
    rows = [(i, x) for i, x in enumerate([*bases, *(_letters_changed(b, 3, i) for i, b in enumerate(bases))])]
    forms = spark.createDataFrame(rows, "key long, line string")
    classes = lines.line_classes(forms)
    assert {r.id: r.component for r in classes.collect()} == {i: i % 20 for i in range(40)}
    left = _rows_left(spark, tmp_path)
    assert left[-1] == 40 and not any(left[:-1])


@pytest.mark.parametrize("seed", range(3))
def test_merged_classes_are_those_of_all_links(spark, seed):
    rng = random.Random(seed)
    first, then = ([(rng.randrange(40), rng.randrange(40)) for _ in range(n)] for n in (15, 12))
    links = [spark.createDataFrame(x, "a long, b long") for x in (first, then)]
    classes = components.merged(components.merged(None, links[0]), links[1]).collect()
    want = _smallest(sorted({i for x in first + then for i in x}), first + then)
    assert len(classes) == len(want) and {r.id: r.component for r in classes} == want


def test_counts_of_characters_are_compared_lane_by_lane(spark):
    """The sum of what one count is larger than the other, up to the most that are counted."""
    rng, most = random.Random(8), lines.MOST_COUNTED
    rows = [([rng.choice((0, 1, 7, most // 3, most)) if n % 9 == 0 else 0 for n in range(lines.BINS)],
             [rng.choice((0, 1, 7, most // 3, most)) if n % 9 == 0 else 0 for n in range(lines.BINS)]) for _ in range(50)]
    rows = [(a, b) for a, b in rows if sum(a) <= most and sum(b) <= most] + [([most] + [0] * 29, [0] * 30), ([0] * 30, [0, 0, most] + [0] * 27)]
    packed = [[sum(v << (lines.LANE_BITS * i) for i, v in enumerate(x[n : n + 3])) for n in range(0, 30, 3)] for r in rows for x in r]
    df = spark.createDataFrame([(n, *packed[2 * n], *packed[2 * n + 1]) for n in range(len(rows))], ["n", *(f"{e}{i}" for e in "ab" for i in range(10))])
    got = df.select("n", lines._more([(F.col(f"a{i}"), F.col(f"b{i}")) for i in range(10)]).alias("more"))
    assert {r.n: r.more for r in got.collect()} == {n: sum(max(0, x - y) for x, y in zip(a, b)) for n, (a, b) in enumerate(rows)}


def test_blocks_of_a_large_bucket_make_few_rows_and_lose_no_link(spark, monkeypatch):
    """One bucket of 300 ids, of which neighbours are linked, and a class of 200 of which one is linked to the last of them."""
    monkeypatch.setattr(components, "BLOCK", 32)
    members = [(1, i, 1) for i in range(500)] + [(2, i, 1) for i in range(0, 500, 7)]
    links, made = [(i, i + 1) for i in range(0, 300) if i % 5 and i != 299] + [(299, 400)], []
    known = spark.createDataFrame([(i, 300) for i in range(300, 500)], "id long, component long")
    linked = spark.createDataFrame(links, "a long, b long")

    def compared(rows):
        made.append(rows.count())
        two = rows.selectExpr("pair", "id as other")
        return rows.join(two, "pair").join(linked, F.expr("a = id and b = other")).select("a", "b")

    def verified(pairs):
        return pairs.join(linked.withColumn("linked", F.lit(True)), ["a", "b"], "left").fillna(False, ["linked"])

    rows = spark.createDataFrame(members, "bucket long, id long, mark long")
    got = {r.id: r.component for r in components.bucket_classes(rows, verified, lambda x, y: F.lit(True), compared=compared, known=known).collect()}
    want = _smallest(range(500), links + [(300, i) for i in range(301, 500)])
    assert {i: got.get(i, i) for i in range(500)} == want
    assert sum(made) < 500 * 500 / 8


@pytest.mark.parametrize("columns", [7, 1 << 14])
def test_likeness_of_blocks_is_that_of_pairs(monkeypatch, columns):
    monkeypatch.setattr(minhash, "COLUMNS", columns)
    rng = np.random.default_rng(3)
    sets = [(np.sort(rng.choice(60, n, replace=False)).astype(np.uint64), rng.integers(1, 4, n)) for n in (1, 5, 20, 40, 40, 60)]
    sets.append((np.empty(0, np.uint64), np.empty(0, np.int64)))
    assert minhash.likenesses(sets[:3], sets[2:]).tolist() == [[minhash.likeness(a, b) for b in sets[2:]] for a in sets[:3]]
    own = minhash.likenesses(sets)
    assert all(own[i, j] == minhash.likeness(sets[i], sets[j]) for i in range(len(sets)) for j in range(len(sets)) if i != j)


def test_counts_of_characters_spare_pairs_but_no_links(spark):
    """Lines of 10 to 300 characters, those around 64 with both n-grams too, with as many edits as a link may have."""
    rng, rows, linked = random.Random(4), [], set()
    letters = "abcdefghijklmnopqrstuvwxyz éñ𝒜1"
    for n in [*range(12, 76), 120, 300]:
        for ends in (0, 1):
            line = list("x" + "".join(rng.choice(letters) for _ in range(n - 2)) + "x")
            other = list(line)
            for at in sorted(rng.sample(range(1, n - 1), n // 10), reverse=True):
                other[at : at + 1] = [] if ends and len(other) > 10 and rng.random() < 0.7 else [rng.choice(letters)]
            linked.add((len(rows), len(rows) + 1))
            rows += [(len(rows), "".join(line)), (len(rows) + 1, "".join(other))]
    linked = {(a, b) for a, b in linked if 1 - _distance(rows[a][1], rows[b][1]) / max(len(rows[a][1]), len(rows[b][1])) >= lines.LEAST}
    far = {(a, b) for a, b in combinations(range(len(rows)), 2) if a % 8 == 0 and (a, b) not in linked}
    forms = spark.createDataFrame(rows, "key long, line string")
    pairs = spark.createDataFrame(sorted(linked | far), "a long, b long")
    got = {(r.a, r.b): r.least for r in lines.may_link(pairs, lines.with_minima(forms)).collect()}
    assert len(linked) > 100 and linked <= set(got)
    assert all(got[a, b] <= _distance(rows[a][1], rows[b][1]) for a, b in linked)
    assert len(set(got) & far) < 0.05 * len(far)


def test_edits_that_are_too_few_are_not_tried(spark, monkeypatch):
    pairs = spark.createDataFrame([("abcdefghij", "abcdefghix", 1, 1), ("abcdefghij", "abcdefgxyz", 3, 1), ("a" * 50, "a" * 46 + "bbbb", 0, 5)],
                                  "a_line string, b_line string, least int, may int")
    monkeypatch.setattr(lines, "FEW_EDITS", (2, 16))
    assert [r.linked for r in pairs.select(lines._linked().alias("linked")).collect()] == [True, False, True]
