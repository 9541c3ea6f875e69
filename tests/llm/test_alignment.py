"""Alignment of two tokenizers against whole texts encoded by the libraries and plain dictionaries."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from llm import odd_rows
from spendloom.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = [" a", "a ", "  a  b ", "\n x", "a▁b", "▁", "a\x1c b", "é　 ü", "\x00 a", "<s> </s> <|endoftext|> <0x41>", "😀 😀😀",
       "it's  ok 12 3.5\r\n\t x", "ﬁ ½ Å Ａ", "z" * 300, "a " * 300, " "]


class Brute:
    """The two libraries on whole texts; token bytes from offsets of the vocabulary entries."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        # Printable Latin-1 characters are themselves; the 68 other bytes are numbered from 256.
        self.others = [x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or 174 <= x <= 255)]

    def _bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _bytes_a(self, i):
        return bytes(ord(c) if ord(c) < 256 else self.others[ord(c) - 256] for c in self.a.id_to_token(i))

    def groups(self, text):
        if not text:
            return []
        whole = " " + text
        ids_a, ids_b = self.a.encode(whole, add_special_tokens=False).ids, self.b.encode(text)
        parts = [self._bytes_a(i) for i in ids_a], [self._bytes_b(i) for i in ids_b]
        if any(b"".join(p) != whole.encode() for p in parts):
            return []
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        both = sorted(set(ends[0]) & set(ends[1]))
        cuts = [np.searchsorted(es, both, "right").tolist() for es in ends]
        out, i, j = [], 0, 0
        for x, y in zip(*cuts):
            out.append((ids_a[i:x], ids_b[j:y]))
            i, j = x, y
        return out


def expected(rows):
    brute = Brute()
    groups = [brute.groups(t) for _, t in rows]
    links = [[(x, y) for a, b in g for x in a for y in b] for g in groups]
    count = Counter(p for found in links for p in set(found))
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    out = []
    for (doc_id, _), g, found in zip(rows, groups, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append(
            (doc_id, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(found),
             sum(count[p] == top[p[0]] for p in found), sum(count[p] for p in found),
             hashlib.sha256(text.encode()).hexdigest() if g else "")
        )
    return Counter(out), count, Counter(p for found in links for p in found)


def _rows():
    return [*odd_rows.odd_texts(), *((100 + i, t) for i, t in enumerate(ODD)), *((200 + i, odd_rows.prose(i % 50, 60)) for i in range(70))]


@pytest.mark.parametrize("most, links", [(alignment.BLOCK, alignment.LINKS), (7, 500)])
def test_alignment_equals_whole_texts(spark, most, links):
    rows = _rows()
    docs = odd_rows.table(spark, rows).repartition(3)
    expect, count, times = expected(rows)
    got = alignment.align(docs, A, B, most, links).collect()
    assert Counter(tuple(r) for r in got) == expect
    _, postings = alignment.index(docs, A, B, most, links)
    pairs = {(r.a, r.b): r for r in alignment.pair_counts(postings).collect()}
    assert {p: r.documents for p, r in pairs.items()} == dict(count)
    assert {p: r.links for p, r in pairs.items()} == dict(times)
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    assert all(r.best == (r.documents == most[x]) for (x, _), r in pairs.items())


def test_planes_hold_documents_and_multiplicity():
    rng = np.random.default_rng(3)
    for size, n in ((4096, 3), (4096, 4000), (9, 9), (1, 1)):
        where = np.sort(rng.choice(size, n, replace=False))
        times = rng.integers(1, 20, n)
        maps = alignment.planes(where, times, size)
        again = np.zeros(size, np.int64)
        for k, m in enumerate(maps):
            again[alignment.positions_of(m)] += 1 << k
        assert (again[where] == times).all() and again.sum() == times.sum()
        assert all(len(m) <= 1 + (size + 7) // 8 for m in maps)


def test_segments_dropped_on_the_way(spark, monkeypatch):
    monkeypatch.setattr(alignment, "KEPT", 20)
    align = alignment.Aligner(A, B)
    brute = Brute()
    import pyarrow as pa

    for t in [odd_rows.prose(s, 90) for s in range(6)]:
        sizes, places = align.cut(pa.array([t]))
        said = ";".join(align.groups[i] for i in places.tolist())
        assert sizes.tolist() == [len(places)]
        assert said == ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute.groups(t))


def test_alignment_of_an_empty_table(spark):
    assert alignment.align(odd_rows.empty(spark), A, B).count() == 0
