"""Repairs against dynamic programming over all edits, on whole conversations in plain Python."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from spendloom.llm import conversations as cv
from spendloom.llm import sql

SCHEMA = "conv_id long, turn long, role string, text string, kind string, place long, block long, audit string"


def plain_damage(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv_id] += [(turn, role, text)] * (2 if kind == 3 else 1)
    md5 = lambda t: hashlib.md5(t.encode()).hexdigest()
    return {k: sorted(v, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), md5(r[2]))) for k, v in out.items()}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        said = re.findall(r"[^\x20\x09-\x0D]", text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, fault):
    """(cost, audit, repaired rows) by forward dynamic programming; states are the shape of the initials so far."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    def settled(states):
        for _ in range(4):  # inserted rows before the next one; more would come back to a state
            for q, (cost, audit, said) in list(states.items()):
                for role in ("user", "assistant"):
                    to = step.get((q, role[0]))
                    new = (cost + 3, audit + "I", [*said, (role, "")])
                    if to is not None and (to not in states or new[:2] < states[to][:2]):
                        states[to] = new
        return states

    states = {"": (0, "", [])}
    for (_, role, text), f in zip(rows, fault):
        after = {}
        for q, (cost, audit, said) in settled(states).items():
            options = [(q, 4, "D", [])]
            if f not in ("blank", "duplicate"):
                more = 3 if f == "truncated" else 0
                if role and (q, role[0]) in step:
                    options.append((step[q, role[0]], more, "K", [(role, text)]))
                options += [(step[q, x[0]], 3 + more, "R", [(x, text)]) for x in ("user", "assistant") if (q, x[0]) in step]
            for to, more, edit, row in options:
                new = (cost + more, audit + edit, said + row)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        states = after
    return min((v for q, v in settled(states).items() if q in ("", "a")), key=lambda v: v[:2])


def expected(rows):
    out = {}
    after = plain_damage(rows)
    for conv_id in {r[0] for r in rows}:
        left = after.get(conv_id, [])
        fault = faults(left)
        cost, audit, said = cheapest(left, fault)
        turns = [t for t, _, _ in left if t is not None]
        initials = [r[:1] for _, r, _ in left]
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in said).encode()).hexdigest(),
        )
    return out


def _run(spark, rows, parts=3):
    table = spark.createDataFrame([(*r, "k", 7, 8, "x") for r in rows], SCHEMA).repartition(parts)
    got = cv.repair(table).collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r)[1:] for r in got}


def _conversation(rng, conv_id, n):
    roles = ["system"] * (rng.random() < 0.3) + ["user", "assistant"] * n
    rows = []
    for turn, role in enumerate(roles[:n]):
        role = rng.choice(["user", "assistant", "system", "tool", "", None, "x"]) if rng.random() < 0.15 else role
        text = rng.choice(["Yes.", "No!", "why?", "cut off", " \t\n", "", None, "Ok.  ", "x.\x0b ", "ñ…"])
        rows.append((conv_id, rng.choice([turn, None, 3]) if rng.random() < 0.1 else turn, role, text))
    return rows


def test_search_equals_dynamic_programming():
    rng = random.Random(4)
    kinds = {"": cv.FINE, "truncated": cv.TRUNCATED, "blank": cv.DROPPED}
    for _ in range(1_500):
        n = rng.randint(0, 9)
        rows = [(0, rng.choice(["user", "assistant", "system", "tool"]), f"{i}") for i in range(n)]
        fault = [rng.choice(["", "", "truncated", "blank"]) for _ in range(n)]
        search = [(r[:1], kinds[f], 1) for (_, r, _), f in zip(rows, fault)]
        cost, audit = cv.Search(search, None).run(cv.START)
        want = cheapest(rows, fault)
        assert (cost, audit) == want[:2]
        said = [(role or rows[i][1], "" if i is None else rows[i][2]) for i, role in cv.repaired(search, audit, cv.START)]
        assert said == want[2]


def test_conversations(spark):
    rng = random.Random(7)
    rows = [r for c in range(120) for r in _conversation(rng, c, rng.randint(1, 9))]
    rows += _conversation(rng, None, 12) + [(500, None, None, None), (501, None, "user", "x" * 300_000 + ".")]
    rows += [r for c in range(600, 700) for r in _conversation(rng, c, 1)]  # some have no row left
    rows += [rows[5]] * 7 + [(800, 1, "user", "same.")] * 40 + [(800, 2, "assistant", "same.")]
    assert _run(spark, rows) == expected(rows)


@pytest.mark.parametrize("parts", [1, 4])
def test_long_conversations_are_cut_into_blocks(spark, parts):
    rng = random.Random(9)
    rows = _conversation(rng, 1, 900) + _conversation(rng, 2, 300) + _conversation(rng, 3, 65) + _conversation(rng, None, 400)
    # Texts of their own, so that rows aren't all duplicates.
    rows = [(c, t, r, x if x is None or i % 5 else f"{i} {x}.") for i, (c, t, r, x) in enumerate(rows)]
    assert _run(spark, rows, parts) == expected(rows)


def test_given_rows(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = [tuple(r) for r in given.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: tuple(r)[1:] for r in cv.repair(given).collect()}
    assert got == expected(rows)


def test_sql_says_the_same(spark):
    duckdb = pytest.importorskip("duckdb")
    rng = random.Random(12)
    rows = [r for c in range(60) for r in _conversation(rng, c, rng.randint(1, 9))]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", [*rows, (None, 1, "user", "Yes."), (None, None, "x", None)])
    got = {r[0]: r[1:] for r in con.execute(sql.OP11).fetchall()}
    assert got == expected([*rows, (None, 1, "user", "Yes."), (None, None, "x", None)])


def test_no_conversations(spark):
    assert cv.repair(spark.createDataFrame([], SCHEMA)).count() == 0
