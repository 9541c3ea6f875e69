"""Salted joins and running totals against plain Python."""

import random

import pytest
from pyspark.sql import functions as F

from spendloom.operators import joins
from spendloom.operators.joins import lookup, running_total

KEYS = ["a", "b"]


def hot_keys(left, right, keys, rows):
    return joins.hot_keys(joins.row_counts(left, right, keys), keys, rows)


def fan_out(base, unique, left, right, keys, rows):
    return joins.fan_out(base, unique, left, right, keys, hot_keys(left, right, keys, rows))


def _rows(rng, n, hot_share=0.4):
    """Rows with one key holding a large share, some keys missing, some keys null."""
    out = []
    for i in range(n):
        hot = rng.random() < hot_share
        a = "hot" if hot else rng.choice(["x", "y", "z", None, f"k{rng.randrange(20)}"])
        out.append((a, 1 if hot else rng.randrange(3), i % 7))
    return out


def _brute(base, unique, left, right):
    def of(rows, key):
        hits = [r[2] for r in rows if None not in key and r[:2] == key]
        return hits or [None]

    return sorted(
        (
            (b[0], b[1], b[2], u, x, y)
            for b in base
            for u in of(unique, b[:2])
            for x in of(left, b[:2])
            for y in of(right, b[:2])
        ),
        key=str,
    )


@pytest.mark.parametrize("rows", [2, 5, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_fan_out_equals_plain_left_joins(spark, rows, seed):
    rng = random.Random(seed)
    base = list({r[:2] + (c,) for r in _rows(rng, 60) for c in ("c1", "c2")})
    left, right = _rows(rng, 50), [r for r in _rows(rng, 30, 0.5) if r[0] != "x"]
    left = [r for r in left if r[0] != "y"] + [("only_left", 1, 5)] * 4
    base += [("only_left", 1, "c1"), ("nobody", 0, "c1"), (None, 2, "c1")]
    unique = [(a, b, i) for i, (a, b) in enumerate(sorted({r[:2] for r in base if r[0]})) if i % 3]
    frame = lambda data, v, t: spark.createDataFrame(data, f"a string, b int, {v} {t}").repartition(3)
    got = fan_out(
        frame(base, "c", "string"), frame(unique, "u", "int"),
        frame(left, "l", "int"), frame(right, "r", "int"), KEYS, rows,
    ).select("a", "b", "c", "u", "l", "r").collect()
    assert sorted(map(tuple, got), key=str) == _brute(base, unique, left, right)


def test_without_hot_keys_every_side_is_shuffled_once(spark):
    rng = random.Random(4)
    base = list({r[:2] + (c,) for r in _rows(rng, 40) for c in ("c1", "c2")})
    left, right, seen = _rows(rng, 30), _rows(rng, 20), _rows(rng, 40)
    frame = lambda data, v, t: spark.createDataFrame(data, f"a string, b int, {v} {t}").repartition(3)
    grouped = joins.with_hash(frame(seen, "u", "int"), KEYS).groupBy(joins.HASH, *KEYS).agg(F.sum("u").alias("u"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        out = joins.fan_out(
            frame(base, "c", "string"), grouped, frame(left, "l", "int"), frame(right, "r", "int"), KEYS, None
        ).select("a", "b", "c", "u", "l", "r")
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = out.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") == 4
    totals = {}
    for a, b, u in seen:
        totals[a, b] = totals.get((a, b), 0) + u
    assert sorted(map(tuple, got), key=str) == _brute(base, [(*k, u) for k, u in totals.items()], left, right)


def test_fan_out_spreads_exact_copies_of_a_hot_key(spark):
    left = spark.createDataFrame([("h", 1, 7)] * 400, "a string, b int, l int").repartition(4)
    one = spark.createDataFrame([("h", 1, 1)], "a string, b int, r int")
    hot = hot_keys(left, one, KEYS, 100).collect()
    assert [(r.left_slices, r.right_slices) for r in hot] == [(4, 1)]
    out = fan_out(one.select("a", "b"), one.withColumnRenamed("r", "u"), left, one, KEYS, 100)
    assert out.count() == 400


@pytest.mark.parametrize("seed", range(3))
def test_slices_do_not_depend_on_where_rows_lie(spark, seed):
    """Inputs that come in another order and other partitions each time they are read, as after a lost task."""
    rng = random.Random(seed)
    left = [("h", 1, rng.choice([1, 1, 1, 2, 3])) for _ in range(300)] + [("x", 1, 4)] * 3
    right = [("h", 1, 9)] * 40 + [("h", 1, i) for i in range(20)]
    base = [("h", 1, "c1"), ("h", 1, "c2"), ("x", 1, "c1")]
    shaken = lambda data, v, t: spark.createDataFrame(data, f"a string, b int, {v} {t}").repartition(5, F.rand()).sortWithinPartitions(F.rand())
    unique = shaken([("h", 1, 5)], "u", "int")
    out = fan_out(shaken(base, "c", "string"), unique, shaken(left, "l", "int"), shaken(right, "r", "int"), KEYS, 25)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "monotonically_increasing_id" not in plan
    want = _brute(base, [("h", 1, 5)], left, right)
    for _ in range(2):
        assert sorted(map(tuple, out.select("a", "b", "c", "u", "l", "r").collect()), key=str) == want


def test_the_heaviest_keys_are_on_the_list(spark, monkeypatch):
    monkeypatch.setattr(joins, "MOST_HOT", 2)
    rows = spark.createDataFrame([(k, 1) for k, n in (("p", 9), ("q", 5), ("r", 7)) for _ in range(n)], "a string, b int")
    got = hot_keys(rows, rows.limit(0), KEYS, 2).collect()
    assert {(r.a, r.left_slices) for r in got} == {("p", 5), ("r", 4)}


def test_hot_key_list_is_bounded(spark):
    df = spark.range(1000).select(F.lit("k").alias("a"), (F.col("id") % 100).alias("b"))
    assert hot_keys(df, df.limit(0), KEYS, 11).count() == 0
    assert hot_keys(df, df.limit(0), KEYS, 10).count() == 100  # 1000 rows / 10


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup_equals_plain_join(spark, how):
    rng = random.Random(5)
    big = spark.createDataFrame(_rows(rng, 300), "a string, b int, v int")
    small = spark.createDataFrame([("hot", 10), ("x", 20)], "a string, w int")
    plain = big.join(small, "a", how).select("a", "b", "v", "w").collect()
    got = lookup(big, small, ["a"], ["b", "v"], 4, how).select("a", "b", "v", "w").collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("rows", [3, 1000])
def test_lookup_of_many_equals_plain_join(spark, how, rows):
    rng = random.Random(6)
    big = spark.createDataFrame(_rows(rng, 300), "a string, b int, v int")
    small = spark.createDataFrame([("hot", 10), ("x", 20), ("k3", 30), (None, 40)], "a string, w int")
    plain = big.join(small, "a", how).select("a", "b", "v", "w").collect()
    got = joins.lookup_of_many(big, small, ["a"], ["b", "v"], rows, how).select("a", "b", "v", "w").collect()
    assert sorted(map(str, got)) == sorted(map(str, plain))


def test_running_total_equals_one_sorted_pass(spark):
    rng = random.Random(9)
    rows = [
        (rng.choice("pq"), rng.randrange(5), rng.randrange(4), i, rng.randrange(100))
        for i in range(300)
    ]
    want, sums = {}, {}
    for k, day, sec, i, v in sorted(rows):
        sums[k] = sums.get(k, 0) + v
        want[i] = sums[k]
    df = spark.createDataFrame(rows, "k string, day int, sec int, i int, v int")
    got = running_total(df, ["k"], ["day", "sec"], ["i"], "v", "total")
    assert {r.i: r.total for r in got.collect()} == want
