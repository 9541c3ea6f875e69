"""Metric and number rules."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spendloom.functions.metrics import METRICS, metric_columns, safe_div
from spendloom.functions.values import fill, money, number_text


def test_safe_div_is_null_on_zero_and_null(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (None, 2.0), (3.0, 2.0)], "n double, d double")
    assert [r[0] for r in df.select(safe_div("n", "d")).collect()] == [None, None, None, 1.5]


def test_metrics_use_their_own_denominators(spark):
    base = spark.sql(
        "select 200D spend, 1000L impressions, 50L clicks, 40L sessions, 4L backend_orders, "
        "8D platform_conversions, 600D platform_revenue, 300D backend_revenue, 2L new_customers, "
        "100D spend_backend_window"
    )
    row = base.withColumns(metric_columns()).collect()[0]
    want = dict(cpm=200.0, ctr=0.05, cpc=4.0, cvr=0.1, cpa_platform=25.0, cpa_backend=25.0,
                roas_platform=3.0, roas_backend=1.5, cac=50.0)
    assert {m: row[m] for m in METRICS} == want


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=1, max_size=300))
def test_money_rounds_like_python(values):
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.getOrCreate()
    values = values + [1.005, 0.125, 2.675, 0.285, 1e7 + 0.005, -1.005, 0.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = {r.i: r.m for r in df.select("i", money(F.col("v")).alias("m")).collect()}
    assert got == {i: round(v, 2) for i, v in enumerate(values)}


def test_number_text_never_uses_an_exponent(spark):
    df = spark.createDataFrame([(12345678.4, 0), (-2.5, 0), (4.0, 1), (1.504, 2), (1.0, 2)], "v double, p int")
    got = [
        df.filter(F.col("p") == p).select(number_text(F.col("v"), p)).collect() for p in (0, 1, 2)
    ]
    assert [[r[0] for r in rows] for rows in got] == [["12345678.0", "-3.0"], ["4.0"], ["1.5", "1.0"]]


def test_text_is_null_when_a_part_is_null(spark):
    df = spark.sql("select 'x' a, cast(null as string) b")
    row = df.select(fill("<{a}>", a=F.col("a")), fill("{a}-{b}", a=F.col("a"), b=F.col("b"))).collect()[0]
    assert tuple(row) == ("<x>", None)
