"""What the physical plans must and must not contain, and how a hot key is spread."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import fixture
from spendloom.operators import gate, joins
from spendloom.plans.warehouse import MODELS, Warehouse


def _plan(df) -> str:
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("raw")
    raw = {}
    for name, df in fixture.raw_tables(spark, ("a", "b")).items():
        df.write.parquet(str(folder / name))
        raw[name] = spark.read.parquet(str(folder / name))
    return Warehouse(raw)


@pytest.mark.parametrize("name", sorted(MODELS))
def test_no_nested_loop_no_cartesian_no_python(stored, name):
    plan = _plan(getattr(stored, name)())
    for bad in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert bad not in plan


@pytest.mark.parametrize("name", ["authorise_actions", "check_requests", "campaign_state_replay",
                                  "ads_platform_extract", "restated_platform", "spend_trend"])
def test_gate_and_ads_plans(spark, name):
    plan = _plan(entry.queries()[name](spark, "/root/testdata/sf0.001"))
    for bad in ("NestedLoop", "CartesianProduct", "Python", "ArrowEval"):
        assert bad not in plan


def test_scans_read_only_needed_columns_and_filter_early(stored):
    plan = _plan(stored.mart_funnel())
    (crm,) = {m for m in re.findall(r"ReadSchema: struct<([^>]*order_date[^>]*)>", plan)}
    columns = {c.split(":")[0] for c in crm.split(",")}
    assert columns == {"client", "order_date", "utm_campaign", "revenue", "new_customer"}
    assert "IsNotNull(utm_campaign)" in plan
    # a model leaves alone the logs it does not need
    for model, unread in {
        "mart_approvals": ("web_sessions", "crm_orders"),
        "mart_funnel": ("gate_spend",),
        "spend_trend": ("web_sessions", "crm_orders", "gate_spend"),
    }.items():
        plan = _plan(getattr(stored, model)())
        assert not [log for log in unread if f"/{log}]" in plan], model
        assert "/platform_daily]" in plan


def test_logs_are_summed_before_they_are_shuffled(stored):
    plan = _plan(stored.fct_performance_daily())
    assert re.search(r"Exchange hashpartitioning\(campaign[^\n]*\n[^\n]*HashAggregate[^\n]*partial_sum", plan)


def _largest_share(df) -> float:
    sizes = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


@pytest.fixture()
def plain_shuffles(spark):
    """No broadcast and no runtime re-planning: only the operators themselves spread rows."""
    changed = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _half_hot(spark, n=40_000):
    hot = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500))
    return spark.range(n).select(hot.alias("k"), (F.col("id") % 97).alias("v"))


def test_lookup_spreads_a_hot_key(spark, plain_shuffles):
    big = _half_hot(spark)
    small = big.select("k").distinct().withColumn("w", F.lit(1))
    assert _largest_share(big.join(small, "k")) > 0.5
    assert _largest_share(joins.lookup(big, small, ["k"], ["v"], 64)) < 0.3


def test_fan_out_spreads_a_hot_key(spark, plain_shuffles):
    right = _half_hot(spark)
    base = right.select("k").distinct()
    unique = base.withColumn("u", F.lit(1))
    left = base.withColumn("l", F.lit(2))
    hot = joins.hot_keys(joins.row_counts(left, right, ["k"]), ["k"], 500)
    out = joins.fan_out(base, unique, left, right, ["k"], hot)
    assert out.count() == 40_000
    assert _largest_share(out) < 0.3


def test_fan_out_spreads_copies_of_one_row(spark, plain_shuffles):
    right = spark.range(40_000).select(F.lit("hot").alias("k"), F.lit(3).alias("v"))
    base = right.distinct().select("k")
    left = base.withColumn("l", F.lit(2))
    hot = joins.hot_keys(joins.row_counts(left, right, ["k"]), ["k"], 500)
    out = joins.fan_out(base, None, left, right, ["k"], hot)
    assert out.count() == 40_000 and _largest_share(out) < 0.3


def test_running_total_spreads_a_hot_key(spark, plain_shuffles):
    df = spark.range(40_000).select(
        F.lit("hot").alias("k"), (F.col("id") / 20_000).cast("int").alias("day"), F.col("id").alias("seq"),
        (F.col("id") / 500).cast("int").alias("block"),
    )
    out = joins.running_total(df, ["k"], ["day", "block"], ["seq"], "seq", "total")
    assert _largest_share(out) < 0.3
    assert out.agg(F.max("total")).collect()[0][0] == 39_999 * 40_000 // 2


def test_replay_of_a_hot_campaign_keeps_no_log_in_one_place(spark):
    plan = _plan(
        gate.replay(
            spark.createDataFrame([], "client string, at string, seq bigint, action struct<type:string, "
            "campaign:string, request_id:string, channel:string, budget:double, daily_budget:double, "
            "start:string, end:string>"),
            spark.createDataFrame([], "client string, request_id string, start_date date, end_date date"),
        )
    )
    assert "SortAggregate" not in plan and "collect_list" not in plan
    # The window holds a campaign's launches, one row each, behind the aggregate.
    assert re.search(r"Window [^\n]*\n(?:[^\n]*\n){1,4}?[^\n]*HashAggregate", plan)
