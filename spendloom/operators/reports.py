"""Report queries: the cumulative trend and the sorted result sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendloom.functions.values import exact_sum
from spendloom.operators.marts import ALL_CHANNELS
from spendloom.sources.scratch import written


def spend_trend(fact: DataFrame) -> DataFrame:
    """Cumulative plan and spend per client and day; spend is null on a day nobody reported.

    The fact is summed to one row per client and day before the window runs, so a window
    holds a calendar, not a log.
    """
    daily = fact.groupBy("client", "date").agg(
        exact_sum("planned_spend").alias("planned"),
        exact_sum("spend").alias("spent"),
        F.bool_or("has_platform_data").alias("reported"),
    )
    w = (
        W.partitionBy("client")
        .orderBy(F.col("date").asc_nulls_last())
        .rangeBetween(W.unboundedPreceding, W.currentRow)
    )
    running = lambda c: F.sum(F.col(c).cast("decimal(24,6)")).over(w).cast("double")
    return daily.select(
        "client",
        "date",
        running("planned").alias("plan_cum"),
        F.when(F.col("reported"), running("spent")).alias("spend_cum"),
    )


def _asc(*names: str):
    return [F.col(n).asc_nulls_last() for n in names]


def report_order(name: str) -> list[Column]:
    """What a result set is sorted by; the last columns tell rows apart that are otherwise equal."""
    by = {
        "mart_campaign_performance": _asc("channel", "campaign", "request_id"),
        "mart_channel_performance": [F.col("spend").desc_nulls_last(), *_asc("channel")],
        "mart_channel_daily": _asc("date", "channel"),
        "mart_funnel": [(F.col("level") == ALL_CHANNELS).desc_nulls_last(), F.col("spend").desc_nulls_last(), *_asc("level")],
        "mart_approvals": _asc("request_id"),
        "mart_alerts": _asc("severity", "rule", "campaign", "channel", "detail"),
        "mart_reconciliation": _asc("campaign", "channel", "request_id"),
        "mart_freshness": _asc("source"),
        "spend_trend": _asc("date"),
        "mart_exec_overview": [],
    }
    return [*_asc("client"), *by[name]]


def ordered(name: str, df: DataFrame) -> DataFrame:
    """A result set in report order, per client."""
    return df.orderBy(*report_order(name))


def numbered(name: str, df: DataFrame) -> DataFrame:
    """A result set with its order as data: ``position`` counts its rows from 1 in report order.

    The rows are dealt by ranges of the order and sorted inside them, and written with the number of
    their range and their place in it; a row's position is that place behind the sizes of all ranges before. No
    task holds more than a range, and of the sizes there is one per range.
    """
    order = report_order(name)
    placed = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()))
    # monotonically_increasing_id: the partition above 33 bits of the row in it.
    part, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    rows = placed.withColumn("_part", part).join(starts, "_part")
    return rows.withColumn("position", F.col("_start") + place + 1).drop("_part", "_start", "_at")
