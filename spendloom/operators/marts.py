"""Marts: totals first, ratios on the totals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendloom.functions import metrics as m
from spendloom.functions.metrics import METRICS, metric_columns, safe_div
from spendloom.functions.values import exact_sum, zero_if_null
from spendloom.params import Params

DELIVERY = ("impressions", "clicks", "spend", "platform_conversions", "platform_revenue")
BACKEND = ("sessions", "backend_orders", "backend_revenue", "new_customers", "spend_backend_window")
FORECAST = ("forecast_spend_low", "forecast_spend_base", "forecast_spend_high")
ALL_CHANNELS = "All channels"


# Whole numbers; all other measures are money or fractions, and added as decimals.
WHOLE = {"impressions", "clicks", "sessions", "backend_orders", "new_customers", "days_remaining", "recent_days"}


def sums(*names: str) -> list[Column]:
    return [(F.sum(n) if n in WHOLE else exact_sum(n)).alias(n) for n in names]


def earliest(value: str) -> Column:
    """The first known value by day: a stable choice where any value will do."""
    known = F.when(F.col(value).isNotNull(), F.struct("date", value))
    return F.min_by(value, known).alias(value)


def is_recent(days: int) -> Column:
    return F.col("has_platform_data") & (F.col("date") > F.date_sub("ref_date", days))


def pacing(spend="spend", planned="planned_spend_to_date") -> Column:
    return safe_div(spend, planned) - 1


def campaign_totals(fact: DataFrame) -> DataFrame:
    """Totals per campaign, channel and request, in one pass over the fact. The ``recent_``
    columns cover the last 7 covered days, for the run rate.

    Text cannot be aggregated by hashing, so the fact is first summed with KPI and target as
    keys; the earliest KPI is then picked among the few rows that are left.
    """
    key = ["client", "campaign", "channel", "request_id"]
    covered, uncovered = F.col("has_platform_data"), ~F.col("has_platform_data")
    recent_spend = F.when(is_recent(7), F.col("spend"))
    added = ("planned_spend_flight", "planned_spend_to_date", *DELIVERY, *BACKEND, "ledger_spend",
             "days_remaining", "recent_spend", "recent_days")
    per_kpi = fact.groupBy(*key, "kpi", "kpi_target").agg(
        F.min("date").alias("date"),
        exact_sum("planned_spend").alias("planned_spend_flight"),
        exact_sum(F.when(covered, F.col("planned_spend"))).alias("planned_spend_to_date"),
        *sums(*DELIVERY, *BACKEND, "ledger_spend"),
        F.count_if(uncovered).alias("days_remaining"),
        F.bool_or("is_synthetic").alias("is_synthetic"),
        F.max("ref_date").alias("ref_date"),
        F.min(recent_spend).alias("recent_low"),
        F.max(recent_spend).alias("recent_high"),
        exact_sum(recent_spend).alias("recent_spend"),
        F.count(recent_spend).alias("recent_days"),
    )
    return per_kpi.groupBy(*key).agg(
        earliest("kpi"),
        earliest("kpi_target"),
        *sums(*added),
        F.bool_or("is_synthetic").alias("is_synthetic"),
        F.max("ref_date").alias("ref_date"),
        F.min("recent_low").alias("recent_low"),
        F.max("recent_high").alias("recent_high"),
    )


RECENT = ("recent_low", "recent_high", "recent_spend", "recent_days")


def run_rate(totals: DataFrame) -> DataFrame:
    """Lowest, mean and highest daily spend of a campaign over the last 7 covered days, over all
    its channels. A covered plan day without delivery is a day of zero spend."""
    return (
        totals.groupBy("client", "campaign")
        .agg(
            F.min("recent_low").alias("low_daily"),
            safe_div(exact_sum("recent_spend"), F.sum("recent_days")).alias("mean_daily"),
            F.max("recent_high").alias("high_daily"),
        )
        .filter(F.col("mean_daily").isNotNull() & F.col("campaign").isNotNull())
    )


def with_run_rate(totals: DataFrame) -> DataFrame:
    """`run_rate` on every row of the totals. The window holds one campaign's channels. Rows without
    a campaign belong to none and have no rate."""
    w = W.partitionBy("client", "campaign")
    rates = {
        "low_daily": F.min("recent_low").over(w),
        "mean_daily": safe_div(F.sum(F.col("recent_spend").cast("decimal(24,6)")).over(w), F.sum("recent_days").over(w)),
        "high_daily": F.max("recent_high").over(w),
    }
    named = F.col("campaign").isNotNull()
    return totals.withColumns({k: F.when(named, v) for k, v in rates.items()}).drop(*RECENT)


def campaign_performance(fact: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Totals to date, pacing and a spend forecast to the end of the flight: remaining days at
    the low, mean and high daily rate, capped at the budget (no budget, no cap)."""
    terms = campaigns.select(
        "client", "campaign", "budget", "daily_budget", "status", "start_date", "end_date"
    )
    rows = with_run_rate(campaign_totals(fact)).join(terms, ["client", "campaign"], "left")

    def projected(rate: str) -> Column:
        return F.col("spend") + F.col("days_remaining") * F.col(rate)

    def capped(rate: str) -> Column:
        return F.least("budget", projected(rate))

    by_kpi = F.when(
        F.col("kpi") == "cpa_backend", m.cpa("spend_backend_window", "backend_orders")
    ).when(F.col("kpi") == "cpm", m.cpm())
    return rows.withColumns(
        {
            "budget_used": safe_div("spend", "budget"),
            "pacing_vs_plan": pacing(),
            "forecast_spend_low": capped("low_daily"),
            "forecast_spend_base": capped("mean_daily"),
            "forecast_spend_high": capped("high_daily"),
            "would_exceed_budget_uncapped": projected("high_daily") > F.col("budget"),
            **metric_columns(),
            "kpi_actual": by_kpi,
        }
    ).drop("low_daily", "high_daily")


def channel_performance(campaign_mart: DataFrame) -> DataFrame:
    return (
        campaign_mart.groupBy("client", "channel")
        .agg(
            F.count("*").alias("campaigns"),
            *sums("budget", "planned_spend_to_date", *DELIVERY, *BACKEND, *FORECAST),
        )
        .withColumns({"pacing_vs_plan": pacing(), **metric_columns()})
    )


def channel_daily(fact: DataFrame) -> DataFrame:
    return (
        fact.filter("has_platform_data")
        .groupBy("client", "date", "channel")
        .agg(
            *sums("planned_spend", *DELIVERY, *BACKEND),
            F.bool_or("is_synthetic").alias("is_synthetic"),
        )
        .withColumns(metric_columns())
    )


def funnel(fact: DataFrame) -> DataFrame:
    """Impressions to revenue per channel and for all channels, over CRM-covered days.

    The fact is summed per channel once; the few channel rows are then counted again under
    the all-channels label. A null channel stays a group of its own, and a client without
    covered days gets no row.
    """
    base = ("impressions", "clicks", "sessions", "backend_orders", "backend_revenue",
            "new_customers", "spend")
    per_channel = fact.filter("has_crm_data").groupBy("client", "channel").agg(*sums(*base))
    levels = per_channel.withColumn(
        "level", F.explode(F.array(F.lit(ALL_CHANNELS), F.col("channel")))
    )
    totals = levels.groupBy("client", "level").agg(*sums(*base))
    return totals.withColumnsRenamed(
        {"backend_orders": "orders", "backend_revenue": "revenue"}
    ).withColumns(
        {
            "ctr": m.ctr(),
            "click_to_session": safe_div("sessions", "clicks"),
            "cvr": m.cvr("orders"),
            "cpm": m.cpm(),
            "cpc": m.cpc(),
            "cpa_backend": m.cpa("spend", "orders"),
            "roas_backend": m.roas("revenue"),
            "cac": m.cac("spend"),
        }
    )


def with_reconciliation(campaign_mart: DataFrame, params: Params) -> DataFrame:
    """Platform spend against the ledger. Without platform spend the share is null and counts
    as within tolerance, whatever the ledger says."""
    difference = F.col("spend") - F.col("ledger_spend")
    share = safe_div(difference, "spend")
    off_pct = F.abs(zero_if_null(share)) * 100
    return campaign_mart.withColumns(
        {
            "difference": difference,
            "difference_pct": share,
            "within_tolerance": off_pct <= params.reconciliation_tolerance_pct,
        }
    )


def reconciliation(campaign_mart: DataFrame, params: Params) -> DataFrame:
    return with_reconciliation(campaign_mart, params).select(
        "client", "campaign", "channel", "request_id", F.col("spend").alias("platform_spend"),
        "ledger_spend", "difference", "difference_pct", "within_tolerance",
    )


def approvals(requests: DataFrame, campaigns: DataFrame, fact: DataFrame) -> DataFrame:
    """Every spend request with what was committed and spent under it."""
    key = ["client", "request_id"]
    committed = campaigns.groupBy(*key).agg(
        exact_sum("budget").alias("committed"),
        exact_sum(F.when(F.col("status") == "live", F.col("daily_budget"))).alias("live_daily_budget"),
        F.count("*").alias("campaigns"),
    )
    # Spend that no request covers has a null id and matches nothing: drop it before the shuffle.
    spent = (
        fact.filter(F.col("request_id").isNotNull())
        .groupBy(*key)
        .agg(exact_sum("spend").alias("platform_spend"), exact_sum("ledger_spend").alias("ledger_spend"))
    )
    zeroed = ("campaigns", "committed", "live_daily_budget", "platform_spend", "ledger_spend")
    return (
        requests.join(committed, key, "left")
        .join(spent, key, "left")
        .withColumns({c: zero_if_null(c) for c in zeroed})
        .withColumns(
            {
                "remaining_of_approval": F.col("approved_amount") - F.col("platform_spend"),
                "approval_used": safe_div("platform_spend", "approved_amount"),
            }
        )
    )


def freshness_mart(freshness: DataFrame) -> DataFrame:
    return freshness.select("client", "source", "data_as_of", "loaded_at", "is_synthetic")


def single(value: Column, what: str) -> Column:
    """The one value of a group; more than one row is an error, as in a scalar subquery."""
    too_many = F.raise_error(F.lit(f"more than one row for {what}"))
    return F.when(F.count(value) > 1, too_many).otherwise(F.max(value))


def executive_overview(
    engagement: DataFrame,
    campaign_mart: DataFrame,
    requests: DataFrame,
    freshness: DataFrame,
    alerts: DataFrame,
) -> DataFrame:
    """One row per engagement. A client without fact rows keeps its row, with null totals."""
    on_cpa = F.col("kpi") == "cpa_backend"
    weighted = F.col("kpi_target") * F.col("backend_orders")

    def of_cpa(value: Column | str) -> Column:
        return exact_sum(F.when(on_cpa, F.col(value) if isinstance(value, str) else value))

    totals = campaign_mart.groupBy("client").agg(
        exact_sum("budget").alias("committed"),
        *sums("spend", "ledger_spend", "planned_spend_to_date", "planned_spend_flight", *FORECAST),
        *sums("impressions", "clicks", "sessions", "platform_conversions", "platform_revenue"),
        *sums("backend_orders", "backend_revenue", "new_customers", "spend_backend_window"),
        safe_div(of_cpa(weighted), of_cpa("backend_orders")).alias("target_cpa_backend"),
        m.cpa(of_cpa("spend_backend_window"), of_cpa("backend_orders")).alias("actual_cpa_backend"),
        F.min("start_date").alias("flight_start"),
        F.max("end_date").alias("flight_end"),
        F.bool_or("is_synthetic").alias("is_synthetic"),
    )
    decided = requests.groupBy("client").agg(
        exact_sum(F.when(F.col("status") == "APPROVED", F.col("approved_amount"))).alias("approved"),
        F.count_if(F.col("status") == "PENDING").alias("pending_requests"),
    )

    def as_of(source: str) -> Column:
        rows = F.when(F.col("source") == source, F.struct("data_as_of"))
        return single(rows, f"source {source}")["data_as_of"]

    current = freshness.groupBy("client").agg(
        as_of("ad_platforms").alias("platform_as_of"), as_of("crm").alias("crm_as_of")
    )
    raised = alerts.groupBy("client").agg(F.count("*").alias("open_alerts"))
    rows = engagement.select("client", "currency", "ceiling")
    for part in (decided, totals, current, raised):
        rows = rows.join(part, "client", "left")
    return rows.withColumns(
        {
            "pending_requests": zero_if_null("pending_requests"),
            "open_alerts": zero_if_null("open_alerts"),
            "remaining_of_ceiling": F.col("ceiling") - F.col("spend"),
            "pacing_vs_plan": pacing(),
            **metric_columns(),
        }
    ).select(
        "client", "currency", "ceiling", "approved", "pending_requests",
        *totals.columns[1:], "remaining_of_ceiling", "pacing_vs_plan", *METRICS,
        "platform_as_of", "crm_as_of", "open_alerts",
    )
