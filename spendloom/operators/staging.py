"""Typed projections of the raw tables: casts and renames, nothing else."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Staging table -> (raw table, columns as "output type [from input]").
_LAYOUT: dict[str, tuple[str, str]] = {
    "stg_platform_daily": (
        "platform_daily",
        "date date, campaign string, channel string, platform string from source, "
        "impressions bigint, clicks bigint, spend double, platform_conversions double, "
        "platform_revenue double, is_synthetic boolean",
    ),
    "stg_web_sessions": (
        "web_sessions",
        "date date, campaign string from utm_campaign, utm_source string, utm_medium string, "
        "sessions bigint, is_synthetic boolean",
    ),
    "stg_crm_orders": (
        "crm_orders",
        "order_id string, date date from order_date, campaign string from utm_campaign, "
        "revenue double, new_customer boolean, is_synthetic boolean",
    ),
    "stg_plan_daily": (
        "plan_daily",
        "date date, campaign string, channel string, planned_spend double, kpi string, "
        "kpi_target double, is_synthetic boolean",
    ),
    "stg_source_freshness": (
        "source_freshness",
        "source string, data_as_of date, loaded_at timestamp_ntz from _loaded_at, "
        "is_synthetic boolean",
    ),
    "stg_gate_engagement": ("gate_engagement", "currency string, ceiling double"),
    "stg_gate_requests": (
        "gate_requests",
        "request_id string from id, campaign_scope string from campaign, channel string, "
        "requested_amount double from amount, approved_amount double, start_date date from start, "
        "end_date date from end, daily_cap double, status string, summary string, "
        "requested_at timestamp_ntz, decided_at timestamp_ntz",
    ),
    "stg_gate_campaigns": (
        "gate_campaigns",
        "campaign string, request_id string, channel string, budget double, daily_budget double, "
        "start_date date from start, end_date date from end, status string",
    ),
    "stg_gate_spend": (
        "gate_spend",
        "campaign string, date date, ledger_spend double from amount",
    ),
}

STAGING = tuple(_LAYOUT)


def stage(raw: dict[str, DataFrame], name: str) -> DataFrame:
    """One staging table. ANSI casts: a value that does not fit its type fails the job."""
    source, columns = _LAYOUT[name]
    picked = [F.col("client").cast("string").alias("client")]
    for spec in columns.split(", "):
        target, dtype, *origin = spec.split(" ")
        picked.append(F.col(origin[-1] if origin else target).cast(dtype).alias(target))
    return raw[source].select(*picked)


def stage_all(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: stage(raw, name) for name in STAGING}
