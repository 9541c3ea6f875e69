"""The campaign x day fact: delivery, sessions, orders, plan and ledger side by side.

A day counts as covered by a source when it is not after that source's as-of date. On an
uncovered day backend measures are null ("not reported yet"); on a covered day without rows
they are 0. A client whose source was never connected has a null as-of date, so its flags
are null, neither true nor false.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.metrics import METRICS, metric_columns
from spendloom.functions.values import exact_sum, zero_if_null
from spendloom.operators.joins import HASH, fan_out, hot_keys, lookup, row_counts, with_hash
from spendloom.params import Params
from spendloom.sources.scratch import written

KEY = ["campaign", "date", "client"]

FACT_COLUMNS = (
    *KEY, "channel", "request_id", "kpi", "kpi_target", "planned_spend", "has_platform_data",
    "has_crm_data", "impressions", "clicks", "spend", "platform_conversions", "platform_revenue",
    "sessions", "backend_orders", "backend_revenue", "new_customers", "spend_backend_window",
    "ledger_spend", "is_synthetic", *METRICS,
)


def as_of_dates(freshness: DataFrame) -> DataFrame:
    """One row per client: the three as-of dates as columns."""

    def as_of(source: str) -> Column:
        return F.max(F.when(F.col("source") == source, F.col("data_as_of")))

    return freshness.groupBy("client").agg(
        as_of("ad_platforms").alias("platform_as_of"),
        as_of("web_analytics").alias("web_as_of"),
        as_of("crm").alias("crm_as_of"),
    )


def spine(stg: dict[str, DataFrame]) -> DataFrame:
    """Every campaign-day-channel that was planned or delivered, once, with its plan and
    platform rows. Plan and platform are read for this once; the reporting context and the
    hot-key check build on the same shuffle. (The filter always holds. It keeps the counts in
    every use of the spine, without which Spark would prune them and not see the plans are one.)
    """
    counts = row_counts(stg["stg_plan_daily"], stg["stg_platform_daily"], [*KEY, "channel"])
    return counts.filter(F.col("left_rows") + F.col("right_rows") > 0)


def reporting_context(days: DataFrame, freshness: DataFrame) -> DataFrame:
    """One row per client: as-of dates and ``ref_date``, the last day of the fact that the
    ad platforms cover. Taken from the client's distinct days, so the fact itself can carry
    it and no mart has to join the fact to its own maximum."""
    covered = F.when(F.col("date") <= F.col("platform_as_of"), F.col("date"))
    return (
        days.select("client", "date")
        .distinct()
        .join(as_of_dates(freshness), "client", "full")
        .groupBy("client")
        .agg(
            F.max("platform_as_of").alias("platform_as_of"),
            F.max("web_as_of").alias("web_as_of"),
            F.max("crm_as_of").alias("crm_as_of"),
            F.max(covered).alias("ref_date"),
        )
    )


# The logs, and the measures of the fact that come from each.
LOGS = {
    "web": ("sessions",),
    "crm": ("backend_orders", "backend_revenue", "new_customers"),
    "ledger": ("ledger_spend",),
}


def daily_activity(stg: dict[str, DataFrame], logs: tuple[str, ...] = tuple(LOGS)) -> DataFrame:
    """Sessions, orders and ledger spend per campaign-day, in one grouped pass.

    The logs are stacked and summed together: partial sums before the only shuffle, so a hot
    campaign is safe. Rows without a campaign or day can match nothing and go first. Grouped by the keys' hash as
    well, which stays in the result, so that the fact joins the rows where they lie.
    """
    values = {
        "web": (stg["stg_web_sessions"], {"sessions": F.col("sessions")}),
        "crm": (
            stg["stg_crm_orders"],
            {
                "backend_orders": F.lit(1),
                "backend_revenue": F.col("revenue"),
                "new_customers": F.when(F.col("new_customer"), 1).otherwise(0),
            },
        ),
        "ledger": (stg["stg_gate_spend"], {"ledger_spend": F.col("ledger_spend")}),
    }
    money = {"backend_revenue", "ledger_spend"}
    measures = [m for name in logs for m in LOGS[name]]

    def stacked(name: str) -> DataFrame:
        frame, given = values[name]
        known = frame.filter(F.col("campaign").isNotNull() & F.col("date").isNotNull())
        as_type = lambda m: "double" if m in money else "bigint"
        return known.select(
            *KEY, *(given.get(m, F.lit(None)).cast(as_type(m)).alias(m) for m in measures)
        )

    rows = reduce(DataFrame.unionByName, map(stacked, logs))
    added = lambda m: exact_sum(m) if m in money else F.sum(m)
    return with_hash(rows, KEY).groupBy(*KEY, HASH).agg(*(added(m).alias(m) for m in measures))


def daily_fact(
    stg: dict[str, DataFrame], params: Params, logs: tuple[str, ...] = tuple(LOGS)
) -> DataFrame:
    """The fact plus ``ref_date``. Plan and platform rows are matched on campaign-day, not on
    channel, and are not pre-aggregated: a campaign-day in two channels or with two platform
    rows multiplies, and the uniqueness check on the fact is what reports it.

    With fewer ``logs`` the others are not read, and their measures and the ratio metrics are
    not in the result: for a mart that needs none of them.
    """
    # Kept before its four uses: the plan and the platforms are counted once, and how many hot keys and campaigns
    # there are is known when the joins are planned.
    days = written(spine(stg))
    hot = written(hot_keys(days, KEY, params.hot_key_rows))
    context = reporting_context(days, stg["stg_source_freshness"])
    requests = stg["stg_gate_campaigns"].select("client", "campaign", "request_id")
    # A client may have a third of the campaigns; a campaign has at most its days x channels.
    # Both lookups are made per campaign. Spark sends the terms round if they are few.
    named = days.select("client", "campaign").distinct().join(requests, ["client", "campaign"], "left")
    terms = written(lookup(named, context, ["client"], ["campaign"], params.salts))
    terms = terms.withColumnsRenamed({"client": "_client", "campaign": "_campaign"})
    of_campaign = F.col("client").eqNullSafe(F.col("_client")) & F.col("campaign").eqNullSafe(F.col("_campaign"))
    rows = days.join(terms, of_campaign, "left").drop("_client", "_campaign")
    plan = stg["stg_plan_daily"].select(
        *KEY, "planned_spend", "kpi", "kpi_target", F.col("is_synthetic").alias("plan_synthetic")
    )
    platform = stg["stg_platform_daily"].drop("channel", "platform").withColumnRenamed(
        "is_synthetic", "platform_synthetic"
    )
    activity = daily_activity(stg, logs) if logs else None
    rows = fan_out(rows, activity, plan, platform, KEY, None if hot.isEmpty() else hot)

    web_covers = F.col("date") <= F.col("web_as_of")
    crm_covers = F.col("date") <= F.col("crm_as_of")
    measures = {
        "has_platform_data": F.col("date") <= F.col("platform_as_of"),
        "has_crm_data": crm_covers,
        "spend_backend_window": F.when(crm_covers, zero_if_null("spend")).otherwise(F.lit(0.0)),
        "is_synthetic": F.coalesce("platform_synthetic", "plan_synthetic", F.lit(False)),
    }
    for m in ("planned_spend", "impressions", "clicks", "spend", "platform_conversions",
              "platform_revenue"):
        measures[m] = zero_if_null(m)
    gates = {"web": web_covers, "crm": crm_covers}
    for name in logs:
        for m in LOGS[name]:
            seen = zero_if_null(m)
            measures[m] = F.when(gates[name], seen) if name in gates else seen
    rows = rows.withColumns(measures)
    if set(logs) == set(LOGS):
        return rows.withColumns(metric_columns()).select(*FACT_COLUMNS, "ref_date")
    absent = {m for name in LOGS if name not in logs for m in LOGS[name]}.union(METRICS)
    return rows.select(*(c for c in FACT_COLUMNS if c not in absent), "ref_date")
