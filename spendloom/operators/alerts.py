"""Alert rules: each one is a filter over the fact or a mart; all share one output schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions import metrics as m
from spendloom.functions.metrics import safe_div
from spendloom.functions.values import exact_sum, fill, number_text
from spendloom.operators.marts import is_recent
from spendloom.params import Params

# Rule names, severities, the click floor and the alert texts.
ACT, REVIEW = "act", "review"
TRACKING_MIN_CLICKS = 100
TEXTS = {
    "overspend": "Platform spend of {spend} is above the campaign budget of {budget}. "
    "Pause or decrease now.",
    "budget_exhaustion": "At the last 7 days' average run-rate the budget runs out about {days} "
    "day(s) before the flight ends. Lower the daily budget to spread it, or accept the early "
    "finish.",
    "pacing_deviation": "Spend is {pacing}% against plan to date (tolerance {tolerance}%).",
    "cpa_spike": "Platform CPA over the last 3 days is {last} against {prior} for the 7 days "
    "before (x{ratio}).",
    "tracking_break": "No web sessions recorded on {day} despite {clicks} platform clicks. "
    "Check the pixel, tag and UTMs.",
    "reconciliation": "Ledger spend differs from platform spend by {pct}% ({difference}). "
    "Reconcile against the invoice.",
    "unapproved_spend": "Spend of {spend} on a campaign the execution service never launched, so "
    "no approval covers it. If it was set up directly in the platform, pause it and raise a Spend "
    "Approval Request; if it is ours, add it to the campaign map.",
    "approval_breach": "Committed or live daily budget is above what {request} approved. The gate "
    "should make this impossible: investigate.",
}


def _alert(
    rule: str,
    severity: Column | str,
    value: Column | str,
    threshold: Column | float | None,
    subject: str = "campaign",
    **text: Column,
) -> Column:
    """One alert as a struct over the columns of the row that raises it."""
    column = lambda v: F.col(v) if isinstance(v, str) else v if isinstance(v, Column) else F.lit(v)
    return F.struct(
        "client",
        F.lit(rule).alias("rule"),
        (F.lit(severity) if isinstance(severity, str) else severity).alias("severity"),
        F.col(subject).alias("campaign"),
        F.col("channel"),
        fill(TEXTS[rule], **text).alias("detail"),
        column(value).cast("double").alias("value"),
        column(threshold).cast("double").alias("threshold"),
        F.col("ref_date").alias("data_as_of"),
    )


Rule = tuple[Column, Column]  # when it fires, the alert


def raise_alerts(rows: DataFrame, *rules: Rule) -> DataFrame:
    """All rules over one pass of ``rows``: a row gives one alert per rule that fires on it."""
    fired = [F.when(when, alert) for when, alert in rules]
    alerts_of_row = F.filter(F.array(*fired), lambda a: a.isNotNull())
    return rows.select(F.inline(alerts_of_row))


def overspend() -> Rule:
    alert = _alert(
        "overspend", ACT, "spend", F.col("budget"),
        spend=number_text(F.col("spend")), budget=number_text(F.col("budget")),
    )
    return F.col("spend") > F.col("budget"), alert


def budget_exhaustion() -> Rule:
    """The division is guarded by its own null, not by the order of the conditions."""
    days_left_over = F.col("days_remaining") - safe_div(
        F.col("budget") - F.col("spend"), "mean_daily"
    )
    alert = _alert(
        "budget_exhaustion", REVIEW, days_left_over, 1, days=number_text(days_left_over, 1)
    )
    return (F.col("mean_daily") > 0) & (days_left_over >= 1), alert


def pacing_deviation(params: Params) -> Rule:
    tolerance = params.pacing_tolerance_pct / 100.0
    off = F.abs("pacing_vs_plan")
    alert = _alert(
        "pacing_deviation",
        F.when(off > 2 * params.pacing_tolerance_pct / 100.0, ACT).otherwise(REVIEW),
        "pacing_vs_plan",
        tolerance,
        pacing=number_text(F.col("pacing_vs_plan") * 100, 1),
        tolerance=F.lit(str(params.pacing_tolerance_pct)),
    )
    return off > tolerance, alert


def unapproved_spend() -> Rule:
    alert = _alert("unapproved_spend", ACT, "spend", 0, spend=number_text(F.col("spend")))
    return F.col("request_id").isNull() & (F.col("spend") > 0), alert


def reconciliation_gap(params: Params) -> Rule:
    alert = _alert(
        "reconciliation", REVIEW, "difference_pct", params.reconciliation_tolerance_pct / 100.0,
        pct=number_text(F.col("difference_pct") * 100, 1),
        difference=number_text(F.col("difference")),
    )
    return ~F.col("within_tolerance"), alert


def cpa_windows(fact: DataFrame) -> DataFrame:
    """Platform CPA of the last 3 covered days and of the 7 before, in one grouped pass."""
    last = F.col("date") > F.date_sub("ref_date", 3)
    part = lambda when, c: exact_sum(F.when(when, F.col(c)))
    return (
        fact.filter(is_recent(10))
        .groupBy("client", "campaign", "channel")
        .agg(
            m.cpa(part(last, "spend"), part(last, "platform_conversions")).alias("cpa_last3"),
            part(last, "platform_conversions").alias("conv_last3"),
            m.cpa(part(~last, "spend"), part(~last, "platform_conversions")).alias("cpa_prior7"),
            F.max("ref_date").alias("ref_date"),
        )
    )


def cpa_spike(params: Params) -> Rule:
    """Over `cpa_windows`. Too few conversions are noise, not a spike."""
    threshold = F.col("cpa_prior7") * params.cpa_spike_ratio
    alert = _alert(
        "cpa_spike", REVIEW, "cpa_last3", threshold,
        last=number_text(F.col("cpa_last3")), prior=number_text(F.col("cpa_prior7")),
        ratio=number_text(safe_div("cpa_last3", "cpa_prior7"), 2),
    )
    enough = F.col("conv_last3") >= params.cpa_spike_min_conversions
    return (F.col("cpa_last3") > threshold) & enough, alert


def tracking_break() -> Rule:
    """Over the fact, one alert per campaign-day. Sessions that are not reported yet are null
    and never hit."""
    alert = _alert(
        "tracking_break", ACT, "sessions", None,
        day=F.date_format("date", "yyyy-MM-dd"), clicks=F.col("clicks").cast("string"),
    )
    silent = (F.col("clicks") >= TRACKING_MIN_CLICKS) & (F.col("sessions") == 0)
    return F.col("has_platform_data") & silent, alert


def approval_breach() -> Rule:
    """Over the approvals mart. The request id stands in the campaign column."""
    alert = _alert(
        "approval_breach", ACT, "committed", F.col("approved_amount"),
        subject="request_id", request=F.col("request_id"),
    )
    over = (
        (F.col("committed") > F.col("approved_amount"))
        | (F.col("live_daily_budget") > F.col("daily_cap"))
        | (F.col("platform_spend") > F.col("approved_amount"))
    )
    return (F.col("status") == "APPROVED") & over, alert


def campaign_rules(params: Params) -> list[Rule]:
    """The rules that read a campaign's row of the campaign mart (with its reconciliation)."""
    return [
        overspend(),
        budget_exhaustion(),
        pacing_deviation(params),
        reconciliation_gap(params),
        unapproved_spend(),
    ]


def alerts(
    fact: DataFrame, campaigns: DataFrame, approvals: DataFrame, params: Params
) -> DataFrame:
    """All open alerts, one pass per input. ``campaigns`` is the campaign mart with its
    reconciliation columns; ``approvals`` carries the client's ``ref_date``."""
    branches = [
        raise_alerts(campaigns, *campaign_rules(params)),
        raise_alerts(cpa_windows(fact), cpa_spike(params)),
        raise_alerts(fact.filter(tracking_break()[0]), tracking_break()),
        raise_alerts(approvals, approval_breach()),
    ]
    return reduce(DataFrame.unionByName, branches)
