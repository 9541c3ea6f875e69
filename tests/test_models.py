"""The model graph on the small engagement: planted faults, coverage, partial and odd inputs."""

from datetime import date

import pytest
from pyspark.sql import functions as F

import fixture
from spendloom.operators import quality, reports
from spendloom.params import Params
from spendloom.plans.store import Store
from spendloom.plans.warehouse import MODELS, Warehouse


@pytest.fixture(scope="module")
def built(spark):
    return Warehouse(fixture.raw_tables(spark, ("demo", "other")), store=Store(spark, "models", "models"))


@pytest.fixture(scope="module")
def raised(built):
    return built.mart_alerts().collect()


@pytest.mark.parametrize("client", ["demo", "other"])
def test_alerts_are_exactly_the_planted_ones(raised, client):
    mine = [(r.rule, r.campaign) for r in raised if r.client == client]
    assert sorted(mine) == sorted(fixture.EXPECTED_ALERTS)
    assert {r.data_as_of for r in raised} == {fixture.PLATFORM_TO}


@pytest.mark.parametrize(
    "rule, severity, value, threshold",
    [
        ("overspend", "act", 10_200.0, 9_000.0),
        ("pacing_deviation", "act", -0.3, 0.1),
        ("cpa_spike", "review", 50.0, 32.5),
        ("tracking_break", "act", 0.0, None),
        ("reconciliation", "review", 0.1, 0.02),
        ("unapproved_spend", "act", 10_200.0, 0.0),
        ("approval_breach", "act", 12_600.0, 12_000.0),
    ],
)
def test_alert_numbers(raised, rule, severity, value, threshold):
    (row,) = [r for r in raised if r.rule == rule and r.client == "demo"]
    assert (row.severity, row.threshold) == (severity, threshold and pytest.approx(threshold))
    assert row.value == pytest.approx(value)


def test_alert_texts(raised):
    text = {r.campaign: r.detail for r in raised if r.client == "demo" and r.rule != "budget_exhaustion"}
    assert text["tundra"] == "Spend is -30.0% against plan to date (tolerance 10.0%)."
    assert "2025-03-12" in text["beacon"] and "500 platform clicks" in text["beacon"]
    assert "10.0%" in text["orchard"] and text["lantern"].endswith("(x2.0).")


def test_reconciliation_by_campaign(built):
    rows = built.mart_reconciliation().filter("client = 'demo'").collect()
    assert {r.campaign for r in rows if not r.within_tolerance} == {"orchard"}
    assert {round(r.difference, 2) for r in rows if r.within_tolerance} == {0.0}


def test_invariants(built):
    fact, campaigns = built.fct_performance_daily(), built.mart_campaign_performance()
    assert quality.duplicate_keys(fact, ["client", "date", "campaign"]).count() == 0
    assert quality.null_rows(fact, ["date", "campaign", "spend"]).count() == 0
    assert quality.backend_after_coverage(fact, built.mart_freshness()).count() == 0
    assert quality.forecast_out_of_order(campaigns).count() == 0
    assert quality.mixed_provenance(built.mart_freshness()).count() == 0
    spend = quality.spend_totals(
        {
            "extract": built.raw["platform_daily"], "campaigns": campaigns,
            "channels": built.mart_channel_performance(), "overview": built.mart_exec_overview(),
            "days": built.mart_channel_daily(),
        }
    ).collect()
    assert len(spend) == 2 and all(r.agree for r in spend)
    position = quality.budget_position(built.mart_exec_overview(), built.ledger()).collect()
    assert len(position) == 2 and all(all(list(r)[1:]) for r in position)


def test_shape_of_the_fact(built):
    fact = built.fct_performance_daily().filter("client = 'demo'")
    counts = fact.agg(
        F.count("*"), F.count_if("has_platform_data"), F.count("sessions"),
        F.count_if("has_crm_data"), F.count("backend_orders"),
    ).collect()[0]
    n, reported = len(fixture.CAMPAIGNS), len(fixture.REPORTED)
    assert tuple(counts) == (n * len(fixture.FLIGHT), n * reported, n * reported, n * (reported - 1), n * (reported - 1))


def test_overview_uses_crm_covered_spend(built):
    ov = built.mart_exec_overview().filter("client = 'demo'").collect()[0]
    days, orders = len(fixture.REPORTED) - 1, 10
    covered = sum(c.daily_spend for c in fixture.CAMPAIGNS) * days
    assert ov.cpa_backend == pytest.approx(covered / (len(fixture.CAMPAIGNS) * days * orders))
    assert (ov.platform_as_of, ov.crm_as_of) == (fixture.PLATFORM_TO, fixture.CRM_TO)
    approved = sum(amount for _, amount in fixture.APPROVALS.values())
    assert not ov.is_synthetic and ov.pending_requests == 0 and ov.approved == approved
    assert ov.open_alerts == len(fixture.EXPECTED_ALERTS)


def test_trend_is_cumulative_and_null_where_nobody_reported(built):
    rows = reports.ordered("spend_trend", built.spend_trend().filter("client = 'demo'")).collect()
    n = len(fixture.REPORTED)
    assert len(rows) == len(fixture.FLIGHT)
    assert [r.spend_cum is None for r in rows] == [i >= n for i in range(len(rows))]
    assert [r.plan_cum for r in rows] == [(i + 1) * 600.0 * len(fixture.CAMPAIGNS) for i in range(len(rows))]


def test_report_order(built):
    levels = [r.level for r in reports.ordered("mart_funnel", built.mart_funnel()).collect()]
    assert levels[0] == "All channels" and levels[4] == "All channels"
    spends = [r.spend for r in reports.ordered("mart_channel_performance", built.mart_channel_performance()).collect()]
    assert spends[:3] == sorted(spends[:3], reverse=True)


def test_positions_follow_the_order_over_many_ranges(spark, built):
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = reports.numbered("spend_trend", built.spend_trend()).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    want = reports.ordered("spend_trend", built.spend_trend()).collect()
    assert [r.position for r in sorted(got, key=lambda r: r.position)] == list(range(1, len(want) + 1))
    assert [(r.client, r.date) for r in sorted(got, key=lambda r: r.position)] == [(r.client, r.date) for r in want]
    none = reports.numbered("mart_freshness", built.mart_freshness().limit(0))
    assert none.count() == 0 and none.columns[-1] == "position"


# ---------------------------------------------------------------- partial and odd inputs


def test_platform_only_client_builds(spark):
    only = {"platform_daily", "gate_engagement", "gate_requests", "gate_campaigns", "source_freshness"}

    def change(name, rows):
        if name == "source_freshness":
            return [r for r in rows if r[1] == "ad_platforms"]
        return rows

    w = Warehouse(fixture.raw_tables(spark, only=only, change=change))
    flags = w.fct_performance_daily().select("has_crm_data", "sessions", "backend_orders").distinct()
    assert [tuple(r) for r in flags.collect()] == [(None, None, None)]
    ov = w.mart_exec_overview().collect()[0]
    assert ov.spend > 0 and ov.crm_as_of is None and ov.backend_orders is None
    assert w.mart_funnel().count() == 0
    unapproved = w.mart_alerts().filter("rule = 'unapproved_spend'").collect()
    assert [r.campaign for r in unapproved] == ["harbour"]


def test_without_freshness_nothing_is_covered_and_nothing_is_false(spark):
    only = {"platform_daily", "plan_daily", "gate_engagement"}
    w = Warehouse(fixture.raw_tables(spark, only=only))
    fact = w.fct_performance_daily()
    assert fact.filter("has_platform_data is not null or has_crm_data is not null").count() == 0
    assert fact.agg(F.sum("spend_backend_window")).collect()[0][0] == 0.0
    assert w.mart_campaign_performance().agg(F.max("days_remaining")).collect()[0][0] == 0
    assert w.mart_channel_daily().count() == 0


def test_empty_inputs_build_empty_models(spark):
    w = Warehouse(fixture.raw_tables(spark, only=set()))
    assert {name: build().count() for name, build in w.models().items()} == dict.fromkeys(MODELS, 0)


def test_client_without_facts_keeps_its_overview_row(spark):
    w = Warehouse(fixture.raw_tables(spark, only={"gate_engagement"}))
    ov = w.mart_exec_overview().collect()
    assert len(ov) == 1 and ov[0].spend is None and ov[0].open_alerts == 0 and ov[0].ceiling == fixture.CEILING


def _tiny(spark, **rows):
    def change(name, _):
        return rows.get(name, [])

    return Warehouse(fixture.raw_tables(spark, change=change), Params(hot_key_rows=2))


DAY = date(2025, 3, 10)


def _platform(campaign="a", channel="x", spend=10.0, impressions=0, clicks=0):
    return ("demo", "src", DAY, campaign, channel, impressions, clicks, spend, 0.0, 0.0, False)


FRESH = [("demo", s, date(2025, 3, 11), False) for s in ("ad_platforms", "web_analytics", "crm")]


def test_two_channels_on_one_campaign_day_multiply_and_are_reported(spark):
    rows = [_platform(channel="x", spend=1.0), _platform(channel="y", spend=2.0)]
    w = _tiny(spark, platform_daily=rows, source_freshness=FRESH)
    got = sorted((r.channel, r.spend) for r in w.fct_performance_daily().collect())
    assert got == [("x", 1.0), ("x", 2.0), ("y", 1.0), ("y", 2.0)]
    assert quality.duplicate_keys(w.fct_performance_daily(), ["client", "date", "campaign"]).count() == 1


def test_null_channel_is_a_group_and_zero_impressions_have_no_cpm(spark):
    rows = [_platform("a", None), _platform("b", "x")]
    w = _tiny(spark, platform_daily=rows, source_freshness=FRESH)
    funnel = {r.level: (r.spend, r.cpm) for r in w.mart_funnel().collect()}
    assert funnel == {"All channels": (20.0, None), None: (10.0, None), "x": (10.0, None)}


def test_ledger_without_platform_spend_is_within_tolerance(spark):
    w = _tiny(
        spark, platform_daily=[_platform(spend=0.0)], source_freshness=FRESH,
        gate_spend=[("demo", "a", 50.0, str(DAY))],
    )
    row = w.mart_reconciliation().collect()[0]
    assert (row.difference, row.difference_pct, row.within_tolerance) == (-50.0, None, True)


def test_unknown_kpi_has_no_actual_and_no_budget_means_no_cap(spark):
    plan = [("demo", DAY, "a", "x", 5.0, "reach", 1.0, False),
            ("demo", date(2025, 3, 12), "a", "x", 5.0, None, None, False)]
    w = _tiny(spark, platform_daily=[_platform()], plan_daily=plan, source_freshness=FRESH)
    row = w.mart_campaign_performance().collect()[0]
    assert (row.kpi, row.kpi_target, row.kpi_actual, row.days_remaining) == ("reach", 1.0, None, 1)
    assert row.forecast_spend_high == 20.0 and row.would_exceed_budget_uncapped is None


def test_orders_before_coverage_ends_count_and_later_ones_do_not(spark):
    orders = [("demo", "o1", DAY, "a", 9.0, True, False), ("demo", "o2", date(2025, 3, 12), "a", 9.0, True, False)]
    plan = [("demo", d, "a", "x", 1.0, "cpm", 1.0, False) for d in (DAY, date(2025, 3, 12))]
    w = _tiny(spark, plan_daily=plan, crm_orders=orders, source_freshness=FRESH)
    got = {r.date: r.backend_orders for r in w.fct_performance_daily().collect()}
    assert got == {DAY: 1, date(2025, 3, 12): None}


def test_overspend_exhaustion_and_breach(spark):
    terms = ("demo", "a", "R", "x", 5.0, 9.0, "2025-03-01", "2025-03-30", "live")
    request = ("demo", "R", "*", "x", 5.0, 5.0, "2025-03-01", "2025-03-30", 8.0, "APPROVED", "s", None, None)
    w = _tiny(
        spark, platform_daily=[_platform(spend=10.0)], source_freshness=FRESH,
        gate_campaigns=[terms], gate_requests=[request], gate_engagement=[("demo", "INR", 9.0)],
    )
    rows = {r.rule: r for r in w.mart_alerts().collect()}
    assert {"overspend", "approval_breach"} <= set(rows)
    assert rows["approval_breach"].campaign == "R" and rows["overspend"].threshold == 5.0
    assert rows["overspend"].detail.startswith("Platform spend of 10.0 is above the campaign budget of 5.0.")


def test_rows_without_a_campaign_have_no_run_rate(spark):
    plan = [("demo", date(2025, 3, 12), None, "x", 5.0, None, None, False)]
    w = _tiny(spark, platform_daily=[_platform(None), _platform("a")], plan_daily=plan, source_freshness=FRESH)
    rows = {r.campaign: r for r in w.mart_campaign_performance().collect()}
    assert rows[None].mean_daily is None and rows[None].forecast_spend_base is None
    assert rows["a"].mean_daily == 10.0


def test_duplicate_freshness_rows_fail_the_overview(spark):
    w = _tiny(
        spark, platform_daily=[_platform()], source_freshness=[*FRESH, FRESH[0]],
        gate_engagement=[("demo", "INR", 9.0)],
    )
    with pytest.raises(Exception, match="more than one row for source ad_platforms"):
        w.mart_exec_overview().collect()
