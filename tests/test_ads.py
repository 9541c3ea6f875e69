"""The ads connector over landed files of the API's shape."""

import json
from datetime import date

import pytest

import fixture
from spendloom.operators import ads
from spendloom.plans.warehouse import Warehouse
from spendloom.sources.ads import read_ads_account, read_ads_report
from spendloom.sources.extracts import stamp_loaded

TODAY = date(2025, 6, 12)
ENGAGEMENT = "client string, currency string, ceiling double"
LAMPS, ROPES, IDLE = "8001", "8002", "8003"

# campaign id, name, type, day, cost in micros, conversions, value, impressions, clicks
DELIVERED = [
    (LAMPS, "Lamps / spring", "VIDEO", "2025-06-10", 2_040_000_000, "4.5", "510.25", "7200", "90"),
    (LAMPS, "Lamps / spring", "VIDEO", "2025-06-11", 1_960_005_000, "4", "402", "6900", "81"),
    (ROPES, "Ropes / trial", "DISPLAY", "2025-06-11", 333_330_000, None, None, "510", "3"),
    (LAMPS, "Lamps / spring", "VIDEO", "2025-06-12", 77_000_000, "1", "9", "400", "2"),  # today isn't over
    (LAMPS, "Lamps / spring", "VIDEO", "2025-05-01", 55_000_000, "1", "9", "400", "2"),  # before the window
    (IDLE, "Quiet", None, "2025-06-11", 0, None, None, "0", "0"),  # never shown
]


def _result(cid, name, kind, day, cost, conversions, value, impressions, clicks):
    given = {"impressions": impressions, "clicks": clicks, "costMicros": f"{cost}",
             "conversions": conversions, "conversionsValue": value}
    campaign = {"id": cid, "name": name, "advertisingChannelType": kind}
    known = lambda d: {k: v for k, v in d.items() if v is not None}
    return {"campaign": known(campaign), "metrics": known(given), "segments": {"date": day}}


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landed")
    rows = [_result(*r) for r in DELIVERED]
    (folder / "report.json").write_text(json.dumps([{"results": rows[:4]}, {}, {"results": rows[4:]}]))
    customer = {"id": "555-010-4477", "currencyCode": "EUR", "timeZone": "Europe/Lisbon"}
    (folder / "account.json").write_text(json.dumps([{"results": [{"customer": customer}]}]))
    return folder


def _chain(spark, landed, currency="EUR", names=((LAMPS, "lamps"),)):
    engagement = spark.createDataFrame([("acme", currency, 500_000.0)], ENGAGEMENT)
    account = read_ads_account(spark, str(landed / "account.json"), "acme")
    window = ads.extraction_window(ads.require_currency(account, engagement), 14, TODAY)
    rows = ads.in_window(ads.normalise(read_ads_report(spark, str(landed / "report.json"), "acme")), window)
    mapping = spark.createDataFrame([("acme", *n) for n in names], "client string, key string, campaign string")
    mapped = ads.map_campaigns(rows, mapping)
    return window, mapped, ads.platform_extract(mapped)


def test_extract(spark, landed):
    window, mapped, extract = _chain(spark, landed)
    got = {(r.campaign, f"{r.date}"): (r.channel, r.impressions, r.clicks, r.spend, r.platform_conversions, r.platform_revenue)
           for r in extract.collect()}
    assert got == {
        ("lamps", "2025-06-10"): ("online_video", 7200, 90, 2040.0, 4.5, 510.25),
        ("lamps", "2025-06-11"): ("online_video", 6900, 81, 1960.01, 4.0, 402.0),
        ("Ropes / trial", "2025-06-11"): ("display", 510, 3, 333.33, 0.0, 0.0),
    }
    assert {(r.source, r.is_synthetic) for r in extract.collect()} == {("google_ads", False)}
    (summary,) = ads.extract_summary(extract, window).collect()
    assert (summary.rows, summary.spend, f"{summary.start}", f"{summary.end}") == (3, 4333.34, "2025-05-29", "2025-06-11")
    assert [r.platform_name for r in ads.unmapped_campaigns(mapped).collect()] == ["Ropes / trial"]


def test_mapping_by_id_then_name_then_own_name(spark, landed):
    names = ((LAMPS, ""), ("Lamps / spring", "by_name"), (ROPES, "by_id"), ("Ropes / trial", "unused"))
    _, mapped, _ = _chain(spark, landed, names=names)
    assert {(r.platform_id, r.campaign, r.is_mapped) for r in mapped.collect()} == {
        (LAMPS, "by_name", True), (ROPES, "by_id", True),
    }


def test_currency_mismatch_fails_every_output(spark, landed):
    window, _, extract = _chain(spark, landed, currency="USD")
    for out in (window, extract, ads.extract_summary(extract, window)):
        with pytest.raises(Exception, match="account currency does not match: acme EUR USD"):
            out.collect()


def test_account_ids(spark):
    df = spark.createDataFrame([("555-010-4477",), ("55501",), (None,)], "id string")
    assert [r[0] for r in df.select(ads.has_valid_id("id")).collect()] == [True, False, None]
    assert df.limit(1).select(ads.account_digits("id")).collect()[0][0] == "5550104477"
    with pytest.raises(Exception, match="needs 10 digits: 55501"):
        df.filter("id = '55501'").select(ads.account_digits("id")).collect()


def test_window_follows_the_account_time_zone(spark):
    accounts = spark.createDataFrame([("a", "Pacific/Kiritimati"), ("b", "Pacific/Midway")], "client string, time_zone string")
    ends = {r.client: r.end for r in ads.extraction_window(accounts).collect()}
    assert (ends["a"] - ends["b"]).days in (1, 2)  # 25 hours apart


def test_freshness_upsert_replaces_one_source(spark, landed):
    window, _, _ = _chain(spark, landed)
    old = spark.createDataFrame(
        [("acme", "ad_platforms", date(2025, 1, 1), True), ("acme", "crm", date(2025, 1, 1), True),
         ("zeta", "ad_platforms", date(2025, 1, 1), True)],
        "client string, source string, data_as_of date, is_synthetic boolean",
    )
    got = {tuple(r) for r in ads.upsert_freshness(old, window).collect()}
    assert got == {
        ("acme", "ad_platforms", date(2025, 6, 11), False), ("acme", "crm", date(2025, 1, 1), True),
        ("zeta", "ad_platforms", date(2025, 1, 1), True),
    }


def test_ads_only_engagement_builds_the_models(spark, landed):
    window, _, extract = _chain(spark, landed)
    raw = fixture.raw_tables(spark, only=set())
    empty = raw["source_freshness"].drop("_loaded_at")
    span = ("2025-05-01", "2025-07-31")
    raw |= {
        "platform_daily": stamp_loaded(extract, fixture.LOADED),
        "source_freshness": stamp_loaded(ads.upsert_freshness(empty, window), fixture.LOADED),
        "gate_engagement": spark.createDataFrame([("acme", "EUR", 500_000.0)], ENGAGEMENT),
        "gate_campaigns": spark.createDataFrame(
            [("acme", "lamps", "AP-7", "online_video", 90_000.0, 4_000.0, *span, "live")],
            fixture.GATE["gate_campaigns"],
        ),
        "gate_requests": spark.createDataFrame(
            [("acme", "AP-7", "*", "online_video", 95_000.0, 95_000.0, *span, 5_000.0, "APPROVED", "lamps", None, None)],
            fixture.GATE["gate_requests"],
        ),
    }
    w = Warehouse(raw)
    ov = w.mart_exec_overview().collect()[0]
    assert (ov.spend, ov.is_synthetic, ov.crm_as_of) == (4333.34, False, None)
    hits = [(r.rule, r.campaign) for r in w.mart_alerts().filter("rule = 'unapproved_spend'").collect()]
    assert hits == [("unapproved_spend", "Ropes / trial")]
