"""Saved models: no shuffle on campaigns, all or nothing, and only what a change touches is written again."""

import re
from datetime import date, timedelta
from pathlib import Path
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

import fixture
from spendloom.plans import store as stores
from spendloom.plans.store import Landing, Store, in_parts
from spendloom.plans.warehouse import MODELS, Warehouse
from spendloom.sources import scratch


def _plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxPlanStringLength", "10000000")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def _files(store, table):
    """Path to content of a table's files."""
    location = store.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()[0].data_type
    folder = Path(re.sub("^file:/*", "/", location))
    return {p: p.read_bytes() for p in sorted(folder.rglob("*.parquet"))}


def _store(spark, name, **more):
    return Store(spark, f"{name}_core", f"{name}_marts", buckets=4, **more)


@pytest.fixture(scope="module")
def saved(spark):
    store = _store(spark, "whole")
    raw = fixture.raw_tables(spark, ("a", "b"))
    return Warehouse(raw, store=store).save(), store, raw


def test_saved_models_equal_those_built_from_raw_tables(spark, saved):
    _, store, raw = saved
    plain, opened = Warehouse(raw), Warehouse.open(store, raw)
    for name, database in MODELS.items():
        want = _rows(getattr(plain, name)())
        assert _rows(getattr(opened, name)()) == want, name
        table = spark.table(f"{store.core if database == 'core' else store.marts}.{name}")
        assert _rows(table.drop("part_client", "part_period")) == want, name


@pytest.mark.parametrize("name", sorted(MODELS))
def test_marts_over_the_saved_fact_do_not_shuffle_on_campaign(spark, saved, name):
    _, store, raw = saved
    # Only the raw tables that aren't part of the fact may be read; without their logs the models still work.
    gone = {n: df.limit(0) for n, df in raw.items() if n in ("platform_daily", "web_sessions", "crm_orders", "plan_daily", "gate_spend")}
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        plan = _plan(getattr(Warehouse.open(store, raw | gone), name)())
        # The context of clients is small; a shuffle of it would be on the client.
        assert not re.search(r"Exchange hashpartitioning\([^)]*campaign#", plan)
        assert "InMemoryTableScan" not in plan
        scans = len(re.findall(r"FileScan parquet [^\n]*fct_performance_daily", plan))
        # Alerts have two rules over days and one over approvals; the overview counts alerts.
        assert scans <= {"mart_alerts": 3, "mart_exec_overview": 3}.get(name, 1)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_no_frame_is_cached(spark, saved):
    _, store, raw = saved
    w = Warehouse.open(store, raw)
    for name in MODELS:
        assert not getattr(w, name)().storageLevel.useMemory


def test_counts_of_a_save(saved):
    made, store, raw = saved
    by = {m.table.split(".")[1]: m for m in made}
    fact = store.table(f"{store.core}.fct_performance_daily")
    assert by["fct_performance_daily"].rows == fact.count() == 2 * 9 * 21
    assert by["fct_performance_daily"].nulls == dict.fromkeys(("client", "date", "campaign", "channel", "spend"), 0)
    spend = {by[n].spend for n in ("fct_performance_daily", "mart_campaign_performance", "mart_channel_performance", "mart_exec_overview")}
    assert spend == {raw["platform_daily"].agg(F.sum("spend")).collect()[0][0]}
    assert by["mart_alerts"].rows == 2 * len(fixture.EXPECTED_ALERTS)


def test_one_client_is_replaced_and_nobody_else(spark):
    store = _store(spark, "clients")
    Warehouse(fixture.raw_tables(spark, ("a", "b")), store=store).save()
    tables = [f"{store.core}.{t}" for t in ("fct_performance_daily", "campaign_terms", "campaign_days", "reporting_context")]
    tables += [f"{store.marts}.{n}" for n, d in MODELS.items() if d == "marts"]
    before = {t: _files(store, t) for t in tables}
    spend = lambda c: spark.table(f"{store.marts}.mart_exec_overview").where(F.col("client") == c).collect()[0].spend
    was = spend("a"), spend("b")

    def half(name, rows):
        return [(*r[:7], r[7] / 2, *r[8:]) for r in rows] if name == "platform_daily" else rows

    Warehouse(fixture.raw_tables(spark, ("a",), change=half), store=store).save(client="a")
    assert (spend("a"), spend("b")) == (was[0] / 2, was[1])
    for t in tables:
        after = _files(store, t)
        others = {p: x for p, x in before[t].items() if "client=b" in str(p)}
        assert others and all(after.get(p) == x for p, x in others.items()), t
    # A client without rows any more loses its partitions.
    Warehouse(fixture.raw_tables(spark, only=set()), store=store).save(client="a")
    left = {r.client for t in tables for r in spark.table(t).select("client").distinct().collect()}
    assert left == {"b"}


def test_a_failed_model_publishes_nothing(spark, saved):
    store = _store(spark, "failing")
    raw = fixture.raw_tables(spark, ("a",))
    Warehouse(raw, store=store).save()
    tables = [f"{store.core}.fct_performance_daily", *(f"{store.marts}.{n}" for n, d in MODELS.items() if d == "marts")]
    before = {t: _files(store, t) for t in tables}
    twice = raw | {"source_freshness": raw["source_freshness"].unionAll(raw["source_freshness"]),
                   "platform_daily": raw["platform_daily"].withColumn("spend", F.lit(1.0))}
    with pytest.raises(Exception, match="more than one row for source"):
        Warehouse(twice, store=store).save()
    assert {t: _files(store, t) for t in tables} == before
    assert not [t.name for d in (store.core, store.marts) for t in spark.catalog.listTables(d) if t.name.endswith("__new")]


def _two_months(spark, **more):
    """The fixture a second time, two months later: three months of days."""
    later = timedelta(days=61)
    moved = {"platform_daily": 2, "web_sessions": 1, "crm_orders": 2, "plan_daily": 1}

    def change(name, rows):
        rows = list(rows)
        if name in moved:
            i = moved[name]
            rows += [(*r[:i], r[i] + later, *r[i + 1 :]) for r in rows]
        if name == "gate_spend":
            rows += [(*r[:3], str(date.fromisoformat(r[3]) + later)) for r in rows]
        if name == "source_freshness":
            rows = [(r[0], r[1], r[2] + later, r[3]) for r in rows]
        return more["then"](name, rows) if "then" in more else rows

    return fixture.raw_tables(spark, ("a", "b"), change=change)


def test_a_restated_window_rewrites_its_partitions_only(spark):
    store = _store(spark, "restated")
    landing = Landing(store, "restated_raw")
    counts = {m.table.split(".")[1]: m.rows for m in landing.land(_two_months(spark))}
    assert counts["platform_daily"] == 2 * 2 * 9 * 17
    Warehouse(landing.raw(), store=store).save()
    fact = f"{store.core}.fct_performance_daily"
    before = _files(store, fact)
    # Spend of client a's last days of the flight in May is restated.
    start, end = date(2025, 5, 5), date(2025, 5, 10)
    window = spark.createDataFrame([("a", start, end)], "client string, start date, end date")
    rows = landing.raw()["platform_daily"].where((F.col("client") == "a") & F.col("date").between(start, end))
    rows = rows.withColumns({"spend": F.col("spend") * 3, "clicks": F.lit(7).cast("long")}).where("campaign <> 'kiln'")
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    assert landing.restate("platform_daily", rows, window) == [("a", "2025-05-01")]
    w = Warehouse.open(store, landing.raw())
    changed = rows.select("client", "date")
    parts = w.refresh(landing, changed)
    assert parts == [("a", "2025-05-01")]
    # Every other partition has the files it had.
    after = _files(store, fact)
    same = {p for p in before if not ("part_client=a" in str(p) and "part_period=2025-05-01" in str(p))}
    assert same and all(after[p] == before[p] for p in same) and set(before) - same and not (set(before) - same) & set(after)
    # What is saved is what a build from nothing gives.
    plain = Warehouse(landing.raw())
    for name, database in MODELS.items():
        table = spark.table(f"{store.core if database == 'core' else store.marts}.{name}").drop("part_client", "part_period")
        assert _rows(table) == _rows(getattr(plain, name)()), name
    # The inputs of a refresh are pruned to the touched partitions.
    pruned = Warehouse(landing.raw(parts)).fct_performance_daily()
    read = {f for f in pruned.inputFiles() if "part_client=" in f}
    assert read and all("part_client=a/part_period=2025-05-01" in f for f in read)
    assert len(re.findall(r"PartitionFilters: \[\(concat_ws\(\|, part_client", _plan(pruned))) >= 5
    # Versions that were replaced as a whole can be swept away; the tables stay as they are.
    kept = _files(store, f"{store.marts}.mart_alerts")
    assert store.sweep() > 0 and store.sweep() == 0 and _files(store, f"{store.marts}.mart_alerts") == kept
    assert _files(store, fact) == after


def test_as_of_days_and_requests_touch_their_days(spark):
    store = _store(spark, "moved")
    landing = Landing(store, "moved_raw")
    landing.land(_two_months(spark))
    Warehouse(landing.raw(), store=store).save()
    none = spark.createDataFrame([], "client string, date date")
    opened = lambda: Warehouse.open(store, landing.raw())
    assert opened().touched(none) == []
    # The CRM of client b reports one more day; campaign kiln of client a loses its request.
    fresh = landing.raw()["source_freshness"]
    moved = F.when((F.col("client") == "b") & (F.col("source") == "crm"), F.date_add("data_as_of", 1)).otherwise(F.col("data_as_of"))
    landing.replace("source_freshness", fresh.withColumn("data_as_of", moved))
    assert opened().touched(none) == [("b", "2025-05-01")]
    campaigns = landing.raw()["gate_campaigns"]
    landing.replace("gate_campaigns", campaigns.where("not (client = 'a' and campaign = 'kiln')"))
    want = [("a", "2025-03-01"), ("a", "2025-05-01"), ("b", "2025-05-01")]
    assert opened().touched(none) == want and opened().refresh(landing, none) == want
    plain = Warehouse(landing.raw())
    for name in ("fct_performance_daily", "mart_alerts", "mart_exec_overview"):
        table = spark.table(f"{store.core if MODELS[name] == 'core' else store.marts}.{name}").drop("part_client", "part_period")
        assert _rows(table) == _rows(getattr(plain, name)()), name


def test_partitions_of_odd_rows(spark):
    rows = spark.createDataFrame([("a", date(2025, 5, 9)), (None, None)], "client string, date date")
    from spendloom.plans.store import parts_of

    got = rows.select(*(c.alias(n) for n, c in parts_of("date", "MONTH").items()))
    assert sorted(map(tuple, got.collect())) == [("a", "2025-05-01"), ("none", "none")]
    assert got.where(in_parts([("none", "none")])).count() == 1


def test_a_fact_of_larger_files_has_more_buckets(spark, monkeypatch):
    store, raw = _store(spark, "larger"), fixture.raw_tables(spark, ("a",))
    landing = Landing(store, "larger_raw")
    landing.land(raw)
    size = stores.bytes_read(list(landing.raw().values()))
    monkeypatch.setattr(stores, "BUCKET_BYTES", -(-size // 9))
    Warehouse(landing.raw(), store=store).save()
    found = {store.buckets_of(f"{store.core}.{t}") for t in ("fct_performance_daily", "campaign_days", "campaign_terms")}
    assert found == {9}
    assert _rows(Warehouse.open(store, landing.raw()).fct_performance_daily()) == _rows(Warehouse(raw).fct_performance_daily())


def test_a_staged_fact_leaves_no_shuffle_files_and_no_scratch_rows(spark, tmp_path, monkeypatch):
    """What its joins and its buckets were dealt by is gone once it is written, before a mart is made of it."""
    monkeypatch.setattr(scratch, "scratch_path", lambda spark: f"{tmp_path}/{uuid4().hex}")
    kept = lambda: spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().size()
    df = spark.range(3000).selectExpr("concat('c', id % 3) as client", "concat('x', id % 50) as campaign", "date_add(date'2024-01-01', cast(id % 90 as int)) as date", "id as spend")
    joined = df.join(df.groupBy("campaign").agg(F.max("spend").alias("most")).hint("merge"), "campaign")
    store, before = _store(spark, "room"), kept()
    assert store.stage_fact(joined, f"{store.core}.fact").rows == 3000
    assert kept() <= before
    assert [spark.read.parquet(str(f)).count() for f in tmp_path.iterdir()] == [0]
    assert _rows(store.table(f"{store.core}.fact").drop(*stores.PARTS)) == _rows(joined)
    store.drop_staged()
