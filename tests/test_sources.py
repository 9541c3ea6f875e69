"""Files in and out, saved tables, saved queries and the audit stream."""

import json
from datetime import date, datetime
from pathlib import Path

import pytest

import fixture
from spendloom.operators import gate
from spendloom.plans.saved import load_saved_query, run_saved_query
from spendloom.plans.warehouse import MODELS, Warehouse
from spendloom.schemas import EXTRACTS
from spendloom.sources import extracts
from spendloom.sources.audit import executed, read_audit
from spendloom.sources.state import gate_tables, read_state
from spendloom.streaming.audit import append_audit, stream_audit

FRESH = "source,data_as_of,is_synthetic\r\ncrm,2026-09-30,True\r\nplan,2026-10-02,False\r\n"


def _write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{name}.csv").write_text(text, newline="")


def test_one_client_folder_and_missing_extract(spark, tmp_path):
    _write(tmp_path, "source_freshness", FRESH)
    df = extracts.read_extract(spark, str(tmp_path), "source_freshness", client="acme")
    assert sorted(map(tuple, df.collect())) == [
        ("acme", "crm", date(2026, 9, 30), True), ("acme", "plan", date(2026, 10, 2), False),
    ]
    missing = extracts.read_extract(spark, str(tmp_path), "crm_orders", client="acme")
    assert missing.columns == ["client", *EXTRACTS["crm_orders"].names] and missing.count() == 0


def test_all_clients_in_one_scan(spark, tmp_path):
    for client in ("007", "b"):
        _write(tmp_path / f"client={client}", "source_freshness", FRESH)
    df = extracts.read_extract(spark, str(tmp_path), "source_freshness")
    assert {r.client for r in df.collect()} == {"007", "b"} and df.count() == 4
    assert extracts.read_extract(spark, str(tmp_path), "plan_daily").count() == 0


@pytest.mark.parametrize(
    "text", [FRESH.replace("2026-09-30", "soon"), FRESH.replace("data_as_of", "as_of")]
)
def test_a_bad_cell_or_header_fails(spark, tmp_path, text):
    _write(tmp_path, "source_freshness", text)
    with pytest.raises(Exception):
        extracts.read_extract(spark, str(tmp_path), "source_freshness", client="x").collect()


def test_extract_round_trip(spark, tmp_path):
    raw = fixture.raw_tables(spark, ("a", "b"))
    for name in EXTRACTS:
        df = raw[name].drop("_loaded_at")
        extracts.write_csv(df, str(tmp_path / name), ("client",))
        back = (
            spark.read.schema(df.schema).option("header", True).option("mode", "FAILFAST")
            .csv(str(tmp_path / name)).select(df.columns)
        )
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect())), name


def test_written_extracts_are_read_again(spark, tmp_path):
    raw = fixture.raw_tables(spark, ("a", "b"))
    extracts.write_csv(raw["plan_daily"].drop("_loaded_at"), str(tmp_path / "plan_daily"), ("client",))
    back = extracts.read_extract(spark, str(tmp_path), "plan_daily", by_extract=True)
    assert sorted(map(str, back.collect())) == sorted(map(str, raw["plan_daily"].drop("_loaded_at").collect()))
    assert extracts.read_extract(spark, str(tmp_path), "crm_orders", by_extract=True).count() == 0


def test_load_stamp_and_counts(spark):
    raw = fixture.raw_tables(spark)
    assert raw["plan_daily"].select("_loaded_at").distinct().collect()[0][0] == fixture.LOADED
    counts = {r.table: r.rows for r in extracts.load_counts(raw).collect()}
    assert (counts["plan_daily"], counts["platform_daily"], counts["gate_requests"]) == (9 * 21, 9 * 17, 3)


def test_replace_table_and_restate(spark, tmp_path):
    one = spark.range(3)
    extracts.replace_table(one, "scratch.t")
    extracts.replace_table(one.limit(1), "scratch.t")
    assert spark.table("scratch.t").count() == 1
    path = str(tmp_path / "days")
    days = lambda *rows: spark.createDataFrame(list(rows), "client string, date date, v int")
    d1, d2 = date(2026, 1, 1), date(2026, 1, 2)
    extracts.restate_partitions(days(("a", d1, 1), ("a", d2, 2), ("b", d2, 3)), path)
    extracts.restate_partitions(days(("a", d2, 9)), path)
    got = sorted((r.client, r.date, r.v) for r in spark.read.parquet(path).collect())
    assert got == [("a", d1, 1), ("a", d2, 9), ("b", d2, 3)]


def test_state_document(spark, tmp_path):
    request = {"id": "SAR-0001", "campaign": "*", "channel": "s", "amount": 5.0, "status": "PENDING",
               "approved_amount": 0.0, "decided_at": None}
    campaign = {"request_id": "SAR-0001", "channel": "s", "budget": 4.0, "daily_budget": 1.0,
                "start": "2026-01-01", "end": "2026-01-31", "status": "live"}
    full = {"client": "a", "currency": "INR", "ceiling": 9.0, "seq": 1, "requests": {"SAR-0001": request},
            "campaigns": {"c": campaign}, "spend": [{"campaign": "c", "amount": 1.5, "date": "2026-01-02"}]}
    bare = {"client": "b", "currency": "USD", "ceiling": 1.0, "seq": 0, "requests": {}, "campaigns": {}, "spend": []}
    for doc in (full, bare):
        (tmp_path / f"{doc['client']}.json").write_text(json.dumps(doc, indent=2))
    tables = gate_tables(read_state(spark, str(tmp_path)))
    assert {n: t.count() for n, t in tables.items()} == {
        "gate_engagement": 2, "gate_requests": 1, "gate_campaigns": 1, "gate_spend": 1,
    }
    row = tables["gate_requests"].collect()[0]
    assert (row.client, row.id, row.summary, row.daily_cap) == ("a", "SAR-0001", None, None)
    assert tables["gate_campaigns"].collect()[0].campaign == "c"


AUDIT_LINES = [
    {"at": "2026-11-05T10:00:00+00:00", "actor": "ceo", "event": "request_created", "request_id": "R", "amount": 5.0},
    {"at": "2026-11-05T10:00:00+00:00", "actor": "ads", "event": "action_blocked",
     "action": {"type": "launch", "campaign": "x"}, "reason": "expired"},
    {"at": "2026-11-05T10:00:01+00:00", "actor": "unknown", "event": "decision_refused_bad_key", "request_id": "R"},
]


def test_audit_scan_keeps_file_order(spark, tmp_path):
    path = tmp_path / "acme.audit.jsonl"
    path.write_text("".join(json.dumps(e) + "\n" for e in AUDIT_LINES))
    audit = read_audit(spark, str(path), "acme")
    rows = audit.orderBy("line").collect()
    assert [r.line for r in rows] == [1, 2, 3] and [r.seq for r in rows] == [None] * 3
    assert [r.event for r in rows] == [e["event"] for e in AUDIT_LINES]
    assert rows[1].action.campaign == "x" and rows[0].file.endswith("acme.audit.jsonl")
    counts = {(r.event, r.reason): r.events for r in gate.audit_counts(audit).collect()}
    assert counts[("action_blocked", "expired")] == 1 and len(counts) == 3
    assert [r.refused for r in gate.refused_decisions(audit).collect()] == [1]


def test_positions_do_not_change_with_how_files_are_cut(spark, tmp_path):
    """Numbers of lines, whatever the size of blocks and whatever other files there are."""
    event = {"at": "2026-11-05T10:00:00+00:00", "actor": "x", "event": "spend_recorded"}

    def log(name, n):
        lines = [json.dumps({**event, "note": f"{name}-{i} " + "é" * (i % 40)}) for i in range(1, n + 1)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(lines) + "\n")

    def read():
        return {(Path(r.file).name, r.note.split()[0]): r.line for r in read_audit(spark, str(tmp_path)).collect()}

    log("a", 700)
    before, first = spark.conf.get("spark.sql.files.maxPartitionBytes"), read()
    assert first == {("a.jsonl", f"a-{i}"): i for i in range(1, 701)}
    try:
        for size in ("900b", "7k", "1g"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            assert read() == first
        log("0", 300)
        assert {k: v for k, v in read().items() if k[0] == "a.jsonl"} == first and len(read()) == 1_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_log_without_numbers_is_replayed_by_its_lines(spark, tmp_path):
    def act(kind, **more):
        return {"at": "2026-11-05T10:00:00+00:00", "actor": "x", "event": "action_executed",
                "action": {"type": kind, "campaign": "c", **more}}

    lines = [act("launch", request_id="R", budget=10.0, daily_budget=5.0), act("decrease_budget", budget=8.0, daily_budget=2.0),
             act("increase_budget", budget=20.0, daily_budget=6.0), act("decrease_budget", budget=9.0, daily_budget=4.0)]
    (tmp_path / "a.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))
    terms = spark.createDataFrame([], "client string, request_id string, start_date date, end_date date")
    (row,) = gate.replay(executed(read_audit(spark, str(tmp_path), "acme")), terms).collect()
    assert (row.budget, row.daily_budget, row.status) == (9.0, 4.0, "live")


def test_audit_stream_lands_each_line_once(spark, tmp_path):
    source, sink, checkpoint = (tmp_path / n for n in ("in", "out", "checkpoint"))
    source.mkdir()
    for i, events in enumerate((AUDIT_LINES[:2], AUDIT_LINES[2:], [])):
        if events:
            (source / f"{i}.jsonl").write_text("".join(json.dumps(e) + "\n" for e in events))
        append_audit(stream_audit(spark, str(source)), str(sink), str(checkpoint)).awaitTermination()
    assert spark.read.parquet(str(sink)).count() == 3


# ---------------------------------------------------------------- saved queries

HEADER = "".join(f"-- {f}: x\n" for f in ("question", "period", "source", "metrics", "caveats"))


@pytest.fixture(scope="module")
def saved_tables(spark):
    Warehouse(fixture.raw_tables(spark)).save()


def test_saved_queries_run_over_saved_tables(spark, saved_tables):
    answer = run_saved_query(spark, "platform_over_claim")
    rows = answer.rows.collect()
    assert {r.channel for r in rows} == {"video", "audio", "maps"}
    assert [r.over_claim_ratio for r in rows] == sorted((r.over_claim_ratio for r in rows), reverse=True)
    assert "CRM" in answer.header["question"]
    made = answer.provenance.collect()[0]
    assert (made.platform_as_of, made.crm_as_of, made.synthetic) == (fixture.PLATFORM_TO, fixture.CRM_TO, False)
    weeks = run_saved_query(spark, "channel_by_week").rows.collect()
    assert all(r.week.isoweekday() == 1 for r in weeks) and len(weeks) == 3 * 3


def test_a_users_own_query_text_runs_unchanged(spark, saved_tables, tmp_path):
    text = HEADER + (
        "select channel, sum(spend)::double as spend, date_trunc('week', max(date))::date as w\n"
        "from core.fct_performance_daily where has_platform_data group by 1 order by spend desc;\n"
    )
    path = tmp_path / "mine.sql"
    path.write_text(text)
    rows = run_saved_query(spark, path).rows.collect()
    assert len(rows) == 3 and rows[0].spend >= rows[1].spend >= rows[2].spend


def test_saved_query_over_frames_leaves_views_and_literals_alone(spark, saved_tables, tmp_path):
    spark.range(1).createOrReplaceTempView("fct_performance_daily")
    models = {n: spark.table(f"{MODELS[n]}.{n}") for n in ("fct_performance_daily", "mart_freshness")}
    path = tmp_path / "literal.sql"
    path.write_text(HEADER + "select 'core.fct_performance_daily' as t, count(*) as n -- marts.mart_freshness\nfrom core.fct_performance_daily")
    answer = run_saved_query(spark, path, models)
    (row,) = answer.rows.collect()
    assert (row.t, row.n) == ("core.fct_performance_daily", 9 * 21)
    assert answer.provenance.count() == 1 and spark.table("fct_performance_daily").count() == 1
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("saved_")]
    spark.catalog.dropTempView("fct_performance_daily")


@pytest.mark.parametrize(
    "text, told",
    [
        ("select reflect('java.lang.System', 'getProperty', 'user.home') as x", "reflect"),
        ("with t as (select java_method('java.lang.Math', 'abs', -1) as x) select * from t", "java_method"),
        ("select * from scratch.t", "scratch.t"),
        ("select * from (select max(spend) from marts.mart_funnel where exists (select 1 from scratch.t))", "scratch.t"),
        ("select * from parquet.`/etc/hosts`", "parquet"),
        ("select transform(channel) using 'cat' as (x) from marts.mart_funnel", "Script"),
        ("select * from read_files('/etc')", "read_files"),
        ("select * from mart_funnel", "mart_funnel"),
    ],
)
def test_saved_query_is_refused_by_its_plan(spark, saved_tables, tmp_path, text, told):
    path = tmp_path / "refused.sql"
    path.write_text(HEADER + text)
    with pytest.raises(ValueError, match=told):
        run_saved_query(spark, path)


def test_saved_query_may_name_parts_and_count(spark, saved_tables, tmp_path):
    path = tmp_path / "parts.sql"
    path.write_text(HEADER + "with Spent as (select channel, sum(spend) as s from core.fct_performance_daily group by 1)\n"
                    "select s.channel, n.id, (select count(*) from marts.mart_alerts) as a from spent s, range(2) n")  # fmt: skip
    assert run_saved_query(spark, path).rows.count() == 6


def test_saved_query_needs_its_header(tmp_path):
    path = tmp_path / "bare.sql"
    path.write_text("select 1")
    with pytest.raises(ValueError, match="question, period, source, metrics, caveats"):
        load_saved_query(path)


@pytest.mark.parametrize(
    "statement",
    ["drop table marts.mart_alerts", "insert into marts.mart_alerts select * from marts.mart_alerts",
     "with t as (select 1) insert into marts.mart_alerts select * from marts.mart_alerts",
     "create table marts.x as select 1", "select 1) ; drop table marts.mart_alerts --"],
)
def test_saved_query_is_read_only(spark, saved_tables, tmp_path, statement):
    path = tmp_path / "write.sql"
    path.write_text(HEADER + statement)
    with pytest.raises(Exception):
        run_saved_query(spark, path).rows.collect()
    assert spark.catalog.tableExists("marts.mart_alerts")
