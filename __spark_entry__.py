"""

Registered queries round doubles to 6 places, like their SQL, but for the ratio metrics. Money is
added as decimals by the operators, so the order of rows doesn't show, and ratios of equal sums are equal
doubles. The operators themselves do not round.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle import sql as oracle
from spendloom.functions.metrics import METRICS
from spendloom.operators import ads, alerts, fact, gate, marts, quality, reports
from spendloom.operators.joins import HASH
from spendloom.operators.staging import STAGING
from spendloom.params import Params
from spendloom.plans import driver, saved
from spendloom.plans.store import Landing, Store
from spendloom.plans.warehouse import MODELS, Warehouse
from spendloom.sources import audit
from spendloom.sources import state as state_tables
from spendloom.sources.ads import report_rows
from spendloom.sources.extracts import load_counts

try:  # the operations for training data are a part that can be taken out
    import corpus_pipeline
    from spendloom.llm import queries as training_data
except ImportError:  # they, or a library that only they use
    training_data = corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

# Conversions per campaign are few in the given log, so a spike needs fewer of them here.
PARAMS = Params(cpa_spike_ratio=1.1, cpa_spike_min_conversions=3)
ADS_DAYS = 14


def rounded(df: DataFrame) -> DataFrame:
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c), 6) for c in doubles if c not in METRICS})


# Models that read the fact or the campaign mart more than once store them first; the others read
# them once, and build what they need of them.
SHARED = {"mart_alerts", "mart_exec_overview"}


def warehouse(
    spark: SparkSession, sf_dir: str, source: str = "events", stored: str | None = None
) -> Warehouse:
    """``stored``: keep the fact in a database of this name."""
    raw = {"events": driver.from_events, "lineitem": driver.from_lineitem}[source](spark, sf_dir)
    # The log has 33 days, the lines have seven years.
    period = {"events": "MONTH", "lineitem": "YEAR"}[source]
    return Warehouse(raw, PARAMS, Store(spark, f"{stored}_{source}", f"{stored}_{source}", period=period) if stored else None)


def entry(spark: SparkSession) -> DataFrame:
    """Campaign performance: totals, pacing, forecast and all metrics per campaign."""
    return rounded(warehouse(spark, "/root/testdata/sf0.001").mart_campaign_performance())


def _on_warehouse(
    build: Callable[[Warehouse], DataFrame], source: str = "events", stored: str | None = None
) -> Query:
    return lambda spark, sf_dir: rounded(build(warehouse(spark, sf_dir, source, stored)))


def _ads(build: Callable[[dict[str, DataFrame]], DataFrame], landed: bool = False) -> Query:
    """The connector chain, with its stages by name; the report from its landed files if so asked."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        raw = driver.from_events(spark, sf_dir)
        accounts = ads.require_currency(driver.ads_accounts(spark, sf_dir), raw["gate_engagement"])
        window = ads.extraction_window(accounts, ADS_DAYS, F.col("today"))
        report = driver.landed_report(spark, sf_dir) if landed else report_rows(driver.ads_report(spark, sf_dir))
        rows = ads.in_window(ads.normalise(report), window)
        mapped = ads.map_campaigns(rows, driver.ads_campaign_map(spark, sf_dir))
        stages = {
            "accounts": accounts, "window": window, "report": report, "rows": rows, "normalised": ads.normalise(report),
            "mapped": mapped, "extract": ads.platform_extract(mapped),
            "platform": raw["platform_daily"].drop("_loaded_at"),
            "freshness": raw["source_freshness"].drop("_loaded_at"),
        }
        return rounded(build(stages))

    return run


def _restated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after a restatement: the platforms' last ten days are landed wrong, saved, and put right."""
    raw = driver.from_events(spark, sf_dir)
    platform = raw["platform_daily"]
    window = platform.groupBy("client").agg(F.max("date").alias("end")).withColumn("start", F.date_sub("end", 9))
    late = platform.join(window, "client").where(F.col("date") >= F.col("start")).select(platform.columns)
    early = platform.join(window, "client").where(F.col("date") < F.col("start")).select(platform.columns)
    wrong = late.where("campaign <> 'cmp_4'").withColumn("spend", F.col("spend") / 2)
    store = Store(spark, "restated_core", "restated_marts")
    landing = Landing(store, "restated_raw")
    landing.land(raw | {"platform_daily": early.unionByName(wrong)})
    Warehouse(landing.raw(), PARAMS, store).save()
    landing.restate("platform_daily", late, window)
    Warehouse.open(store, landing.raw(), PARAMS).refresh(landing, late.select("client", "date"))
    return rounded(Warehouse.open(store, landing.raw(), PARAMS).fct_performance_daily())


def _one_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The campaign mart after client c1, whose spend was saved wrong, is saved again alone."""
    raw = driver.from_events(spark, sf_dir)
    of_c1, spend = F.col("client") == "c1", F.col("spend")
    wrong = raw["platform_daily"].withColumn("spend", F.when(of_c1, spend / 2).otherwise(spend))
    store = Store(spark, "client_core", "client_marts")
    Warehouse(raw | {"platform_daily": wrong}, PARAMS, store).save()
    Warehouse({name: df.where(of_c1) for name, df in raw.items()}, PARAMS, store).save(client="c1")
    return rounded(spark.table("client_marts.mart_campaign_performance"))


def _save_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a save counts while it writes: rows, rows without a spend, and spend of each model that has one."""
    made = warehouse(spark, sf_dir, stored="counts").save()
    known = [(m.table.split(".")[1], m.rows, m.nulls.get("spend"), m.spend) for m in made if m.table.split(".")[1] in MODELS]
    return rounded(spark.createDataFrame(known, "model string, rows long, no_spend long, spend double"))


def _gate(build: Callable[[Warehouse, SparkSession, str], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(warehouse(spark, sf_dir), spark, sf_dir))


def _saved(name: str, source: str = "events") -> Query:
    return _on_warehouse(
        lambda w: saved.run_saved_query(
            w.daily.sparkSession, name,
            {"fct_performance_daily": w.fct_performance_daily(), "mart_freshness": w.mart_freshness()},
        ).rows,
        source,
    )


def _alert(rule: str) -> Query:
    """One alert rule alone, over the one input it reads."""
    p = PARAMS
    rows, made = {
        "overspend": (lambda w: w.campaigns_checked, alerts.overspend()),
        "budget_exhaustion": (lambda w: w.campaigns_checked, alerts.budget_exhaustion()),
        "pacing_deviation": (lambda w: w.campaigns_checked, alerts.pacing_deviation(p)),
        "cpa_spike": (lambda w: alerts.cpa_windows(w.daily_of()), alerts.cpa_spike(p)),
        "tracking_break": (lambda w: w.daily_of("web"), alerts.tracking_break()),
        "reconciliation": (lambda w: w.campaigns_checked, alerts.reconciliation_gap(p)),
        "unapproved_spend": (lambda w: w.campaigns_checked, alerts.unapproved_spend()),
        "approval_breach": (lambda w: w.approvals_dated, alerts.approval_breach()),
    }[rule]
    return _on_warehouse(lambda w: alerts.raise_alerts(rows(w), made))


def _ledger(w: Warehouse) -> tuple[DataFrame, DataFrame, DataFrame]:
    return w.stg["stg_gate_campaigns"], w.stg["stg_gate_requests"], w.stg["stg_gate_spend"]


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    # Sources: counts per raw table, nested state documents and report batches to rows.
    out["load_counts"] = lambda spark, d: load_counts(driver.from_events(spark, d))
    out["extract_csv_rows"] = lambda spark, d: rounded(driver.csv_rows(spark, d))
    out["landed_counts"] = lambda spark, d: load_counts(driver.landed_extracts(spark, d))
    out["landed_platform_rows"] = lambda spark, d: rounded(driver.landed_extracts(spark, d)["platform_daily"])
    for name, flatten in {
        "state_engagement": state_tables.flatten_engagement,
        "state_requests": state_tables.flatten_requests,
        "state_campaigns": state_tables.flatten_campaigns,
        "state_spend": state_tables.flatten_spend,
    }.items():
        out[name] = lambda spark, d, flatten=flatten: rounded(
            flatten(driver.state_documents(driver.from_events(spark, d)))
        )
    # Staging.
    for name in STAGING:
        out[name] = _on_warehouse(lambda w, name=name: w.stg[name])
    # Fact and its parts.
    out["as_of_dates"] = _on_warehouse(lambda w: fact.as_of_dates(w.stg["stg_source_freshness"]))
    out["reporting_context"] = _on_warehouse(lambda w: w.context)
    out["daily_activity"] = _on_warehouse(lambda w: fact.daily_activity(w.stg).drop(HASH))
    out["campaign_day_spine"] = _on_warehouse(lambda w: fact.spine(w.stg).drop("left_rows", "right_rows"))
    # Marts, over both views of the given tables.
    for name in MODELS:
        build = lambda w, name=name: getattr(w, name)()
        stored = name if name in SHARED else None
        out[name] = _on_warehouse(build, "events", stored)
        out[f"{name}_lineitem"] = _on_warehouse(build, "lineitem", stored)
    for name in ("fct_performance_daily", "mart_campaign_performance", "mart_channel_performance", "mart_funnel",
                 "mart_channel_daily", "mart_reconciliation", "mart_approvals"):
        out[f"{name}_stored"] = _on_warehouse(
            lambda w, name=name: getattr(w, name)(), "events", f"stored_{name}"
        )
    out["fct_performance_daily_restated"] = _restated
    out["save_counts"] = _save_counts
    out["mart_campaign_performance_one_client"] = _one_client
    out["campaign_totals"] = _on_warehouse(
        lambda w: marts.campaign_totals(w.daily).drop("ref_date", *marts.RECENT)
    )
    out["campaign_run_rate"] = _on_warehouse(lambda w: marts.run_rate(marts.campaign_totals(w.daily)))
    out["cpa_windows"] = _on_warehouse(lambda w: alerts.cpa_windows(w.daily_of()).drop("ref_date"))
    for rule in alerts.TEXTS:
        out[f"alert_{rule}"] = lambda spark, d, rule=rule: _alert(rule)(spark, d)
    # Reports and saved queries.
    out["spend_trend"] = _on_warehouse(lambda w: w.spend_trend())
    out["spend_trend_lineitem"] = _on_warehouse(lambda w: w.spend_trend(), "lineitem")
    for name in ("mart_campaign_performance", "mart_channel_performance", "mart_channel_daily", "mart_funnel", "mart_approvals",
                 "mart_alerts", "mart_reconciliation", "mart_freshness", "mart_exec_overview", "spend_trend"):
        out[f"report_{name.removeprefix('mart_')}"] = _on_warehouse(
            lambda w, name=name: reports.numbered(name, getattr(w, name)()),
            "events", f"report_{name}" if name in SHARED else None,
        )
    out["platform_over_claim"] = _saved("platform_over_claim")
    out["channel_by_week"] = _saved("channel_by_week")
    out["channel_by_week_lineitem"] = _saved("channel_by_week", "lineitem")
    out["answer_provenance"] = _on_warehouse(lambda w: saved.provenance(w.mart_freshness()))
    # Ads connector.
    out["ads_account_ids"] = _ads(
        lambda s: s["accounts"].select(
            "client",
            ads.account_digits("account_id").alias("account_id"),
            ads.has_valid_id("account_id").alias("is_valid"),
        )
    )
    out["ads_extraction_window"] = _ads(lambda s: s["window"].select("client", "start", "end"))
    out["ads_report_rows"] = _ads(
        lambda s: s["report"].select(
            "client", "campaign.id", "campaign.name", "segments.date", "metrics.costMicros"
        )
    )
    out["ads_rows_in_window"] = _ads(lambda s: s["rows"])
    out["ads_platform_extract"] = _ads(lambda s: s["extract"])
    out["ads_platform_extract_landed"] = _ads(lambda s: s["extract"], landed=True)
    out["ads_currency_mismatches"] = lambda s, d: ads.currency_mismatches(  # planted: c1's account is in another one
        driver.ads_accounts(s, d).withColumn("currency", F.when(F.col("client") == "c1", "EUR").otherwise(F.col("currency"))),
        driver.from_events(s, d)["gate_engagement"],
    )
    out["ads_rows_without_account"] = _ads(  # planted: client c2 has none
        lambda s: ads.rows_without_account(s["normalised"], s["window"].where("client <> 'c2'"))
    )
    out["ads_unmapped_campaigns"] = _ads(lambda s: ads.unmapped_campaigns(s["mapped"]))
    out["ads_extract_summary"] = _ads(lambda s: ads.extract_summary(s["extract"], s["window"]))
    out["freshness_upsert"] = _ads(lambda s: ads.upsert_freshness(s["freshness"], s["window"]))
    out["restated_platform"] = _ads(
        lambda s: ads.restate_window(
            s["platform"], s["extract"].select(s["platform"].columns), s["window"]
        )
    )
    # Gate and ledger.
    out["approved_total"] = _gate(lambda w, s, d: gate.approved_total(w.stg["stg_gate_requests"]))
    out["ledger_spent"] = _gate(
        lambda w, s, d: gate.spent(w.stg["stg_gate_spend"], by_campaign=True)
    )
    out["ledger_position"] = _gate(lambda w, s, d: w.ledger())
    out["pending_requests"] = _gate(
        lambda w, s, d: gate.pending_requests(w.stg["stg_gate_requests"])
    )
    out["request_by_id"] = _gate(
        lambda w, s, d: gate.request_by_id(w.stg["stg_gate_requests"], "c1", "SAR-1-2")
    )
    out["campaigns_over_budget"] = _gate(
        lambda w, s, d: gate.campaigns_over_budget(
            w.stg["stg_gate_campaigns"], w.stg["stg_gate_spend"]
        )
    )
    out["budget_line"] = _gate(
        lambda w, s, d: gate.budget_line(w.stg["stg_gate_requests"], w.ledger())
    )
    out["authorise_actions"] = _gate(
        lambda w, s, d: gate.authorise(driver.proposed_actions(s, d), *_ledger(w)[:2])
    )
    out["check_requests"] = _gate(
        lambda w, s, d: gate.check_requests(driver.spend_proposals(s, d), w.ledger())
    )
    out["check_approvals"] = lambda s, d: rounded(gate.check_approvals(**driver.recorded_approvals(s, d)))
    out["request_state_replay"] = lambda s, d: rounded(
        gate.request_states(
            driver.recorded_approvals(s, d)["requests"], gate.check_approvals(**driver.recorded_approvals(s, d))
        )
    )
    def decided(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
        given = driver.recorded_approvals(s, d, rejections=True)
        return given["requests"], gate.check_approvals(**given)

    out["check_decisions"] = lambda s, d: rounded(decided(s, d)[1].drop("approved", "cap", "modified"))
    out["request_state_decided"] = lambda s, d: rounded(gate.request_states(*decided(s, d)))
    out["check_pauses"] = _gate(
        lambda w, s, d: gate.check_pauses(driver.proposed_actions(s, d), w.stg["stg_gate_campaigns"])
    )
    out["check_ledger_entries"] = _gate(
        lambda w, s, d: gate.check_ledger_entries(driver.ledger_entries(s, d), w.stg["stg_gate_campaigns"])
    )
    out["check_decreases"] = _gate(
        lambda w, s, d: gate.check_decreases(
            driver.proposed_actions(s, d), w.stg["stg_gate_campaigns"], w.stg["stg_gate_spend"]
        )
    )
    out["campaign_state_replay"] = _gate(
        lambda w, s, d: gate.replay(
            driver.executed_actions(s, d), w.stg["stg_gate_requests"]
        )
    )
    out["campaign_state_from_log"] = _gate(
        lambda w, s, d: gate.replay(audit.executed(driver.landed_audit(s, d)), w.stg["stg_gate_requests"])
    )
    out["audit_positions"] = lambda s, d: driver.landed_audit(s, d).groupBy("client", "event").agg(
        F.count("*").alias("events"), F.min("line").alias("first_line"), F.max("line").alias("last_line"),
        F.sum("line").alias("lines"),
    )
    out["audit_counts"] = lambda s, d: gate.audit_counts(driver.audit_log(s, d))
    out["refused_decisions"] = lambda s, d: gate.refused_decisions(driver.audit_log(s, d))
    out["requests_to_send"] = lambda s, d: gate.requests_to_send(
        state_tables.request_messages(driver.state_documents(driver.from_events(s, d)), "chat")
    )
    out["pending_request_owner"] = lambda s, d: gate.pending_owner(
        state_tables.request_messages(driver.state_documents(driver.from_events(s, d)), "chat")
    )
    out["ambiguous_request_owner"] = lambda s, d: gate.pending_owner(  # planted: ids without their client, all pending
        state_tables.request_messages(driver.state_documents(driver.from_events(s, d)), "chat").withColumns(
            {"request_id": F.regexp_replace("request_id", r"SAR-\d+-", "SAR-"), "status": F.lit("PENDING")}
        ).where("not (client = 'c2' and request_id = 'SAR-1')")
    )
    # Data quality.
    out["duplicate_campaign_days"] = _on_warehouse(
        lambda w: quality.duplicate_keys(  # planted: some days twice
            w.daily_of().unionAll(w.daily_of().filter(F.dayofmonth("date") % 10 == 3)), ["client", "date", "campaign"]
        )
    )
    out["duplicate_order_lines"] = lambda s, d: quality.duplicate_keys(
        driver.table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]
    )
    out["null_counts"] = _on_warehouse(
        lambda w: quality.null_counts(w.daily, ["date", "campaign", "spend", "sessions", "backend_orders"])
    )
    out["null_rows"] = _on_warehouse(
        lambda w: quality.null_rows(w.fct_performance_daily(), ["backend_orders"]).select(
            "client", "date", "campaign"
        )
    )
    out["spend_agreement"] = _on_warehouse(
        lambda w: quality.spend_totals(
            {
                "extract": w.raw["platform_daily"],
                "campaigns": w.mart_campaign_performance(),
                "channels": w.mart_channel_performance(),
                "channel_days": w.mart_channel_daily(),
                "overview": w.mart_exec_overview(),
            }
        ),
        stored="spend_agreement",
    )
    out["budget_agreement"] = _on_warehouse(
        lambda w: quality.budget_position(w.mart_exec_overview(), w.ledger()), stored="budget_agreement"
    )
    out["backend_after_coverage"] = _on_warehouse(
        lambda w: quality.backend_after_coverage(  # planted: the sources claim two days less
            w.fct_performance_daily(), w.mart_freshness().withColumn("data_as_of", F.date_sub("data_as_of", 2))
        ).select("client", "date", "campaign")
    )
    out["forecast_out_of_order"] = _on_warehouse(
        lambda w: quality.forecast_out_of_order(  # planted: two of the forecasts change places
            w.mart_campaign_performance().withColumns(
                {"forecast_spend_low": F.col("forecast_spend_base"), "forecast_spend_base": F.col("forecast_spend_low")}
            )
        ).select("client", "campaign")
    )
    out["mixed_provenance"] = _on_warehouse(lambda w: quality.mixed_provenance(  # planted: one source of some clients is real
            w.mart_freshness().withColumn("is_synthetic", ~((F.col("source") == "plan") & (F.col("client") != "c1")))
        ))
    if training_data:
        out |= training_data.queries()
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    out = oracle.statements()
    if training_data:
        out |= training_data.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out
