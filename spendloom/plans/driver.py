"""The given tables, read as the nine raw tables of the domain.

Two views of them: `from_events` (a 30-day log; small campaigns, all gate tables) and
`from_lineitem` (suppliers as campaigns over seven years; the large one). All money is
handled in whole cents until the last step, so both engines compute equal doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendloom.operators.joins import lookup
from spendloom.schemas import ADS_BATCHES, AUDIT, EXTRACTS, STATE
from spendloom.sources.ads import read_ads_report
from spendloom.sources.audit import read_audit
from spendloom.sources.extracts import read_extract, write_csv
from spendloom.sources.scratch import scratch_path

SUPPLIERS = 10**12  # above any supplier number
LOADED_AT = "2024-01-31 06:00:00"
# Days from a log's last day to a source's as-of day; the plan runs on beyond the log.
COVERED = {"ad_platforms": 0, "web_analytics": 0, "crm": -1, "plan": 3}
COVERED_LINES = {"ad_platforms": -21, "web_analytics": -21, "crm": -23}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def money_of(c: Column) -> Column:
    return c.cast("double") / 100.0


def _loaded(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    at = F.lit(LOADED_AT).cast("timestamp_ntz")
    return {name: df.withColumn("_loaded_at", at) for name, df in raw.items()}


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their client, campaign and channel (user id modulo 3, 30 and 5)."""
    n = F.col("user_id") % 30
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("c"), F.col("user_id") % 3).alias("client"),
        F.concat(F.lit("cmp_"), n).alias("campaign"),
        F.concat(F.lit("ch_"), F.col("user_id") % 5).alias("channel"),
        n.alias("n"),
        F.to_date("ts").alias("date"),
        "ts",
        "event_id",
        "user_id",
        "event_type",
        "value",
        cents("value").alias("c"),
    )


def _calendar(log: DataFrame) -> DataFrame:
    """First and last day of a client's log: client, first_day, last_day."""
    return log.groupBy("client").agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"))


def _freshness(calendar: DataFrame, days: dict[str, int], synthetic: bool) -> DataFrame:
    after = F.create_map(*(F.lit(x) for pair in days.items() for x in pair))
    return calendar.select("client", "last_day", F.explode(after).alias("source", "n")).select(
        "client", "source", F.date_add("last_day", F.col("n")).alias("data_as_of"),
        F.lit(synthetic).alias("is_synthetic"),
    )


def _budgets(log: DataFrame) -> DataFrame:
    """One row per campaign: budget in cents from its spend, by campaign number, and its flight."""
    spend = F.when(F.col("event_type").isin("view", "click"), F.col("c")).otherwise(0)
    digit = F.col("n") % 10
    share = F.when(digit == 0, 90).when(digit == 1, 105).when(digit == 2, 111).otherwise(130)
    return (
        log.groupBy("client", "campaign", "channel", "n")
        .agg(F.sum(spend).alias("spent"))
        .join(_calendar(log), "client")
        .withColumn("starts", F.col("first_day"))
        .withColumn("ends", F.date_add("last_day", COVERED["plan"]))
        .withColumn("budget", F.floor(F.col("spent") * share / 100).cast("bigint"))
        .withColumn("daily", F.floor(F.col("budget") / F.datediff("ends", "starts")).cast("bigint"))
    )


def _request_id() -> Column:
    return F.concat(F.lit("SAR-"), F.substring("client", 2, 9), F.lit("-"), F.substring("channel", 4, 9))


def from_events(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    log = event_log(spark, sf_dir)
    is_ = lambda *kinds: F.col("event_type").isin(*kinds)
    platform = (
        log.groupBy("client", "campaign", "channel", "date")
        .agg(
            (F.count_if(is_("view")) * 1000).alias("impressions"),
            (F.count_if(is_("click")) * 100).alias("clicks"),
            money_of(F.sum(F.when(is_("view", "click"), F.col("c")).otherwise(0))).alias("spend"),
            F.count_if(is_("purchase", "signup")).cast("double").alias("platform_conversions"),
            money_of(F.sum(F.when(is_("purchase"), F.col("c")).otherwise(0))).alias("platform_revenue"),
        )
        .withColumn("source", F.concat(F.lit("src_"), F.substring("channel", 4, 9)))
        .withColumn("is_synthetic", F.lit(True))
    )
    broken = (F.col("campaign") == "cmp_7") & F.dayofmonth("date").isin(25, 26)
    web = log.filter(is_("click")).select(
        "client", "date",
        F.concat(F.lit("src_"), F.substring("channel", 4, 9)).alias("utm_source"),
        F.lit("cpc").alias("utm_medium"), F.col("campaign").alias("utm_campaign"),
        F.when(broken, 0).otherwise(60).cast("bigint").alias("sessions"),
        F.lit(True).alias("is_synthetic"),
    )
    crm = log.filter(is_("purchase")).select(
        "client", F.concat(F.lit("ord_"), "event_id").alias("order_id"),
        F.col("date").alias("order_date"), F.col("campaign").alias("utm_campaign"),
        F.col("value").alias("revenue"), (F.col("event_id") % 3 != 0).alias("new_customer"),
        F.lit(True).alias("is_synthetic"),
    )
    budgets = _budgets(log)
    days = F.sequence("starts", "ends")
    channel_no = F.substring("channel", 4, 9).cast("int")
    kpi = F.when(channel_no <= 2, "cpa_backend").when(channel_no == 3, "cpm").otherwise("reach")
    plan = budgets.filter("campaign <> 'cmp_13'").select(
        "client", F.explode(days).alias("date"), "campaign", "channel",
        money_of(F.col("daily")).alias("planned_spend"), kpi.alias("kpi"),
        (channel_no * 10 + 40).cast("double").alias("kpi_target"),
        F.lit(True).alias("is_synthetic"),
    )
    # Client c2 has no CRM connected.
    freshness = _freshness(_calendar(log), COVERED, True).filter("not (client = 'c2' and source = 'crm')")
    launched = budgets.filter("campaign <> 'cmp_17'").withColumn("request_id", _request_id())
    campaigns = launched.select(
        "client", "campaign", "request_id", "channel",
        money_of(F.col("budget")).alias("budget"), money_of(F.col("daily")).alias("daily_budget"),
        F.date_format("starts", "yyyy-MM-dd").alias("start"), F.date_format("ends", "yyyy-MM-dd").alias("end"),
        F.when(F.col("n") % 7 == 0, "paused").otherwise("live").alias("status"),
    )
    # One request per client and channel: 2-1 is pending, 1-4 rejected, 1-2 approved too low.
    rid = F.col("request_id")
    status = F.when(rid == "SAR-2-1", "PENDING").when(rid == "SAR-1-4", "REJECTED").otherwise("APPROVED")
    share = F.when(rid == "SAR-1-2", 80).otherwise(120)
    requests = (
        launched.groupBy("client", "channel", "request_id")
        .agg(
            F.sum("budget").alias("b"), F.sum("daily").alias("d"),
            F.min("starts").alias("starts"), F.max("ends").alias("ends"),
        )
        .select(
            "client", rid.alias("id"),
            F.when(rid == "SAR-0-0", "cmp_0").otherwise("*").alias("campaign"), "channel",
            money_of(F.floor(F.col("b") * 125 / 100)).alias("amount"),
            money_of(F.when(status == "APPROVED", F.floor(F.col("b") * share / 100)).otherwise(0))
            .alias("approved_amount"),
            F.date_format("starts", "yyyy-MM-dd").alias("start"), F.date_format("ends", "yyyy-MM-dd").alias("end"),
            money_of(F.floor(F.col("d") * 110 / 100)).alias("daily_cap"),
            status.alias("status"), F.concat(F.lit("Envelope for "), "channel").alias("summary"),
            F.lit("2023-12-20T09:00:00+00:00").alias("requested_at"),
            F.when(status != "PENDING", "2023-12-21T10:30:00+00:00").alias("decided_at"),
        )
    )
    engagement = launched.groupBy("client").agg(F.sum("budget").alias("b")).select(
        "client", F.when(F.col("client") == "c2", "USD").otherwise("INR").alias("currency"),
        money_of(F.floor(F.col("b") * 115 / 100)).alias("ceiling"),
    )
    booked = F.when(F.col("campaign") == "cmp_11", F.floor(F.round(F.col("spend") * 100) * 96 / 100)).otherwise(
        F.round(F.col("spend") * 100)
    )
    spend = platform.filter("campaign <> 'cmp_17'").select(
        "client", "campaign", money_of(booked).alias("amount"), F.col("date").cast("string").alias("date")
    )
    return _loaded(
        {
            "platform_daily": platform, "web_sessions": web, "crm_orders": crm, "plan_daily": plan,
            "source_freshness": freshness, "gate_engagement": engagement, "gate_requests": requests,
            "gate_campaigns": campaigns, "gate_spend": spend,
        }
    )


def _named(suppkey: str) -> dict[str, Column]:
    """A supplier as a campaign: client and channel are its number modulo 5 and 7."""
    k = F.col(suppkey)
    return {
        "client": F.concat(F.lit("client_"), k % 5),
        "campaign": F.concat(F.lit("sup_"), k),
        "channel": F.concat(F.lit("ch_"), k % 7),
    }


def from_lineitem(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Suppliers as campaigns, order lines as delivery, sessions and ledger, orders as CRM."""
    read = lambda name: table(spark, sf_dir, name)
    suppliers = read("supplier").select("s_suppkey").withColumns(_named("s_suppkey"))
    # Clients by supplier number, so that the lines are summed before names are put on.
    shipped = read("lineitem").groupBy((F.col("l_suppkey") % 5).alias("k")).agg(
        F.to_date(F.min("l_shipdate")).alias("first_day"), F.to_date(F.max("l_shipdate")).alias("last_day")
    )
    calendar = shipped.select(F.concat(F.lit("client_"), "k").alias("client"), "first_day", "last_day")
    lines = read("lineitem").select(
        "l_orderkey", "l_suppkey", "l_linenumber", F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("q"), "l_extendedprice",
        (F.col("l_returnflag") == "R").alias("returned"),
    )
    # Summed by supplier number; the names are put on afterwards.
    platform = (
        lines.groupBy("l_suppkey", "date")
        .agg(
            (F.sum("q") * 1000).alias("impressions"), (F.sum("q") * 10).alias("clicks"),
            F.sum(cents("l_extendedprice")).alias("c"), F.count("*").cast("double").alias("platform_conversions"),
        )
        .withColumns(_named("l_suppkey"))
        .select(
            "client", F.lit("network").alias("source"), "date", "campaign", "channel", "impressions",
            "clicks", money_of(F.col("c")).alias("spend"), "platform_conversions",
            money_of(F.col("c") * 2).alias("platform_revenue"), F.lit(False).alias("is_synthetic"),
        )
    )
    web = lines.withColumns(_named("l_suppkey")).select(
        "client", "date", F.lit("network").alias("utm_source"), F.lit("cpc").alias("utm_medium"),
        F.col("campaign").alias("utm_campaign"),
        F.when(F.col("returned"), 0).otherwise(F.col("q") * 8).alias("sessions"),
        F.lit(False).alias("is_synthetic"),
    )
    # The order belongs to the supplier of its first line; an order without lines to nobody.
    # Line and supplier number in one bigint, which a hash aggregate can take the least of.
    line_then_supplier = F.col("l_linenumber").cast("bigint") * SUPPLIERS + F.col("l_suppkey")
    first = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        (F.min(line_then_supplier) % SUPPLIERS).alias("l_suppkey")
    )
    crm = (
        read("orders")
        .join(first, "o_orderkey", "left")
        .withColumns(_named("l_suppkey"))
        .select(
            "client", F.concat(F.lit("ord_"), "o_orderkey").alias("order_id"),
            F.to_date("o_orderdate").alias("order_date"), F.col("campaign").alias("utm_campaign"),
            F.col("o_totalprice").alias("revenue"), (F.col("o_custkey") % 3 != 0).alias("new_customer"),
            F.lit(False).alias("is_synthetic"),
        )
    )
    # The plan covers the last 120 days, of which the platforms haven't reported 21.
    days = F.sequence(F.date_sub("last_day", 119), F.col("last_day"))
    plan = suppliers.join(calendar, "client").select(
        "client", F.explode(days).alias("date"), "campaign", "channel",
        F.lit(30000.0).alias("planned_spend"),
        F.when(F.col("s_suppkey") % 2 == 0, "cpa_backend").otherwise("cpm").alias("kpi"),
        F.lit(25000.0).alias("kpi_target"), F.lit(False).alias("is_synthetic"),
    )
    freshness = _freshness(calendar, COVERED_LINES, False)
    span = {"start": F.lit("1995-01-01"), "end": F.lit("2001-12-31")}
    request = F.concat(F.lit("SAR-"), "client", F.lit("-"), "channel")
    campaigns = suppliers.filter(F.col("s_suppkey") % 17 != 0).select(
        "client", "campaign", request.alias("request_id"), "channel",
        F.lit(25_000_000.0).alias("budget"), F.lit(30_000.0).alias("daily_budget"),
        span["start"].alias("start"), span["end"].alias("end"), F.lit("live").alias("status"),
    )
    grouped = campaigns.groupBy("client", "channel", "request_id").agg(F.count("*").alias("n"))
    requests = grouped.select(
        "client", F.col("request_id").alias("id"), F.lit("*").alias("campaign"), "channel",
        (F.col("n") * 26_000_000.0).alias("amount"), (F.col("n") * 26_000_000.0).alias("approved_amount"),
        span["start"].alias("start"), span["end"].alias("end"),
        (F.col("n") * 31_000.0).alias("daily_cap"), F.lit("APPROVED").alias("status"),
        F.concat(F.lit("Envelope for "), "channel").alias("summary"),
        F.lit("1994-12-01T00:00:00+00:00").alias("requested_at"),
        F.lit("1994-12-02T00:00:00+00:00").alias("decided_at"),
    )
    engagement = grouped.groupBy("client").agg(F.sum("n").alias("n")).select(
        "client", F.lit("USD").alias("currency"), (F.col("n") * 26_000_000.0).alias("ceiling")
    )
    # One ledger entry per line, none for unapproved suppliers.
    spend = lines.filter(F.col("l_suppkey") % 17 != 0).withColumns(_named("l_suppkey")).select(
        "client", "campaign", F.col("l_extendedprice").alias("amount"), F.col("date").cast("string").alias("date")
    )
    return _loaded(
        {
            "platform_daily": platform, "web_sessions": web, "crm_orders": crm, "plan_daily": plan,
            "source_freshness": freshness, "gate_engagement": engagement, "gate_requests": requests,
            "gate_campaigns": campaigns, "gate_spend": spend,
        }
    )


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The platform extract through CSV text and back, with the declared schema."""
    columns = EXTRACTS["platform_daily"]
    rows = from_events(spark, sf_dir)["platform_daily"]
    text = rows.select("client", F.to_csv(F.struct(*columns.names)).alias("line"))
    parsed = F.from_csv("line", columns.simpleString()[7:-1].replace(":", " "), {"mode": "FAILFAST"})
    return text.select("client", parsed.alias("r")).select("client", "r.*")


# ---------------------------------------------------------------- gate inputs from events


def state_documents(raw: dict[str, DataFrame]) -> DataFrame:
    """One nested state document per client, through JSON text, as the gate writes it.

    A document holds the client's requests, campaigns and ledger days: at most 5, 10 and 300
    entries in this mapping, whatever the size of the log.
    """
    requests = raw["gate_requests"].drop("_loaded_at")
    entry = F.struct(
        *(F.col(c) for c in requests.columns if c != "client"),
        F.when(F.col("id").endswith("3"), F.create_map(F.lit("chat"), F.lit("a1b2"))).alias("nonces"),
    )
    campaign = F.struct("request_id", "channel", "budget", "daily_budget", "start", "end", "status")
    by_client = lambda df, c: df.groupBy("client").agg(c)
    docs = (
        raw["gate_engagement"].drop("_loaded_at")
        .join(by_client(requests, F.map_from_entries(F.collect_list(F.struct("id", entry))).alias("requests")), "client", "left")
        .join(by_client(raw["gate_campaigns"], F.map_from_entries(F.collect_list(F.struct("campaign", campaign))).alias("campaigns")), "client", "left")
        .join(by_client(raw["gate_spend"], F.collect_list(F.struct("campaign", "amount", "date")).alias("spend")), "client", "left")
    )
    bound = F.struct(F.lit(7).cast("bigint").alias("user_id"), F.lit(70).cast("bigint").alias("chat_id"))
    channels = F.when(F.col("client") != "c1", F.create_map(F.lit("chat"), bound))
    text = docs.select(F.to_json(F.struct("*", channels.alias("channels"))).alias("json"))
    return text.select(F.from_json("json", STATE).alias("d")).select("d.*")


def _every(n: int, rest: int = 0) -> Column:
    return F.col("event_id") % n == rest


def proposed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One proposed campaign action per signup, with gaps and faults by event number."""
    kinds = ("launch", "increase_budget", "extend_flight", "decrease_budget", "pause", "boost")
    kind = F.element_at(F.array(*map(F.lit, kinds)), (F.col("event_id") % 6 + 1).cast("int"))
    rid = F.when(_every(3), None).when(_every(7), "").when(_every(17), "SAR-9-9").otherwise(_request_id())
    log = event_log(spark, sf_dir)
    signups = lookup(log.filter("event_type = 'signup'"), _calendar(log), ["client"], ["event_id"], 16)
    return signups.select(
        "client", F.col("event_id").alias("action_id"), kind.alias("type"),
        F.when(_every(5), F.concat(F.lit("new_"), F.col("event_id") % 40)).otherwise(F.col("campaign")).alias("campaign"),
        rid.alias("request_id"),
        F.when(_every(4), None).when(_every(19), "ch_9").otherwise(F.col("channel")).alias("channel"),
        F.when(_every(23), None).otherwise(money_of(F.col("c") * 60)).alias("budget"),
        F.when(_every(9), None).otherwise(money_of(F.col("c"))).alias("daily_budget"),
        F.lit(None).cast("string").alias("start"),
        F.when(_every(29), F.date_format(F.date_add("last_day", 14), "yyyy-MM-dd")).alias("end"),
        F.when(_every(31), F.date_add("last_day", 9)).otherwise(F.col("date")).alias("today"),
    )


def spend_proposals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One proposed spend request per purchase."""
    return event_log(spark, sf_dir).filter("event_type = 'purchase'").select(
        "client", F.col("event_id").alias("proposal_id"), money_of(F.col("c") * 100).alias("amount"),
        F.when(_every(11), 0.0).otherwise(F.col("value")).alias("daily_cap"),
        F.when(_every(13), "2024-02-20").otherwise("2024-02-01").alias("start"),
        F.lit("2024-02-10").alias("end"),
    )


def audit_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Audit events: one per log event, and one launch per campaign."""
    log = event_log(spark, sf_dir)
    kind = F.col("event_type")
    event = (
        F.when(kind == "view", "action_executed")
        .when(kind == "click", "spend_recorded")
        .when((kind == "signup") & _every(3), "request_modified_and_approved")
        .when(kind == "signup", "request_approved")
        .when(kind == "purchase", "request_created")
        .when(_every(4, 2), "decision_refused_stale_message")
        .when(_every(4, 3), "decision_refused_bad_key")
        .otherwise("action_blocked")
    )
    reasons = F.array(*map(F.lit, ("expired", "over_daily_cap", "unknown_action")))
    kinds = F.array(*map(F.lit, ("increase_budget", "decrease_budget", "extend_flight", "pause")))
    act = F.element_at(kinds, F.when((F.col("event_id") % 16 == 3), 4).otherwise((F.col("event_id") % 3) + 1).cast("int"))
    action = F.struct(
        act.alias("type"), "campaign",
        F.when(act.isin("increase_budget", "decrease_budget"), F.col("value")).alias("budget"),
        F.when(act.isin("increase_budget", "decrease_budget") & ~_every(4, 1), money_of(F.floor(F.col("c") / 10))).alias("daily_budget"),
        F.when(act == "extend_flight", F.date_format("date", "yyyy-MM-dd")).alias("end"),
    )
    approval = kind == "signup"
    lines = log.select(
        "client", F.col("event_id").alias("seq"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'").alias("at"),
        F.lit("agent").alias("actor"), event.alias("event"),
        F.when(approval, _request_id()).alias("request_id"),
        F.when(approval & ~_every(5), F.col("value")).alias("approved_amount"),
        F.when(approval & _every(7), money_of(F.floor(F.col("c") / 10))).alias("daily_cap"),
        F.when(approval & _every(4), "chat").alias("via"),
        F.when(event == "action_blocked", F.element_at(reasons, (F.col("event_id") % 3 + 1).cast("int"))).alias("reason"),
        F.when(kind == "view", action).alias("action"),
    )
    launches = log.select("client", "campaign", "channel").distinct().select(
        "client", F.lit(-1).cast("bigint").alias("seq"), F.lit("2023-12-31T00:00:00+00:00").alias("at"),
        F.lit("agent").alias("actor"), F.lit("action_executed").alias("event"),
        F.struct(
            F.lit("launch").alias("type"), "campaign", _request_id().alias("request_id"), "channel",
            F.lit(1000.0).alias("budget"), F.lit(50.0).alias("daily_budget"),
        ).alias("action"),
    )

    return lines, launches


def audit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit events through JSON lines, as the log's readers see them."""
    parsed = [
        df.select(F.from_json(F.to_json(F.struct("*")), AUDIT).alias("e")).select("e.*")
        for df in audit_events(spark, sf_dir)
    ]
    return parsed[0].unionByName(parsed[1])


def landed_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit events as files of JSON lines, a folder per client, without numbers, read by the log's reader."""
    at = scratch_path(spark)
    lines = [df.select("client", "at", "seq", F.to_json(F.struct(*(c for c in df.columns if c not in ("client", "seq")))).alias("value"))
             for df in audit_events(spark, sf_dir)]
    rows = lines[0].unionByName(lines[1]).repartition("client").sortWithinPartitions("client", "at", "seq")
    rows.select("client", "value").write.partitionBy("client").text(at)
    return read_audit(spark, at)


def landed_extracts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The extracts through CSV files and the extracts' reader. Plan and CRM were never connected: no files."""
    raw, at = from_events(spark, sf_dir), scratch_path(spark)
    for name in ("platform_daily", "web_sessions", "source_freshness"):
        write_csv(raw[name].select("client", *EXTRACTS[name].names), f"{at}/{name}", ("client",))
    return {name: read_extract(spark, at, name, by_extract=True) for name in EXTRACTS}


def landed_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ads report as files, each a list of batches, a folder per client, read by the connector's reader."""
    at = scratch_path(spark)
    batches = ads_report(spark, sf_dir).select("client", F.to_json(F.array(F.struct("results"))).alias("value"))
    # A file is one document, so each batch goes to a file of its own.
    batches.write.option("maxRecordsPerFile", 1).partitionBy("client").text(at)
    return read_ads_report(spark, at)


def executed_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, launches = audit_events(spark, sf_dir)
    done = lines.filter("event = 'action_executed'")
    columns = ("client", "at", "seq", "action")
    fields = ("type", "campaign", "request_id", "channel", "budget", "daily_budget", "start", "end")

    def whole(df: DataFrame) -> DataFrame:
        has = set(df.schema["action"].dataType.names)
        money_fields = ("budget", "daily_budget")
        action = F.struct(
            *(
                (F.col(f"action.{f}") if f in has else F.lit(None))
                .cast("double" if f in money_fields else "string").alias(f)
                for f in fields
            )
        )
        return df.withColumn("action", action).select(*columns)

    return whole(done).unionByName(whole(launches))


def ledger_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ledger entry per click, some for campaigns that don't exist, without an amount or with a strange day."""
    return event_log(spark, sf_dir).filter("event_type = 'click'").select(
        "client", F.col("event_id").alias("entry_id"),
        F.when(_every(6), F.concat(F.lit("new_"), F.col("event_id") % 40)).otherwise(F.col("campaign")).alias("campaign"),
        F.when(_every(35), None).otherwise(F.col("value")).alias("amount"),
        F.when(_every(25), "soon").otherwise(F.date_format("date", "yyyy-MM-dd")).alias("date"),
    )


def recorded_approvals(spark: SparkSession, sf_dir: str, rejections: bool = False) -> dict[str, DataFrame]:
    """Decisions, the requests they are about and the clients' ceilings, from the log's signups.

    Every signup is a request for its value. Each is decided once; every seventh a second time.
    Every 13th decision names a request that was never filed. Ceilings are 60 % of all requests. With
    ``rejections`` every 11th decision is one.
    """
    log = event_log(spark, sf_dir).filter("event_type = 'signup'")
    rid = F.concat(F.lit("RQ-"), "event_id")
    requests = log.select(
        "client", rid.alias("request_id"), F.col("value").alias("requested_amount"),
        money_of(F.floor(F.col("c") / 10)).alias("daily_cap"),
    )
    asked = F.when(_every(9), -F.col("value")).when(_every(6), F.col("value") * 2).when(~_every(5), F.col("value"))
    times = F.when(_every(7), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    decisions = log.select("*", F.explode(times).alias("time")).select(
        "client",
        F.when(_every(13), F.concat(F.lit("NONE-"), "event_id")).otherwise(rid).alias("request_id"),
        F.date_trunc("second", F.col("ts")).cast("timestamp_ntz").alias("at"),
        (F.col("event_id") * 2 + F.col("time")).alias("seq"), asked.alias("approved_amount"),
        F.when(_every(19), 0.0).alias("daily_cap"), F.when(_every(4), "chat").alias("via"),
    )
    if rejections:
        # The sequence number is twice that of the event, and one more for the second time.
        of_event = F.floor(F.col("seq") / 2)
        decisions = decisions.withColumn("decision", F.when(of_event % 11 == 0, "reject").otherwise("approve"))
    ceilings = log.groupBy("client").agg(money_of(F.floor(F.sum("c") * 60 / 100)).alias("ceiling"))
    return {"decisions": decisions, "requests": requests, "engagement": ceilings}


# ---------------------------------------------------------------- ads report from events


def ads_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API-shaped batches, one per client and day (at most 10 campaigns each), as JSON text
    parsed with the declared schema. Some fields are absent."""
    rows = from_events(spark, sf_dir)["platform_daily"]
    n = F.substring("campaign", 5, 9).cast("int")
    kinds = F.array(*map(F.lit, ("SEARCH", "PERFORMANCE_MAX", "VIDEO", "DISPLAY", "HOTEL")))
    channel_no = F.substring("channel", 4, 9).cast("int")
    result = F.struct(
        F.struct(
            (n + 100).cast("string").alias("id"), F.concat(F.lit("Net | "), "campaign").alias("name"),
            F.when(n != 29, F.element_at(kinds, channel_no + 1)).alias("advertisingChannelType"),
        ).alias("campaign"),
        F.struct(
            F.col("impressions").cast("string").alias("impressions"),
            F.col("clicks").cast("string").alias("clicks"),
            (F.round(F.col("spend") * 100).cast("bigint") * 10_000).cast("string").alias("costMicros"),
            F.when(n % 4 != 0, F.col("platform_conversions").cast("string")).alias("conversions"),
            F.when(n % 4 != 0, F.col("platform_revenue").cast("string")).alias("conversionsValue"),
        ).alias("metrics"),
        F.struct(F.date_format("date", "yyyy-MM-dd").alias("date")).alias("segments"),
    )
    batches = rows.groupBy("client", "date").agg(F.collect_list(result).alias("results"))
    text = batches.select("client", F.to_json(F.struct("results")).alias("json"))
    return text.select("client", F.from_json("json", ADS_BATCHES).alias("b")).select("client", "b.*")


def ads_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One account per client; ``today`` is the day after the last one of the whole log."""
    money_unit = F.when(F.col("client") == "c2", "USD").otherwise("INR")
    everybody = W.partitionBy(F.lit(1))
    days = event_log(spark, sf_dir).groupBy("client").agg(F.max("date").alias("last"))
    return days.select(
        "client", F.concat(F.lit("123-456-789"), F.substring("client", 2, 1)).alias("account_id"),
        money_unit.alias("currency"), F.lit("Asia/Kolkata").alias("time_zone"),
        F.date_add(F.max("last").over(everybody), 1).alias("today"),
    )


def ads_campaign_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns 0-9 by id (5 mapped to nothing), 10-19 by name; the rest unmapped."""
    rows = event_log(spark, sf_dir).select("client", "campaign", "n").distinct().filter("n < 20")
    return rows.select(
        "client",
        F.when(F.col("n") < 10, (F.col("n") + 100).cast("string"))
        .otherwise(F.concat(F.lit("Net | "), "campaign")).alias("key"),
        F.when(F.col("n") == 5, "").otherwise(F.concat(F.lit("agency_"), F.col("n"))).alias("campaign"),
    )
