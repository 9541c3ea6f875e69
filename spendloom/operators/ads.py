"""Normalise a landed ads report into the platform extract.

A connector only has to land the API's answer as files; mapping, units, types, the trailing
window and the freshness row are DataFrame work.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.values import exact_sum, money
from spendloom.operators.joins import lookup

# The platform's channel types and the channel names used for them.
CHANNELS = {
    "SEARCH": "paid_search",
    "PERFORMANCE_MAX": "performance_max",
    "VIDEO": "online_video",
    "DISPLAY": "display",
    "DEMAND_GEN": "demand_gen",
    "SHOPPING": "shopping",
    "MULTI_CHANNEL": "app",
}
OTHER_CHANNEL = "google_ads_other"
SOURCE = "google_ads"
FRESHNESS_SOURCE = "ad_platforms"
MICROS = 1_000_000
ACCOUNT_DIGITS = 10


def account_digits(account_id: Column | str) -> Column:
    """The account id without punctuation; anything but 10 digits is an error."""
    raw = F.col(account_id) if isinstance(account_id, str) else account_id
    digits = F.regexp_replace(raw.cast("string"), r"[^0-9]", "")
    wrong = F.raise_error(F.concat(F.lit("account id needs 10 digits: "), F.coalesce(raw, F.lit("null"))))
    return F.when(F.length(digits) == ACCOUNT_DIGITS, digits).otherwise(wrong)


def has_valid_id(account_id: Column | str) -> Column:
    raw = F.col(account_id) if isinstance(account_id, str) else account_id
    return F.length(F.regexp_replace(raw.cast("string"), r"[^0-9]", "")) == ACCOUNT_DIGITS


def extraction_window(accounts: DataFrame, days: int = 30, today: date | Column | None = None) -> DataFrame:
    """Per account the last ``days`` full days, ending yesterday in the account's time zone, or the day
    before ``today``, a day or a column of the accounts."""
    here = (
        (today if isinstance(today, Column) else F.lit(today))
        if today is not None
        else F.to_date(F.convert_timezone(F.lit("UTC"), F.col("time_zone"), _utc_now()))
    )
    return accounts.withColumn("end", F.date_sub(here, 1)).withColumn(
        "start", F.date_sub("end", days - 1)
    )


def _utc_now() -> Column:
    return F.convert_timezone(
        F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
    )


def currency_mismatches(accounts: DataFrame, engagement: DataFrame) -> DataFrame:
    """Accounts whose currency is not their engagement's: client, currency, expected."""
    expected = engagement.select("client", F.col("currency").alias("expected"))
    rows = accounts.select("client", "currency").join(expected, "client", "left")
    return rows.where(~F.col("currency").eqNullSafe(F.col("expected")))


def require_currency(accounts: DataFrame, engagement: DataFrame) -> DataFrame:
    """``accounts`` unchanged, or a failed job if an account's currency is not its engagement's.

    Guard the accounts before taking their window: rows, freshness and summary all read the
    window, so none of them can be written past a mismatch.
    """
    expected = engagement.select("client", F.col("currency").alias("_expected"))
    told = F.concat_ws(" ", "client", "currency", "_expected")
    wrong = F.raise_error(F.concat(F.lit("account currency does not match: "), told))
    same = F.col("currency").eqNullSafe(F.col("_expected"))
    return (
        accounts.join(expected, "client", "left")
        .filter(F.when(same, F.lit(True)).otherwise(wrong.cast("boolean")))
        .drop("_expected")
    )


def normalise(report: DataFrame) -> DataFrame:
    """Typed report rows: text to numbers, micros to money, absent to 0."""

    def amount(field: str) -> Column:
        return F.coalesce(F.col(f"metrics.{field}").cast("double"), F.lit(0.0))

    def count(field: str) -> Column:
        return F.coalesce(F.col(f"metrics.{field}").cast("bigint"), F.lit(0))

    names = F.create_map(*(F.lit(x) for pair in CHANNELS.items() for x in pair))
    kind = F.coalesce("campaign.advertisingChannelType", F.lit(""))
    return report.select(
        "client",
        F.col("segments.date").cast("date").alias("date"),
        F.col("campaign.id").alias("platform_id"),
        F.col("campaign.name").alias("platform_name"),
        F.coalesce(names[kind], F.lit(OTHER_CHANNEL)).alias("channel"),
        count("impressions").alias("impressions"),
        count("clicks").alias("clicks"),
        money(count("costMicros") / MICROS).alias("spend"),
        money(amount("conversions")).alias("platform_conversions"),
        money(amount("conversionsValue")).alias("platform_revenue"),
    )


def in_window(rows: DataFrame, window: DataFrame) -> DataFrame:
    """Delivered rows inside the client's window. ``window``: client, start, end."""
    delivered = rows.filter(F.col("impressions") > 0)
    spans = window.select("client", "start", "end")
    return (
        lookup(delivered, spans, ["client"], ["platform_id", "date"], 16, how="inner")
        .filter(F.col("date").between(F.col("start"), F.col("end")))
        .drop("start", "end")
    )


def rows_without_account(rows: DataFrame, window: DataFrame) -> DataFrame:
    """Delivered rows of clients that have no account, which no extract will hold: client, rows, spend."""
    delivered = rows.filter(F.col("impressions") > 0)
    lost = delivered.join(window.select("client"), "client", "left_anti")
    return lost.groupBy("client").agg(F.count("*").alias("rows"), exact_sum("spend").alias("spend"))


def map_campaigns(rows: DataFrame, campaign_map: DataFrame) -> DataFrame:
    """Agency campaign by platform id, else by exact name, else the platform's own name.
    ``campaign_map``: client, key, campaign. Adds ``campaign`` and ``is_mapped``."""
    by_id = campaign_map.select("client", F.col("key").alias("platform_id"), F.col("campaign").alias("_a"))
    by_name = campaign_map.select(
        "client", F.col("key").alias("platform_name"), F.col("campaign").alias("_b")
    )
    rows = lookup(rows, by_id, ["client", "platform_id"], ["date", "platform_name"], 16)
    rows = lookup(rows, by_name, ["client", "platform_name"], ["date", "platform_id"], 16)
    mapped = F.coalesce(F.nullif("_a", F.lit("")), F.nullif("_b", F.lit("")))
    return rows.withColumns(
        {"campaign": F.coalesce(mapped, "platform_name"), "is_mapped": mapped.isNotNull()}
    ).drop("_a", "_b")


def unmapped_campaigns(mapped: DataFrame) -> DataFrame:
    return (
        mapped.filter(~F.col("is_mapped"))
        .select("client", "platform_name")
        .distinct()
        .orderBy("client", "platform_name")
    )


def platform_extract(mapped: DataFrame) -> DataFrame:
    """Rows in the shape of the platform_daily extract."""
    return mapped.select(
        "client", F.lit(SOURCE).alias("source"), "date", "campaign", "channel", "impressions",
        "clicks", "spend", "platform_conversions", "platform_revenue",
        F.lit(False).alias("is_synthetic"),
    )


def extract_summary(extract: DataFrame, window: DataFrame) -> DataFrame:
    """Per client: rows, window and total spend; a client without rows has 0 of both."""
    totals = extract.groupBy("client").agg(F.count("*").alias("rows"), exact_sum("spend").alias("spend"))
    return (
        window.select("client", "start", "end", F.col("time_zone").alias("account_time_zone"))
        .join(totals, "client", "left")
        .select(
            "client", F.coalesce("rows", F.lit(0)).alias("rows"), "start", "end",
            money(F.coalesce("spend", F.lit(0.0))).alias("spend"), "account_time_zone",
        )
    )


def upsert_freshness(freshness: DataFrame, window: DataFrame) -> DataFrame:
    """The ad platforms' as-of day becomes the window's end; other rows stay."""
    new = window.select(
        "client",
        F.lit(FRESHNESS_SOURCE).alias("source"),
        F.col("end").alias("data_as_of"),
        F.lit(False).alias("is_synthetic"),
    )
    kept = freshness.join(new.select("client", "source"), ["client", "source"], "left_anti")
    return kept.select(*new.columns).unionByName(new)


def restate_window(existing: DataFrame, fresh: DataFrame, window: DataFrame) -> DataFrame:
    """Restatement as a query: the old rows outside each client's window, plus the fresh rows.
    Older days stay, as do clients that were not pulled. ``window``: client, start, end."""
    spans = window.select("client", "start", "end")
    inside = F.col("date").between(F.col("start"), F.col("end"))
    kept = lookup(existing, spans, ["client"], ["campaign", "date"], 16).filter(
        ~F.coalesce(inside, F.lit(False))
    )
    return kept.select(*existing.columns).unionByName(fresh)
