"""Landed ads-report files: each file is a list of batches, each batch a list of results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.schemas import ADS_ACCOUNTS, ADS_BATCHES


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_ads_report(spark: SparkSession, path: str, client: str | None = None) -> DataFrame:
    """All result rows of all batches, in one frame. Without ``client`` the path has a folder per client
    (``client=<name>``)."""
    batches = _read(spark, path, ADS_BATCHES)
    named = F.col("client").cast("string") if client is None else F.lit(client)
    return report_rows(batches.withColumn("client", named))


def report_rows(batches: DataFrame) -> DataFrame:
    return batches.select("client", F.inline("results"))


def read_ads_account(spark: SparkSession, path: str, client: str) -> DataFrame:
    rows = _read(spark, path, ADS_ACCOUNTS).select(F.inline("results"))
    return rows.select(
        F.lit(client).alias("client"),
        F.col("customer.id").alias("account_id"),
        F.col("customer.currencyCode").alias("currency"),
        F.col("customer.timeZone").alias("time_zone"),
    )
