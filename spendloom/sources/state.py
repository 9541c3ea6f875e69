"""The approval gate's nested state documents, flattened to tables.

A document is one client: maps of requests and campaigns, an array of ledger spend and a
few scalars. Rows come out by ``explode``; an empty map or array gives zero rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.schemas import GATE, STATE


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STATE).option("multiLine", True).option("mode", "FAILFAST").json(path)


def flatten_engagement(state: DataFrame) -> DataFrame:
    return state.select("client", "currency", "ceiling")


def flatten_requests(state: DataFrame) -> DataFrame:
    rows = state.select("client", F.explode(F.map_values("requests")).alias("r"))
    return rows.select("client", *(F.col(f"r.{c}") for c in GATE["gate_requests"].names[1:]))


def flatten_campaigns(state: DataFrame) -> DataFrame:
    rows = state.select("client", F.explode("campaigns").alias("campaign", "c"))
    return rows.select("client", "campaign", "c.*")


def flatten_spend(state: DataFrame) -> DataFrame:
    return state.select("client", F.inline("spend"))


def gate_tables(state: DataFrame) -> dict[str, DataFrame]:
    return {
        "gate_engagement": flatten_engagement(state),
        "gate_requests": flatten_requests(state),
        "gate_campaigns": flatten_campaigns(state),
        "gate_spend": flatten_spend(state),
    }


def request_messages(state: DataFrame, channel: str) -> DataFrame:
    """Requests with what an approval channel needs: the bound user and the live nonce."""
    rows = state.select(
        "client",
        F.col("channels")[channel]["user_id"].alias("user_id"),
        F.col("channels")[channel].isNotNull().alias("is_bound"),
        F.explode(F.map_values("requests")).alias("r"),
    )
    return rows.select(
        "client",
        "user_id",
        F.coalesce("is_bound", F.lit(False)).alias("is_bound"),
        F.col("r.id").alias("request_id"),
        "r.status",
        F.col("r.amount").alias("amount"),
        F.col("r.nonces")[channel].alias("nonce"),
    )
