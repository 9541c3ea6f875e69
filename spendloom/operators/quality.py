"""Data-quality checks. Each returns the violating rows, or one row of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.functions.values import exact_sum
from spendloom.operators.joins import lookup


def duplicate_keys(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key combinations that occur more than once."""
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Nulls per column, all columns in one pass: column, nulls."""
    counted = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counted.unpivot([], columns, "column", "nulls")


def null_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
    return df.filter(bad)


def spend_totals(frames: dict[str, DataFrame]) -> DataFrame:
    """Total spend per client in each named frame, and whether all agree to 2 places. A frame
    without the client counts as a disagreement."""
    totals = None
    for name, df in frames.items():
        part = df.groupBy("client").agg(F.round(exact_sum("spend"), 2).alias(name))
        totals = part if totals is None else totals.join(part, "client", "full")
    first, *rest = list(frames)
    agree = F.lit(True)
    for name in rest:
        agree = agree & F.coalesce(F.abs(F.col(name) - F.col(first)) < 0.005, F.lit(False))
    return totals.withColumn("agree", agree)


def budget_position(overview: DataFrame, ledger: DataFrame) -> DataFrame:
    """Overview against the gate's own ledger, per client: approved within the ceiling, and the
    same ceiling, approved and committed totals."""
    gate = ledger.select(
        "client",
        F.col("ceiling").alias("gate_ceiling"),
        F.col("approved").alias("gate_approved"),
        F.col("committed").alias("gate_committed"),
    )

    def same(mart: str, gate_value: str):
        return F.round(F.coalesce(mart, F.lit(0)), 2) == F.round(gate_value, 2)

    return overview.join(gate, "client", "full").select(
        "client",
        same("ceiling", "gate_ceiling").alias("ceiling_agrees"),
        same("approved", "gate_approved").alias("approved_agrees"),
        same("committed", "gate_committed").alias("committed_agrees"),
        (F.coalesce("approved", F.lit(0)) <= F.col("ceiling")).alias("approved_within_ceiling"),
    )


def backend_after_coverage(fact: DataFrame, freshness: DataFrame) -> DataFrame:
    """Fact rows after the CRM's as-of day that still carry backend measures."""
    crm = freshness.filter("source = 'crm'").select("client", "data_as_of")
    late = (F.col("date") > F.col("data_as_of")) & (
        F.col("backend_orders").isNotNull() | (F.col("spend_backend_window") != 0)
    )
    return lookup(fact, crm, ["client"], ["campaign", "date"], 16, "inner").filter(late)


def forecast_out_of_order(campaigns: DataFrame) -> DataFrame:
    """Campaigns whose forecast is not low <= base <= high <= budget (within rounding)."""
    slack = 1e-6
    chain = ["forecast_spend_low", "forecast_spend_base", "forecast_spend_high", "budget"]
    bad = F.lit(False)
    for lower, upper in zip(chain, chain[1:]):
        bad = bad | (F.col(lower) > F.col(upper) + slack)
    return campaigns.filter(bad)


def mixed_provenance(freshness: DataFrame) -> DataFrame:
    """Clients that mix synthetic and real sources."""
    return (
        freshness.groupBy("client")
        .agg(
            F.count_if("is_synthetic").alias("synthetic"),
            F.count_if(~F.col("is_synthetic")).alias("real"),
        )
        .filter("synthetic > 0 and real > 0")
    )
