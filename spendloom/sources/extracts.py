"""CSV extracts, result exports and saved tables.

Layouts: one folder per client (``<root>/client=<name>/<extract>.csv``), read in one scan
for all clients, a plain folder for one named client, or what `write_csv` leaves: one folder per extract with
one per client in it (``<root>/<extract>/client=<name>``).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.schemas import EXTRACTS


def read_extract(
    spark: SparkSession, root: str, name: str, client: str | None = None, by_extract: bool = False
) -> DataFrame:
    """Typed scan of one extract. A bad cell or header fails the job. A source that was
    never connected (no file) gives zero rows of the declared schema."""
    columns = EXTRACTS[name]
    if client is None:
        columns = T.StructType([*columns.fields, T.StructField("client", T.StringType())])
        path = f"{root}/{name}" if by_extract else f"{root}/client=*/{name}.csv"
    else:
        path = f"{root}/{name}.csv"
    reader = (
        spark.read.schema(columns)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
    )
    if client is None:
        reader = reader.option("basePath", path if by_extract else root)
    try:
        df = reader.csv(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], columns)
    if client is not None:
        df = df.withColumn("client", F.lit(client))
    return df.select("client", *EXTRACTS[name].names)


def load_stamp(at: datetime) -> Column:
    """One load time (naive UTC) for every row of a load."""
    return F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def stamp_loaded(df: DataFrame, at: datetime) -> DataFrame:
    return df.withColumn("_loaded_at", load_stamp(at))


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per loaded table. Each branch is a map-side count; nothing is shuffled but totals."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table"), "rows")
        for name, df in tables.items()
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def write_csv(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Extract sink and query-result export: a folder of CSV parts with header lines."""
    df.write.mode("overwrite").option("header", True).partitionBy(*partition_by).csv(path)


def replace_table(df: DataFrame, name: str, by: tuple[str, ...] = ()) -> None:
    """Full refresh of a saved table, partitioned by ``by``. Rows are rebalanced on it first:
    few files per partition, and a big partition is split over several tasks."""
    if "." in name:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{name.split('.')[0]}`")
    rows = df.hint("rebalance", *by) if by else df
    rows.write.mode("overwrite").format("parquet").partitionBy(*by).saveAsTable(name)


def restate_partitions(df: DataFrame, path: str, by: tuple[str, ...] = ("client", "date")) -> None:
    """Replace only the partitions present in ``df``; older days stay.

    Restating the trailing window of one source rewrites that window and nothing else.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )
