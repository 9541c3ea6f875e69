"""Intermediate results as tables in a folder that all executors share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession) -> str:
    """A fresh path under spark.checkpoint.dir, or the warehouse where the session names none."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir") + "/scratch"
    return f"{root.rstrip('/')}/{uuid4().hex}"


# Once a result is written, the shuffle files it was made from are of no further use.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written inside go when its write ends, not when the driver happens to collect garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def written(df: DataFrame) -> DataFrame:
    """df as Parquet at a scratch path, read again: what follows doesn't depend on lost executors and doesn't
    repeat what came before."""
    path = scratch_path(df.sparkSession)
    with shuffles_removed(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def emptied(df: DataFrame) -> None:
    """A table made by `written` whose rows aren't needed any more takes no room."""
    files = df.inputFiles()
    if files:
        df.limit(0).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])
