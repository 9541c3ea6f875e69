"""Follow the append-only audit log: new files in, parsed events out, exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from spendloom.schemas import AUDIT


def stream_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.schema(AUDIT).option("mode", "FAILFAST").json(path)


def append_audit(events: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Land what has arrived since the last run and stop, as a scheduled job does."""
    return (
        events.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
