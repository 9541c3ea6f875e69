"""The append-only audit log: one JSON object per line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from spendloom.schemas import AUDIT


def read_audit(spark: SparkSession, path: str, client: str | None = None) -> DataFrame:
    """Scan audit files. Times have one-second resolution, so ``file`` and ``line`` (from 1) say where an event stands;
    ``seq`` is the logged number, null where the log has none.

    Spark cuts files into blocks and deals them to tasks as it sees fit, so a place in a task says nothing. Lines
    are counted within the blocks of a file, and a block's first line comes behind the lines of all blocks
    before it: the same number however the files are cut and whatever files are added.
    """
    rows = spark.read.schema(AUDIT).option("mode", "FAILFAST").json(path)
    block = ["file", "_block"]
    rows = rows.withColumns(
        {"_at": F.monotonically_increasing_id(), "file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start")}
    )
    # A block is read by one task, in order; a window holds one block.
    rows = rows.withColumn("_in_block", F.row_number().over(W.partitionBy(*block).orderBy("_at")))
    sizes = rows.groupBy(*block).agg(F.count("*").alias("_lines"))
    ahead = F.sum("_lines").over(W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select(*block, F.coalesce(ahead, F.lit(0)).alias("_ahead"))
    placed = rows.join(starts, block).withColumn("line", F.col("_ahead") + F.col("_in_block"))
    placed = placed.drop("_at", "_block", "_in_block", "_ahead")
    return placed if client is None else placed.withColumn("client", F.lit(client))


def executed(audit: DataFrame) -> DataFrame:
    """The executed actions of a scanned log, as `gate.replay` takes them. A log that numbers its events is
    ordered by these numbers, one that doesn't by its lines."""
    done = audit.filter(F.col("event") == "action_executed")
    return done.select("client", "at", F.coalesce("seq", "line").alias("seq"), "action")
