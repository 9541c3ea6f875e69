"""What the operators of this subpackage share: tables, the shared scratch folder, fixed splits.

A document table has doc_id and text. Operators read these two columns only, under names of their
own, so further columns of any name do no harm. A null text counts as an empty one.
"""

from __future__ import annotations

import math
import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """doc_id and text of a document table; null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def scratch(spark: SparkSession) -> str:
    """A fresh path in the folder that all executors share (spark.checkpoint.dir).

    Where the session names none and runs on one machine, as in tests, a temporary folder is set; on a cluster that
    would be another folder on each machine, and is refused.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("intermediate tables need a folder that all executors share: set spark.checkpoint.dir")
    if not root:
        root = tempfile.mkdtemp(prefix="llm-scratch-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


# Once a result is written, the shuffle files it was made from are of no further use.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, read again: later steps don't depend on lost executors.
    Shuffle files of this write are removed when it ends."""
    spark = df.sparkSession
    path, before = scratch(spark), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Tables made by `written` whose rows aren't needed any more are emptied, so that they take no room."""
    for df in tables:
        files = df.inputFiles()
        if files:
            df.limit(0).write.mode("overwrite").parquet(files[0].rsplit("/", 1)[0])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_text_hash(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with null texts empty and a 64-bit hash of the text; the name of that column."""
    h = fresh(docs, "_h")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumn("text", text).withColumn(h, F.xxhash64("text")), h


def with_text(docs: DataFrame, text: Column) -> DataFrame:
    """docs with another text; n_chars follows, where there is such a column."""
    out = docs.withColumn("text", text)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out


def held_out() -> Column:
    """Whether a document is kept out of learning: crc32(doc_id as text) mod 4 is 2."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


def training_labels(labels: DataFrame, label: str) -> DataFrame:
    """doc_id, label (0/1) of the labelled documents that are not held out.

    Rows with a null id, a null label or a label other than 0 and 1 teach nothing. A document with
    several labels counts with the largest.
    """
    return (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )


def chosen(share: float) -> Column:
    """Whether a document is in a sample of about this share of all, taken by the hash of its id."""
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    return place < F.lit(min(1 << 30, math.ceil(share * (1 << 30))))


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, most: tuple[int, int], counted: tuple[int, int]
) -> DataFrame:
    """doc_id, text, label of about `most` training documents of each label at most, of which there are `counted`.
    A threshold on the hash of their ids takes them, wherever they lie; the ids are few by that bound, so they
    are broadcast and no text is shuffled."""
    known = training_labels(labels, label)
    few = [known.where((F.col("label") == y) & chosen(most[y] / max(1, counted[y]))) for y in (0, 1)]
    return texts(docs).join(F.broadcast(few[0].unionAll(few[1])), "doc_id")


def portions(sizes: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(start, end) of runs of rows of about `most` bytes together, one row at least. sizes: bytes of each row."""
    ends = np.cumsum(sizes.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most)))
        yield start, end
        start = end


def crc32(data: bytes) -> int:
    return zlib.crc32(data)
