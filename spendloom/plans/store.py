"""Saved tables: written beside the old ones, published together, and kept so that marts need no shuffle.

The fact, the campaign mart and the campaigns' terms lie in buckets by (client, campaign), so that marts group by
campaign, look a campaign's days over and join its terms inside a bucket. The fact is partitioned by client
and period as well; a changed day rewrites its partition and nothing else.

A table's files are never changed in place. `stage` writes a new version next to the published one and counts it
on the way; `publish` points the names to the new versions, all or none of those staged.
"""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from spendloom.functions.values import exact_sum
from spendloom.sources.scratch import emptied, shuffles_removed, written

PARTS = ["part_client", "part_period"]
BUCKETED = ["client", "campaign"]
# Columns whose nulls are counted while a table is written, where it has them.
COUNTED = ("client", "date", "campaign", "channel", "spend")
_NEW = "__new"
# Bytes of input files per bucket. The rows made of them are some 20 times that in a task's memory.
BUCKET_BYTES = 16 * 2**20


@dataclass(frozen=True)
class Written:
    """What was counted while a version was written."""

    table: str
    rows: int
    nulls: dict[str, int]
    spend: float | None


def parts_of(date: str, period: str) -> dict[str, Column]:
    """Partition of a row: its client and the first day of its period, as text; "none" for nulls."""
    day = F.date_format(F.date_trunc(period, F.col(date).cast("date")), "yyyy-MM-dd")
    return {PARTS[0]: F.coalesce("client", F.lit("none")), PARTS[1]: F.coalesce(day, F.lit("none"))}


def in_parts(parts: list[tuple[str, str]]) -> Column:
    """Whether a row's partition is one of these. Reads partition columns only, so that scans are pruned."""
    return F.concat_ws("|", *PARTS).isin([f"{client}|{period}" for client, period in parts])


def bytes_read(frames: list[DataFrame]) -> int:
    """Size of the files that these frames are made of, each file once. Nothing is read of them."""
    files = sorted({unquote(f) for df in frames for f in df.inputFiles()})
    if not files:
        return 0
    lengths = frames[0].sparkSession.read.format("binaryFile").load(files).agg(F.sum("length").alias("n"))
    return lengths.first().n or 0


class Store:
    """Tables of a warehouse in the databases ``core`` and ``marts`` (or others). A bucket is the least that one task
    reads and sorts, so there are as many as the files that a fact is made of need, ``buckets`` at least."""

    def __init__(
        self, spark: SparkSession, core: str = "core", marts: str = "marts", buckets: int = 8, period: str = "MONTH"
    ) -> None:
        self.spark, self.core, self.marts = spark, core, marts
        self.buckets, self.period = buckets, period
        self._staged: dict[str, Written] = {}

    @property
    def staged(self) -> dict[str, Written]:
        return dict(self._staged)

    def table(self, table: str) -> DataFrame:
        """The staged version of a table if there is one, else the published one."""
        return self.spark.table(f"{table}{_NEW}" if table in self._staged else table)

    # ------------------------------------------------------------ write beside

    def _put(self, df: DataFrame, table: str, by: list[str], buckets: int = 0) -> Written:
        database, name = table.split(".")
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        self.spark.sql(f"DROP TABLE IF EXISTS {table}{_NEW}")
        path = f"{self.spark.conf.get('spark.sql.warehouse.dir')}/{database}.tables/{name}-{uuid4().hex}"
        df = df.repartition(buckets, *BUCKETED) if buckets else df
        # Counted in the stage that writes, where each row passes once.
        seen = Observation()
        known = [c for c in COUNTED if c in df.columns]
        money = [exact_sum("spend").alias("spend")] if "spend" in df.columns else []
        nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in known]
        df = df.observe(seen, F.count("*").alias("rows"), *nulls, *money)
        writer = df.write.format("parquet").option("path", path).option("compression", "zstd").option("partitionOverwriteMode", "dynamic")
        if by:
            writer = writer.partitionBy(*by)
        if buckets:
            writer = writer.bucketBy(buckets, *BUCKETED)
        with shuffles_removed(self.spark):
            writer.saveAsTable(f"{table}{_NEW}")
        got = seen.get
        made = Written(table, got["rows"], {c: got[f"null_{c}"] for c in known}, got.get("spend"))
        self._staged[table] = made
        return made

    def stage(self, df: DataFrame, table: str) -> Written:
        """A new version of a table, partitioned by client, not visible yet."""
        return self._put(df.hint("rebalance", "client"), table, ["client"])

    def stage_bucketed(self, df: DataFrame, table: str, like: str) -> Written:
        """In as many buckets as the table ``like`` has, so that the two are joined bucket by bucket."""
        rows = df.withColumn(PARTS[0], F.coalesce("client", F.lit("none")))
        return self._put(rows, table, PARTS[:1], self.buckets_of(like))

    def stage_fact(self, df: DataFrame, table: str, read: list[DataFrame] | None = None) -> Written:
        """``read``: the frames that the fact is made of, if df doesn't tell by itself.

        The joined rows are written before they are dealt to buckets, so the shuffle files of the joins are gone by then.
        """
        buckets = max(self.buckets, -(-bytes_read(read or [df]) // BUCKET_BYTES))
        rows = written(df.withColumns(parts_of("date", self.period)))
        made = self._put(rows, table, PARTS, buckets)
        emptied(rows)
        return made

    def buckets_of(self, table: str) -> int:
        """Of the staged version if there is one, else the published one."""
        told = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}{_NEW if table in self._staged else ''}")
        return int(told.where("col_name = 'Num Buckets'").first().data_type)

    # ------------------------------------------------------------ publish

    def sweep(self) -> int:
        """Delete the folders of versions that no table has any more; how many. Not while they are read."""
        spark, removed = self.spark, 0
        for database in {self.core, self.marts}:
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{spark.conf.get('spark.sql.warehouse.dir')}/{database}.tables")
            files = path.getFileSystem(spark._jsc.hadoopConfiguration())
            if not files.exists(path):
                continue
            used = set()
            for t in spark.catalog.listTables(database):
                rows = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.{t.name}").where("col_name = 'Location'")
                used |= {r.data_type.rsplit("/", 1)[-1] for r in rows.collect()}
            for folder in files.listStatus(path):
                if folder.getPath().getName() not in used:
                    files.delete(folder.getPath(), True)
                    removed += 1
        return removed

    def drop_staged(self) -> None:
        for table in self._staged:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}{_NEW}")
        self._staged = {}

    def publish(self, parts: dict[str, Column] | None = None) -> list[Written]:
        """The staged versions take the places of the published ones.

        A table in ``parts`` is replaced in part: the partitions of its new version take the places of theirs, and
        those for which the condition holds and that have no new version go. All others keep their files.
        """
        made, self._staged = self._staged, {}
        for table in made:
            if table in (parts or {}) and self.spark.catalog.tableExists(table):
                self._publish_parts(table, parts[table])
            else:
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
                self.spark.sql(f"ALTER TABLE {table}{_NEW} RENAME TO {table}")
        return list(made.values())

    def _publish_parts(self, table: str, replaced: Column) -> None:
        old, fresh = self.spark.table(table), self.spark.table(f"{table}{_NEW}")
        by = [c.name for c in self.spark.catalog.listColumns(table) if c.isPartition]
        gone = old.where(replaced).select(*by).distinct().join(fresh.select(*by).distinct(), by, "left_anti").collect()
        fresh.select(*old.columns).write.insertInto(table, overwrite=True)
        for r in gone:
            spec = ", ".join(f"{c} = '{r[c]}'".replace("\\", "\\\\") for c in by)
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
        self.spark.sql(f"DROP TABLE {table}{_NEW}")
        self.spark.catalog.refreshTable(table)


# Raw logs with a day, and the column it is in. The other raw tables are one row per client, request or campaign.
DAYS = {
    "platform_daily": "date", "web_sessions": "date", "crm_orders": "order_date", "plan_daily": "date",
    "gate_spend": "date",
}


class Landing:
    """Raw tables as landed: logs partitioned by client and period, like the fact."""

    def __init__(self, store: Store, database: str = "raw") -> None:
        self._store, self._database = store, database

    def _name(self, table: str) -> str:
        return f"{self._database}.{table}"

    def land(self, raw: dict[str, DataFrame]) -> list[Written]:
        """All raw tables, replaced together; counted on the way."""
        for name, df in raw.items():
            if name in DAYS:
                rows = df.withColumns(parts_of(DAYS[name], self._store.period))
                self._store._put(rows.hint("rebalance", *PARTS), self._name(name), PARTS)
            else:
                self._store._put(df, self._name(name), [])
        return self._store.publish()

    def restate(self, name: str, rows: DataFrame, window: DataFrame) -> list[tuple[str, str]]:
        """Replace a log's rows inside each client's window (client, start, end) by `rows`; returns the
        partitions that were rewritten. Days outside stay, also those of the same partition."""
        day, period = DAYS[name], self._store.period
        starts = F.explode(F.sequence(F.date_trunc(period, "start"), F.date_trunc(period, "end"), F.expr("interval 1 month")))
        spans = window.select("client", "start", "end", starts.alias("_at"))
        parts = [tuple(r) for r in spans.withColumn("_day", F.to_date("_at")).select(*(
            c.alias(n) for n, c in parts_of("_day", period).items())).distinct().collect()]
        old = self._store.table(self._name(name)).where(in_parts(parts))
        limits = window.select(F.col("client").alias("_client"), "start", "end")
        inside = (F.col("client") == F.col("_client")) & F.col(day).cast("date").between(F.col("start"), F.col("end"))
        kept = old.join(limits, inside, "left_anti")
        fresh = rows.withColumns(parts_of(day, period)).select(*kept.columns)
        self._store._put(kept.unionByName(fresh), self._name(name), PARTS)
        self._store.publish({self._name(name): in_parts(parts)})
        return parts

    def replace(self, name: str, df: DataFrame) -> None:
        """Another version of a raw table that is no log."""
        self._store._put(df, self._name(name), [])
        self._store.publish()

    def raw(self, parts: list[tuple[str, str]] | None = None) -> dict[str, DataFrame]:
        """The raw tables; of the logs only these partitions."""
        out = {}
        for t in self._store.spark.catalog.listTables(self._database):
            df = self._store.table(self._name(t.name))
            if t.name in DAYS:
                df = (df if parts is None else df.where(in_parts(parts))).drop(*PARTS)
            out[t.name] = df
        return out
