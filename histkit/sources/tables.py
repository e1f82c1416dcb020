"""Target tables: upsert, replace, append, read.

A stored table is partitioned Parquet: a directory for each period (day, month or
year) of the effective time. A load writes the periods that its rows fall in again,
by Spark's dynamic partition overwrite, and leaves the others alone. Catalogs with
row-level operations do not need this; see ``merge_into``.

What a lost load leaves behind: Spark writes new files aside and moves them at the
end, directory by directory. A load that is lost before that has changed nothing; run
it again. One that is lost while directories are moved can leave some periods new
and others old, and the period in hand without rows. The newest load time may then
be that of the lost load, so load again with ``watermark=`` the day before it, or
with ``full_refresh``: loads give the same rows however often they are run. A full
refresh deletes first, so a lost one leaves no table, and the next load is a first
run. One writer at a time, and readers see the old or the new files of a period, or
fail if their files went away while they read.
"""

from __future__ import annotations

import re
import tempfile
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import zone_free
from ..operators.watermark import DAY, EXACT, current_watermark

PERIOD = "history_period"
CODEC = "zstd"
GRAINS = {"day": "yyyy-MM-dd", "month": "yyyy-MM", "year": "yyyy"}


def upsert(target: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """``target`` with the rows of ``batch`` replaced or added by ``key``."""
    return target.join(batch.select(key), key, "left_anti").unionByName(batch)


def merge_into(batch: DataFrame, table: str, key: str) -> None:
    """The same as MERGE INTO, for a catalog table that supports it."""
    source = batch.alias("batch")
    merge = source.mergeInto(table, F.expr(f"{table}.`{key}` = batch.`{key}`"))
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all executors can read.

    Only a local session may go without a checkpoint folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = tempfile.mkdtemp(prefix="histkit-")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Ends the lineage, so later jobs neither compute it again nor lose it with
    an executor, and gives the planner its true size for join choices. Documents
    repeat their member names, so they are packed tighter than Spark's default does.
    """
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@dataclass(frozen=True)
class HistoryTable:
    """A table at ``path`` cut into periods of ``time`` (one if None)."""

    spark: SparkSession
    path: str
    time: str | None = "timestamp_effective"
    grain: str = "month"
    loaded: str = "etl_updated_timestamp"

    # The columns are kept in a folder without rows, which Spark's readers pass over:
    # a table can be empty, and reading needs no look into its files.
    @property
    def _columns(self) -> str:
        return f"{self.path}/_columns"

    def exists(self) -> bool:
        done = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._columns}/_SUCCESS")
        return done.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(done)

    def all_rows(self) -> DataFrame:
        """All rows with their period."""
        if not self.exists():
            raise ValueError(f"no table at {self.path}")
        columns = self.spark.read.parquet(self._columns).schema
        return self.spark.read.schema(columns.add(PERIOD, T.StringType())).parquet(self.path)

    def rows(self, since: str | None = None) -> DataFrame:
        """All rows, or those of the periods from a time on (text, in UTC) and without time."""
        rows = self.all_rows()
        if since is not None and self.time is not None:
            first = since[: len(GRAINS[self.grain])]
            rows = rows.where(F.col(PERIOD).isNull() | (F.col(PERIOD) >= first))
        return rows.drop(PERIOD)

    def watermark(self, day: bool = True) -> str | None:
        """Newest load time, cut to the day unless ``day`` is false: reads that column only."""
        rows = self.rows()
        return current_watermark(rows, self.loaded, DAY if day else EXACT) if self.loaded in rows.columns else None

    def _period(self, df: DataFrame) -> Column:
        if self.time is None:
            return F.lit("all")
        return F.date_format(zone_free(F.col(self.time), df.schema[self.time].dataType), GRAINS[self.grain])

    def _write(self, df: DataFrame, mode: str, overwrite: str = "static") -> None:
        # rebalance joins small outputs of a period and splits large ones
        rows = df.withColumn(PERIOD, self._period(df)).hint("rebalance", F.col(PERIOD))
        writer = rows.write.mode(mode).option("partitionOverwriteMode", overwrite).option("compression", CODEC)
        writer.partitionBy(PERIOD).parquet(self.path)

    def replace(self, df: DataFrame) -> None:
        """Full refresh."""
        self._write(df, "overwrite")
        df.limit(0).write.mode("overwrite").parquet(self._columns)

    def append(self, batch: DataFrame) -> None:
        """Add rows."""
        if not self.exists():
            return self.replace(batch)
        self._write(batch.select(*self.rows().columns), "append")

    def upsert(self, batch: DataFrame, key: str) -> None:
        """Replace or add rows by ``key``.

        A key must fix the effective time, so that a row and its replacement
        are in one period. ``batch`` is read several times: pass a staged frame.
        """
        if not self.exists():
            return self.replace(batch)
        stored = self.all_rows()
        batch = batch.select(*[c for c in stored.columns if c != PERIOD])
        # as many as the batch has periods
        touched = [r[0] for r in batch.select(self._period(batch).alias(PERIOD)).distinct().collect()]
        within = F.col(PERIOD).isin([p for p in touched if p is not None])
        within = within | F.col(PERIOD).isNull() if None in touched else within
        stored = stored.where(within).drop(PERIOD)
        # most rows of a batch are new, so the few keys it replaces are found first, without the rows
        replaced = stage(stored.select(key).join(batch.select(key), key, "left_semi"))
        self._rewrite(stored.join(replaced, key, "left_anti").select(*batch.columns).unionByName(batch))

    def _rewrite(self, rows: DataFrame) -> None:
        """Write periods again from rows that are read out of them: the old files go when the new ones are there."""
        self._write(rows, "overwrite", "dynamic")


@dataclass(frozen=True)
class BucketedTable(HistoryTable):
    """A catalog table whose periods are cut into ``buckets`` by ``key``, sorted by key and time.

    Joins and windows by key read it where it lies: of a batch and its target only
    the batch is shuffled. Every period has a file for each bucket it has rows of, so
    choose buckets for the size of a period, and the year or month as the period.
    ``path`` is where the files are; a catalog that lives as long as its session
    has to be told again with ``attach``.
    """

    name: str = ""
    key: str = "id"
    buckets: int = 64

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def all_rows(self) -> DataFrame:
        """All rows with their period."""
        if not self.exists():
            raise ValueError(f"no table {self.name}")
        return self.spark.table(self.name)

    def _sorted_by(self, df: DataFrame) -> list[str]:
        return [self.key, *[c for c in (self.time,) if c in df.columns]]

    def _in_buckets(self, df: DataFrame) -> DataFrame:
        # one task a bucket, so one file in each period
        return df.withColumn(PERIOD, self._period(df)).repartition(self.buckets, self.key)

    def replace(self, df: DataFrame) -> None:
        writer = self._in_buckets(df).write.mode("overwrite").option("path", self.path).partitionBy(PERIOD)
        writer.bucketBy(self.buckets, self.key).sortBy(*self._sorted_by(df)).saveAsTable(self.name)

    def _write(self, df: DataFrame, mode: str, overwrite: str = "static") -> None:
        conf, name = self.spark.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(name)
        conf.set(name, overwrite)
        try:
            self._in_buckets(df).write.insertInto(self.name, overwrite=mode == "overwrite")
        finally:
            conf.set(name, before)

    def _rewrite(self, rows: DataFrame) -> None:
        # an INSERT may not read the table it overwrites
        super()._rewrite(stage(rows))

    def attach(self, columns: T.StructType) -> None:
        """Name the files at ``path`` to a catalog that has forgotten them."""
        spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*columns, T.StructField(PERIOD, T.StringType())])
        order = ", ".join(f"`{c}`" for c in [self.key, *[c for c in (self.time,) if c in columns.names]])
        self.spark.sql(
            f"CREATE TABLE {self.name} ({spec}) USING parquet PARTITIONED BY ({PERIOD}) "
            f"CLUSTERED BY (`{self.key}`) SORTED BY ({order}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        self.spark.catalog.recoverPartitions(self.name)


def _drop_old(fs, path, needed: set[str], older_than: float) -> int:
    before = (time.time() - older_than) * 1000
    old = [f.getPath() for f in fs.listStatus(path) if f.getModificationTime() < before]
    return sum(fs.delete(p, True) for p in old if p.getName() not in needed)


def remove_staged(spark: SparkSession, older_than: float) -> int:
    """Delete staged batches below ``spark.checkpoint.dir`` last changed more than ``older_than`` seconds ago."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark)).getParent()
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    others = {f.getPath().getName() for f in fs.listStatus(path)} if fs.exists(path) else set()
    foreign = {name for name in others if not re.fullmatch("[0-9a-f]{32}", name)}
    return _drop_old(fs, path, foreign, older_than) if others else 0
