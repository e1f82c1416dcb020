"""Inputs the queries share, in Spark and as SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histkit.plans import CdcSpec, Column

NTZ = "timestamp_ntz"
CUT = "2024-01-15"
RUN_TS = "2024-03-01 00:00:00"


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Registry(dict):
    def add(self, sql: str | None = None):
        """Register the decorated function under its name, less the ``q_`` that avoids an import's name."""

        def take(run):
            self[run.__name__.removeprefix("q_")] = Query(run, sql)
            return run

        return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A test table is one small file, so one task; a landing zone is not."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def hash_sql(*exprs: str) -> str:
    """``row_hash`` as SQL."""
    parts = [
        f"coalesce(CAST(length(CAST({e} AS VARCHAR)) AS VARCHAR) || ':' || CAST({e} AS VARCHAR), '-')" for e in exprs
    ]
    return f"md5({' || '.join(parts)})"


def key_sql(*exprs: str) -> str:
    """``surrogate_key`` as SQL."""
    return "md5(" + " || '-' || ".join(f"coalesce(CAST({e} AS VARCHAR), '')" for e in exprs) + ")"


# A change log made of all events, each landing an hour after it happened, and
# a second copy of each that lands two days later and says something else.

LOG_SPEC = CdcSpec(
    "events",
    ("events", "events"),
    "event_key",
    (
        Column("id", "bigint", "id"),
        Column("status", "string", "status"),
        Column("amount", "decimal(18,4)", "amount", tracked=False),
    ),
    time_type=NTZ,
)


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")

    def copy(status, delay):
        return e.select(
            F.col("user_id").alias("id"),
            F.expr(status).alias("status"),
            F.col("value").alias("amount"),
            F.expr(f"ts + interval {delay}").alias("_h2_sf_inserted"),
            F.expr("event_type = 'error'").alias("_h2_is_deleted"),
            F.col("ts").alias("_h2_binlog_ts_ms"),
        )

    return copy("event_type", "1 hour").unionByName(copy("'replayed'", "2 days"))


def change_log_sql() -> str:
    """CTE ``log``: the typed change log with its row hash."""

    def copy(status, delay):
        return f"""SELECT user_id AS id, {status} AS status, CAST(value AS DECIMAL(18,4)) AS amount,
            ts + INTERVAL {delay} AS etl_updated_timestamp, event_type = 'error' AS is_deleted_in_source,
            ts AS timestamp_effective FROM events"""

    return f"""log AS (SELECT *, {hash_sql("id", "status")} AS row_hash FROM (
        {copy("event_type", "'1' HOUR")} UNION ALL {copy("'replayed'", "'2' DAY")}) x)"""


LOG_COLUMNS = "id, status, amount, etl_updated_timestamp, is_deleted_in_source, timestamp_effective, row_hash"


def dedupe_sql(source: str, key: str = "id", loaded: str = "etl_updated_timestamp") -> str:
    return f"""(SELECT * FROM {source} QUALIFY row_number() OVER (
        PARTITION BY {key}, timestamp_effective ORDER BY {loaded}, row_hash) = 1)"""


def compact_sql(source: str, key: str = "id") -> str:
    return f"""(SELECT * EXCLUDE (prev) FROM (SELECT *, lag(row_hash) OVER (
        PARTITION BY {key} ORDER BY timestamp_effective) AS prev FROM {source}) y
        WHERE prev IS NULL OR prev <> row_hash)"""
