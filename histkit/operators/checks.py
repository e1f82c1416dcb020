"""Data checks as aggregates."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

PASS, WARN = "pass", "warn"


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit(PASS)).otherwise(F.lit(WARN))


def check_not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs per column in one pass: (column, failures, status)."""
    columns = list(df.columns if columns is None else columns)
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column", "failures").withColumn("status", _status(F.col("failures") == 0))


def check_recency(df: DataFrame, field: str, datepart: str, interval: int, as_of: str) -> DataFrame:
    """Is the newest value within ``interval`` date parts of ``as_of``?

    One row: (field, newest, oldest_allowed, status).
    """
    limit = F.expr(f"timestamp_ntz '{as_of}' - interval {int(interval)} {datepart}")
    newest = F.col("newest")
    return df.agg(F.max(field).cast("timestamp_ntz").alias("newest")).select(
        F.lit(field).alias("field"),
        newest,
        limit.alias("oldest_allowed"),
        _status(newest.isNotNull() & (newest >= limit)).alias("status"),
    )


def check_distinct_count_equal(
    a: DataFrame, column_a: str, b: DataFrame, column_b: str, where_a: str | None = None, where_b: str | None = None
) -> DataFrame:
    """Do two columns hold equally many distinct values? (D3)

    One row: (distinct_a, distinct_b, status). Both sides share one grouping
    by value, partially aggregated before the shuffle; NULLs do not count.
    """
    a = a.where(where_a) if where_a else a
    b = b.where(where_b) if where_b else b
    left = a.select(F.col(column_a).alias("value"), F.lit(1).alias("in_a"), F.lit(0).alias("in_b"))
    right = b.select(F.col(column_b).alias("value"), F.lit(0).alias("in_a"), F.lit(1).alias("in_b"))
    values = (
        left.unionByName(right)
        .where("value IS NOT NULL")
        .groupBy("value")
        .agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    )
    total = values.agg(
        F.coalesce(F.sum("in_a"), F.lit(0)).alias("distinct_a"),
        F.coalesce(F.sum("in_b"), F.lit(0)).alias("distinct_b"),
    )
    return total.withColumn("status", _status(F.col("distinct_a") == F.col("distinct_b")))


def check_table(
    df: DataFrame,
    recency: tuple[str, str, int] | None = None,
    as_of: str | None = None,
    distinct: tuple[str, DataFrame, str] | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """All checks of a table: (check, column, tag, severity, failures, status).

    NULLs of every column (or ``columns``); with ``recency`` (field, date part,
    interval) whether the table is up to date ``as_of`` a time; with ``distinct``
    (column, other table, its column) whether both have equally many values.
    ``failures`` counts NULLs, 1 for a table that is late, or the difference.
    """

    out = _nulls_checked(check_not_null(df, columns))
    if recency:
        out = out.unionByName(_recency_checked(check_recency(df, *recency, as_of)))
    if distinct:
        out = out.unionByName(_distinct_checked(df, distinct))
    return out


def _tagged(checked: DataFrame, check: str, column: Column, tag: str, failures: Column) -> DataFrame:
    return checked.select(
        F.lit(check).alias("check"),
        column.alias("column"),
        F.lit(tag).alias("tag"),
        F.lit(WARN).alias("severity"),
        failures.cast("bigint").alias("failures"),
        "status",
    )


def _nulls_checked(counts: DataFrame) -> DataFrame:
    return _tagged(counts, "not_null", F.col("column"), "validity", F.col("failures"))


def _recency_checked(late: DataFrame) -> DataFrame:
    return _tagged(late, "recency", F.col("field"), "timeliness", (F.col("status") != PASS).cast("int"))


def _distinct_checked(df: DataFrame, distinct: tuple[str, DataFrame, str]) -> DataFrame:
    column, other, other_column = distinct
    both = check_distinct_count_equal(df, column, other, other_column)
    return _tagged(both, "distinct_count", F.lit(column), "completeness", F.abs(F.col("distinct_a") - F.col("distinct_b")))


@dataclass(frozen=True)
class Checks:
    """What ``check_table`` takes, for checks of rows that a job writes anyway."""

    recency: tuple[str, str, int] | None = None
    as_of: str | None = None
    distinct: tuple[str, DataFrame, str] | None = None
    columns: Sequence[str] | None = None


def observed(df: DataFrame, checks: Checks) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``df`` under observation, and the check rows once a job has run over it.

    NULLs and the newest time are counted while the job's rows pass by (D1, D2), so
    they cost no second read. Distinct values (D3) can't be merged like that: for them
    the second function reads one column of what the job wrote, which it is given.
    """
    columns = list(df.columns if checks.columns is None else checks.columns)
    metrics = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(columns)]
    if checks.recency:
        metrics.append(F.max(checks.recency[0]).cast("timestamp_ntz").alias("newest"))
    seen = Observation()

    def rows(written: DataFrame) -> DataFrame:
        spark, got = written.sparkSession, seen.get
        counts = spark.createDataFrame([(c, got[f"nulls_{i}"]) for i, c in enumerate(columns)], "column string, failures bigint")
        out = _nulls_checked(counts.withColumn("status", _status(F.col("failures") == 0)))
        if checks.recency:
            field = checks.recency[0]
            newest = spark.createDataFrame([(got["newest"],)], f"`{field}` timestamp_ntz")
            out = out.unionByName(_recency_checked(check_recency(newest, *checks.recency, checks.as_of)))
        if checks.distinct:
            out = out.unionByName(_distinct_checked(written, checks.distinct))
        return out

    return df.observe(seen, *metrics), rows


def column_profile(df: DataFrame, table: str, exact: bool = False) -> DataFrame:
    """Name, position, type, comment, NULL and distinct counts of each column.

    Distinct counts are estimated with sketches, in one pass that shuffles
    nothing but them. ``exact=True`` counts them: each distinct value of each
    column is shuffled once, after values were counted where they are read.
    """
    spark = df.sparkSession
    if exact:
        as_text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
        cells = as_text.unpivot([], df.columns, "column_name", "value")
        counts = (
            cells.groupBy("column_name", "value")
            .agg(F.count(F.lit(1)).alias("n"))
            .groupBy("column_name")
            .agg(
                F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
                F.count("value").alias("n_distinct"),
            )
        )
    else:
        pairs = df.agg(
            *[
                F.struct(
                    F.count_if(F.col(f"`{c}`").isNull()).alias("n_null"),
                    F.approx_count_distinct(f"`{c}`").alias("n_distinct"),
                ).alias(c)
                for c in df.columns
            ]
        )
        counts = pairs.unpivot([], df.columns, "column_name", "c").select("column_name", "c.*")
    described = spark.createDataFrame(
        [
            (table, f.name, i + 1, f.dataType.simpleString(), f.metadata.get("comment"))
            for i, f in enumerate(df.schema.fields)
        ],
        "table_name string, column_name string, position int, data_type string, comment string",
    )
    # one row per column of the schema on both sides
    return described.join(counts, "column_name", "left").select(
        "table_name",
        "column_name",
        "position",
        "data_type",
        "comment",
        F.coalesce("n_null", F.lit(0)).cast("bigint").alias("n_null"),
        F.coalesce("n_distinct", F.lit(0)).cast("bigint").alias("n_distinct"),
    )
