"""High-water marks of incremental loads.

A mark travels as text in UTC and goes back in as a literal of the filtered
column's own type, so the comparison needs no cast on the
column and reaches the Parquet scan and partition pruning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import zone_free

DAY, EXACT = "day", None


def _grain(col: Column, grain: str | None) -> Column:
    return col.cast("date") if grain == DAY else col


def current_watermark(target: DataFrame, column: str, grain: str | None = DAY) -> str | None:
    """Newest load time of ``target``, cut to the day by default; None if it has none."""
    newest = zone_free(F.max(column), target.schema[column].dataType)
    return target.agg(_grain(newest, grain).cast("string")).first()[0]


def mark_literal(watermark: str, target: T.DataType) -> Column:
    """A mark as a literal of type ``target``."""
    if isinstance(target, T.TimestampType):
        watermark = f"{watermark} 00:00:00Z" if len(watermark) == 10 else f"{watermark}Z"
    return F.lit(watermark).cast(target)


def watermark_filter(df: DataFrame, column: str, watermark: str | None, day: str | None = None) -> DataFrame:
    """Rows loaded at or after the mark. No mark means a first run: all rows.

    ``day`` names a partition column with the day of ``column`` (in UTC, as a date or
    as text): directories of earlier days are not even listed for reading.
    """
    if watermark is None:
        return df
    since = F.col(column) >= mark_literal(watermark, df.schema[column].dataType)
    if day is not None:
        since &= F.col(day) >= F.lit(watermark[:10]).cast(df.schema[day].dataType)
    return df.where(since)


def watermark_subquery(
    df: DataFrame, column: str, target: DataFrame, target_column: str, grain: str | None = DAY, day: str | None = None
) -> DataFrame:
    """The same filter as one lazy plan with a scalar subquery.

    Without a first job; an empty target keeps nothing. The mark is not known when
    the scan is planned, but with ``day`` its value picks the directories when the
    scan starts.
    """
    newest = zone_free(F.max(target_column), target.schema[target_column].dataType)

    def mark():
        return target.agg(_grain(newest, grain).cast("timestamp_ntz").alias("mark")).scalar()

    kind = df.schema[column].dataType
    if isinstance(kind, T.TimestampType):
        micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), mark())
        since = F.col(column) >= F.timestamp_micros(micros)
    else:
        since = F.col(column) >= mark().cast(kind)
    if day is not None:
        since &= F.col(day) >= mark().cast("date").cast(df.schema[day].dataType)
    return df.where(since)
