"""Typed casts of flat columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FAIL, NULL = "fail", "null"


def cast_to(col: Column, target: str, source: T.DataType | None = None, on_error: str = FAIL) -> Column:
    """Cast ``col``; bad input raises, or gives NULL with ``on_error="null"``.

    Fractions cast to an integer are rounded, not cut off; pass the column's
    ``source`` type so that only fractional columns pay for the rounding.
    """
    if target == "bigint" and isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
        col = F.round(col)
    return col.try_cast(target) if on_error == NULL else col.cast(target)


def effective_time(col: Column, source: T.DataType, target: str = "timestamp", on_error: str = FAIL) -> Column:
    """Read a change-log time: whole numbers are epoch milliseconds, anything else is cast."""
    if isinstance(source, T.IntegralType):
        return F.timestamp_millis(col).cast(target)
    return cast_to(col, target, source, on_error)


def date_as_timestamp(col: Column, target: str = "timestamp", on_error: str = FAIL) -> Column:
    """Text to date to timestamp: the time of day is dropped."""
    return cast_to(col, "date", on_error=on_error).cast(target)


def zone_free(col: Column, source: T.DataType) -> Column:
    """A ``timestamp`` as the date and time it has in UTC, whatever the session time zone; other types as they are.

    Text, days and months of a ``timestamp`` follow the session, so two times in
    the hour that clocks repeat look equal. Keys, hashes, parts and watermarks
    are made from this instead.
    """
    if not isinstance(source, T.TimestampType):
        return col
    seconds = (F.unix_micros(col) / F.lit(1_000_000).cast("decimal(10,0)")).cast("decimal(18,6)")
    return F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def type_name(col: Column) -> Column:
    """SQL type name of a value."""
    return F.typeof(col)
