"""Versions of a key over time: dedupe, latest, change compaction, set logic.

W1-W4, J1, J2 and U1. A version is identified by (key, effective time); NULL
times sort after all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .skew import BORDER, STRETCH, sampled, stretches, task_limit, time_cuts


# A column of its own, because an expression would be computed anew for each
# window, and the second window would not see that its rows are sorted already.
UNDATED = "_undated"


def _per_key(key: str, ts: str, ties: Sequence[str] = (), stretch: Sequence[str] = ()) -> WindowSpec:
    """Rows of a key by time, NULLS LAST."""
    return Window.partitionBy(key, *stretch).orderBy(UNDATED, ts, *ties)


def _first_copy(
    df: DataFrame, key: str, ts: str, order: Sequence[str | Column], stretch: Sequence[str] = ()
) -> DataFrame:
    w = Window.partitionBy(key, *stretch, UNDATED, ts).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _dated(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(UNDATED, F.col(ts).isNull())


def dedupe_versions(df: DataFrame, key: str, ts: str, order: Sequence[str | Column]) -> DataFrame:
    """Keep one row per (key, time): the first by ``order``.

    The row-number limit runs before the shuffle as well as after it, so a
    version with any number of copies sends one row per input task.
    """
    return _first_copy(_dated(df, ts), key, ts, order).drop(UNDATED)


def latest_per_key(
    df: DataFrame, key: str, ts: str, ascending: bool = False, order: Sequence[str | Column] = ()
) -> DataFrame:
    """Keep the newest row per key, or the oldest with ``ascending``.

    A NULL time counts as newer than any other. Limited before the shuffle,
    like ``dedupe_versions``.
    """
    late = F.col(ts).isNull()
    by = [late.asc(), F.col(ts).asc()] if ascending else [late.desc(), F.col(ts).desc()]
    w = Window.partitionBy(key).orderBy(*by, *order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def _changed(previous: str, row_hash: str) -> Column:
    return F.col(previous).isNull() | (F.col(previous) != F.col(row_hash))


def change_history(
    df: DataFrame,
    key: str,
    ts: str,
    order: Sequence[str | Column] | None = None,
    row_hash: str = "row_hash",
    sample: DataFrame | None = None,
    task_rows: int | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Versions that differ from the version before them.

    With ``order`` the copies of a version are removed first (W1); without it
    rows of one (key, time) follow each other by hash. ``row_hash`` must not
    be NULL. With ``flag`` all versions are returned, and a column of that name
    tells which ones differ.

    One shuffle and one sort serve W1 and W4 together, whether keys are cut into
    stretches or not. ``sample`` gives keys and times for the cuts, as ``sampled``
    takes them, where ``df`` is dear to read twice; ``task_rows`` is the number of
    rows of a key that one task may hold.
    """
    limit = task_rows or task_limit(df)
    cuts = time_cuts(sampled(df, limit) if sample is None else sample, key, ts, limit)
    stretch = [STRETCH] if cuts else []
    rows = stretches(df, key, ts, cuts) if cuts else df
    rows = _dated(rows.repartition(key, *stretch), ts)
    if order is not None:
        rows = _first_copy(rows, key, ts, order, stretch)
    ties = [row_hash] if order is None else []
    rows = rows.withColumn("_previous", F.lag(row_hash).over(_per_key(key, ts, ties, stretch)))
    if cuts:
        rows = rows.where(~F.col(BORDER))
    changed = _changed("_previous", row_hash)
    rows = rows.withColumn(flag, changed) if flag else rows.where(changed)
    return rows.drop("_previous", UNDATED, STRETCH, BORDER)


def compact_changes(
    df: DataFrame, key: str, ts: str, row_hash: str = "row_hash", task_rows: int | None = None
) -> DataFrame:
    """Change compaction of rows that are already unique per (key, time)."""
    return change_history(df, key, ts, None, row_hash, task_rows=task_rows)


def anti_versions(last: DataFrame, batch: DataFrame, key: str, ts: str) -> DataFrame:
    """Rows of ``last`` whose (key, time) the batch lacks; NULL matches nothing."""
    return last.join(batch.select(key, ts), [key, ts], "left_anti")


def anti_rows(df: DataFrame, target: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose ``columns`` do not occur in ``target``."""
    return df.join(target.select(*columns), list(columns), "left_anti")


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    """UNION of two frames by column name."""
    return a.unionByName(b).distinct()
