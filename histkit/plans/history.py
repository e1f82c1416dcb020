"""The part change logs and snapshots share: new rows against stored versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.casts import zone_free
from ..operators.key_filter import key_filter, may_match, pages_for
from ..operators.skew import SMALL_ROWS, if_small
from ..operators.versions import change_history, latest_per_key

TIME, HASH, LOADED = "timestamp_effective", "row_hash", "etl_updated_timestamp"

REFERENCE, CONSISTENT = "reference", "consistent"

#: Which versions are changes, and when a snapshot landed; kept beside the versions in consistent mode.
CHANGED, LANDED = "is_change", "_loaded"


def of_keys(target: DataFrame, rows: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Rows of ``target`` whose key occurs in the ``n_rows`` rows, NULL included. ``rows`` are a staged batch.

    The keys of a small batch are broadcast, so that the target is filtered
    where it is read. Those of a large one are joined by shuffle, of the target's rows
    that pass a broadcast map of the keys' hashes. The join is a plain equality, so a
    target in buckets of the key stays where it is.
    """
    keys = rows.select(F.col(key).alias("_key")).where("_key IS NOT NULL").distinct()
    pages = pages_for(n_rows) if n_rows > SMALL_ROWS else None
    same = F.col(key) == F.col("_key")
    if pages:
        near = may_match(target, key, key_filter(rows, key, pages), pages)
        # an inner join with distinct keys: a semi join would be moved below the filter
        found = near.join(keys, same).drop("_key")
    else:
        found = target.join(if_small(keys, n_rows), same, "left_semi")
    if rows.where(F.col(key).isNull()).isEmpty():
        return found
    return found.unionByName(target.where(F.col(key).isNull()))


def history_of(versions: DataFrame) -> DataFrame:
    """The history among all versions of consistent mode: the changes, without what is kept beside them."""
    if CHANGED not in versions.columns:
        return versions
    return versions.where(CHANGED).drop(CHANGED, LANDED)


def changes(
    rows: DataFrame,
    key: str,
    loaded: str,
    target: DataFrame | None = None,
    mode: str = REFERENCE,
    carry_all: bool = False,
    sample: DataFrame | None = None,
    task_rows: int | None = None,
) -> DataFrame:
    """Changed versions among ``rows``, seen against the versions in ``target``.

    Stored versions join the new rows before the one shuffle by key, so the
    dedupe there does the work of an anti-join on (key, time): in ``reference``
    mode a stored last version steps back behind a new row of the same time.

    - ``reference``: only the last stored version of a key takes part. Without
      ``carry_all`` it serves as a predecessor and is not returned (it would
      replace itself by an equal row), so three columns of the target are
      read, and only for the keys in the batch. With ``carry_all`` the last
      versions of all keys are read in full and returned.
    - ``consistent``: the result is *all* versions, marked as change or not, so
      that what compaction leaves out is not forgotten: a version's time stays
      taken, and a late version can make its successor a change. ``target`` holds
      such rows too; those of the batch's keys take part, and the result has the
      whole history of these keys.

    With a target ``rows`` are read several times: pass a staged batch.
    """
    order, options = [loaded, HASH], {"sample": sample, "task_rows": task_rows}
    if target is None:
        flag = CHANGED if mode == CONSISTENT else None
        return change_history(rows, key, TIME, order, HASH, flag=flag, **options)
    n = rows.count()
    if mode == CONSISTENT:
        if CHANGED not in target.columns:
            raise ValueError(f"consistent mode needs all versions, with {CHANGED}, as it returns them")
        stored = of_keys(target.select(*rows.columns), rows, key, n)
        # a key with few new rows may have many stored ones: they are cut together
        return change_history(rows.unionByName(stored), key, TIME, order, HASH, task_rows=task_rows, flag=CHANGED)
    if CHANGED in target.columns:
        raise ValueError("the target has all versions: use consistent mode, or its history_of")
    if carry_all:
        stored = target.select([c for c in target.columns if c in rows.columns])
    else:
        stored = of_keys(target.select(key, TIME, HASH), rows, key, n)
    last = latest_per_key(stored, key, TIME, order=[HASH])
    both = _marked(rows, 0).unionByName(_marked(last, 1), allowMissingColumns=True)
    out = change_history(both, key, TIME, ["_side", *order], HASH, **options)
    return (out if carry_all else out.where("_side = 0")).drop("_side")


def first_versions(rows: DataFrame, key: str) -> DataFrame:
    """The earliest effective time per key, as (_key, _since); NULL times are the latest."""
    return rows.groupBy(F.col(key).alias("_key")).agg(F.min(_position()).alias("_since"))


def earliest(firsts: DataFrame) -> str:
    """The smallest time in ``firsts``, in UTC; a time after all others if there is none."""
    kind = firsts.schema["_since"].dataType["time"].dataType
    return firsts.agg(zone_free(F.min("_since.time"), kind).cast("string")).first()[0] or "9999-12-31"


def versions_from(stored: DataFrame, firsts: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Stored versions of the keys in ``firsts`` from there on."""
    both = stored.join(if_small(firsts, n_rows), F.col(key).eqNullSafe(F.col("_key")))
    return both.where(_position() >= F.col("_since")).drop("_key", "_since")


def last_before(stored: DataFrame, firsts: DataFrame, key: str, n_rows: int) -> DataFrame:
    """Key, time and hash of the last stored version of each key before its time in ``firsts``."""
    narrow = stored.select(key, TIME, HASH).join(if_small(firsts, n_rows), F.col(key).eqNullSafe(F.col("_key")))
    before = narrow.where(_position() < F.col("_since")).drop("_key", "_since")
    return latest_per_key(before, key, TIME, order=[HASH])


def rebuild_tails(
    stored: DataFrame, recent: DataFrame, firsts: DataFrame, key: str, loaded: str, rows: DataFrame, task_rows: int | None = None
) -> DataFrame:
    """Versions to write, marked, out of stored versions and new ``rows``, for the keys in ``firsts`` from there on.

    What lies before the first new version of a key cannot change, so of a key
    with a long history only its end is read in full, out of ``recent``: the
    stored rows of the periods that can hold it. Three columns of all stored
    rows give the version before. Of a version's copies, stored or new, the one
    loaded first is kept, the stored one of equals. One that is stored already
    with the same mark is left out, unless nobody knows when it was loaded.
    """
    n = rows.count()
    after, before = versions_from(recent, firsts, key, n), last_before(stored, firsts, key, n)
    # a new row has no mark so far
    after = after.select(*rows.columns, F.col(CHANGED).alias("_was"))
    both = _marked(after.unionByName(rows, allowMissingColumns=True), 0)
    both = both.unionByName(_marked(before, 1), allowMissingColumns=True)
    order = [loaded, HASH, F.col("_was").asc_nulls_last()]
    out = change_history(both, key, TIME, order, HASH, task_rows=task_rows, flag=CHANGED)
    same = F.col("_was").eqNullSafe(F.col(CHANGED)) & F.col(loaded).isNotNull()
    return out.where((F.col("_side") == 0) & ~same).drop("_side", "_was")


def _position() -> Column:
    return F.struct(F.col(TIME).isNull().alias("undated"), F.col(TIME).alias("time"))


def _marked(df: DataFrame, side: int) -> DataFrame:
    return df.withColumn("_side", F.lit(side))


def replace_keys(target: DataFrame, rebuilt: DataFrame, key: str) -> DataFrame:
    """``target`` with all versions of the rebuilt keys replaced."""
    keys = rebuilt.select(F.col(key).alias("_key")).distinct()
    rest = target.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti")
    return rest.unionByName(rebuilt)
