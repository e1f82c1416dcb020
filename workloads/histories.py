"""Change-log histories: full, incremental, consistent, stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from histkit.plans import CONSISTENT, cdc_history, history_of, load, read_history, replace_keys
from histkit.sources import BucketedTable, HistoryTable, shared_folder, stage, upsert

from .common import (
    CUT,
    LOG_COLUMNS,
    LOG_SPEC,
    Registry,
    change_log,
    change_log_sql,
    compact_sql,
    dedupe_sql,
    key_sql,
)

QUERIES = Registry()

KEYED = f"{key_sql('id', 'timestamp_effective')} AS event_key, {LOG_COLUMNS}"


def full_sql() -> str:
    return f"WITH {change_log_sql()} SELECT {KEYED} FROM {compact_sql(dedupe_sql('log') + ' d')} h"


@QUERIES.add(full_sql())
def cdc_history_full(spark, sf):
    return cdc_history(LOG_SPEC, change_log(spark, sf))


# the table after the first run, then one run over the rows since its last day
INCREMENTAL = f"""
    WITH {change_log_sql()},
    target AS (SELECT * FROM {compact_sql(dedupe_sql(
        f"(SELECT * FROM log WHERE etl_updated_timestamp < DATE '{CUT}')") + " d")} t),
    batch AS (SELECT * FROM {dedupe_sql(
        "(SELECT * FROM log WHERE etl_updated_timestamp >= (SELECT CAST(max(etl_updated_timestamp) AS DATE) FROM target))"
    )} b),
    last AS (SELECT * FROM target QUALIFY row_number() OVER (
        PARTITION BY id ORDER BY timestamp_effective DESC) = 1),
    records AS (SELECT * FROM batch UNION SELECT * FROM last l WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE l.id = b.id AND l.timestamp_effective = b.timestamp_effective)),
    changed AS (SELECT * FROM {compact_sql("records")} c)
    SELECT {KEYED} FROM changed
    UNION ALL SELECT {KEYED} FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM changed c WHERE c.id = t.id AND c.timestamp_effective = t.timestamp_effective)"""


def _loaded_before(log, day):
    return log.where(F.col("_h2_sf_inserted") < F.lit(day).cast("timestamp_ntz"))


@QUERIES.add(INCREMENTAL)
def cdc_history_incremental(spark, sf):
    log = change_log(spark, sf)
    target = stage(cdc_history(LOG_SPEC, _loaded_before(log, CUT)))
    return upsert(target, stage(cdc_history(LOG_SPEC, log, target)), LOG_SPEC.unique_key)


@QUERIES.add(INCREMENTAL)
def load_incremental(spark, sf):
    """The same through a stored table: first load, second load, read."""
    log = change_log(spark, sf)
    stored = HistoryTable(spark, shared_folder(spark), grain="day")
    load(LOG_SPEC, _loaded_before(log, CUT), stored)
    load(LOG_SPEC, log, stored)
    return read_history(stored)


@QUERIES.add(INCREMENTAL)
def load_bucketed(spark, sf):
    """The same into a catalog table in buckets of the key, which loads don't shuffle."""
    log, folder = change_log(spark, sf), shared_folder(spark)
    name = f"history_{folder.rsplit('/', 1)[1]}"
    stored = BucketedTable(spark, f"{folder}", name=name, buckets=4)
    load(LOG_SPEC, _loaded_before(log, CUT), stored)
    load(LOG_SPEC, log, stored)
    return read_history(stored)


@QUERIES.add(full_sql())
def cdc_history_consistent(spark, sf):
    """Two runs in consistent mode equal one full rebuild; late copies differ from what is stored."""
    log = change_log(spark, sf)
    versions = stage(cdc_history(LOG_SPEC, _loaded_before(log, CUT), mode=CONSISTENT))
    rebuilt = stage(cdc_history(LOG_SPEC, log, versions, mode=CONSISTENT))
    return history_of(replace_keys(versions, rebuilt, LOG_SPEC.key))


@QUERIES.add(full_sql())
def load_consistent_from_log(spark, sf):
    """Three loads with late copies that differ, into a table of all versions: equal to one full rebuild."""
    log = change_log(spark, sf)
    stored = HistoryTable(spark, shared_folder(spark), grain="day")
    for part in (_loaded_before(log, "2024-01-10"), _loaded_before(log, CUT), log):
        load(LOG_SPEC, part, stored, mode=CONSISTENT)
    return read_history(stored)


@QUERIES.add(full_sql())
def load_consistent_out_of_order(spark, sf):
    """Rows that land late, in the middle of what is stored: the second half of the log, then all of it."""
    log = change_log(spark, sf)
    stored = HistoryTable(spark, shared_folder(spark), grain="day")
    load(LOG_SPEC, log.where(F.col("_h2_sf_inserted") >= F.lit(CUT).cast("timestamp_ntz")), stored, mode=CONSISTENT)
    load(LOG_SPEC, log, stored, mode=CONSISTENT, watermark="2024-01-01")
    return read_history(stored)
