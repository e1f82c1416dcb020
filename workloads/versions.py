"""Version operators, filters, joins and hashes on their own."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.functions import cast_to, date_as_timestamp, effective_time, row_hash, surrogate_key, type_name
from histkit.operators import (
    anti_rows,
    anti_versions,
    change_history,
    compact_changes,
    current_watermark,
    dedupe_versions,
    key_filter,
    latest_per_key,
    may_match,
    pages_for,
    union_distinct,
    watermark_filter,
    watermark_subquery,
)
from histkit.sources import read_source, scan_cdc, shared_folder, stage, upsert

from .common import CUT, NTZ, Registry, change_log, change_log_sql, dedupe_sql, hash_sql, key_sql, table

QUERIES = Registry()


@QUERIES.add("""
    SELECT user_id AS id, event_type AS status, CAST(value AS DECIMAL(18,4)) AS amount,
           CAST(round(value) AS BIGINT) AS rounded, ts AS timestamp_effective, CAST(ts AS DATE) AS day
    FROM events""")
def cdc_project_cast(spark, sf):
    e = scan_cdc(table(spark, sf, "events"), ["user_id", "event_type", "value", "ts"])
    value = e.schema["value"].dataType
    return e.select(
        cast_to(F.col("user_id"), "bigint").alias("id"),
        cast_to(F.col("event_type"), "string").alias("status"),
        cast_to(F.col("value"), "decimal(18,4)", value).alias("amount"),
        cast_to(F.col("value"), "bigint", value).alias("rounded"),
        cast_to(F.col("ts"), NTZ).alias("timestamp_effective"),
        cast_to(F.col("ts"), "date").alias("day"),
    )


@QUERIES.add("""
    SELECT event_id, ts AS timestamp_effective, date_trunc('day', ts)::TIMESTAMP AS day_start,
           'bigint' AS id_type FROM events""")
def effective_times(spark, sf):
    e = table(spark, sf, "events").withColumn("ms", F.unix_micros(F.col("ts").cast("timestamp")))
    millis = effective_time((F.col("ms") / 1000).cast("bigint"), T.LongType(), NTZ)
    # whole milliseconds from the number, the rest of the microseconds put back
    rest = F.make_dt_interval(secs=(F.col("ms") % 1000) / F.lit(1000000))
    return e.select(
        "event_id",
        (millis + rest).cast(NTZ).alias("timestamp_effective"),
        date_as_timestamp(F.col("ts").cast("string").substr(1, 10), NTZ).alias("day_start"),
        type_name(F.col("ms")).alias("id_type"),
    )


@QUERIES.add(f"""
    SELECT event_id, user_id, ts FROM events
    WHERE ts >= (SELECT CAST(max(ts) AS DATE) FROM events WHERE ts < DATE '{CUT}')""")
def watermark_day(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return watermark_filter(e, "ts", current_watermark(e.where(F.col("ts") < CUT), "ts"))


@QUERIES.add(f"""
    SELECT event_id, user_id, ts FROM events
    WHERE ts >= (SELECT max(ts) FROM events WHERE ts < DATE '{CUT}')""")
def watermark_exact(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return watermark_filter(e, "ts", current_watermark(e.where(F.col("ts") < CUT), "ts", grain=None))


@QUERIES.add(f"""
    SELECT event_id, user_id, ts FROM events
    WHERE ts >= (SELECT CAST(max(ts) AS DATE) FROM events WHERE ts < DATE '{CUT}')""")
def watermark_scalar_subquery(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return watermark_subquery(e, "ts", e.where(F.col("ts") < CUT), "ts")


@QUERIES.add(f"""
    WITH {change_log_sql()} SELECT id, timestamp_effective, status, etl_updated_timestamp, row_hash
    FROM {dedupe_sql("log")} d""")
def q_dedupe_versions(spark, sf):
    log = change_log(spark, sf)
    log = log.select(
        "id",
        F.col("_h2_binlog_ts_ms").alias("timestamp_effective"),
        "status",
        F.col("_h2_sf_inserted").alias("etl_updated_timestamp"),
    )
    log = log.withColumn("row_hash", row_hash(log, ["id", "status"]))
    return dedupe_versions(log, "id", "timestamp_effective", ["etl_updated_timestamp", "row_hash"])


@QUERIES.add("""
    SELECT user_id, ts, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1""")
def q_latest_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_per_key(e, "user_id", "ts", order=["event_id"])


@QUERIES.add("""
    SELECT user_id, ts, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1""")
def q_earliest_per_key(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type")
    return latest_per_key(e, "user_id", "ts", ascending=True, order=["event_id"])


@QUERIES.add(f"""
    SELECT o_orderkey, {hash_sql("o_custkey", "o_orderstatus", "cents", "o_orderdate", "nullif(o_orderpriority, '5-LOW')")}
           AS row_hash
    FROM (SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS cents FROM orders) o""")
def q_row_hash(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.col("o_totalprice").cast("decimal(18,2)").alias("cents"),
        "o_orderdate",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
    )
    return o.select("o_orderkey", row_hash(o, o.columns[1:]).alias("row_hash"))


@QUERIES.add(f"SELECT event_id, {key_sql('user_id', 'ts')} AS event_key FROM events")
def q_surrogate_key(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", surrogate_key(e, "user_id", "ts").alias("event_key"))


@QUERIES.add(f"""
    SELECT event_id, {key_sql('user_id', 'ts')} AS event_key, {hash_sql('user_id', 'ts')} AS row_hash FROM events""")
def keys_in_another_zone(spark, sf):
    """Keys and hashes of a ``timestamp``, made in a session that is not in UTC."""
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        e = table(spark, sf, "events").withColumn("ts", F.expr("to_timestamp(cast(ts AS string) || 'Z')"))
        both = [surrogate_key(e, "user_id", "ts").alias("event_key"), row_hash(e, ["user_id", "ts"]).alias("row_hash")]
        return stage(e.select("event_id", *both))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@QUERIES.add("SELECT c_custkey, c_name, c_nationkey FROM customer")
def q_read_source(spark, sf):
    """A raw table by its name, where it was put."""
    found = read_source(spark, "icims_raw", "person", tables={"person": f"{sf}/customer.parquet"})
    return found.select("c_custkey", "c_name", "c_nationkey")


def _by_load_day(spark, sf):
    """The change log as it lands, in a directory for each day, read back."""
    log = change_log(spark, sf)
    path = shared_folder(spark)
    log.withColumn("load_day", F.col("_h2_sf_inserted").cast("date")).write.partitionBy("load_day").parquet(path)
    return spark.read.schema(log.schema.add("load_day", "date")).parquet(path)


_SINCE = f"""
    WITH {change_log_sql()}, mark AS (SELECT CAST(max(etl_updated_timestamp) AS DATE) AS day FROM log
        WHERE etl_updated_timestamp < DATE '{CUT}')
    SELECT id, status, timestamp_effective FROM log, mark WHERE etl_updated_timestamp >= day"""
_OF_LOG = ["id", "status", "_h2_binlog_ts_ms AS timestamp_effective"]


@QUERIES.add(_SINCE)
def watermark_by_load_day(spark, sf):
    """Only the directories of the days since the mark are read."""
    log = _by_load_day(spark, sf)
    stored = log.where(F.col("_h2_sf_inserted") < F.lit(CUT).cast(NTZ))
    mark = current_watermark(stored, "_h2_sf_inserted")
    return watermark_filter(log, "_h2_sf_inserted", mark, "load_day").selectExpr(*_OF_LOG)


@QUERIES.add(_SINCE)
def watermark_subquery_by_load_day(spark, sf):
    log = _by_load_day(spark, sf)
    stored = log.where(F.col("_h2_sf_inserted") < F.lit(CUT).cast(NTZ))
    return watermark_subquery(log, "_h2_sf_inserted", stored, "_h2_sf_inserted", day="load_day").selectExpr(*_OF_LOG)


_COMPACT = """
    SELECT {key}, ts, event_id, row_hash FROM (
        SELECT *, lag(row_hash) OVER (PARTITION BY {key} ORDER BY ts) AS prev FROM (
            SELECT {key}, ts, event_id, {hash} AS row_hash FROM events) h) x
    WHERE prev IS NULL OR prev <> row_hash"""


@QUERIES.add(_COMPACT.format(key="user_id", hash=hash_sql("event_type")))
def change_compaction(spark, sf):
    e = table(spark, sf, "events")
    e = e.select("user_id", "ts", "event_id", row_hash(e, ["event_type"]).alias("row_hash"))
    return compact_changes(e, "user_id", "ts")


@QUERIES.add(_COMPACT.format(key="event_type", hash=hash_sql("user_id % 3")))
def change_compaction_hot_keys(spark, sf):
    """A fifth of all rows per key: the keys are cut into time slices."""
    e = table(spark, sf, "events").withColumn("group", F.col("user_id") % 3)
    e = e.select("event_type", "ts", "event_id", row_hash(e, ["group"]).alias("row_hash"))
    return compact_changes(e, "event_type", "ts", task_rows=100)


@QUERIES.add(f"""
    SELECT event_type AS id, timestamp_effective, status, etl_updated_timestamp, row_hash FROM (
        SELECT *, lag(row_hash) OVER (PARTITION BY event_type ORDER BY timestamp_effective) AS prev FROM (
            SELECT event_type, ts AS timestamp_effective, status, etl_updated_timestamp,
                   {hash_sql("status")} AS row_hash
            FROM (SELECT event_type, ts, user_id % 2 = 0 AS status, ts + INTERVAL '1' HOUR AS etl_updated_timestamp
                  FROM events
                  UNION ALL SELECT event_type, ts, user_id % 2 = 1, ts + INTERVAL '2' DAY FROM events) c
            QUALIFY row_number() OVER (PARTITION BY event_type, ts ORDER BY etl_updated_timestamp) = 1) d) x
    WHERE prev IS NULL OR prev <> row_hash""")
def history_hot_keys(spark, sf):
    """Dedupe and compaction together on hot keys."""
    e = table(spark, sf, "events")

    def copy(rest, delay):
        return e.select(
            F.col("event_type").alias("id"),
            F.col("ts").alias("timestamp_effective"),
            (F.col("user_id") % 2 == rest).alias("status"),
            F.expr(f"ts + interval {delay}").alias("etl_updated_timestamp"),
        )

    log = copy(0, "1 hour").unionByName(copy(1, "2 days"))
    log = log.withColumn("row_hash", row_hash(log, ["status"]))
    order = ["etl_updated_timestamp", "row_hash"]
    return change_history(log, "id", "timestamp_effective", order, task_rows=100)


@QUERIES.add(f"""
    WITH last AS (SELECT user_id, ts, event_id FROM events WHERE ts < DATE '{CUT}'),
         batch AS (SELECT user_id, ts FROM events WHERE ts >= DATE '{CUT}' - INTERVAL '2' DAY)
    SELECT * FROM last l WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE l.user_id = b.user_id AND l.ts = b.ts)""")
def q_anti_versions(spark, sf):
    e = table(spark, sf, "events").select("user_id", "ts", "event_id")
    batch = e.where(F.col("ts") >= F.expr(f"timestamp_ntz '{CUT}' - interval 2 days"))
    return anti_versions(e.where(F.col("ts") < CUT), batch, "user_id", "ts")


@QUERIES.add("""
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""")
def q_key_filter(spark, sf):
    """Rows with a key of the batch; most others don't reach the join."""
    batch = stage(table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("key")))
    lines, pages = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), pages_for(batch.count())
    near = may_match(lines, "l_orderkey", key_filter(batch, "key", pages), pages)
    return near.join(batch, F.col("l_orderkey") == F.col("key")).drop("key")


@QUERIES.add("""
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    LEFT JOIN (SELECT DISTINCT 2 * c_custkey AS twice, 'F' AS status FROM customer) c
        ON o_custkey = twice AND o_orderstatus = status WHERE twice IS NULL""")
def q_anti_rows(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    known = table(spark, sf, "customer").select(
        (2 * F.col("c_custkey")).alias("o_custkey"), F.lit("F").alias("o_orderstatus")
    )
    return anti_rows(orders, known, ["o_custkey", "o_orderstatus"])


@QUERIES.add("""
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice < 300000
    UNION
    SELECT o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_totalprice >= 200000""")
def q_union_distinct(spark, sf):
    o = table(spark, sf, "orders")
    cols = ["o_custkey", "o_orderstatus", "o_orderpriority"]
    return union_distinct(o.where("o_totalprice < 300000").select(cols), o.where("o_totalprice >= 200000").select(cols))


@QUERIES.add("""
    SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus = 'O' THEN '1-URGENT' ELSE o_orderpriority END
           AS o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey + 100000000, 'N', o_orderpriority FROM orders WHERE o_orderstatus = 'F'""")
def q_upsert(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    changed = o.where("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("1-URGENT"))
    new = o.where("o_orderstatus = 'F'").select(
        (F.col("o_orderkey") + 100000000).alias("o_orderkey"), F.lit("N").alias("o_orderstatus"), "o_orderpriority"
    )
    return upsert(o, stage(changed.unionByName(new)), "o_orderkey")
