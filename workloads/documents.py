"""JSON documents: paths, lists, snapshots, attribute lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.functions import json_get
from histkit.operators import (
    attribute_rows,
    child_columns,
    child_list,
    child_pivot,
    explode_variant,
    infer_fields,
    lateral_left,
    pivot_rows,
)
from histkit.plans import (
    CONSISTENT,
    AttributeSpec,
    ChildColumns,
    Column,
    SnapshotSpec,
    attribute_pivot,
    columns,
    history_of,
    json_history,
    load,
    read_history,
    replace_keys,
)
from histkit.sources import HistoryTable, scan_attributes, scan_files, scan_json, shared_folder, stage, store_documents, upsert

from .common import CUT, NTZ, RUN_TS, Registry, compact_sql, dedupe_sql, hash_sql, key_sql, spread, table

QUERIES = Registry()

# paths


@QUERIES.add("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def json_path_cast(spark, sf):
    e = table(spark, sf, "events").select("event_id", F.parse_json("props").alias("doc"))
    return e.select("event_id", json_get(F.col("doc"), "$.k", "bigint").alias("k"))


def _order_documents(spark, sf) -> DataFrame:
    """One document per order with its lines, in line order."""
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        F.struct(
            "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", F.col("l_quantity").cast("bigint").alias("l_quantity")
        ).alias("line"),
    )
    per_order = lines.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    doc = F.to_json(F.struct("o_orderkey", "o_orderstatus", F.coalesce("lines", F.array()).alias("lines")))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return joined.select("o_orderkey", F.parse_json(doc).alias("doc"))


_FIRST_LINE = """(SELECT * FROM lineitem QUALIFY row_number() OVER (
    PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_quantity) = 1)"""


@QUERIES.add(f"""
    SELECT o_orderkey, l_partkey AS first_part,
           CASE WHEN l_partkey IS NOT NULL THEN '{{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey
             || ',"l_quantity":' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || ',"l_returnflag":"'
             || l_returnflag || '","l_suppkey":' || l_suppkey || '}}' END AS first_line
    FROM orders LEFT JOIN {_FIRST_LINE} f ON o_orderkey = l_orderkey""")
def json_array_first(spark, sf):
    doc = F.col("doc")
    first_line = json_get(doc, "$.lines[0]", "string")
    return _order_documents(spark, sf).select(
        "o_orderkey", json_get(doc, "$.lines[0].l_partkey", "bigint").alias("first_part"), first_line.alias("first_line")
    )


@QUERIES.add("""
    SELECT event_id, '{"k":' || CAST(CAST(props->>'$.k' AS BIGINT) AS VARCHAR) || ',"type":"' || event_type || '"}'
           AS detail, event_type AS kind, CAST(NULL AS VARCHAR) AS missing FROM events""")
def keep_subdocument(spark, sf):
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    raw = F.to_json(F.struct(F.struct(F.col("event_type").alias("type"), k.alias("k")).alias("detail")))
    docs = e.select("event_id", F.parse_json(raw).alias("doc"))
    doc = F.col("doc")
    return docs.select(
        "event_id",
        json_get(doc, "$.detail", "json").alias("detail"),
        json_get(doc, "$.detail.type", "string").alias("kind"),
        json_get(doc, "$.nothing", "json").alias("missing"),
    )


# lists


@QUERIES.add("SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey FROM lineitem")
def explode_children(spark, sf):
    rows = explode_variant(_order_documents(spark, sf), "doc", "$.lines", "line")
    line = F.col("line")
    return rows.select(
        "o_orderkey",
        json_get(line, "$.l_linenumber", "int").alias("l_linenumber"),
        json_get(line, "$.l_partkey", "bigint").alias("l_partkey"),
    )


@QUERIES.add("""
    SELECT o_orderkey, l_linenumber, l_partkey FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey""")
def explode_children_outer(spark, sf):
    rows = explode_variant(_order_documents(spark, sf), "doc", "$.lines", "line", outer=True)
    line = F.col("line")
    return rows.select(
        "o_orderkey",
        json_get(line, "$.l_linenumber", "int").alias("l_linenumber"),
        json_get(line, "$.l_partkey", "bigint").alias("l_partkey"),
    )


FLAGS = {"A": "part_a", "N": "part_n", "R": "part_r"}


@QUERIES.add("""
    SELECT l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_partkey END) AS part_a,
           max(CASE WHEN l_returnflag = 'N' THEN l_partkey END) AS part_n,
           max(CASE WHEN l_returnflag = 'R' THEN l_partkey END) AS part_r
    FROM lineitem WHERE l_returnflag IN ('A', 'N', 'R') GROUP BY l_orderkey""")
def q_child_pivot(spark, sf):
    return child_pivot(table(spark, sf, "lineitem"), ["l_orderkey"], "l_returnflag", "l_partkey", FLAGS)


@QUERIES.add("""
    SELECT o_orderkey, max(CASE WHEN l_returnflag = 'A' THEN l_partkey::VARCHAR END) AS part_a,
           max(CASE WHEN l_returnflag = 'N' THEN l_partkey::VARCHAR END) AS part_n,
           max(CASE WHEN l_returnflag = 'R' THEN l_partkey::VARCHAR END) AS part_r
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_orderkey""")
def child_pivot_in_document(spark, sf):
    docs = _order_documents(spark, sf)
    lists = docs.select("o_orderkey", child_list(F.col("doc"), "$.lines", "l_partkey", "l_returnflag").alias("lines"))
    return lists.select("o_orderkey", *child_columns(F.col("lines"), FLAGS))


@QUERIES.add("""
    SELECT o_orderkey, o_orderstatus, a.l_partkey AS part_a, n.l_partkey AS part_n, r.l_partkey AS part_r
    FROM orders
    LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'A') a ON a.l_orderkey = o_orderkey
    LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'N') n ON n.l_orderkey = o_orderkey
    LEFT JOIN (SELECT * FROM lineitem WHERE l_returnflag = 'R') r ON r.l_orderkey = o_orderkey""")
def q_lateral_left(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_returnflag", "l_partkey")
    return lateral_left(orders, lines, "o_orderkey", "l_returnflag", "l_partkey", FLAGS)


# snapshots: one document per event, dated by day, so that a user has several
# copies of a day; every seventh day a document says nothing about its date

SNAPSHOTS = SnapshotSpec(
    "snapshots",
    ("events", "snapshots"),
    "snapshot_key",
    columns(
        """
        entity_id string Entity_ID
        status string Status
        is_deleted boolean Inactive
        seen_date date Seen
        first_tag string Tags[0].Name
        tags string Tags
        detail json Detail
        """,
        path=True,
    ),
    key="entity_id",
    effective=Column("timestamp_effective", "date_timestamp", "$.Report_Date"),
    children=ChildColumns("$.Tags", "Name", "Kind", {"main": "main_tag", "other": "other_tag"}, after="tags"),
    time_type=NTZ,
)


def _snapshots(spark, sf) -> DataFrame:
    e = spread(table(spark, sf, "events"))
    k = F.get_json_object("props", "$.k").cast("bigint")
    tag = F.struct(F.lit("main").alias("Kind"), F.col("event_type").alias("Name"))
    other = F.struct(F.lit("other").alias("Kind"), F.concat(F.lit("t"), F.col("user_id") % 4).alias("Name"))
    seen = F.concat(F.to_date("ts").cast("string"), F.lit(" 00:00:00"))
    doc = F.struct(
        F.concat(F.lit("u"), F.col("user_id")).alias("Entity_ID"),
        F.col("event_type").alias("Status"),
        (k < 50).alias("Inactive"),
        F.date_format("ts", "yyyy-MM-01").alias("Seen"),
        F.when(F.dayofmonth("ts") % 7 != 0, seen).alias("Report_Date"),
        F.array(tag, other).alias("Tags"),
        F.struct((k < 50).alias("low"), F.col("event_type").alias("type")).alias("Detail"),
    )
    landed = F.expr("ts + interval 1 hour").alias("raw_inserted_timestamp")
    return e.select(F.to_json(doc).alias("raw_data"), F.lit("events").alias("raw_filename"), landed)


_SNAPSHOT_COLUMNS = [
    "entity_id", "status", "is_deleted", "seen_date", "first_tag", "tags", "main_tag", "other_tag", "detail",
]
_SNAPSHOT_ROWS = f"""
    docs AS (SELECT *, {hash_sql(*_SNAPSHOT_COLUMNS)} AS row_hash FROM (
        SELECT 'u' || user_id AS entity_id, event_type AS status, k < 50 AS is_deleted,
            CAST(date_trunc('month', ts) AS DATE) AS seen_date, event_type AS first_tag,
            '[{{"Kind":"main","Name":"' || event_type || '"}},{{"Kind":"other","Name":"t' || (user_id % 4) || '"}}]' AS tags,
            event_type AS main_tag, 't' || (user_id % 4) AS other_tag,
            '{{"low":' || CAST(k < 50 AS VARCHAR) || ',"type":"' || event_type || '"}}' AS detail,
            CASE WHEN day(ts) % 7 <> 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP) END AS timestamp_effective,
            ts + INTERVAL '1' HOUR AS loaded
        FROM (SELECT *, CAST(props->>'$.k' AS BIGINT) AS k FROM events) e) x)"""


def _stamped(run_ts: str) -> str:
    return f"""{key_sql("entity_id", "timestamp_effective")} AS snapshot_key, {", ".join(_SNAPSHOT_COLUMNS)},
        timestamp_effective, row_hash, TIMESTAMP '{run_ts}' AS etl_updated_timestamp"""


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}
    SELECT {_stamped(RUN_TS)} FROM {compact_sql(dedupe_sql("docs", "entity_id", "loaded") + " d", "entity_id")} h""")
def json_history_full(spark, sf):
    return json_history(SNAPSHOTS, _snapshots(spark, sf), run_ts=RUN_TS)


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}
    SELECT {_stamped(RUN_TS)} FROM {compact_sql(dedupe_sql("docs", "entity_id", "loaded") + " d", "entity_id")} h""")
def json_history_stored_documents(spark, sf):
    """The same from documents that were parsed when they were stored; only the paths read leave the files."""
    path = shared_folder(spark)
    store_documents(_snapshots(spark, sf), path)
    return json_history(SNAPSHOTS, spark.read.parquet(path), run_ts=RUN_TS)


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}, dated AS (SELECT * FROM docs WHERE timestamp_effective IS NOT NULL)
    SELECT {_stamped(RUN_TS)} FROM {compact_sql(dedupe_sql("dated", "entity_id", "loaded") + " d", "entity_id")} h""")
def require_not_null(spark, sf):
    spec = SNAPSHOTS.with_(require_not_null=("timestamp_effective",))
    return json_history(spec, _snapshots(spark, sf), run_ts=RUN_TS)


# first run over what had landed before the cut, stamped within its last day;
# second run over the rows landed since that day
FIRST_RUN, SECOND_RUN = "2024-01-14 23:30:00", RUN_TS

_DAY = f"(SELECT * FROM dated WHERE loaded >= CAST(TIMESTAMP '{FIRST_RUN}' AS DATE))"


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}, dated AS (SELECT * FROM docs WHERE timestamp_effective IS NOT NULL),
    target AS (SELECT * FROM {compact_sql(dedupe_sql(
        f"(SELECT * FROM dated WHERE loaded < DATE '{CUT}')", "entity_id", "loaded") + " d", "entity_id")} t),
    batch AS (SELECT * FROM {dedupe_sql(_DAY, "entity_id", "loaded")} b),
    last AS (SELECT * FROM target QUALIFY row_number() OVER (
        PARTITION BY entity_id ORDER BY timestamp_effective DESC) = 1),
    records AS (SELECT * FROM batch UNION SELECT * FROM last l WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE l.entity_id = b.entity_id AND l.timestamp_effective = b.timestamp_effective)),
    changed AS (SELECT * FROM {compact_sql("records", "entity_id")} c)
    SELECT {_stamped(SECOND_RUN)} FROM changed
    UNION ALL SELECT {_stamped(FIRST_RUN)} FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM changed c WHERE c.entity_id = t.entity_id AND c.timestamp_effective = t.timestamp_effective)""")
def json_history_incremental(spark, sf):
    spec = SNAPSHOTS.with_(require_not_null=("timestamp_effective",))
    raw = stage(_snapshots(spark, sf))
    early = raw.where(F.col("raw_inserted_timestamp") < F.lit(CUT).cast(NTZ))
    target = stage(json_history(spec, early, run_ts=FIRST_RUN))
    return upsert(target, stage(json_history(spec, raw, target, run_ts=SECOND_RUN)), spec.unique_key)


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}, dated AS (SELECT * FROM docs WHERE timestamp_effective IS NOT NULL),
    target AS (SELECT * FROM {compact_sql(dedupe_sql(
        f"(SELECT * FROM dated WHERE loaded < DATE '{CUT}')", "entity_id", "loaded") + " d", "entity_id")} t),
    batch AS (SELECT *, true AS fresh FROM {dedupe_sql(_DAY, "entity_id", "loaded")} b),
    last AS (SELECT *, false AS fresh FROM target QUALIFY row_number() OVER (
        PARTITION BY entity_id ORDER BY timestamp_effective DESC) = 1),
    records AS (SELECT * FROM batch UNION ALL SELECT * FROM last l WHERE NOT EXISTS (
        SELECT 1 FROM batch b WHERE l.entity_id = b.entity_id AND l.timestamp_effective = b.timestamp_effective)),
    changed AS (SELECT * FROM {compact_sql("records", "entity_id")} c WHERE fresh)
    SELECT {_stamped(SECOND_RUN)} FROM changed
    UNION ALL SELECT {_stamped(FIRST_RUN)} FROM target t WHERE NOT EXISTS (
        SELECT 1 FROM changed c WHERE c.entity_id = t.entity_id AND c.timestamp_effective = t.timestamp_effective)""")
def json_history_carry_batch(spark, sf):
    """Two loads into a stored table; last versions that the batch does not change keep their load time."""
    spec = SNAPSHOTS.with_(require_not_null=("timestamp_effective",))
    raw = stage(_snapshots(spark, sf))
    stored = HistoryTable(spark, shared_folder(spark))
    load(spec, raw.where(F.col("raw_inserted_timestamp") < F.lit(CUT).cast(NTZ)), stored, FIRST_RUN, carry_all=False)
    load(spec, raw, stored, SECOND_RUN, carry_all=False)
    return read_history(stored)


@QUERIES.add(f"""
    WITH {_SNAPSHOT_ROWS}, dated AS (SELECT * FROM docs WHERE timestamp_effective IS NOT NULL),
    whole AS (SELECT * FROM {compact_sql(dedupe_sql("dated", "entity_id", "loaded") + " d", "entity_id")} h)
    SELECT {_stamped(SECOND_RUN)} FROM whole WHERE entity_id IN (SELECT entity_id FROM {_DAY} b)
    UNION ALL SELECT {_stamped(FIRST_RUN)} FROM whole WHERE entity_id NOT IN (SELECT entity_id FROM {_DAY} b)""")
def json_history_consistent(spark, sf):
    """Two runs in consistent mode give the versions of one full rebuild."""
    spec = SNAPSHOTS.with_(require_not_null=("timestamp_effective",))
    raw = stage(_snapshots(spark, sf))
    early = raw.where(F.col("raw_inserted_timestamp") < F.lit(CUT).cast(NTZ))
    versions = stage(json_history(spec, early, run_ts=FIRST_RUN, mode=CONSISTENT))
    rebuilt = stage(json_history(spec, raw, versions, run_ts=SECOND_RUN, mode=CONSISTENT))
    return history_of(replace_keys(versions, rebuilt, spec.key))


# attribute lists: every order as a document, each landed twice

ORDERS = AttributeSpec(
    "orders",
    ("orders", "orders"),
    {
        "custkey": "id",
        "status": "label",
        "priority": "str",
        "orderdate": "ts",
        "total": "num",
        "detail": "var",
        "absent": "str",
        "order": "num",
    },
    time_type=NTZ,
)


def _attribute_documents(spark, sf) -> DataFrame:
    o = spread(table(spark, sf, "orders"))

    def text(name, value):
        return F.concat(F.lit(f'{{"name":"{name}","type":"t","value":'), value, F.lit("}"))

    def quoted(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    cents = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    fields = [
        text("custkey", F.concat(F.lit('{"id":'), F.col("o_custkey"), F.lit("}"))),
        text(
            "status",
            F.concat(F.lit('{"id":1,"defaultAttributes":{"Label":"'), F.col("o_orderstatus"), F.lit('"}}')),
        ),
        text("priority", quoted(F.col("o_orderpriority"))),
        text("orderdate", quoted(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))),
        text("total", cents),
        text("detail", F.concat(F.lit('{"z":'), F.col("o_custkey"), F.lit(',"a":[1,2]}'))),
        text("absent", F.lit("null")),
        text("order", F.col("o_orderkey").cast("string")),
    ]
    doc = F.concat(
        F.lit('{"deleted":"false","id":'),
        F.col("o_orderkey"),
        F.lit(',"lastUpdated":"'),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
        F.lit('","fields":['),
        F.concat_ws(",", *fields),
        F.lit("]}"),
    )
    first = o.select(doc.alias("raw_data"), F.col("o_orderdate").alias("raw_inserted_timestamp"))
    again = o.select(doc.alias("raw_data"), F.expr("o_orderdate + interval 1 day").alias("raw_inserted_timestamp"))
    return first.unionByName(again)


_ATTRIBUTE_COLUMNS = [
    "deleted", "id", "lastUpdated", "custkey", "status", "priority", "orderdate", "total", "detail", "absent", '"order"',
]
_ATTRIBUTE_ROWS = f"""(
    SELECT *, {hash_sql(*_ATTRIBUTE_COLUMNS)} AS row_hash, TIMESTAMP '{RUN_TS}' AS etl_updated_timestamp FROM (
        SELECT 'false' AS deleted, o_orderkey AS id, o_orderdate AS lastUpdated, o_custkey AS custkey,
            o_orderstatus AS status, o_orderpriority AS priority, o_orderdate AS orderdate,
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,0)) AS total,
            '{{"a":[1,2],"z":' || o_custkey || '}}' AS detail, CAST(NULL AS VARCHAR) AS absent,
            CAST(o_orderkey AS DECIMAL(38,0)) AS "order"
        FROM orders) x)"""


@QUERIES.add(f"SELECT * FROM {_ATTRIBUTE_ROWS} p")
def q_attribute_pivot(spark, sf):
    return attribute_pivot(ORDERS, _attribute_documents(spark, sf), run_ts=RUN_TS)


# the first run stops at the middle of the order dates; the second one reads
# what landed since, which includes second copies of stored documents
_HALF = "1998-06-01 00:00:00"


@QUERIES.add(f"SELECT * REPLACE (CASE WHEN lastUpdated < TIMESTAMP '{_HALF}' THEN TIMESTAMP '{_HALF}' "
             f"ELSE etl_updated_timestamp END AS etl_updated_timestamp) FROM {_ATTRIBUTE_ROWS} p")  # fmt: skip
def attribute_pivot_incremental(spark, sf):
    docs = stage(_attribute_documents(spark, sf))
    early = docs.where(F.col("raw_inserted_timestamp") < F.lit(_HALF).cast(NTZ))
    target = stage(attribute_pivot(ORDERS, early, run_ts=_HALF))
    return target.unionByName(attribute_pivot(ORDERS, docs, target, run_ts=RUN_TS))


@QUERIES.add(f"SELECT * REPLACE (CASE WHEN lastUpdated < TIMESTAMP '{_HALF}' THEN TIMESTAMP '{_HALF}' "
             f"ELSE etl_updated_timestamp END AS etl_updated_timestamp) FROM {_ATTRIBUTE_ROWS} p")  # fmt: skip
def load_attributes(spark, sf):
    """The same through a stored table."""
    docs = stage(_attribute_documents(spark, sf))
    stored = HistoryTable(spark, shared_folder(spark), grain="year")
    load(ORDERS, docs.where(F.col("raw_inserted_timestamp") < F.lit(_HALF).cast(NTZ)), stored, _HALF)
    load(ORDERS, docs, stored, RUN_TS)
    return read_history(stored)


@QUERIES.add("""
    SELECT 'false' AS deleted, o_orderkey AS id, o_orderdate AS "lastUpdated", name, 't' AS type, value FROM (
        SELECT o_orderkey, o_orderdate, 'custkey' AS name, '{"id":' || o_custkey || '}' AS value FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'status',
            '{"defaultAttributes":{"Label":"' || o_orderstatus || '"},"id":1}' FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'priority', '"' || o_orderpriority || '"' FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'orderdate',
            '"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '"' FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'total', regexp_replace(
            CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR), '[.]?0+$', '') FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'absent', 'null' FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'detail', '{"a":[1,2],"z":' || o_custkey || '}' FROM orders
        UNION ALL SELECT o_orderkey, o_orderdate, 'order', CAST(o_orderkey AS VARCHAR) FROM orders) x""")
def attribute_rows_distinct(spark, sf):
    return attribute_rows(scan_attributes(_attribute_documents(spark, sf)))


_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@QUERIES.add("""
    SELECT o_custkey, """ + ", ".join(
    f"""max(CASE WHEN o_orderpriority = '{p}' THEN o_orderstatus END) AS "{p}\"""" for p in _PRIORITIES
) + " FROM orders GROUP BY o_custkey")
def conditional_max_pivot(spark, sf):
    o = table(spark, sf, "orders")
    return pivot_rows(o, ["o_custkey"], "o_orderpriority", "o_orderstatus", _PRIORITIES)


@QUERIES.add("""
    SELECT name, kind, 2 * count(*) AS n_docs FROM orders CROSS JOIN (VALUES ('custkey', 'id'), ('status', 'label'),
        ('priority', 'str'), ('orderdate', 'ts'), ('total', 'num'), ('detail', 'var'), ('absent', 'str'),
        ('order', 'num')) v(name, kind) GROUP BY name, kind""")
def q_infer_fields(spark, sf):
    return infer_fields(scan_attributes(_attribute_documents(spark, sf)))


@QUERIES.add("""
    SELECT event_id, event_type AS status, ts + INTERVAL '1' HOUR AS raw_inserted_timestamp FROM events""")
def scan_json_documents(spark, sf):
    e = table(spark, sf, "events")
    raw = e.select(
        F.to_json(F.struct("event_id", F.col("event_type").alias("status"))).alias("raw_data"),
        F.expr("ts + interval 1 hour").alias("raw_inserted_timestamp"),
    )
    doc = F.col("document")
    return scan_json(raw).select(
        json_get(doc, "$.event_id", "bigint").alias("event_id"),
        json_get(doc, "$.status", "string").alias("status"),
        "raw_inserted_timestamp",
    )


@QUERIES.add(f"SELECT * FROM {_ATTRIBUTE_ROWS} p")
def attribute_pivot_stored_documents(spark, sf):
    path = shared_folder(spark)
    store_documents(_attribute_documents(spark, sf), path)
    return attribute_pivot(ORDERS, spark.read.parquet(path), run_ts=RUN_TS)


@QUERIES.add("""
    SELECT name, kind, 2 * count(*) AS n_docs, shape FROM orders CROSS JOIN (VALUES ('custkey', 'id', NULL),
        ('status', 'label', NULL), ('priority', 'str', NULL), ('orderdate', 'ts', NULL), ('total', 'num', NULL),
        ('detail', 'var', 'OBJECT<a: ARRAY<BIGINT>, z: BIGINT>'), ('absent', 'str', NULL), ('order', 'num', NULL))
        v(name, kind, shape) GROUP BY name, kind, shape""")
def infer_nested_fields(spark, sf):
    """With the types of the members of objects and lists."""
    return infer_fields(scan_attributes(_attribute_documents(spark, sf)), nested=True)


@QUERIES.add("""
    SELECT event_id, event_type AS status, CAST(props->>'$.k' AS BIGINT) AS k, CAST(ts AS DATE) AS day,
           true AS is_named, true AS is_timed FROM events""")
def scan_json_files(spark, sf):
    """Files of JSON lines where they land, read without a schema."""
    e, path = table(spark, sf, "events"), shared_folder(spark)
    inner = F.struct(F.get_json_object("props", "$.k").cast("bigint").alias("k"))
    lines = e.select("event_id", F.col("event_type").alias("status"), inner.alias("inner"), F.to_date("ts").alias("day"))
    lines.write.partitionBy("day").json(path)
    raw = scan_files(spark, path)
    doc = F.col("raw_data")
    return raw.select(
        json_get(doc, "$.event_id", "bigint").alias("event_id"),
        json_get(doc, "$.status", "string").alias("status"),
        json_get(doc, "$.inner.k", "bigint").alias("k"),
        "day",
        F.col("raw_filename").like("part-%.json").alias("is_named"),
        (F.col("raw_inserted_timestamp") > F.lit("2024-01-01").cast("timestamp")).alias("is_timed"),
    )
