"""Every table description on raw tables derived from the test tables.

The raw columns follow a rule by type, so that a key passes through about ten
states with NULLs among the values. The SQL states the values directly.
"""

from __future__ import annotations

from itertools import groupby

from pyspark.sql import functions as F

from histkit.plans import (
    CONSISTENT,
    MODELS,
    AttributeSpec,
    CdcSpec,
    SnapshotSpec,
    attribute_pivot,
    cdc_history,
    json_history,
    load,
    read_history,
)
from histkit.plans.snapshots import output_columns
from histkit.sources import HistoryTable, shared_folder, stage

from .common import CUT, NTZ, RUN_TS, Query, compact_sql, dedupe_sql, hash_sql, key_sql, spread, table

LOW = "CAST(get_json_object(props, '$.k') AS BIGINT) < 50"
MONTH = "CAST(trunc(CAST(ts AS DATE), 'MM') AS STRING)"
LOW_SQL = "CAST(props->>'$.k' AS BIGINT) < 50"


def _text(i: int) -> str:
    return f"CASE WHEN low THEN concat(event_type, '-{i}') END" if i % 2 else f"concat(event_type, ' {i}')"


def _number(i: int) -> str:
    return f"CASE WHEN low THEN {i} END" if i % 2 else f"length(event_type) + {i}"


def _object(i: int) -> str:
    """JSON text with unsorted keys."""
    return f"""concat('{{"b": {i}, "a": "', event_type, '"}}')"""


def _sorted_object(i: int) -> str:
    return f"""concat('{{"a":"', event_type, '","b":{i}}}')"""


def _quoted(names) -> str:
    return ", ".join(f'"{n}"' for n in names)


# change logs


def _cdc_raw(spec: CdcSpec, spark, sf):
    e = table(spark, sf, "events").withColumn("low", F.expr(LOW))
    cols = []
    for i, c in enumerate(spec.columns):
        if ":" in c.source:
            continue
        if c.name == "id":
            expr = "user_id"
        elif c.source == "meta":
            expr = """concat('{"lastModifiedBy": "', event_type, '", "a": 1}')"""
        else:
            expr = {
                "bigint": _number(i),
                "string": _text(i),
                "boolean": "low" if i % 2 else "CAST(low AS BIGINT)",
                "timestamp": "CAST(date_trunc('HOUR', ts) AS TIMESTAMP_NTZ)",
                "double": f"CAST(length(event_type) AS DOUBLE) / 4 + {i}",
                "json": _object(i),
            }[c.type]
        cols.append(F.expr(expr).alias(c.source))
    return e.select(
        *cols,
        F.expr("ts + interval 1 hour").alias(spec.loaded),
        F.expr("event_type = 'error'").alias(spec.deleted),
        F.unix_millis(F.col("ts").cast("timestamp")).alias(spec.effective),
    )


def _cdc_sql(spec: CdcSpec) -> str:
    cols = []
    for i, c in enumerate(spec.columns):
        if c.name == "id":
            expr = "user_id"
        elif ":" in c.source:
            expr = "event_type"
        elif c.source == "meta":
            expr = """concat('{"a":1,"lastModifiedBy":"', event_type, '"}')"""
        else:
            expr = {
                "bigint": f"CAST({_number(i)} AS BIGINT)",
                "string": _text(i),
                "boolean": "low",
                "timestamp": "date_trunc('hour', ts)",
                "double": f"CAST(length(event_type) AS DOUBLE) / 4 + {i}",
                "json": _sorted_object(i),
            }[c.type]
        cols.append(f'{expr} AS "{c.name}"')
    names = [c.name for c in spec.columns]
    row_hash = hash_sql(*[f'"{n}"' for n in names])
    return f"""
        WITH log AS (SELECT *, {row_hash} AS row_hash FROM (
            SELECT {", ".join(cols)}, ts + INTERVAL '1' HOUR AS etl_updated_timestamp,
                event_type = 'error' AS is_deleted_in_source,
                date_trunc('milliseconds', ts) AS timestamp_effective
            FROM (SELECT *, {LOW_SQL} AS low FROM events) e) x)
        SELECT {key_sql("id", "timestamp_effective")} AS {spec.unique_key}, {_quoted(names)},
            etl_updated_timestamp, is_deleted_in_source, timestamp_effective, row_hash
        FROM {compact_sql(dedupe_sql("log") + " d")} h"""


# snapshots

GROUP = "Job_Families_on_Job_Profile_group"
ORGANISATIONS = "Worker_Position_Organizations_group"


def _snapshot_raw(spec, spark, sf):
    e = spread(table(spark, sf, "events")).withColumn("low", F.expr(LOW))
    members = {}
    for i, c in enumerate(spec.columns):
        name = c.source[2:]
        if name.startswith(GROUP):
            members[GROUP] = ("object", '[{"Job_Family_Group":"g @","Job_Family":"f"},{"Job_Family":"x"}]')
        elif name == ORGANISATIONS:
            members[name] = ("object", "[" + ",".join(_child(j, k) for j, k in enumerate(spec.children.types)) + "]")
        elif c.name == spec.key:
            members[name] = ("key", "concat('\"w', user_id, '\"')")
        else:
            members[name] = {
                "string": ("plain", (f'"@-{i}"', "null") if i % 2 else (f'"@ {i}"', f'"@ {i}"')),
                "boolean": ("plain", ("true", "false")),
                "date": ("date", ('"@"', "null")),
                "date_timestamp": ("month", '"@ 10:11:12"'),
                "json": ("object", f'{{"b": {i}, "a": "@"}}'),
            }[c.type]
    members[spec.effective.source[2:]] = ("day", '"@"')
    # the text of neighbours of a kind with a mark where the row's value stands: one replacement for all of them;
    # values of an absent event type are null, objects and times of an absent one are no members
    parts = []
    for kind, run in groupby(members.items(), lambda m: m[1][0]):
        named = [(name, of) for name, (_, of) in run]

        def text(value):
            return ",".join(f'"{name}":{value(of)}' for name, of in named)

        if kind == "key":
            parts += [f"""concat('"{name}":', coalesce({of}, 'null'))""" for name, of in named]
        elif kind == "plain":
            low, other = text(lambda of: of[0]), text(lambda of: of[1])
            absent = [text(lambda of, at=at: "null" if "@" in of[at] else of[at]) for at in (0, 1)]
            filled = f"replace(CASE WHEN low THEN '{low}' ELSE '{other}' END, '@', event_type)"
            parts.append(f"coalesce({filled}, CASE WHEN low THEN '{absent[0]}' ELSE '{absent[1]}' END)")
        elif kind == "date":
            low, other = text(lambda of: of[0]), text(lambda of: of[1])
            parts.append(f"CASE WHEN low THEN replace('{low}', '@', {MONTH}) ELSE '{other}' END")
        else:
            value = {"object": "event_type", "month": MONTH, "day": "CAST(CAST(ts AS DATE) AS STRING)"}[kind]
            parts.append(f"replace('{text(str)}', '@', {value})")
    doc = "concat('{', concat_ws(',', " + ", ".join(parts) + "), '}')"
    return e.select(
        F.expr(doc).alias("raw_data"),
        F.lit("f").alias("raw_filename"),
        F.expr("ts + interval 1 hour").alias("raw_inserted_timestamp"),
    )


def _value(spec, column, i: int) -> str:
    return "concat('w', user_id)" if column.name == spec.key else _text(i)


def _child(j: int, kind: str) -> str:
    return f'{{"Workday_ID":"@{j}","Type":"{kind}"}}'


def _snapshot_sql(spec, stamp: str = f"TIMESTAMP '{RUN_TS}'") -> str:
    cols = []
    for i, c in enumerate(spec.columns):
        name = c.source[2:]
        if name == GROUP:
            expr = """concat('[{"Job_Family":"f","Job_Family_Group":"g ', event_type, '"},{"Job_Family":"x"}]')"""
        elif name.startswith(GROUP):
            expr = "concat('g ', event_type)" if name.endswith("Group") else "'f'"
        elif name == ORGANISATIONS:
            kinds = enumerate(spec.children.types)
            children = [f"""concat('{{"Type":"{k}","Workday_ID":"', event_type, '{j}"}}')""" for j, k in kinds]
            expr = "concat('[', " + ", ',', ".join(children) + ", ']')"
        else:
            expr = {
                "string": _value(spec, c, i),
                "boolean": "low",
                "date": "CASE WHEN low THEN CAST(date_trunc('month', ts) AS DATE) END",
                "date_timestamp": "CAST(date_trunc('month', ts) AS TIMESTAMP)",
                "json": _sorted_object(i),
            }[c.type]
        cols.append(f'{expr} AS "{c.name}"')
    if spec.children:
        cols += [f"concat(event_type, '{j}') AS {n}" for j, n in enumerate(spec.children.types.values())]
    names = output_columns(spec)
    row_hash = hash_sql(*[f'"{n}"' for n in names])
    day = "CAST(ts AS DATE)" if spec.effective.type == "date" else "CAST(CAST(ts AS DATE) AS TIMESTAMP)"
    return f"""
        WITH docs AS (SELECT *, {row_hash} AS row_hash FROM (
            SELECT {", ".join(cols)}, {day} AS timestamp_effective, ts + INTERVAL '1' HOUR AS loaded
            FROM (SELECT *, {LOW_SQL} AS low FROM events) e) x)
        SELECT {key_sql(spec.key, "timestamp_effective")} AS {spec.unique_key}, {_quoted(names)},
            timestamp_effective, row_hash, {stamp} AS etl_updated_timestamp
        FROM {compact_sql(dedupe_sql("docs", spec.key, "loaded") + " d", spec.key)} h"""


# attribute lists


def _attribute_raw(spec: AttributeSpec, spark, sf):
    o = spread(table(spark, sf, "orders"))
    value = {
        "str": ('"@-{i}"', "o_orderstatus"),
        "label": ('{{"id":{i},"defaultAttributes":{{"Label":"@"}}}}', "o_orderpriority"),
        "id": """concat('{{"id":', o_custkey + {i}, '}}')""",
        "ts": ('"@"', "CAST(o_orderdate AS STRING)"),
        "num": ("@", "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"),
        "var": ('{{"b": {i}, "a": "@"}}', "o_orderstatus"),
    }
    # the text of a kind's attributes with a mark where the row's value stands: the pieces between the marks are joined
    # by it; a value that differs by attribute takes an expression for each
    parts = []
    for kind in dict.fromkeys(spec.fields.values()):
        names = [(name, i) for i, (name, k) in enumerate(spec.fields.items()) if k == kind]
        if kind == "id":
            each = [f"""concat('{{"name":"{name}","type":"{kind}","value":', {value[kind].format(i=i)}, '}}')""" for name, i in names]
            parts.append(f"concat_ws(',', {', '.join(each)})")
        else:
            mark, expr = value[kind]
            text = ",".join(f'{{"name":"{name}","type":"{kind}","value":{mark.format(i=i)}}}' for name, i in names)
            parts.append(f"coalesce(array_join(split('{text}', '@'), {expr}), '')")
    doc = f"""concat('{{"deleted":"false","id":', o_orderkey, ',"lastUpdated":"', CAST(o_orderdate AS STRING),
        '","fields":[', concat_ws(',', {", ".join(parts)}), ']}}')"""
    return o.select(F.expr(doc).alias("raw_data"), F.col("o_orderdate").alias("raw_inserted_timestamp"))


def _attribute_sql(spec: AttributeSpec) -> str:
    value = {
        "str": "concat(o_orderstatus, '-{i}')",
        "label": "o_orderpriority",
        "id": "o_custkey + {i}",
        "ts": "o_orderdate",
        "num": "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(38,0))",
        "var": """concat('{{"a":"', o_orderstatus, '","b":{i}}}')""",
    }
    cols = [f'{value[kind].format(i=i)} AS "{name}"' for i, (name, kind) in enumerate(spec.fields.items())]
    names = ["deleted", "id", "lastUpdated", *spec.fields]
    row_hash = hash_sql(*[f'"{n}"' for n in names])
    return f"""SELECT *, {row_hash} AS row_hash, TIMESTAMP '{RUN_TS}' AS etl_updated_timestamp FROM (
        SELECT 'false' AS deleted, o_orderkey AS id, o_orderdate AS "lastUpdated", {", ".join(cols)} FROM orders) x"""


def _query(spec) -> Query:
    spec = spec.with_(time_type=NTZ)
    if isinstance(spec, CdcSpec):
        return Query(lambda spark, sf: cdc_history(spec, _cdc_raw(spec, spark, sf)), _cdc_sql(spec))
    if isinstance(spec, AttributeSpec):
        run = lambda spark, sf: attribute_pivot(spec, _attribute_raw(spec, spark, sf), run_ts=RUN_TS)
        return Query(run, _attribute_sql(spec))
    run = lambda spark, sf: json_history(spec, _snapshot_raw(spec, spark, sf), run_ts=RUN_TS)
    return Query(run, _snapshot_sql(spec))


# second runs: the rows that landed before a cut, then all rows, through a stored table

HALF = "1998-06-01 00:00:00"
LAST_OF_FIRST = "2024-01-14 23:30:00"


def _in_two_loads(spec, raw, cut: str, first: str, **options):
    def run(spark, sf):
        stored = HistoryTable(spark, shared_folder(spark), grain="year")
        source = stage(raw(spec, spark, sf))
        load(spec, source.where(F.col(spec.loaded) < F.lit(cut).cast(NTZ)), stored, first, **options)
        load(spec, source, stored, RUN_TS, **options)
        return read_history(stored)

    return run


def _second_run(spec) -> Query:
    """Histories end like one full rebuild; snapshots and attribute rows keep the load time of the run that added them."""
    spec = spec.with_(time_type=NTZ)
    if isinstance(spec, CdcSpec):
        return Query(_in_two_loads(spec, _cdc_raw, CUT, CUT, mode=CONSISTENT), _cdc_sql(spec))
    if isinstance(spec, SnapshotSpec):
        stamp = f"CASE WHEN loaded < TIMESTAMP '{CUT}' THEN TIMESTAMP '{LAST_OF_FIRST}' ELSE TIMESTAMP '{RUN_TS}' END"
        return Query(_in_two_loads(spec, _snapshot_raw, CUT, LAST_OF_FIRST, mode=CONSISTENT), _snapshot_sql(spec, stamp))
    sql = f"""SELECT * REPLACE (CASE WHEN "lastUpdated" < TIMESTAMP '{HALF}' THEN TIMESTAMP '{HALF}'
        ELSE etl_updated_timestamp END AS etl_updated_timestamp) FROM ({_attribute_sql(spec)}) a"""
    return Query(_in_two_loads(spec, _attribute_raw, HALF, HALF), sql)


QUERIES = {f"model_{name}": _query(spec) for name, spec in MODELS.items()}
QUERIES |= {f"load_{name}": _second_run(spec) for name, spec in MODELS.items()}
