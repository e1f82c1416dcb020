import datetime as dt
import json
import random
from importlib import import_module

import pytest
from pyspark.sql import functions as F

from histkit.operators import (
    attribute_rows,
    child_columns,
    child_list,
    child_pivot,
    explode_variant,
    infer_fields,
    lateral_left,
    pivot,
    pivot_attributes,
)
from histkit.plans import (
    AttributeSpec,
    ChildColumns,
    Column,
    SnapshotSpec,
    attribute_pivot,
    columns,
    infer_spec,
    json_history,
    load,
    read_history,
)
from histkit.sources import HistoryTable, scan_attributes, tables

SNAP = SnapshotSpec(
    "snap",
    ("s", "snap"),
    "snap_key",
    columns("id string Id\nname string Name\ngroups json Groups\nis_deleted boolean Inactive", path=True),
    key="id",
    effective=Column("timestamp_effective", "date_timestamp", "$.Day"),
    time_type="timestamp_ntz",
)


def landed(spark, docs, day=1):
    rows = [(d if isinstance(d, str) else json.dumps(d), dt.datetime(2024, 1, day) + dt.timedelta(seconds=n)) for n, d in enumerate(docs)]
    return spark.createDataFrame(rows, "raw_data string, raw_inserted_timestamp timestamp_ntz")


def history(spark, docs, spec=SNAP, **more):
    out = json_history(spec, landed(spark, docs), run_ts="2024-02-01", **more)
    return sorted(out.collect(), key=lambda r: (r["id"] or "", str(r["timestamp_effective"])))


def test_key_order_in_a_kept_document_is_no_change(spark):
    rows = history(
        spark,
        [
            '{"Id":"a","Day":"2024-01-01","Groups":{"x":1,"y":2}}',
            '{"Id":"a","Day":"2024-01-02","Groups":{"y":2,"x":1}}',
            '{"Id":"a","Day":"2024-01-03","Groups":{"y":3,"x":1}}',
        ],
    )
    assert [r["groups"] for r in rows] == ['{"x":1,"y":2}', '{"x":1,"y":3}']


def test_missing_paths_nulls_and_undated_documents(spark):
    docs = [{"Id": "a", "Day": "2024-01-01"}, {"Id": "a", "Day": "2024-01-02", "Name": None}, {"Id": "a", "Name": "n"}]
    rows = history(spark, docs)
    assert [(str(r["timestamp_effective"]), r["name"]) for r in rows] == [("2024-01-01 00:00:00", None), ("None", "n")]
    assert len(history(spark, docs, SNAP.with_(require_not_null=("timestamp_effective",)))) == 1


def test_a_hot_entity_gives_the_same_history(spark):
    docs = [{"Id": "hot", "Day": f"2024-{1 + n // 28:02}-{1 + n % 28:02}", "Name": "ab"[n % 3 == 0]} for n in range(200)]
    docs += [{"Id": "b", "Day": "2024-01-01", "Name": "x"}]
    assert history(spark, docs, task_rows=20) == history(spark, docs)


def test_same_day_keeps_the_document_that_landed_first(spark):
    rows = history(spark, [{"Id": "a", "Day": "2024-01-01", "Name": n} for n in ("first", "second")])
    assert [r["name"] for r in rows] == ["first"]


def test_a_run_stamps_the_last_version_of_every_key_unless_told_not_to(spark):
    target = json_history(
        SNAP,
        landed(spark, [{"Id": k, "Day": "2024-01-01", "Name": "n"} for k in "ab"]),
        run_ts="2024-01-01 12:00:00",
    )
    news = landed(spark, [{"Id": "a", "Day": "2024-01-02", "Name": "m"}], day=2)
    every = json_history(SNAP, news, target, run_ts="2024-02-01")
    assert sorted((r["id"], r["name"]) for r in every.collect()) == [("a", "m"), ("a", "n"), ("b", "n")]
    only = json_history(SNAP, news, target, run_ts="2024-02-01", carry_all=False)
    assert sorted((r["id"], r["name"]) for r in only.collect()) == [("a", "m")]


PARENTS = SnapshotSpec(
    "p",
    ("s", "p"),
    "p_key",
    columns("id string Id\nname string Name", path=True),
    key="id",
    effective=Column("timestamp_effective", "date", "$.Day"),
    children=ChildColumns("$.Kids", "Key", "Type", {"One": "one", "Pay Group": "pay_group"}, after="name"),
    time_type="timestamp_ntz",
)


def test_child_columns_and_their_lateral_form(spark):
    docs = [
        {"Id": "a", "Day": "2024-01-01", "Kids": [{"Key": "k1", "Type": "One"}, {"Key": "k2", "Type": "One"}]},
        {"Id": "a", "Day": "2024-01-02", "Kids": [{"Key": "p", "Type": "Pay Group"}]},
        {"Id": "b", "Day": "2024-01-01", "Kids": []},
        {"Id": "c", "Day": "2024-01-01"},
    ]
    rows = [(r["id"], r["one"], r["pay_group"]) for r in history(spark, docs, PARENTS)]
    assert rows == [("a", "k2", None), ("a", None, "p"), ("b", None, None), ("c", None, None)]
    # joined on the key alone, both dates of "a" see all three children
    wide = [(r["id"], r["one"], r["pay_group"]) for r in history(spark, docs, PARENTS, children="lateral")]
    assert sorted(set(wide), key=repr) == sorted(
        {("a", "k1", "p"), ("a", "k2", "p"), ("b", None, None), ("c", None, None)}, key=repr
    )


def test_explode_keeps_or_drops_empty_lists(spark):
    df = spark.createDataFrame([(1, "[1,2]"), (2, "[]"), (3, None), (4, '{"x":1}')], "id int, raw string")
    df = df.select("id", F.try_parse_json("raw").alias("doc"))
    lists = df.where("id < 4")
    assert [r["id"] for r in explode_variant(lists, "doc").orderBy("id").collect()] == [1, 1]
    assert [r["id"] for r in explode_variant(lists, "doc", outer=True).orderBy("id").collect()] == [1, 1, 2, 3]


def test_child_rows(spark):
    kids = spark.createDataFrame([(1, "A", 5), (1, "A", 7), (1, "B", 1), (2, "C", 9)], "id int, kind string, v int")
    types = {"A": "a", "B": "b"}
    assert [tuple(r) for r in child_pivot(kids, ["id"], "kind", "v", types).collect()] == [(1, 7, 1)]
    parents = spark.createDataFrame([(1,), (2,)], "id int")
    rows = lateral_left(parents, kids, "id", "kind", "v", types).collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, 5, 1), (1, 7, 1), (2, None, None)]


def test_child_list_of_null(spark):
    df = spark.sql("SELECT parse_json('null') d").select(child_list(F.col("d"), "$", "Key", "Type").alias("c"))
    assert df.select(*child_columns(F.col("c"), {"One": "one"})).first()[0] is None


# attribute lists

FIELDS = {"name": "str", "rank": "num", "boss": "id", "kind": "label", "when": "ts", "blob": "var"}
SPEC = AttributeSpec("t", ("s", "t"), FIELDS, time_type="timestamp_ntz")


def doc(id, *attributes, updated="2024-01-01T00:00:00", **more):
    return {
        "deleted": "false",
        "id": id,
        "lastUpdated": updated,
        "fields": [{"name": n, "type": "t", "value": v} for n, v in attributes],
        **more,
    }


def pivoted(spark, docs):
    out = attribute_pivot(SPEC, landed(spark, docs), run_ts="2024-02-01")
    return {r["id"]: r for r in out.collect()}


def test_pivot_reads_every_kind(spark):
    row = pivoted(
        spark,
        [
            doc(
                1,
                ("name", "x"),
                ("rank", 2.5),
                ("boss", {"id": 7}),
                ("kind", {"id": 1, "defaultAttributes": {"Label": "L"}}),
                ("when", "2024-01-02T03:04:05"),
                ("blob", {"b": 1, "a": [1]}),
                ("other", 3),
            )
        ],
    )[1]
    assert (row["name"], int(row["rank"]), row["boss"], row["kind"]) == ("x", 3, 7, "L")
    assert (row["when"], row["blob"]) == (dt.datetime(2024, 1, 2, 3, 4, 5), '{"a":[1],"b":1}')


def test_pivot_reads_values_at_the_top_in_one_pass(spark):
    fields = {**{f"Text {i}": "str" for i in range(30)}, "Size s": "num", "when": "ts", "boss": "id"}
    raw = landed(spark, [doc(1, ("Text 0", 1.5), ("Text 29", {"b": 1, "a": None}), ("Size s", "7"), ("boss", {"id": 3}), ("odd", []))])
    wide = pivot_attributes(scan_attributes(raw), fields)
    plan = spark._jvm.PythonSQLUtils.explainString(wide._jdf.queryExecution(), "simple")
    assert plan.count("variant_get(values") == 2
    row = wide.collect()[0]
    assert (row["Text 0"], row["Text 1"], row["Text 29"], row["boss"]) == ("1.5", None, '{"a":null,"b":1}', 3)


def test_repeated_names_take_the_largest_value_as_its_type(spark):
    rows = pivoted(spark, [doc(1, ("rank", 9), ("rank", 10), ("name", "b"), ("name", "a"), ("name", None), ("boss", {"id": 3}))])
    assert (int(rows[1]["rank"]), rows[1]["name"], rows[1]["boss"]) == (10, "b", 3)


def test_documents_without_attributes_vanish_and_nameless_ones_do_not(spark):
    docs = [doc(1), doc(2, fields=None), doc(3, (None, "x")), doc(4, ("name", None)), {"id": 5, "deleted": "true"}]
    docs.append({**doc(6), "fields": [{"name": "name"}]})
    rows = pivoted(spark, docs)
    assert sorted(rows) == [3, 4, 6]
    assert all(rows[i]["name"] is None for i in rows)


def test_replays_and_versions(spark):
    d = doc(1, ("name", "x"))
    again = doc(1, ("name", "x"), updated="2024-01-02T00:00:00")
    assert attribute_pivot(SPEC, landed(spark, [d, d, again]), run_ts="2024-02-01").count() == 2
    assert attribute_rows(scan_attributes(landed(spark, [d, d, again]))).count() == 2


def test_incremental_appends_only_new_content(spark):
    first = landed(spark, [doc(1, ("name", "x"))])
    target = attribute_pivot(SPEC, first, run_ts="2024-01-01")
    both = landed(spark, [doc(1, ("name", "x")), doc(1, ("name", "y")), doc(2, ("name", "x"))], day=2)
    new = attribute_pivot(SPEC, both.unionByName(first), target, run_ts="2024-02-01")
    # the two contents of document 1 share a version, so the larger one stands
    assert sorted((r["id"], r["name"]) for r in new.collect()) == [(1, "y"), (2, "x")]


def test_a_batch_of_documents_is_staged_tight_and_wide_rows_once(spark, tmp_path, monkeypatch):
    """Staged rows are packed by zstd; what the table holds of a batch is staged on two columns, the batch not again."""
    staged, stage = [], tables.stage

    def recorded(df):
        staged.append(stage(df))
        return staged[-1]

    for name in ("attributes", "load"):
        monkeypatch.setattr(import_module(f"histkit.plans.{name}"), "stage", recorded)
    table = HistoryTable(spark, str(tmp_path), grain="year")
    spec = AttributeSpec("t", ("t", "t"), {"name": "str"}, time_type="timestamp_ntz")
    first = landed(spark, [doc(1, ("name", "a")), doc(2, ("name", "b"))])
    load(spec, first, table, "2024-01-01 00:00:00")
    again = first.unionByName(landed(spark, [doc(2, ("name", "b")), doc(3, ("name", "c"))], day=2))
    load(spec, again, table, "2024-01-02 00:00:00")
    assert sorted((r["id"], r["name"]) for r in table.rows().collect()) == [(1, "a"), (2, "b"), (3, "c")]
    assert [len(df.columns) for df in staged] == [5, 2] and staged[1].count() == 2
    assert all(".zstd." in f for df in (*staged, table.rows()) for f in df.inputFiles())


def test_variant_payload(spark):
    raw = landed(spark, [doc(1, ("name", "x"))]).withColumn("raw_data", F.parse_json("raw_data"))
    assert attribute_pivot(SPEC, raw, run_ts="2024-02-01").first()["name"] == "x"


def test_bad_values_raise_or_give_null(spark):
    raw = landed(spark, [doc(1, ("rank", "many"), ("name", "x"))])
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        attribute_pivot(SPEC, raw, run_ts="2024-02-01").collect()
    row = attribute_pivot(SPEC.with_(on_error="null"), raw, run_ts="2024-02-01").first()
    assert (row["rank"], row["name"]) == (None, "x")


def test_inferred_fields_drive_the_pivot(spark):
    docs = [
        doc(1, ("name", "x"), ("rank", 2), ("boss", {"id": 7}), ("when", "2024-01-02T03:04:05")),
        doc(2, ("name", "y"), ("name", "z"), ("kind", {"id": 1, "defaultAttributes": {"Label": "L"}}), ("blob", [1])),
        doc(3, ("mixed", 1), ("none", None), ("flag", True)),
        doc(4, ("mixed", "x")),
    ]
    raw = landed(spark, docs)
    found = {r["name"]: (r["kind"], r["n_docs"]) for r in infer_fields(scan_attributes(raw)).collect()}
    assert found == {
        "name": ("str", 2),
        "rank": ("num", 1),
        "boss": ("id", 1),
        "when": ("ts", 1),
        "kind": ("label", 1),
        "blob": ("var", 1),
        "mixed": ("var", 2),
        "none": ("str", 1),
        "flag": ("str", 1),
    }
    spec = infer_spec(AttributeSpec("t", ("s", "t"), time_type="timestamp_ntz"), raw)
    row = {r["id"]: r for r in attribute_pivot(spec, raw, run_ts="2024-02-01").collect()}[2]
    assert (row["name"], row["kind"], row["blob"]) == ("z", "L", "[1]")


def test_attributes_of_one_kind_keep_their_own_columns(spark):
    """Values travel in lists by kind: absent, null and repeated names must not move the others."""
    fields = {"a": "str", "n": "num", "b": "str", "m": "num", "c": "str", "l": "label"}
    docs = [
        doc(1, ("c", "3"), ("a", "1"), ("m", 2)),
        doc(2, ("b", "x"), ("b", "y"), ("n", 7), ("c", None), ("l", {"id": 1, "defaultAttributes": {"Label": "L"}})),
        doc(3, ("other", "1")),
    ]
    out = {r["id"]: tuple(r)[3:] for r in pivot_attributes(scan_attributes(landed(spark, docs)), fields).collect()}
    assert out == {1: ("1", None, None, 2, "3", None), 2: (None, 7, "y", None, None, "L"), 3: (None,) * 6}


def test_many_fields_are_read_in_place_with_the_same_rows(spark, monkeypatch):
    """Also of repeated, absent, nameless and null attributes, and of two names with one CRC-32."""
    kinds = {"name": "str", "rank": "num", "boss": "id", "kind": "label", "when": "ts", "blob": "var", "plumless": "str", "a b.c": "str"}
    fields = {**kinds, **{f"field{i}": "str" for i in range(120)}}
    label = {"id": 1, "defaultAttributes": {"Label": "L"}}
    docs = [
        doc(1, ("blob", {"b": 1, "a": [1]}), ("name", 1.50), ("when", "2024-01-02T03:04:05"), ("kind", label), ("boss", {"id": 7}), ("other", 3)),
        doc(2, ("rank", 9), ("rank", 10), ("name", None), ("name", "a"), ("name", "b"), (None, "x"), ("kind", "L")),
        doc(3, ("buckeroo", "x"), ("field7", {"b": 1, "a": None})),
        doc(4, ("buckeroo", "x"), ("plumless", "y"), ("a b.c", "z")),
        doc(5, (None, "x"), (None, "y")),
        doc(6, (None, "x")),
        doc(7),
        doc(8, fields=None),
        {**doc(9), "fields": [{"name": "name"}, {"value": "x"}, {"name": "rank", "value": 2.5}]},
        doc(1, ("name", "later"), ("blob", None), updated="2024-01-02T00:00:00"),
        doc(1, ("name", "2"), ("field119", True)),
    ]
    documents = scan_attributes(landed(spark, docs))
    wide = pivot_attributes(documents, fields)
    assert "to_variant_object" not in spark._jvm.PythonSQLUtils.explainString(wide._jdf.queryExecution(), "extended")
    rows = {(r["id"], r["lastUpdated"].day): r for r in wide.collect()}
    assert (rows[1, 1]["name"], rows[1, 1]["boss"], rows[1, 1]["kind"], rows[1, 1]["blob"]) == ("2", 7, "L", '{"a":[1],"b":1}')
    assert (rows[2, 1]["name"], int(rows[2, 1]["rank"]), rows[2, 1]["kind"]) == ("b", 10, None)
    assert (rows[3, 1]["plumless"], rows[4, 1]["plumless"], rows[4, 1]["a b.c"]) == (None, "y", "z")
    assert sorted(i for i, _ in rows) == [1, 1, 2, 3, 4, 5, 6, 9]
    monkeypatch.setattr(pivot, "LOOKED_UP", 1000)
    assert sorted(pivot_attributes(documents, fields).collect(), key=repr) == sorted(wide.collect(), key=repr)


def test_bad_values_of_many_fields_raise_or_give_null(spark, monkeypatch):
    monkeypatch.setattr(pivot, "LOOKED_UP", 0)
    test_bad_values_raise_or_give_null(spark)
    test_header_times_in_the_fields_format(spark)
    test_variant_payload(spark)


def test_names_that_need_quoting(spark):
    fields = {"a b": "str", "group": "str", "x.y": "str"}
    raw = landed(spark, [doc(1, ("a b", "1"), ("group", "2"), ("x.y", "3"))])
    out = pivot_attributes(scan_attributes(raw), fields).first()
    assert (out["a b"], out["group"], out["x.y"]) == ("1", "2", "3")


def test_consistent_snapshot_loads_equal_a_full_rebuild(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    docs = [{"Id": i, "Day": f"2024-01-{d:02}", "Name": n} for i, d, n in [("a", 1, "x"), ("a", 3, "y"), ("b", 1, "x")]]
    first = landed(spark, docs)
    second = landed(spark, [{"Id": "a", "Day": "2024-01-02", "Name": "y"}, {"Id": "a", "Name": "z"}], day=2)
    load(SNAP, first, table, run_ts="2024-01-01 12:00:00", mode="consistent")
    load(SNAP, first.unionByName(second), table, run_ts="2024-01-02 12:00:00", mode="consistent")
    full = json_history(SNAP, first.unionByName(second), run_ts="2024-02-01").drop("etl_updated_timestamp")
    stored = read_history(table)
    assert sorted(stored.drop("etl_updated_timestamp").collect()) == sorted(full.collect())
    stamps = {(r["id"], r["name"]): r["etl_updated_timestamp"].day for r in stored.collect()}
    assert stamps == {("a", "x"): 1, ("b", "x"): 1, ("a", "y"): 2, ("a", "z"): 2}


def test_header_times_in_the_fields_format(spark):
    """Two versions of one id with 12-hour times stay two; an unread time raises in either mode."""
    spec = AttributeSpec("t", ("t", "t"), {"name": "str", "at": "ts"}, time_type="timestamp_ntz")
    docs = [
        doc(1, ("name", "a"), ("at", "2024-01-01 09:00 AM"), updated="2024-01-01 01:00 AM"),
        doc(1, ("name", "b"), ("at", "2024-01-01 09:00 PM"), updated="2024-01-01 01:00 PM"),
    ]
    clock = spec.with_(timestamp_format="yyyy-MM-dd hh:mm a")
    for mode in ("fail", "null"):
        out = attribute_pivot(clock.with_(on_error=mode), landed(spark, docs), run_ts="2024-02-01").collect()
        assert sorted((r["lastUpdated"].hour, r["name"], r["at"].hour) for r in out) == [(1, "a", 9), (13, "b", 21)]
        with pytest.raises(Exception, match="INVALID_VARIANT_CAST|CANNOT_PARSE"):
            attribute_pivot(spec.with_(on_error=mode), landed(spark, docs[:1]), run_ts="2024-02-01").collect()


def test_consistent_snapshots_with_late_unequal_copies(spark, tmp_path):
    """Documents of one day that land in several runs: the first stays, also where compaction left it out."""
    rng = random.Random(11)
    days = [None, *range(1, 9)]
    docs = [[{"Id": rng.choice("ab"), "Name": rng.choice("xy"), "Day": (d := rng.choice(days)) and f"2024-01-{d:02}"} for _ in range(12)] for _ in range(3)]
    parts = [landed(spark, docs[i], day=1 + i) for i in range(3)]
    table, seen = HistoryTable(spark, str(tmp_path), grain="day"), None
    for i, part in enumerate(parts):
        seen = part if seen is None else seen.unionByName(part)
        load(SNAP, seen, table, run_ts=f"2024-01-0{i + 1} 12:00:00", mode="consistent")
    full = json_history(SNAP, seen, run_ts="2024-02-01").drop("etl_updated_timestamp")
    stored = read_history(table).drop("etl_updated_timestamp")
    assert sorted(stored.collect(), key=repr) == sorted(full.collect(), key=repr)
