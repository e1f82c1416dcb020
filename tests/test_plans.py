"""The physical plans we want, not only the rows."""

import re

import pytest
from pyspark.sql import functions as F

from histkit.operators import current_watermark, latest_per_key, skew, watermark_filter, watermark_subquery
from histkit.plans import cdc_history, cdc_rows, history
from histkit.plans.history import HASH, TIME
from histkit.sources import BucketedTable, stage
from workloads import ALL
from workloads.common import LOG_SPEC, change_log

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def count(text, operator):
    return len(re.findall(rf"[-+ ]{operator}\b", text))


def assert_no_slow_path(text):
    for word in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
    assert not re.search(r"Window[^\n]*\n[^\n]*Exchange SinglePartition", text)


def test_full_history_shuffles_and_sorts_once(spark):
    text = plan(ALL["cdc_history_full"].run(spark, SF))
    assert count(text, "Exchange") == 1 and count(text, "Sort") == 1


def test_snapshot_history_shuffles_and_sorts_once(spark):
    text = plan(ALL["json_history_full"].run(spark, SF))
    # one more exchange spreads the single test file
    assert count(text, "Exchange") == 2 and count(text, "Sort") == 1


def test_copies_are_dropped_before_the_shuffle(spark):
    text = plan(ALL["dedupe_versions"].run(spark, SF))
    assert text.count("WindowGroupLimit") == 2 and count(text, "Exchange") == 1


def test_pivot_shuffles_narrow_rows_and_sorts_once(spark):
    text = plan(ALL["attribute_pivot"].run(spark, SF))
    assert text.count("hashpartitioning") == 1 and count(text, "Sort") == 1


def test_pivot_reads_its_values_before_the_shuffle(spark):
    """A document that is a column of a shuffled row is copied whole for each path read from it."""
    above, below = plan(ALL["model_submittal"].run(spark, SF)).split("Exchange hashpartitioning", 1)
    assert "variant_get" not in above and "variant_get" in below


def test_attribute_rows_parse_a_document_once_and_shuffle_it_whole(spark):
    text = plan(ALL["attribute_rows_distinct"].run(spark, SF))
    assert text.count("hashpartitioning") == 1 and text.index("explode") < text.index("hashpartitioning")
    assert text.count("Project [from_json(") == text.count("from_json(") == 2


def test_inferring_fields_sorts_nothing(spark):
    text = plan(ALL["infer_fields"].run(spark, SF))
    assert count(text, "Sort") == 0 and "HashAggregate" in text


@pytest.mark.parametrize("partitions", [4, 8, 200])
@pytest.mark.parametrize("name", ["history_hot_keys", "change_compaction_hot_keys"])
def test_stretches_are_shuffled_and_sorted_once_in_every_session(spark, name, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        text = plan(ALL[name].run(spark, SF))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "_stretch" in text and "BroadcastHashJoin" in text
    assert count(text, "Exchange") == 1 and count(text, "Sort") == 1


def test_rows_are_not_counted_by_key(spark, monkeypatch):
    """Only the sample's size reaches the driver."""
    counted, frame = [], type(spark.range(1))
    count_rows = frame.count
    monkeypatch.setattr(frame, "count", lambda df: counted.append(df.columns) or count_rows(df))
    for name in ("first", "collect", "toPandas", "toArrow"):
        monkeypatch.setattr(frame, name, lambda df: pytest.fail("collected"))
    ALL["history_hot_keys"].run(spark, SF)
    assert counted == [["_cut_key", "_cut"]]


def test_incremental_reads_three_columns_of_the_target_and_broadcasts_the_batch_keys(spark):
    log = change_log(spark, SF)
    target = stage(cdc_history(LOG_SPEC, log))
    text = plan(cdc_history(LOG_SPEC, log, target))
    schemas = re.findall(r"ReadSchema: struct<([^>\n]*)>", text)
    assert "id:bigint,timestamp_effective:timestamp_ntz,row_hash:string" in schemas
    assert "LeftSemi" in text and "BroadcastExchange" in text


def above(text, scan):
    """The operators between the first scan that matches and the next join above it."""
    lines = text.splitlines()
    at = next(i for i, line in enumerate(lines) if re.search(scan, line))
    indent = lambda line: len(re.match(r"[ :|+-]*", line)[0])
    out, depth = [], indent(lines[at])
    for line in reversed(lines[:at]):
        if indent(line) < depth:
            depth = indent(line)
            out.append(line.lstrip(" :|+-*0123456789()"))
            if "Join" in line:
                break
    return out


def test_a_target_in_buckets_is_not_shuffled(spark, tmp_path, monkeypatch):
    """A batch too large to broadcast goes to the buckets of the target, for the join and for the last versions."""
    monkeypatch.setattr(history, "if_small", lambda df, n: df)
    log = change_log(spark, SF)
    stored = BucketedTable(spark, f"{tmp_path}/t", grain="year", name="bucketed_plan", buckets=4)
    stored.replace(cdc_history(LOG_SPEC, log))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = stage(cdc_rows(LOG_SPEC, log))
        last = latest_per_key(history.of_keys(stored.rows().select("id", TIME, HASH), rows, "id", 10**9), "id", TIME)
        text = plan(last)
        whole = plan(cdc_history(LOG_SPEC, log, stored.rows()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for tree in (text, whole):
        path = above(tree, "Bucketed: true")
        assert path[-1].startswith("SortMergeJoin") and not any("Exchange" in line for line in path)
        assert "SelectedBucketsCount: 4 out of 4" in tree
    # above the join, the window finds its rows by key as well
    assert count(text.split("SortMergeJoin")[0], "Exchange") == 0 and "Window" in text


def test_a_large_batch_filters_the_target_before_the_shuffle(spark, monkeypatch):
    """The map of keys is broadcast, and stands between the target's scan and its exchange; rows are the same."""
    log = change_log(spark, SF)
    target = stage(cdc_history(LOG_SPEC, log))
    plain = sorted(cdc_history(LOG_SPEC, log, target).collect())
    for module in (history, skew):
        monkeypatch.setattr(module, "SMALL_ROWS", 10)
    monkeypatch.setattr(history, "if_small", lambda df, n: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = stage(cdc_rows(LOG_SPEC, log).where("id < 20"))
        text = plan(history.of_keys(target.select("id", TIME, HASH), rows, "id", 1000))
        found = sorted(cdc_history(LOG_SPEC, log, target).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    path = above(text, r"FileScan[^\n]*ReadSchema: struct<id:bigint,timestamp_effective:timestamp_ntz,row_hash:string>")
    assert path[-1].startswith("BroadcastHashJoin") and not any("Exchange" in line for line in path)
    assert "bitmap_construct_agg" in text and found == plain


def test_stored_documents_are_read_by_path(spark):
    """The scan gives the seven members that the description reads, and no document."""
    text = plan(ALL["json_history_stored_documents"].run(spark, SF))
    members = ",".join(f"{i}:variant" for i in range(7))
    assert f"ReadSchema: struct<raw_data:struct<{members}>,raw" in text
    assert "raw_data:variant" not in text
    assert spark.conf.get("spark.sql.variant.writeShredding.enabled", None) is None


def test_a_watermark_reaches_the_scan(spark):
    raw = stage(change_log(spark, SF).withColumn("_h2_sf_inserted", F.col("_h2_sf_inserted").cast("timestamp")))
    mark = current_watermark(raw, "_h2_sf_inserted")
    text = plan(watermark_filter(raw.select("id", "_h2_sf_inserted"), "_h2_sf_inserted", mark))
    assert "GreaterThanOrEqual(_h2_sf_inserted" in text
    assert "ReadSchema: struct<id:bigint,_h2_sf_inserted:timestamp>" in text


def directories_read(spark, df):
    """How many directories each scan of a plan reads."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    metrics = [leaves.apply(i).metrics() for i in range(leaves.size())]
    return [m.apply("numPartitions").value() for m in metrics if m.contains("numPartitions")]


def by_day(spark, path, kind):
    """A raw log in directories by the day it landed."""
    log = change_log(spark, SF)
    log.withColumn("day", F.col("_h2_sf_inserted").cast("date").cast(kind)).write.partitionBy("day").parquet(path)
    return spark.read.schema(log.schema.add("day", kind)).parquet(path)


@pytest.mark.parametrize("kind", ["date", "string"])
def test_a_watermark_picks_the_directories_of_its_days(spark, tmp_path, kind):
    raw = by_day(spark, f"{tmp_path}/raw", kind)
    days = sorted(r[0] for r in raw.select(F.col("day").cast("string")).distinct().collect())
    mark = days[-3]
    late = watermark_filter(raw, "_h2_sf_inserted", mark, "day")
    assert re.search(r"PartitionFilters: \[isnotnull\(day#\d+\), \(day#\d+ >= ", plan(late))
    assert directories_read(spark, late.select("id")) == [3]
    assert late.count() == raw.where(F.col("_h2_sf_inserted") >= F.lit(mark).cast("timestamp_ntz")).count()
    # the whole load: its batch has the filter too
    spec = LOG_SPEC.with_(loaded_day="day")
    target = stage(cdc_history(spec, raw))
    assert "PartitionFilters: [isnotnull(day" in plan(watermark_filter(raw, spec.loaded, current_watermark(target, "etl_updated_timestamp"), spec.loaded_day))


def test_a_subquery_watermark_picks_them_when_the_scan_starts(spark, tmp_path):
    raw = by_day(spark, f"{tmp_path}/raw", "date")
    days = sorted(r[0] for r in raw.select("day").distinct().collect())
    target = stage(raw.where(F.col("day") <= days[-3]).select(F.col("_h2_sf_inserted").alias("loaded")))
    late = watermark_subquery(raw, "_h2_sf_inserted", target, "loaded", day="day").select("id")
    assert re.search(r"PartitionFilters: \[[^\n]*day#\d+ >= [^\n]*ubquery", plan(late))
    assert directories_read(spark, late.select("id")) == [3]


# what the loads run is looked at where they run, in test_oracle.py
@pytest.mark.parametrize("name", sorted(n for n in ALL if not n.startswith("load_")))
def test_no_python_no_cross_join_no_single_partition_window(spark, name):
    assert_no_slow_path(plan(ALL[name].run(spark, SF)))
