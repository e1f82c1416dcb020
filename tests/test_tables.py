import datetime as dt
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from histkit.plans import AttributeSpec, load
from histkit.sources import BucketedTable, HistoryTable, merge_into, read_source, remove_staged, shared_folder, stage, tables, upsert
from tests.test_documents import SPEC as ATTRIBUTES
from tests.test_documents import doc, landed

SCHEMA = "k string, v int, timestamp_effective timestamp_ntz, etl_updated_timestamp timestamp_ntz"


def frame(spark, *rows):
    """Rows of (key, value, month, load day)."""
    return spark.createDataFrame(
        [(k, v, None if m is None else dt.datetime(2024, m, 5), dt.datetime(2024, 6, d)) for k, v, m, d in rows], SCHEMA
    )


def short(df):
    return sorted((r["k"], r["v"]) for r in df.collect())


def files(table):
    """Data files by period."""
    out = {}
    for folder, _, names in os.walk(table.path):
        if "history_period=" in folder:
            found = {n for n in names if n.endswith(".parquet")}
            out |= {folder.split("history_period=")[1]: found} if found else {}
    return out


def test_upsert_rewrites_only_the_periods_it_touches(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    assert not table.exists()
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", 1, 2, 1), ("c", 1, None, 1)))
    before = files(table)
    assert set(before) == {"2024-01", "2024-02", "__HIVE_DEFAULT_PARTITION__"}
    table.upsert(stage(frame(spark, ("b", 2, 2, 3), ("d", 2, 3, 3))), "k")
    after = files(table)
    assert short(table.rows()) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert {p for p in before if before[p] == after[p]} == {"2024-01", "__HIVE_DEFAULT_PARTITION__"}
    table.upsert(stage(frame(spark, ("c", 5, None, 4))), "k")
    assert files(table)["2024-02"] == after["2024-02"] and ("c", 5) in short(table.rows())
    assert table.watermark() == "2024-06-04"
    assert table.watermark(day=False) == "2024-06-04 00:00:00"


def test_an_upsert_stages_keys_and_no_rows(spark, tmp_path, monkeypatch):
    staged = []
    monkeypatch.setattr(tables, "stage", lambda df: staged.append(df.columns) or stage(df))
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", 1, 1, 1), (None, 1, 1, 1)))
    table.upsert(stage(frame(spark, ("b", 2, 1, 3), ("d", 2, 2, 3), (None, 2, 1, 3))), "k")
    assert staged == [["k"]]
    rows = table.rows()
    assert short(rows.where("k IS NOT NULL")) == [("a", 1), ("b", 2), ("d", 2)]
    assert sorted(r["v"] for r in rows.where("k IS NULL").collect()) == [1, 2]


def test_append_and_column_order(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    table.append(frame(spark, ("a", 1, 1, 1)))
    table.append(frame(spark, ("b", 2, 1, 2)).select("etl_updated_timestamp", "v", "k", "timestamp_effective"))
    assert short(table.rows()) == [("a", 1), ("b", 2)]
    table.upsert(stage(frame(spark, ("a", 3, 1, 3))), "k")
    assert short(table.rows()) == [("a", 3), ("b", 2)]


def test_a_table_without_time_is_one_period(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), time=None)
    table.replace(frame(spark, ("a", 1, 1, 1)).select("k", "v"))
    table.upsert(stage(frame(spark, ("a", 2, 1, 1), ("b", 1, 1, 1)).select("k", "v")), "k")
    assert short(table.rows()) == [("a", 2), ("b", 1)] and set(files(table)) == {"all"}
    assert table.watermark() is None


@pytest.mark.parametrize("grain, periods", [("day", {"2024-01-05", "2024-02-05"}), ("year", {"2024"})])
def test_grains(spark, tmp_path, grain, periods):
    table = HistoryTable(spark, str(tmp_path), grain=grain)
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", 1, 2, 1)))
    assert set(files(table)) == periods and short(table.rows()) == [("a", 1), ("b", 1)]


def test_a_full_refresh_leaves_nothing_of_the_table_before(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", 1, 2, 1)))
    table.replace(frame(spark, ("a", 2, 1, 2)).withColumn("more", F.lit("x")))
    assert short(table.rows()) == [("a", 2)] and set(files(table)) == {"2024-01"}
    assert table.rows().columns[-1] == "more"


def test_a_lost_write_is_not_seen(spark, tmp_path):
    """What a job leaves aside when it is lost before it moves its files."""
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark, ("a", 1, 1, 1)))
    aside = f"{tmp_path}/.spark-staging-lost/history_period=2024-01"
    frame(spark, ("z", 9, 1, 9)).write.parquet(aside)
    assert short(table.rows()) == [("a", 1)]
    broken = frame(spark, ("b", 1, 1, 2)).withColumn("v", F.expr("CAST(raise_error('lost') AS int)"))
    with pytest.raises(Exception, match="lost"):
        table.append(broken)
    assert short(table.rows()) == [("a", 1)] and table.watermark() == "2024-06-01"


def test_a_lost_full_refresh_is_no_table(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    broken = frame(spark, ("b", 1, 1, 2)).withColumn("v", F.expr("CAST(raise_error('lost') AS int)"))
    with pytest.raises(Exception, match="lost"):
        table.replace(broken)
    assert not table.exists()
    with pytest.raises(ValueError):
        table.rows()
    table.replace(frame(spark, ("a", 1, 1, 1)))
    assert short(table.rows()) == [("a", 1)]


def test_buckets_hold_the_same_rows(spark, tmp_path):
    table = BucketedTable(spark, f"{tmp_path}/t", name="bucketed_for_test", key="k", buckets=3)
    assert not table.exists()
    table.upsert(frame(spark, ("a", 1, 1, 1), ("b", 1, 2, 1), ("c", 1, None, 1)), "k")
    before = files(table)
    assert set(before) == {"2024-01", "2024-02", "__HIVE_DEFAULT_PARTITION__"}
    table.upsert(stage(frame(spark, ("b", 2, 2, 3), ("d", 2, 3, 3))), "k")
    after = files(table)
    assert short(table.rows()) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert {p for p in before if before[p] == after[p]} == {"2024-01", "__HIVE_DEFAULT_PARTITION__"}
    table.append(frame(spark, ("e", 1, 1, 4)))
    assert ("e", 1) in short(table.rows()) and table.watermark() == "2024-06-04"
    assert short(table.rows("2024-03-01")) == [("c", 1), ("d", 2)]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    rows, columns = short(table.rows()), table.rows().schema
    spark.sql("DROP TABLE bucketed_for_test")  # its files stay
    assert not table.exists()
    table.attach(columns)
    assert short(table.rows()) == rows
    table.replace(frame(spark, ("z", 1, 1, 1)))
    assert short(table.rows()) == [("z", 1)]


def test_staged_batches_are_removed_by_age(spark):
    stage(frame(spark, ("a", 1, 1, 1)))
    assert remove_staged(spark, 24 * 3600) == 0


def test_attribute_load_with_a_default_table(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    for day in (1, 3):
        load(ATTRIBUTES, landed(spark, [doc(day, ("name", "x"))], day=day), table, run_ts=f"2024-01-0{day} 00:00:00")
    assert sorted(r["id"] for r in table.rows().collect()) == [1, 3]


def test_reading_from_a_time_on_skips_earlier_periods(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", 1, 2, 1), ("c", 1, 3, 1), ("d", 1, None, 1)))
    late = table.rows("2024-02-20 10:00:00")
    assert short(late) == [("b", 1), ("c", 1), ("d", 1)]
    assert "PartitionFilters: [(isnull(history_period" in late._jdf.queryExecution().executedPlan().toString()
    assert short(table.rows("9999-12-31")) == [("d", 1)]


def test_empty_first_load(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark))
    assert table.exists() and table.watermark() is None and table.rows().columns[0] == "k"


def test_upsert_frames(spark):
    merged = upsert(frame(spark, ("a", 1, 1, 1), ("b", 1, 1, 1)), frame(spark, ("b", 2, 1, 1), ("c", 2, 1, 1)), "k")
    assert short(merged) == [("a", 1), ("b", 2), ("c", 2)]


def test_merge_into_needs_a_catalog_with_row_level_operations(spark, tmp_path):
    with pytest.raises(AnalysisException):
        merge_into(frame(spark, ("a", 1, 1, 1)), "no_such_table", "k")


def test_staging_uses_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark).startswith(base)
    df = stage(frame(spark, ("a", 1, 1, 1)))
    assert df.inputFiles()[0].startswith(f"file://{base}")


def test_read_source(spark, tmp_path):
    df = frame(spark, ("a", 1, 1, 1))
    df.write.parquet(f"{tmp_path}/icims/room")
    assert short(read_source(spark, "icims_raw", "room", root=str(tmp_path))) == [("a", 1)]
    elsewhere = {"person": f"{tmp_path}/icims/room"}
    assert short(read_source(spark, "icims_raw", "person", tables=elsewhere)) == [("a", 1)]
    df.createOrReplaceTempView("rooms_for_test")
    assert short(read_source(spark, "icims_raw", "company", tables={"company": "rooms_for_test"})) == [("a", 1)]
    with pytest.raises(KeyError):
        read_source(spark, "icims_raw", "nothing")


def test_attribute_tables_append_and_refresh(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path), time="lastUpdated")
    spec: AttributeSpec = ATTRIBUTES
    first = landed(spark, [doc(1, ("name", "x"))])
    load(spec, first, table, run_ts="2024-01-01 00:00:00")
    both = first.unionByName(landed(spark, [doc(2, ("name", "y"))], day=3))
    load(spec, both, table, run_ts="2024-01-04 00:00:00")
    load(spec, both, table, run_ts="2024-01-05 00:00:00")
    assert sorted((r["id"], str(r["etl_updated_timestamp"])[:10]) for r in table.rows().collect()) == [
        (1, "2024-01-01"),
        (2, "2024-01-04"),
    ]
    load(spec, both.where("raw_data LIKE '%\"y\"%'"), table, run_ts="2024-01-06", full_refresh=True)
    assert [r["id"] for r in table.rows().collect()] == [2]
