import datetime as dt
import json

from pyspark.sql import functions as F

from histkit.operators import Checks, check_table, infer_fields
from histkit.plans import json_history, load, read_history
from histkit.sources import HistoryTable, compare_columns, profile_periods, scan_attributes, scan_files, stage, stored_profile
from tests.test_documents import SNAP, doc, landed
from tests.test_histories import SPEC, days, raw, scrambled
from tests.test_tables import frame


def numbers(spark, low, high, month=1):
    rows = spark.range(low, high).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    at = F.lit(dt.datetime(2024, month, 5)).cast("timestamp_ntz")
    return rows.withColumns({"timestamp_effective": at, "etl_updated_timestamp": at})


def estimates(table):
    return {r["column_name"]: (r["n_null"], r["n_distinct"]) for r in stored_profile(table, "t").collect()}


def test_estimates_stay_within_their_bound(spark, tmp_path):
    """Many values, most of them in several periods."""
    table = HistoryTable(spark, str(tmp_path))
    table.replace(numbers(spark, 0, 30_000).unionByName(numbers(spark, 10_000, 50_000, 2)).unionByName(numbers(spark, 0, 50_000, 3)))
    found = estimates(table)
    assert abs(found["k"][1] - 50_000) <= 0.05 * 50_000
    assert found["v"] == (0, 1) and found["timestamp_effective"] == (0, 3)


def test_only_changed_periods_are_read(spark, tmp_path, monkeypatch):
    from histkit.sources import profiles

    read, profiled = [], profiles._profiled
    monkeypatch.setattr(profiles, "_profiled", lambda rows: read.append(sorted(r[0] or "" for r in rows.select("history_period").distinct().collect())) or profiled(rows))
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark, ("a", 1, 1, 1), ("b", None, 2, 1), ("c", 1, None, 1)))
    assert estimates(table)["v"] == (1, 1) and estimates(table)["k"] == (0, 3)
    table.upsert(stage(frame(spark, ("b", 2, 2, 3), ("d", 2, 3, 3))), "k")
    assert estimates(table)["v"] == (0, 2) and estimates(table)["k"] == (0, 4)
    table.append(frame(spark, ("e", 7, None, 3)))
    assert estimates(table)["v"] == (0, 3)
    assert read == [["", "2024-01", "2024-02"], ["2024-02", "2024-03"], [""]]
    # a period that a full refresh ended is forgotten
    table.replace(frame(spark, ("z", 5, 4, 4)))
    assert estimates(table)["v"] == (0, 1)
    assert {r[0] for r in profile_periods(table).select("history_period").distinct().collect()} == {"2024-04"}


def test_an_empty_table_has_an_empty_profile(spark, tmp_path):
    table = HistoryTable(spark, str(tmp_path))
    table.replace(frame(spark))
    assert stored_profile(table, "t").collect() == []


def test_columns_of_two_tables(spark, tmp_path):
    a, b = HistoryTable(spark, f"{tmp_path}/a"), HistoryTable(spark, f"{tmp_path}/b")
    a.replace(numbers(spark, 0, 1000))
    b.replace(numbers(spark, 100, 1000).unionByName(numbers(spark, 1000, 1050, 2)))
    assert tuple(compare_columns(a, "k", b, "k").first()) == (1000, 950, 100, 50, "pass")
    assert compare_columns(a, "k", b, "k", within=0.01).first()["status"] == "warn"
    large = HistoryTable(spark, f"{tmp_path}/large")
    large.replace(numbers(spark, 0, 40_000))
    row = compare_columns(large, "k", a, "k").first()
    assert abs(row["only_a"] - 39_000) < 0.05 * 40_000 and row["only_b"] <= 50 and row["status"] == "warn"


def checks_of(rows, checks):
    return check_table(rows, checks.recency, checks.as_of, checks.distinct, checks.columns)


def bag(df):
    return sorted(map(tuple, df.collect()))


def test_checks_as_rows_are_written(spark, tmp_path):
    """First loads and refreshes check the table, later ones what they write; the same rows as check_table."""
    rows = scrambled(4)
    others = spark.createDataFrame([(1,), (2,), (9,)], "x int")
    for mode in ("reference", "consistent"):
        table = HistoryTable(spark, f"{tmp_path}/{mode}")
        checks = Checks(("timestamp_effective", "day", 1), "2024-01-02", ("id", others, "x"))
        first = load(SPEC, raw(spark, days(rows, 0, 1)), table, mode=mode, checks=checks)
        assert bag(first) == bag(checks_of(table.rows(), checks)) and first.count() == len(table.rows().columns) + 2
        before = {r["item_key"]: r for r in table.rows().collect()}
        later = load(SPEC, raw(spark, rows), table, mode=mode, checks=Checks(columns=["id", "timestamp_effective", "a"]))
        written = [r for r in table.rows().collect() if before.get(r["item_key"]) != r]
        nulls = sum(r["id"] is None for r in written)
        failures = {r["column"]: r["failures"] for r in later.collect()}
        # rows read again are written again in reference mode
        assert failures["id"] == nulls if mode == "consistent" else failures["id"] >= nulls
    assert load(SPEC, raw(spark, rows), table, mode="consistent") is None


def test_checks_read_the_rows_once(spark, tmp_path):
    """Nothing but the write reads the source."""
    table = HistoryTable(spark, str(tmp_path / "t"))
    raw(spark, scrambled(1)).write.parquet(str(tmp_path / "raw"))
    source = spark.read.parquet(str(tmp_path / "raw"))
    told = load(SPEC, source, table, checks=Checks(("timestamp_effective", "day", 1), "2024-01-02"))
    # the check rows come from values that were counted, not from files
    assert told.inputFiles() == [] and bag(told) == bag(checks_of(read_history(table), Checks(("timestamp_effective", "day", 1), "2024-01-02")))


def test_files_where_they_land(spark, tmp_path):
    docs = [{"Id": "a", "Day": "2024-01-01", "Name": "x"}, {"Id": "a", "Day": "2024-01-02", "Name": "y"}, {"Id": "b", "Day": "2024-01-01"}]
    (tmp_path / "one.json").write_text("\n".join(map(json.dumps, docs)))
    raw_files = scan_files(spark, str(tmp_path))
    assert raw_files.dtypes[0] == ("raw_data", "variant") and {r[0] for r in raw_files.select("raw_filename").collect()} == {"one.json"}
    text = landed(spark, docs)
    own = lambda df: sorted(json_history(SNAP, df, run_ts="2024-02-01").collect(), key=repr)
    assert own(raw_files.drop("raw_filename")) == own(text)


def test_shapes_of_members(spark):
    docs = [doc(1, ("blob", {"a": 1, "b": [{"c": "x"}]}), ("n", 1)), doc(2, ("blob", {"a": 2.5, "d": None})), doc(3, ("blob", [1]))]
    found = {r["name"]: (r["kind"], r["shape"]) for r in infer_fields(scan_attributes(landed(spark, docs)), nested=True).collect()}
    assert found["n"] == ("num", None) and found["blob"][0] == "var"
    members = infer_fields(scan_attributes(landed(spark, docs[:2])), nested=True).where("name = 'blob'").first()["shape"]
    assert "a: DECIMAL(11,1)" in members or "a: DECIMAL" in members
    assert "b: ARRAY<OBJECT<c: STRING>>" in members


