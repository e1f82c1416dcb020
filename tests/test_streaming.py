import random

from histkit.plans import cdc_history, read_history
from histkit.sources import HistoryTable
from histkit.streaming import load_available
from tests.test_histories import SCHEMA, SPEC, raw, short

ROWS = [(1, 10, "A", "", 0), (1, 20, "B", "", 0), (2, 10, "A", "", 1), (1, 30, "B", "", 1), (1, 40, "A", "", 2)]


def test_files_as_they_land_equal_a_full_rebuild(spark, tmp_path):
    landing, table = f"{tmp_path}/landing", HistoryTable(spark, f"{tmp_path}/table")
    for day in range(3):
        raw(spark, [r for r in ROWS if r[4] == day]).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        load_available(SPEC, stream, table, f"{tmp_path}/checkpoint").awaitTermination()
    assert short(read_history(table)) == short(cdc_history(SPEC, raw(spark, ROWS)))


def test_late_copies_that_differ_and_late_versions(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([1, 2, None]), rng.choice([None, *range(12)]), rng.choice("AB"), "", n // 15) for n in range(45)]
    landing, table = f"{tmp_path}/landing", HistoryTable(spark, f"{tmp_path}/table", grain="day")
    for day in range(3):
        raw(spark, [(r if r[4] == day else None) for r in rows]).write.mode("append").parquet(landing)
        stream = spark.readStream.schema(SCHEMA).parquet(landing)
        load_available(SPEC, stream, table, f"{tmp_path}/checkpoint").awaitTermination()
    assert short(read_history(table)) == short(cdc_history(SPEC, raw(spark, rows)))
