"""Keys, hashes, parts and marks of a ``timestamp`` do not depend on the session's zone."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from histkit.functions import row_hash, surrogate_key
from histkit.operators import current_watermark, watermark_filter, watermark_subquery
from histkit.plans import load
from histkit.sources import HistoryTable
from workloads.common import LOG_SPEC

# 2024-11-03: clocks in New York show 01:30 at 05:30 and again at 06:30 UTC
FIRST, SECOND = 1730611800, 1730615400
SPEC = LOG_SPEC.with_(time_type="timestamp")


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kolkata"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def times(spark):
    return spark.createDataFrame([(1, FIRST), (1, SECOND)], "id bigint, s bigint").select(
        "id", F.timestamp_seconds("s").alias("t")
    )


def test_keys_and_hashes(spark, zone):
    df = times(spark)
    got = df.select(surrogate_key(df, "id", "t").alias("k"), row_hash(df).alias("h")).collect()
    as_utc = spark.sql("SELECT * FROM VALUES ('2024-11-03 05:30:00'), ('2024-11-03 06:30:00') AS v(t)")
    want = as_utc.select(F.md5(F.concat(F.lit("1-"), "t")), F.md5(F.concat(F.lit("1:119:"), "t"))).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_marks(spark, zone):
    df = times(spark)
    assert current_watermark(df, "t", None) == "2024-11-03 06:30:00"
    assert current_watermark(df, "t") == "2024-11-03"
    assert watermark_filter(df, "t", current_watermark(df, "t", None)).count() == 1
    assert watermark_filter(df, "t", "2024-11-03").count() == 2
    assert watermark_filter(df, "t", "2024-11-04").count() == 0
    assert watermark_subquery(df, "t", df, "t", None).count() == 1
    assert watermark_subquery(df, "t", df, "t").count() == 2


def raw(spark, *rows):
    """Change-log rows of (status, effective second, load day)."""
    return spark.createDataFrame(
        [(1, s, 1.0, t * 1000, False, dt.datetime(2024, 11, d)) for s, t, d in rows],
        "id bigint, status string, amount double, _h2_binlog_ts_ms bigint, _h2_is_deleted boolean, "
        "_h2_sf_inserted timestamp_ntz",
    ).withColumn("_h2_sf_inserted", F.expr("to_timestamp(_h2_sf_inserted || 'Z')"))


def test_both_versions_of_the_repeated_hour_are_stored(spark, zone, tmp_path):
    table = HistoryTable(spark, str(tmp_path), grain="day")
    load(SPEC, raw(spark, ("a", FIRST, 4)), table)
    load(SPEC, raw(spark, ("a", FIRST, 4), ("b", SECOND, 5)), table)
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    load(SPEC, raw(spark, ("a", FIRST, 4), ("b", SECOND, 5)), table)  # again, in another zone
    rows = table.rows().select("event_key", "status", F.unix_seconds("timestamp_effective").alias("s")).collect()
    assert sorted((r["status"], r["s"]) for r in rows) == [("a", FIRST), ("b", SECOND)]
    assert len({r["event_key"] for r in rows}) == 2
    assert {n for n in os.listdir(tmp_path) if "=" in n} == {"history_period=2024-11-03"}
