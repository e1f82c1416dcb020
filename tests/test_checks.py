import datetime as dt

from histkit.operators import check_distinct_count_equal, check_not_null, check_recency, column_profile


def test_not_null(spark):
    df = spark.createDataFrame([(1, None), (2, "x"), (None, None)], "a int, `b c` string")
    assert sorted(map(tuple, check_not_null(df).collect())) == [("a", 1, "warn"), ("b c", 2, "warn")]
    assert check_not_null(df.where("a = 2"), ["a"]).first()["status"] == "pass"


def test_recency(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5),), (None,)], "t timestamp_ntz")
    assert check_recency(df, "t", "day", 2, "2024-01-07").first()["status"] == "pass"
    assert check_recency(df, "t", "day", 1, "2024-01-07").first()["status"] == "warn"
    assert check_recency(df.where("t IS NULL"), "t", "day", 1, "2024-01-07").first()["status"] == "warn"


def test_distinct_counts(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(7,), (8,), (9,)], "y int")
    assert tuple(check_distinct_count_equal(a, "x", b, "y").first()) == (2, 3, "warn")
    assert tuple(check_distinct_count_equal(a, "x", b, "y", where_b="y < 9").first()) == (2, 2, "pass")
    assert tuple(check_distinct_count_equal(a, "x", b, "y", "x > 5", "y > 50").first()) == (0, 0, "pass")


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "a int, b string").withMetadata("a", {"comment": "key"})
    rows = sorted(map(tuple, column_profile(df, "t", exact=True).collect()))
    assert rows == [("t", "a", 1, "int", "key", 0, 1), ("t", "b", 2, "string", None, 1, 1)]
    assert [r["n_null"] for r in column_profile(df.limit(0), "t").collect()] == [0, 0]


def test_profile_by_sketch(spark):
    df = spark.range(1000).selectExpr("id", "id % 10 AS d", "nullif(id % 2, 0) AS n")
    rows = {r["column_name"]: (r["n_null"], r["n_distinct"]) for r in column_profile(df, "t").collect()}
    assert rows["d"] == (0, 10) and rows["n"] == (500, 1) and abs(rows["id"][1] - 1000) < 100
