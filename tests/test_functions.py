import datetime as dt
import hashlib
import re
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.functions import (
    cast_to,
    date_as_timestamp,
    effective_time,
    field_value,
    json_get,
    member_path,
    read_members,
    row_hash,
    surrogate_key,
    type_name,
)


def hashes(spark, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(row_hash(df)).collect()]


def test_row_hash_sees_a_null_that_moves(spark):
    a, b = hashes(spark, [(1, None, 2), (1, 2, None)], "a int, b int, c int")
    assert a != b


def test_row_hash_sees_moved_separators(spark):
    assert len(set(hashes(spark, [("a:", "b"), ("a", ":b"), ("-", "b"), (None, "b"), ("", "b")], "x string, y string"))) == 5


def test_row_hash_of_a_wide_row_is_code_that_the_jvm_compiles(spark, tmp_path):
    """HotSpot leaves methods of more than 8000 bytes to its interpreter."""
    path = str(tmp_path / "wide")
    spark.range(2).select(*[F.concat(F.col("id"), F.lit(i)).alias(f"c{i}") for i in range(56)]).write.parquet(path)
    df = spark.read.parquet(path)
    plan = spark._jvm.PythonSQLUtils.explainString(df.select(row_hash(df))._jdf.queryExecution(), "codegen")
    assert all(int(size) <= 8000 for size in re.findall(r"maxMethodCodeSize:(\d+)", plan))
    text = ["".join(f"{len(v)}:{v}" for v in (f"{i}{c}" for c in range(56))) for i in (0, 1)]
    assert {r[0] for r in df.select(row_hash(df)).collect()} == {hashlib.md5(t.encode()).hexdigest() for t in text}


def test_row_hash_does_not_depend_on_integer_width_or_zero_sign(spark):
    assert hashes(spark, [(7,)], "a int") == hashes(spark, [(7,)], "a bigint")
    assert len(set(hashes(spark, [(0.0,), (-0.0,)], "a double"))) == 1
    assert len(set(hashes(spark, [(0.00001,), (0.00002,)], "a double"))) == 2


def test_row_hash_of_nested_and_variant_values(spark):
    df = spark.sql("""SELECT parse_json('{"b":1,"a":2}') v UNION ALL SELECT parse_json('{"a":2,"b":1}')""")
    assert len({r[0] for r in df.select(row_hash(df)).collect()}) == 1


def test_surrogate_key_treats_null_as_empty(spark):
    df = spark.createDataFrame([(None, "x"), ("", "x"), ("1", None)], "a string, b string")
    keys = [r[0] for r in df.select(surrogate_key(df, "a", "b")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert keys[2] == spark.sql("SELECT md5('1-')").first()[0]


def test_integer_casts_round(spark):
    row = spark.sql("SELECT 1.5D d, CAST(2.5 AS DECIMAL(9,2)) m, '7' s").select(
        cast_to(F.col("d"), "bigint", T.DoubleType()),
        cast_to(F.col("m"), "bigint", T.DecimalType(9, 2)),
        cast_to(F.col("s"), "bigint", T.StringType()),
    )
    assert tuple(row.first()) == (2, 3, 7)


def test_bad_casts_raise_or_give_null(spark):
    df = spark.createDataFrame([("x",)], "s string")
    with pytest.raises(PySparkException):
        df.select(cast_to(F.col("s"), "bigint")).collect()
    assert df.select(cast_to(F.col("s"), "bigint", on_error="null")).first()[0] is None


def test_effective_time_reads_milliseconds_or_casts(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 678000)
    row = spark.sql("SELECT 1704164645678L ms, '2024-01-02 03:04:05.678' t").select(
        effective_time(F.col("ms"), T.LongType(), "timestamp_ntz"),
        effective_time(F.col("t"), T.StringType(), "timestamp_ntz"),
    )
    assert tuple(row.first()) == (when, when)


def test_date_as_timestamp_drops_the_time_of_day(spark):
    row = spark.sql("SELECT '2024-01-02 03:04:05' t").select(date_as_timestamp(F.col("t"), "timestamp_ntz")).first()
    assert row[0] == dt.datetime(2024, 1, 2)


def test_type_name(spark):
    assert spark.sql("SELECT 1L x").select(type_name(F.col("x"))).first()[0] == "bigint"


DOC = '{"s":"x","n":1.5,"o":{"b":1,"a":null},"g":[{"f":"p"},{"f":"q"}],"e":[],"z":null,"d":"2024-01-02 10:00:00"}'


@pytest.mark.parametrize(
    "path, kind, expected",
    [
        ("$.s", "string", "x"),
        ("$.n", "bigint", 2),
        ("$.n", "decimal(38,0)", Decimal(2)),
        ("$.o", "json", '{"a":null,"b":1}'),
        ("$.o", "string", '{"a":null,"b":1}'),
        ("$.g[0].f", "string", "p"),
        ("$.e[0].f", "string", None),
        ("$.missing", "string", None),
        ("$.missing.deeper", "bigint", None),
        ("$.z", "string", None),
        ("$.z", "json", "null"),
        ("$.missing", "json", None),
        ("$.d", "date", dt.date(2024, 1, 2)),
        ("$.d", "date_timestamp", dt.datetime(2024, 1, 2)),
    ],
)
def test_json_get(spark, path, kind, expected):
    df = spark.createDataFrame([(DOC,)], "raw string")
    whole = df.select(json_get(F.parse_json("raw"), path, kind, "timestamp_ntz")).first()[0]
    name, rest = member_path(path)
    member = df.select(read_members(F.col("raw"), T.StringType(), {name: "variant"}).alias("m"))
    assert whole == expected
    assert member.select(json_get(F.col("m")[name], rest, kind, "timestamp_ntz")).first()[0] == expected


def test_members_of_a_variant_column(spark):
    df = spark.createDataFrame([(DOC,)], "raw string").select(F.parse_json("raw").alias("raw"))
    m = df.select(read_members(F.col("raw"), T.VariantType(), {"s": "string", "q": "string"}).alias("m"))
    assert tuple(m.first()["m"]) == ("x", None)


def test_documents_that_do_not_parse(spark):
    df = spark.createDataFrame([("{oops",)], "raw string")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        df.select(read_members(F.col("raw"), T.StringType(), {"s": "variant"})).collect()
    soft = df.select(read_members(F.col("raw"), T.StringType(), {"s": "string"}, "null").alias("m"))
    assert soft.select("m.s").first()[0] is None


def test_field_kinds(spark):
    raw = """{"str":"5","label":{"id":1,"defaultAttributes":{"Label":"L"}},"id":{"id":9},"num":2.5,
              "ts":"2024-01-02T03:04:05","var":{"b":1,"a":2},"none":null}"""
    df = spark.createDataFrame([(raw,)], "raw string").select(F.parse_json("raw").alias("v"))
    kinds = ["str", "label", "id", "num", "ts", "var"]
    row = df.select(*[field_value(F.col("v"), k, f"$['{k}']") for k in kinds]).first()
    assert tuple(row) == ("5", "L", 9, Decimal(3), dt.datetime(2024, 1, 2, 3, 4, 5), '{"a":2,"b":1}')
    assert df.select(field_value(F.col("v"), "var", "$['none']")).first()[0] is None


def test_twelve_hour_times(spark):
    df = spark.sql("""SELECT parse_json('"2024-01-02 03:04 PM"') v, parse_json('"soon"') w""")
    ok = df.select(field_value(F.col("v"), "ts", timestamp_format="yyyy-MM-dd hh:mm a")).first()[0]
    assert ok == dt.datetime(2024, 1, 2, 15, 4)
    bad = df.select(field_value(F.col("w"), "ts", timestamp_format="yyyy-MM-dd hh:mm a", on_error="null"))
    assert bad.first()[0] is None
