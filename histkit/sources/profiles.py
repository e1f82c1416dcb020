"""Column profiles kept by period.

For each period and column of a stored table: rows, NULLs and a theta sketch of the
values. Sketches of periods are united, so a table's profile comes from them alone,
and two of them can be subtracted. Only periods with files that are newer than their
profile are read. Sketches are exact up to 4,096 values; beyond that estimates are
within 5 % with a probability of 99.8 % (three deviations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.casts import zone_free
from .tables import PERIOD, HistoryTable

LOG_ENTRIES = 12
#: Counts that differ by this share or less may be equal.
WITHIN = 0.05
PROFILE = "column_name string, position int, data_type string, n_rows bigint, n_null bigint, sketch binary, read_at timestamp"


def _folder(table: HistoryTable) -> str:
    # Spark's readers pass over folders with this sign
    return f"{table.path}/_profile"


def _stored(table: HistoryTable) -> DataFrame | None:
    spark, folder = table.spark, _folder(table)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(f"{PROFILE}, {PERIOD} string").parquet(folder)


def _as_value(field: T.StructField):
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.VariantType, T.StructType, T.ArrayType, T.MapType)):
        return F.to_json(col)
    return zone_free(col, field.dataType).cast("string")


def profile_periods(table: HistoryTable) -> DataFrame:
    """The profile of each period and column, brought up to date."""
    rows = table.all_rows()
    newest = rows.groupBy(PERIOD).agg(F.max("_metadata.file_modification_time").alias("newest"))
    known = _stored(table)
    if known is None:
        due = newest.withColumn("read_at", F.lit(None).cast("timestamp"))
    else:
        at = known.groupBy(F.col(PERIOD).alias("_period")).agg(F.min("read_at").alias("read_at"))
        due = newest.join(at, F.col(PERIOD).eqNullSafe(F.col("_period")), "left").drop("_period")
    # as many as the table has periods
    periods = due.where(F.col("read_at").isNull() | (F.col("newest") > F.col("read_at"))).select(PERIOD).collect()
    wanted = [r[0] for r in periods]
    if wanted:
        within = F.col(PERIOD).isin([p for p in wanted if p is not None])
        within = within | F.col(PERIOD).isNull() if None in wanted else within
        _profiled(rows.where(within)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            PERIOD
        ).parquet(_folder(table))
    if _stored(table) is None:
        return table.spark.createDataFrame([], f"{PROFILE}, {PERIOD} string")
    here = newest.select(F.col(PERIOD).alias("_period"))
    # a full refresh may have ended periods
    return _stored(table).join(F.broadcast(here), F.col(PERIOD).eqNullSafe(F.col("_period")), "left_semi")


def _profiled(rows: DataFrame) -> DataFrame:
    fields = [f for f in rows.schema.fields if f.name != PERIOD]
    of_column = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(i + 1).alias("position"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(f"`{f.name}`").isNull()).alias("n_null"),
            F.theta_sketch_agg(_as_value(f), LOG_ENTRIES).alias("sketch"),
            F.max("_metadata.file_modification_time").alias("read_at"),
        )
        for i, f in enumerate(fields)
    ]
    return rows.groupBy(PERIOD).agg(F.array(*of_column).alias("c")).select(PERIOD, F.inline("c"))


def stored_profile(table: HistoryTable, name: str) -> DataFrame:
    """``column_profile`` of a stored table from the profiles of its periods."""
    united = profile_periods(table).groupBy("column_name", "position", "data_type").agg(
        F.sum("n_null").alias("n_null"), F.theta_union_agg("sketch", LOG_ENTRIES).alias("sketch")
    )
    return united.select(
        F.lit(name).alias("table_name"),
        "column_name",
        "position",
        "data_type",
        "n_null",
        F.theta_sketch_estimate("sketch").alias("n_distinct"),
    )


def compare_columns(a: HistoryTable, column_a: str, b: HistoryTable, column_b: str, within: float = WITHIN) -> DataFrame:
    """Do two columns hold equally many values, and how many has only one of them? From the profiles (D3).

    One row: (distinct_a, distinct_b, only_a, only_b, status); counts that differ by no more than
    the share ``within`` pass.
    """

    def side(table: HistoryTable, column: str, name: str) -> DataFrame:
        return profile_periods(table).where(F.col("column_name") == column).select(F.lit(name).alias("side"), "sketch")

    def whole(name: str):
        return F.theta_union_agg(F.when(F.col("side") == name, F.col("sketch")), LOG_ENTRIES).alias(name)

    both = side(a, column_a, "a").unionByName(side(b, column_b, "b")).agg(whole("a"), whole("b"))
    counts = both.select(
        F.theta_sketch_estimate("a").alias("distinct_a"),
        F.theta_sketch_estimate("b").alias("distinct_b"),
        F.theta_sketch_estimate(F.theta_difference("a", "b")).alias("only_a"),
        F.theta_sketch_estimate(F.theta_difference("b", "a")).alias("only_b"),
    )
    gap = F.abs(F.col("distinct_a") - F.col("distinct_b"))
    near = gap <= within * F.greatest("distinct_a", "distinct_b")
    return counts.withColumn("status", F.when(near, F.lit("pass")).otherwise(F.lit("warn")))
