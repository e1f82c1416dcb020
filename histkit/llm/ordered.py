"""Each row's next row in a total order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histkit.llm.common import ceil_div
from histkit.sources.tables import stage

#: Rows of a range, as far as ``MAX_RANGES`` allows. Cut points reach the driver, so their number has a bound.
ROWS_PER_RANGE = 1_000
MAX_RANGES = 100_000


def _range_of(key: Column, cuts: list[int]) -> Column:
    """How many cut points lie below ``key``; -1 for NULL. Looks at two short lists, not at all cut points."""
    step = max(1, int(len(cuts) ** 0.5))
    every = F.lit(cuts[step - 1 :: step] or [2**63 - 1]).cast("array<bigint>")
    coarse = F.size(F.filter(every, lambda c: c < key)) * step
    rest = F.slice(F.lit(cuts).cast("array<bigint>"), coarse + 1, F.lit(step))
    return F.when(key.isNull(), -1).otherwise(coarse + F.size(F.filter(rest, lambda c: c < key)))


def _ranges_of_nulls(df: DataFrame, key: str, tie: str) -> DataFrame:
    """The rows with a NULL key in ranges -1, -2, ... of rising ``tie``, copies dealt over several, as a table."""
    lone = df.where(F.col(key).isNull()).withColumn("_salt", F.xxhash64(F.monotonically_increasing_id()))
    ranged = lone.repartitionByRange(tie, "_salt").withColumn("_range", -1 - F.spark_partition_id())
    return stage(ranged.drop("_salt"))


def with_next(
    df: DataFrame,
    key: str,
    tie: str,
    columns: list[str],
    rows_per_range: int = ROWS_PER_RANGE,
    derive: dict[str, Column] | None = None,
) -> DataFrame:
    """Add ``next_<c>`` for each of ``columns``: the value in the next row by falling ``key``.

    ``derive`` adds columns made from others of the row; costly ones belong
    there, so that they are made once per row.

    Ties go by rising ``tie``, NULL keys come last, and after the last row comes
    the first. ``key`` must be a bigint that few rows share; any number may have none.

    Keys are cut into ranges at quantiles that are keys themselves, so the top
    row of each range is known by its key. A copy of it is put at the end of the
    range above, and a window over one range then finds every next row. Rows with a
    NULL key are cut into ranges by ``tie``, as Spark does it.
    """
    spark = df.sparkSession
    rows, top, nulls = df.agg(F.count(F.lit(1)), F.max(key), F.count_if(F.col(key).isNull())).first()
    cuts = []
    if top is not None:
        n = min(MAX_RANGES, max(1, ceil_div(rows, rows_per_range)))
        marks = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)] or [0.5], max(10_000, 10 * n))).first()[0]
        cuts = sorted({*marks, top})
    heads = [(cut, i + 1) for i, cut in enumerate(cuts[:-1])]
    rows_of = df.withColumn("_range", _range_of(F.col(key), cuts or [0]))

    def first_rows(some: DataFrame) -> DataFrame:
        return some.groupBy("_range").agg(F.min_by(F.struct(*df.columns), F.col(tie)).alias("_row"))

    def copies(first: DataFrame) -> DataFrame:
        return first.select("_row.*", "_range", F.lit(True).alias("_copy"))

    last = 0
    if nulls:
        lone = _ranges_of_nulls(df, key, tie)
        rows_of = rows_of.where(F.col(key).isNotNull()).unionByName(lone)
        # a row for each range; the first of the NULLs follows the smallest key, or the last of the NULLs
        before = F.lag("_range").over(Window.orderBy(F.desc("_range")))
        last = lone.agg(F.min("_range")).first()[0]
        ends = copies(first_rows(lone).withColumn("_range", F.coalesce(before, F.lit(0 if cuts else last))))
    if cuts:
        heads.append((top, last))
    marked = spark.createDataFrame(heads, "_head bigint, _range int")
    tops = copies(first_rows(df.join(F.broadcast(marked), F.col(key) == F.col("_head")).drop("_head")))
    ends = tops.unionByName(ends) if nulls else tops
    within = Window.partitionBy("_range").orderBy("_copy", F.col(key).desc_nulls_last(), tie)
    rows_of, ends = rows_of.withColumn("_copy", F.lit(False)).withColumns(derive or {}), ends.withColumns(derive or {})
    found = rows_of.unionByName(ends).select("*", *[F.lead(c).over(within).alias(f"next_{c}") for c in columns])
    return found.where(~F.col("_copy")).drop("_range", "_copy")
