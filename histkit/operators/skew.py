"""Hot keys: cut the versions of keys that outgrow a task into stretches of time.

A history is ordered per key, so a plain window puts all versions of a key in one
task. That is right for most keys and fails for one that holds a third of all rows.

All versions in (key, time) order are cut into ranges of about as many rows as a
task may hold. The cuts are versions of the data, taken at even steps from a sample of
keys and times that Spark has partitioned by range. A key without a cut stays whole. Of a key with cuts each range is a *stretch*, and as a cut is a version
itself, a copy of that version goes along into the next stretch, where it stands
before all others: a window over one stretch finds every predecessor.

No rows are counted by key, and what is known of the cuts is a table like others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import stage

#: What one task may hold of a key, as rows and as bytes of the row's type.
TASK_ROWS = 2_000_000
TASK_BYTES = 512 << 20
#: Rows of a range that the sample has, about.
SAMPLED = 2_000
#: Rows of a frame that may be broadcast, and cuts of a frame; beyond them ranges get longer.
SMALL_ROWS = MOST_CUTS = 200_000

STRETCH, BORDER = "_stretch", "_border"


@dataclass(frozen=True)
class Cuts:
    """Cuts by key, in two levels, so that a row meets two short lists: tables of ``rows`` rows at most.

    A key's cuts, in order, are dealt into chunks: ``heads`` has (_cut_key, _heads, _chunk_size),
    the first cuts of its chunks, and ``chunks`` has (_cut_key, _chunk, _cuts).
    """

    heads: DataFrame
    chunks: DataFrame
    rows: int


def task_limit(df: DataFrame) -> int:
    """Rows of ``df`` that a task may hold of one key; a wide row counts for more."""
    return max(1, min(TASK_ROWS, TASK_BYTES // max(1, df._jdf.schema().defaultSize())))


def sampled(df: DataFrame, limit: int) -> DataFrame:
    """A share of the rows, so that a range of ``limit`` rows has about ``SAMPLED`` of them."""
    return df if limit <= SAMPLED else df.sample(SAMPLED / limit, seed=7)


def time_cuts(sample: DataFrame, key: str, ts: str, limit: int) -> Cuts | None:
    """Cuts for ranges of about ``limit`` rows, from a sample as ``sampled`` takes it; None for one range."""
    rows = stage(sample.select(F.col(key).alias("_cut_key"), F.col(ts).alias("_cut")))
    step = min(limit, SAMPLED)
    n = rows.count()
    if n <= step:
        return None
    step = max(step, -(-n // MOST_CUTS))
    # within ranges of Spark's own making every so manieth version is a cut; NULL times follow all cuts
    ranged = rows.repartitionByRange("_cut_key", F.col("_cut").asc_nulls_last()).withColumn("_range", F.spark_partition_id())
    in_order = Window.partitionBy("_range").orderBy("_cut_key", F.col("_cut").asc_nulls_last())
    ends = ranged.withColumn("_n", F.row_number().over(in_order)).where((F.col("_n") % step == 0) & F.col("_cut").isNotNull())
    cuts = ends.groupBy("_cut_key").agg(F.sort_array(F.collect_set("_cut")).alias("_cuts"))
    size = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    sized = cuts.withColumn("_chunk_size", size).withColumn("_starts", F.expr("sequence(1, size(_cuts), _chunk_size)"))
    dealt = F.transform("_starts", lambda i: F.slice("_cuts", i, F.col("_chunk_size")))
    table = stage(sized.select("_cut_key", "_chunk_size", dealt.alias("_chunks")))
    heads = table.select("_cut_key", "_chunk_size", F.transform("_chunks", lambda c: F.get(c, 0)).alias("_heads"))
    chunks = table.select("_cut_key", F.posexplode("_chunks").alias("_chunk", "_cuts"))
    return Cuts(heads, chunks, n // step)


def _below(cuts: Column, value: Column) -> Column:
    """How many of the sorted ``cuts``, fewer than 1024, lie below ``value``; NULL cuts are none."""

    def jump(at: Column, step: Column) -> Column:
        return at + F.when(F.get(cuts, at + step - 1) < value, step).otherwise(0)

    return F.when(cuts.isNotNull(), F.aggregate(F.lit([1 << i for i in reversed(range(10))]), F.lit(0), jump))


def stretches(df: DataFrame, key: str, ts: str, cuts: Cuts) -> DataFrame:
    """``df`` with the number of each row's stretch, which rises with time within a key.

    A version at a cut is there twice: the second time, marked as border, in the next stretch.
    """
    time, own = F.col(ts), [F.col(f"`{c}`") for c in df.columns]
    heads = df.join(if_small(cuts.heads, cuts.rows), F.col(key).eqNullSafe(F.col("_cut_key")), "left")
    # rows of a key without cuts have no chunk, and those without a time lie behind the last
    place = F.when(time.isNull(), F.size("_heads")).otherwise(_below(F.col("_heads"), time))
    placed = heads.select(*own, "_chunk_size", F.get("_heads", place).alias("_next"), F.greatest(place - 1, F.lit(0)).alias("_at"))
    chunks = cuts.chunks.select(F.col("_cut_key").alias("_key"), F.col("_chunk").alias("_at_chunk"), "_cuts")
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_at") == F.col("_at_chunk"))
    met = placed.join(if_small(chunks, cuts.rows), same, "left")
    inside = F.when(time.isNull(), F.size("_cuts")).otherwise(_below(F.col("_cuts"), time))
    numbered = met.select(*own, "_next", "_cuts", inside.alias("_inside"), (F.col("_at") * F.col("_chunk_size") + inside).alias(STRETCH))
    at_cut = (F.get("_cuts", F.col("_inside")) == time) | (F.col("_next") == time)
    twice = F.when(F.coalesce(at_cut, F.lit(False)), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    both = numbered.select(*own, F.coalesce(STRETCH, F.lit(0)).alias(STRETCH), F.explode(twice).alias(BORDER))
    return both.withColumn(STRETCH, F.col(STRETCH) + F.col(BORDER).cast("int"))


def if_small(df: DataFrame, rows: int, limit: int = SMALL_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if its counted size allows it."""
    return F.broadcast(df) if rows <= limit else df
