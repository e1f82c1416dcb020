"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal text form a group that must not be divided. A *partial
partition* is a vector of shard sums. Differencing repeatedly takes the two
partial partitions with the largest spread (largest less smallest sum) and adds
them oppositely ordered, the largest sum of one to the smallest of the other,
so that their spreads cancel. What is left at the end is one partition.

Differencing is a tree of such additions, so it runs as one: groups are dealt
to buckets of bounded size, each bucket is differenced in its own task, and the
buckets' partial partitions are differenced again, up to ``FAN_IN`` at a time,
until one is left. No task and no driver sees more than that. A group is
aggregated to one row before it moves, so a text that a third of all rows share
is one item.

Odd rows: a NULL text has no bytes and belongs to the group of empty texts;
repeated rows count as often as they occur; NULL ids are numbered like others;
an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from histkit.llm.common import ceil_div, whole_texts
from histkit.sources.tables import stage

#: Groups that one task differences.
GROUPS_PER_TASK = 20_000
#: Partial partitions that one task differences.
FAN_IN = 4_096
#: Rows of a shard that are numbered together.
ROWS_PER_SLICE = 4_096


def difference(vectors: Sequence[Sequence[int]]) -> tuple[list[int], list[list[int]]]:
    """Karmarkar-Karp over partial partitions of equal length.

    Returns the final sums, rising, and for each vector the final place of each
    of its parts. Ties go to the vector that comes first.
    """
    if not vectors:
        return [], []
    heap = []
    for i, sums in enumerate(vectors):
        parts = sorted((s, p) for p, s in enumerate(sums))
        # a part is a tree whose leaves are (vector, part)
        node = [(s, (i, p, None)) for s, p in parts]
        heap.append((node[0][0] - node[-1][0], i, node))
    heapq.heapify(heap)
    turn = len(vectors)
    while len(heap) > 1:
        a, b = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        joined = [(x + y, (left, right)) for (x, left), (y, right) in zip(a, reversed(b), strict=True)]
        joined.sort(key=lambda part: part[0])
        heapq.heappush(heap, (joined[0][0] - joined[-1][0], turn, joined))
        turn += 1
    final = heap[0][2]
    places = [[0] * len(v) for v in vectors]
    for place, (_, tree) in enumerate(final):
        todo = [tree]
        while todo:
            node = todo.pop()
            if len(node) == 3:
                places[node[0]][node[1]] = place
            else:
                todo += node
    return [s for s, _ in final], places


def _bucket_groups(shards: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "content"], ascending=[False, True], kind="stable")
        vectors = [[0] * (shards - 1) + [int(b)] for b in frame["bytes"]]
        _, places = difference(vectors)
        return pd.DataFrame(
            {
                "bucket": frame["bucket"].to_numpy(),
                "content": frame["content"].to_numpy(),
                "bytes": frame["bytes"].to_numpy(),
                "part": [p[-1] for p in places],
            }
        )

    return run


def _combine(frame: pd.DataFrame) -> pd.DataFrame:
    """Difference the partial partitions of one node of the tree."""
    frame = frame.sort_values("id", kind="stable")
    sums, places = difference([list(map(int, s)) for s in frame["sums"]])
    return pd.DataFrame(
        {"node": frame["node"].to_numpy(), "id": frame["id"].to_numpy(), "places": places, "sums": [sums] * len(frame)}
    )


def _merge_tree(parts: DataFrame, count: int) -> DataFrame:
    """``bucket, places``: the shard of each part of each bucket. ``parts``: id, sums."""
    schema = "node bigint, id bigint, places array<int>, sums array<bigint>"
    route, level = None, parts
    while True:
        nodes = ceil_div(count, FAN_IN)
        step = stage(
            level.withColumn("node", F.pmod("id", F.lit(nodes)).cast("bigint"))
            .groupBy("node")
            .applyInPandas(_combine, schema)
        )
        taken = step.select(F.col("id").alias("at"), "node", "places")
        if route is None:
            route = taken.select(F.col("at").alias("bucket"), F.col("node").alias("at"), "places")
        else:
            moved = F.transform(route["places"], lambda p: F.get(taken["places"], p))
            route = route.join(taken, "at").select("bucket", F.col("node").alias("at"), moved.alias("places"))
        if nodes <= 1:
            return route.select("bucket", "places")
        level = step.groupBy(F.col("node").alias("id")).agg(F.any_value("sums").alias("sums"))
        count = nodes


def shard_by_bytes(docs: DataFrame, shards: int = 8, groups_per_task: int = GROUPS_PER_TASK) -> DataFrame:
    """Deal ``docs`` to ``shards`` of nearly equal bytes, equal texts together.

    Returns doc_id, size (UTF-8 bytes plus 1), text_crc32, shard, and slot, a
    gapless number from 0 within the shard.
    """
    if shards < 1:
        raise ValueError("shards must be at least 1")
    spark = docs.sparkSession
    rows = stage(
        whole_texts(docs).select(
            "doc_id",
            (F.octet_length("text").cast("bigint") + 1).alias("size"),
            F.crc32(F.encode("text", "UTF-8")).alias("text_crc32"),
            F.unhex(F.sha2("text", 256)).alias("content"),
        )
    )
    sums = rows.groupBy("content").agg(F.sum("size").alias("bytes"))
    n_rows, n_groups = rows.count(), sums.count()
    buckets = max(1, ceil_div(n_groups, groups_per_task))
    placed = stage(
        sums.withColumn("bucket", F.pmod(F.xxhash64("content"), F.lit(buckets)).cast("bigint"))
        .groupBy("bucket")
        .applyInPandas(_bucket_groups(shards), "bucket bigint, content binary, bytes bigint, part int")
    )
    in_part = [F.sum(F.when(F.col("part") == p, F.col("bytes")).otherwise(0)) for p in range(shards)]
    vectors = placed.groupBy(F.col("bucket").alias("id")).agg(F.array(*in_part).alias("sums"))
    places = _merge_tree(vectors, buckets)
    group_shard = placed.join(places, "bucket").select("content", F.get("places", F.col("part")).alias("shard"))

    slices = max(1, ceil_div(n_rows, ROWS_PER_SLICE))
    dealt = stage(
        rows.join(group_shard, "content").withColumn(
            "slice", F.pmod(F.xxhash64("doc_id", "content"), F.lit(slices)).cast("int")
        )
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    numbered = Window.partitionBy("shard", "slice").orderBy("doc_id", "content")
    return (
        dealt.join(offsets, ["shard", "slice"])
        .withColumn("slot", F.col("offset") + F.row_number().over(numbered) - 1)
        .select("doc_id", "size", "text_crc32", F.col("shard").cast(T.IntegerType()).alias("shard"), "slot")
    )
