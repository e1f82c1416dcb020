"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables.

Codes: unit vectors are centred, projected on their first 64 principal directions
and rotated so that they lie as near as possible to the corners of a cube (turns of
"nearest corner" and "best rotation for these corners"); the signs are the code, its
bits balanced by the centring. Three rotations from different starts give three codes
of 64 bits. They are learned from at most about ``SAMPLE`` distinct vectors.

Tables: each code has five pieces of 12 bits, so a vector lies in one bucket of each
of 15 tables. Bits of vectors at angle t differ with probability t/pi: at a cosine of
0.95 a pair shares a bucket with probability 0.99, at 0.97 with 0.999. Of those that
meet, pairs whose first codes differ in too many bits (five deviations over what the
angle makes likely) are passed over; all others are compared exactly, in double precision,
by their original vectors, so a link that is reported is one.

Large groups of near copies are not taken apart into pairs:

1. Equal vectors are one node. Each node is compared with the smallest node of each of
   its buckets (its pivots; at most 15 x 4096 exist), and joins the smallest one it
   links with. The group's middle is the mean of its members. Members within half the
   angle of a link from it are a *unit*, all of whose members link with each other; any
   other node is a unit by itself.
2. Units meet in the buckets of their members. The angle between two middles less or
   plus the units' radii tells whether none or all of their members link.
3. Where it doesn't tell, the members are compared with each other exactly, in blocks
   of 256, and each member's links are counted; no pair leaves the block.

A bucket with many units is split: it is cut into blocks, and each pair of blocks is a
piece of work by itself.

Odd rows: vectors that are NULL, zero or hold NULL or non-finite components link with
nothing; shorter vectors end in zeros; each of several rows with equal vectors counts,
whatever its id; a NULL id is never the smallest, unless the component has no other, and
such a component has the NULL id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import ceil_div, tidy
from histkit.llm.components import components
from histkit.llm.vectors import as_lists, is_finite, matrix
from histkit.sources.tables import stage

SIMILAR = 0.95
#: Bits of a code, codes, and bits of the pieces that make a bucket.
BITS, CODES, PIECE = 64, 3, 12
PIECES = BITS // PIECE
#: Distinct vectors that the codes are learned from, about, and turns of the iteration.
SAMPLE, TURNS = 20_000, 30
#: Units of a bucket, or members of a unit, that are compared with each other at a time.
UNITS, MEMBERS = 1024, 256
#: Rows of buckets in a task.
TASK_ROWS = 20_000
#: Angles that differ by less are not told apart by way of a middle.
SLACK = 1e-6


def unit_rows(v: np.ndarray) -> np.ndarray:
    v = v / np.maximum(np.abs(v).max(axis=1, keepdims=True, initial=0), 1e-300)
    return v / np.maximum(np.sqrt((v**2).sum(axis=1, keepdims=True)), 1e-300)


class Quantiser:
    """A mean, and a projection with rotation for each code."""

    def __init__(self, sample: np.ndarray, seed: int = 11):
        x = unit_rows(sample)
        self.width = x.shape[1]
        self.mean = x.mean(axis=0) if len(x) else np.zeros(self.width)
        x = x - self.mean
        _, directions = np.linalg.eigh(x.T @ x)
        directions = directions[:, ::-1][:, :BITS]
        random = np.random.default_rng(seed)
        # fewer components than bits: the directions are laid into the larger space at random
        lift, _ = np.linalg.qr(random.normal(size=(BITS, BITS)))
        first = directions @ lift[: directions.shape[1]]
        low = x @ first
        self.maps = []
        for _ in range(CODES):
            turn, _ = np.linalg.qr(random.normal(size=(BITS, BITS)))
            for _ in range(TURNS if len(x) else 0):
                corners = np.where(low @ turn > 0, 1.0, -1.0)
                left, _, right = np.linalg.svd(corners.T @ low)
                turn = (left @ right).T
            self.maps.append(first @ turn)

    def codes(self, unit: np.ndarray) -> np.ndarray:
        """A column for each code."""
        own = np.zeros((len(unit), self.width))
        own[:, : unit.shape[1]] = unit[:, : self.width]
        bits = [np.packbits((own - self.mean) @ m > 0, axis=1, bitorder="little") for m in self.maps]
        return np.stack([b.view(np.int64).ravel() for b in bits], axis=1)


def buckets(codes: np.ndarray) -> np.ndarray:
    """The bucket in each table, told apart by table."""
    out = []
    for t in range(CODES * PIECES):
        code = codes[:, t // PIECES].view(np.uint64)
        piece = (code >> np.uint64(t % PIECES * PIECE)) & np.uint64((1 << PIECE) - 1)
        out.append(piece.astype(np.int32) + t * (1 << PIECE))
    return np.stack(out, axis=1)


def allowed_bits(similar: float) -> int:
    """Bits in which the codes of a pair at this cosine differ, and five deviations more."""
    p = np.arccos(similar) / np.pi
    return int(np.ceil(BITS * p + 5 * np.sqrt(BITS * p * (1 - p))))


def _coder(model):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = model.value.codes(unit_rows(matrix(batch.column("vector"))))
                yield pa.record_batch(
                    [batch.column(0), pa.array(codes[:, 0]), as_lists(buckets(codes))], names=["node", "code", "buckets"]
                )

    return tidy(code)


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the cosine of the vectors ``v`` and ``w`` of a row in their place."""
    for batch in batches:
        if batch.num_rows:
            v, w = matrix(batch.column("v")), matrix(batch.column("w"))
            n = min(v.shape[1], w.shape[1])
            cosine = np.einsum("ij,ij->i", unit_rows(v)[:, :n], unit_rows(w)[:, :n])
            rest = batch.drop_columns(["v", "w"])
            yield pa.record_batch([*rest.columns, pa.array(cosine)], names=[*rest.schema.names, "cosine"])


def with_cosine(pairs: DataFrame) -> DataFrame:
    kept = [f for f in pairs.schema.fields if f.name not in ("v", "w")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    ordered = pairs.select(*[f.name for f in kept], "v", "w")
    return ordered.mapInArrow(tidy(_angles), f"{schema}, cosine double")


# units


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch the sum of the unit vectors of each group."""
    for batch in batches:
        if batch.num_rows:
            v = unit_rows(matrix(batch.column("vector")))
            groups, at = np.unique(batch.column("grp").to_numpy(), return_inverse=True)
            total = np.zeros((len(groups), v.shape[1]))
            np.add.at(total, at, v)
            yield pa.record_batch([pa.array(groups), as_lists(total)], names=["grp", "vector"])


def _sum(table: pa.Table) -> pa.Table:
    total = matrix(table.column("vector")).sum(axis=0, keepdims=True)
    return pa.table({"grp": table.column("grp").slice(0, 1), "vector": as_lists(total)})


def _groups(nodes: DataFrame, coded: DataFrame, similar: float) -> DataFrame:
    """node, grp: the smallest pivot that a node links with, or the node itself; only groups of two or more."""
    slots = coded.select("node", "code", F.explode("buckets").alias("bucket"))
    heads = slots.groupBy("bucket").agg(F.min(F.struct("node", "code")).alias("head"))
    heads = heads.select("bucket", F.col("head.node").alias("pivot"), F.col("head.code").alias("pivot_code"))
    # never more rows than there are buckets
    met = slots.join(F.broadcast(heads), "bucket").where(F.col("node") != F.col("pivot"))
    near = F.bit_count(F.col("code").bitwiseXOR(F.col("pivot_code"))) <= allowed_bits(similar)
    pairs = met.where(near).select("node", "pivot").distinct()
    own = nodes.select("node", F.col("vector").alias("v"))
    others = nodes.select(F.col("node").alias("pivot"), F.col("vector").alias("w"))
    linked = with_cosine(pairs.join(own, "node").join(others, "pivot")).where(F.col("cosine") >= similar)
    joined = stage(linked.groupBy("node").agg(F.min("pivot").alias("grp")))
    # a pivot is in its own group, unless it has joined another
    leads = joined.select(F.col("grp").alias("node")).distinct().join(joined, "node", "left_anti")
    return joined.unionByName(leads.withColumn("grp", F.col("node")))


def _units(nodes: DataFrame, coded: DataFrame, model, similar: float) -> tuple[DataFrame, DataFrame]:
    """Members (node, unit, copies, code, buckets) and units (unit, vector, radius, size, code, reach)."""
    half = float(np.arccos(similar)) / 2 - SLACK
    grouped = stage(_groups(nodes, coded, similar).join(nodes.select("node", "vector"), "node"))
    sums = grouped.select("grp", "vector").mapInArrow(tidy(_sums), "grp bigint, vector array<double>")
    middles = stage(sums.groupBy("grp").applyInArrow(_sum, "grp bigint, vector array<double>"))
    away = with_cosine(grouped.withColumnRenamed("vector", "v").join(middles.withColumnRenamed("vector", "w"), "grp"))
    angle = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), "cosine")))
    inside = away.select("node", "grp", angle.alias("angle")).where(F.col("angle") <= half)
    inside = inside.select("node", (-F.col("grp") - 1).alias("grp_unit"), "angle")
    members = (
        nodes.select("node", "copies")
        .join(coded, "node")
        .join(inside, "node", "left")
        .select(
            "node",
            F.coalesce("grp_unit", "node").alias("unit"),
            "copies",
            "code",
            "buckets",
            F.coalesce("angle", F.lit(0.0)).alias("angle"),
        )
    )
    members = stage(members)
    named = middles.select((-F.col("grp") - 1).alias("node"), "vector")
    centres = named.mapInArrow(_coder(model), "node bigint, code bigint, buckets array<int>")
    centres = stage(centres.select(F.col("node").alias("unit"), F.col("code").alias("centre")))
    reach = F.max(F.bit_count(F.col("code").bitwiseXOR(F.col("centre"))))
    large = (
        members.where("unit < 0")
        .join(centres, "unit")
        .groupBy("unit", "centre")
        .agg(F.max("angle").alias("radius"), F.sum("copies").alias("size"), reach.alias("reach"))
        .join(named.withColumnRenamed("node", "unit"), "unit")
        .select("unit", "vector", "radius", "size", F.col("centre").alias("code"), "reach")
    )
    single = members.where("unit >= 0").select("node", "unit", "code", F.col("copies").alias("size")).join(nodes.select("node", "vector"), "node")
    zero = F.lit(0.0).alias("radius"), F.lit(0).alias("reach")
    return members, stage(large.unionByName(single.select("unit", "vector", zero[0], "size", "code", zero[1])))


# pairs of units


def _pairs(table: pa.Table, bits: int):
    """The order of a table's rows by piece of work, and pairs of places in it whose codes are near enough, a few at a time.

    A piece is a bucket, or two blocks of it, of which only pairs across count.
    """
    bucket, i, j, block, unit, code, reach = (
        table.column(c).to_numpy() for c in ("bucket", "i", "j", "block", "unit", "code", "reach")
    )
    order = np.lexsort((unit, j, i, bucket))
    bucket, i, j, block, unit, code, reach = (x[order] for x in (bucket, i, j, block, unit, code, reach))
    starts = np.flatnonzero(np.append(True, (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])))
    sizes = np.diff(np.append(starts, len(unit)))
    end = np.repeat(starts + sizes, sizes)

    def near():
        here, step = np.arange(len(unit)), 1
        while len(here):
            here = here[here + step < end[here]]
            there = here + step
            far = np.bitwise_count((code[here] ^ code[there]).view(np.uint64)).astype(np.int64)
            keep = (far <= bits + reach[here] + reach[there]) & ((i[here] == j[here]) | (block[here] != block[there]))
            yield here[keep], there[keep]
            step += 1

    return order, near()


def _meeting(bits: int):
    """The rows of a table that are near another one in their piece of work."""

    def meet(table: pa.Table) -> pa.Table:
        order, near = _pairs(table, bits)
        hit = np.zeros(len(order), bool)
        for here, there in near:
            hit[order[here]] = True
            hit[order[there]] = True
        return table.filter(pa.array(hit))

    return meet


def _judge(bits: int, similar: float):
    """Pairs of near units of which all members link, or (false) perhaps some: u, v, their sizes, all_."""
    angle = float(np.arccos(similar))

    def judge(table: pa.Table) -> pa.Table:
        order, near = _pairs(table, bits)
        unit, size, radius = (table.column(c).to_numpy()[order] for c in ("unit", "size", "radius"))
        vector = unit_rows(matrix(table.column("vector")))[order]
        out = []
        for here, there in near:
            cosine = np.einsum("ij,ij->i", vector[here], vector[there])
            between, radii = np.arccos(np.clip(cosine, -1, 1)), radius[here] + radius[there]
            plain = (unit[here] >= 0) & (unit[there] >= 0)
            all_ = np.where(plain, cosine >= similar, between + radii <= angle - SLACK)
            some = np.where(plain, cosine >= similar, between - radii <= angle + SLACK)
            out.append([x[some] for x in (unit[here], unit[there], size[here], size[there], all_)])
        columns = [np.concatenate(x) for x in zip(*out)] if out else [np.zeros(0, np.int64)] * 4 + [np.zeros(0, bool)]
        return pa.table(dict(zip(("u", "v", "u_size", "v_size", "all_"), map(pa.array, columns))))

    return judge


def _unit_links(members: DataFrame, units: DataFrame, similar: float) -> DataFrame:
    """u, v (u < v), u_size, v_size, all_: pairs of units that meet in a bucket and of which all or perhaps some members link."""
    bits = allowed_bits(similar)
    marks = units.select("unit", F.col("code").alias("mark"), "reach")
    slots = members.select("unit", "buckets").join(marks, "unit")
    slots = slots.select("unit", F.col("mark").alias("code"), "reach", F.explode("buckets").alias("bucket"))
    slots = stage(slots.where("unit < 0").distinct().unionByName(slots.where("unit >= 0")))
    sizes = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # never more rows than there are buckets
    sized = slots.join(F.broadcast(sizes.withColumn("blocks", F.ceil(F.col("n") / UNITS).cast("int"))), "bucket")
    block = F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    cut = sized.withColumn("block", block).select("bucket", "block", "unit", "code", "reach", other)
    cut = cut.select("*", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j")).drop("other")

    def sharded(rows: DataFrame) -> DataFrame:
        rows = stage(rows)
        shard = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(max(1, ceil_div(rows.count(), TASK_ROWS))))
        return rows.withColumn("shard", shard).groupBy("shard")

    schema = "bucket int, block int, unit bigint, code bigint, reach int, i int, j int"
    met = sharded(cut).applyInArrow(lambda t: _meeting(bits)(t).drop_columns(["shard"]), schema)
    judged = sharded(met.join(units.select("unit", "vector", "radius", "size"), "unit")).applyInArrow(
        _judge(bits, similar), "u bigint, v bigint, u_size bigint, v_size bigint, all_ boolean"
    )
    return judged.distinct()


def _counter(similar: float):
    """Links between the members of two blocks, for each member; u, v, node, links."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                u, v = batch.column("u")[r].as_py(), batch.column("v")[r].as_py()
                (a, ca, x), (b, cb, y) = (
                    (
                        np.array(batch.column(f"{s}_nodes")[r].as_py(), np.int64),
                        np.array(batch.column(f"{s}_copies")[r].as_py(), np.int64),
                        unit_rows(matrix(batch.column(f"{s}_vectors")[r].values)),
                    )
                    for s in "uv"
                )
                n = min(x.shape[1], y.shape[1])
                hits = x[:, :n] @ y[:, :n].T >= similar
                node, links = np.concatenate([a, b]), np.concatenate([hits @ cb, hits.T @ ca])
                some = links > 0
                size = int(some.sum())
                yield pa.record_batch(
                    [pa.array([u] * size, pa.int64()), pa.array([v] * size, pa.int64()), pa.array(node[some]), pa.array(links[some])],
                    names=["u", "v", "node", "links"],
                )

    return tidy(count)


def _open_links(open_: DataFrame, members: DataFrame, nodes: DataFrame, similar: float) -> DataFrame:
    """u, v, node, links: links across pairs of units that the middles leave open."""
    asked = open_.select(F.col("u").alias("unit")).unionByName(open_.select(F.col("v").alias("unit"))).distinct()
    counted = members.join(asked, "unit", "left_semi").groupBy("unit").agg(F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")
    rows = members.select("node", "unit", "copies").join(counted, "unit").join(nodes.select("node", "vector"), "node")
    packed = rows.withColumn("block", block).groupBy("unit", "block").agg(F.collect_list(F.struct("node", "copies", "vector")).alias("m"))
    packed = stage(packed.select("unit", F.col("m.node").alias("nodes"), F.col("m.copies").alias("copies"), F.col("m.vector").alias("vectors")))

    def side(name: str) -> DataFrame:
        return packed.select(F.col("unit").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("nodes", "copies", "vectors")])

    both = open_.select("u", "v").join(side("u"), "u").join(side("v"), "v")
    # a few blocks to a batch: a row holds two of them
    return both.repartition("u", "v", F.expr("u_nodes[0]"), F.expr("v_nodes[0]")).mapInArrow(
        _counter(similar), "u bigint, v bigint, node bigint, links bigint"
    )


# the whole


def _usable(vector: Column) -> Column:
    return is_finite(vector) & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))


def vector_links(rows: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """For each row of ``rows`` (vec_id, embedding) vec_id, n_links, component_id, kept.

    n_links counts the other rows at a cosine of ``similar`` or more, component_id is
    the smallest id that links lead to, kept marks the rows that bear it.
    """
    spark = rows.sparkSession
    # adding zero folds -0.0 into 0.0
    vector = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0))
    ok = _usable(F.col("embedding"))
    name = [F.when(ok, F.xxhash64(F.lit(seed), vector)).alias(n) for seed, n in ((1, "n1"), (2, "n2"))]
    table = stage(rows.select("vec_id", *name, F.when(ok, vector).alias("vector")))
    nodes = (
        table.where("vector IS NOT NULL")
        .groupBy("n1", "n2")
        .agg(F.any_value("vector").alias("vector"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = stage(nodes)
    every = max(1, ceil_div(nodes.count(), SAMPLE))
    sample = nodes.where(F.pmod(F.xxhash64("n1", "n2"), F.lit(every)) == 0).orderBy("n1", "n2").select("vector").toArrow()
    model = spark.sparkContext.broadcast(Quantiser(matrix(sample.column("vector"))))
    coded = nodes.select("node", "vector").mapInArrow(_coder(model), "node bigint, code bigint, buckets array<int>")
    coded = stage(coded)

    members, units = _units(nodes, coded, model, similar)
    decided = stage(_unit_links(members, units, similar))
    whole, open_ = decided.where("all_"), decided.where("NOT all_")
    some = stage(_open_links(open_, members, nodes, similar))

    across = whole.select(F.col("u").alias("unit"), F.col("v_size").alias("more")).unionByName(
        whole.select(F.col("v").alias("unit"), F.col("u_size").alias("more"))
    )
    across = across.groupBy("unit").agg(F.sum("more").alias("more"))
    single = some.groupBy("node").agg(F.sum("links").alias("links"))
    edges = whole.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(
        some.select(F.col("u").alias("a"), F.col("v").alias("b")).distinct()
    )
    roots = components(edges)
    told = (
        members.select("node", "unit")
        .join(units.select("unit", "size"), "unit")
        .join(across, "unit", "left")
        .join(roots.withColumnRenamed("node", "unit"), "unit", "left")
        .join(single, "node", "left")
        .join(nodes.select("node", "n1", "n2", "least"), "node")
        .select(
            "n1",
            "n2",
            "least",
            (F.col("size") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("root", "unit").alias("root"),
        )
    )
    told = stage(told)
    smallest = told.groupBy("root").agg(F.min("least").alias("component"))
    named = told.join(smallest, "root").select("n1", "n2", "n_links", "component", F.lit(True).alias("linked"))
    out = table.select("vec_id", "n1", "n2").join(named, ["n1", "n2"], "left")
    component = F.when(F.col("linked"), F.col("component")).otherwise(F.col("vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
