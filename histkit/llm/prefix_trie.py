"""A z-fast trie of conversations.

Conversations are strings of turns, and a prefix is known by its length and a
128-bit hash: the exclusive or of the hashes of (place, role, text) of its turns,
so prefixes come from one running aggregate. The trie is compacted: its nodes are
the prefixes at which a conversation ends or several ways part; such a node's
``extent`` is the prefix itself, and the edge above it holds the lengths from its
parent's extent (not included) to its own. The node is found by its *handle*, the
prefix whose length is the two-fattest number on the edge, the one that a power
of two as large as possible divides.

The trie is a table of nodes, and everything done with it is a join:

- *Locating*, by fat binary search: of the lengths still possible for the last
  node on a conversation's way, the two-fattest is tried. If a node has that prefix
  as its handle, the search goes on below its extent, else above the length tried.
  That is one join a round for all conversations at once, and as many rounds as
  the greatest length has bits. What is left is to see whether the way goes on
  past the last node found, and into which edge.
- *Inserting*, in three growing batches: the ways of a batch below the nodes where
  they leave the trie, and the edges that they leave in their middle, are grouped by
  prefix. A prefix at which one ends or two part becomes a node. Nodes get the next
  node above as parent, edges that were cut get new handles.
- *Expanding*: the lengths within an edge have the node's members, one child and its
  leaves. Sums over subtrees need no walk over the trie: a node's own share counts
  for the smallest conversation through it, as a sum over what lies further on that
  conversation's way, and a node adds these sums up over its members.

Equal conversations are one string with a count. Groups are only ever aggregated
partially, then as a whole; a prefix that many share is one key of joins that
adaptive execution can split. A conversation's own turns are sorted in one task and
stream through it. The ids that end at a node are joined to text by ranges
of ids and hashed in order, one piece of text at a time.

Odd rows: rows without a conversation's id take no part; NULL turns come first, and
of one turn's rows that with the smaller hash of role and text; NULL roles and texts
are empty; repeated rows are turns like others; a conversation may become
turnless and is a member of the root; an empty table has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.llm.common import tidy
from histkit.sources.tables import stage

#: Batches, as bounds of a conversation's hash.
PARTS = 16
BATCHES = ((0, 1), (1, 4), (4, 16))
#: Rounds of a search whose joins are planned together.
ROUNDS = 4
#: Characters of ids that are joined to one text.
TEXT = 1 << 16

PREFIX = ["d", "a", "b"]
NODE = "d int, a bigint, b bigint, pl int, pa bigint, pb bigint, f int, ha bigint, hb bigint, ta bigint, tb bigint, rep bigint"


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] that the largest power of two divides; for 0 <= low < high."""
    bits = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high - high % F.call_function("shiftleft", F.lit(1), bits)


# conversations as prefixes


def turn_rows(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 1), two hashes of role and text, bytes of the text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turns = rows.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        F.xxhash64(F.lit(1), role, text).alias("t1"),
        F.xxhash64(F.lit(2), role, text).alias("t2"),
        F.octet_length(text).cast("bigint").alias("bytes"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "t1", "t2")
    return turns.select("conv_id", F.row_number().over(order).alias("place"), "t1", "t2", "bytes")


def rebuilt(turns: DataFrame, group: int = 5, shares: int = 9) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin like the first of their group: (conv_id, d, t1, t2, bytes) and all conv_ids.

    The first h turns come from conversation c - c % ``group``, h being the crc32
    of c as text modulo ``shares``; then come c's own turns after its first h.
    """
    c = F.col("conv_id")
    lengths = turns.groupBy("conv_id").agg(F.max("place").alias("n"))
    asked = lengths.select(
        "conv_id", (c - c % group).alias("first"), F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(shares)).cast("int").alias("h")
    )
    heads = lengths.select(F.col("conv_id").alias("first"), F.col("n").alias("first_n"))
    taken = asked.join(heads, "first", "left").withColumn("taken", F.least("h", F.coalesce("first_n", F.lit(0))))
    rest = turns.join(taken.select("conv_id", "h", "taken"), "conv_id").where(F.col("place") > F.col("h"))
    rest = rest.withColumn("d", F.col("place") - F.col("h") + F.col("taken"))
    # a group's first few turns, for the few conversations of the group
    starts = turns.where(F.col("place") < shares).withColumnRenamed("conv_id", "first")
    begun = starts.join(taken.select("conv_id", "first", "h"), "first").where(F.col("place") <= F.col("h"))
    columns = ["conv_id", "d", "t1", "t2", "bytes"]
    out = rest.select(columns).unionByName(begun.withColumnRenamed("place", "d").select(columns))
    return out, lengths.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, d, a, b, bytes: the prefix of each length and the bytes of its last text."""
    way = Window.partitionBy("conv_id").orderBy("d")
    place = [F.xxhash64(F.lit(seed), "d", "t1", "t2") for seed in (3, 4)]
    return turns.select("conv_id", "d", *[F.bit_xor(p).over(way).alias(n) for p, n in zip(place, "ab")], "bytes")


# the trie


def _search(state: DataFrame, ways: DataFrame, trie: DataFrame, rounds: int) -> DataFrame:
    """The last node on each way whose handle is on it: (rep, n, ld, la, lb, lpl, lpa, lpb)."""
    at = ways.select("rep", F.col("d").alias("f"), F.col("a").alias("ha"), F.col("b").alias("hb"))
    nodes = trie.select("f", "ha", "hb", *[F.col(c).alias(f"x{c}") for c in ("d", "a", "b", "pl", "pa", "pb")])
    found = state.select(
        "rep", "n", F.lit(0).alias("low"), F.col("n").alias("high"),
        *[F.lit(0).cast("int" if c in ("d", "pl") else "bigint").alias(f"l{c}") for c in ("d", "a", "b", "pl", "pa", "pb")],
    )
    for i in range(rounds):
        tried = found.withColumn("f", F.when(F.col("low") < F.col("high"), two_fattest(F.col("low"), F.col("high"))))
        seen = tried.join(at, ["rep", "f"], "left").join(nodes, ["f", "ha", "hb"], "left")
        hit, open_ = F.col("xd").isNotNull(), F.col("f").isNotNull()
        found = seen.select(
            "rep",
            "n",
            F.when(hit, F.col("xd")).otherwise(F.col("low")).alias("low"),
            F.when(open_ & ~hit, F.col("f") - 1).otherwise(F.col("high")).alias("high"),
            *[F.when(hit, F.col(f"x{c}")).otherwise(F.col(f"l{c}")).alias(f"l{c}") for c in ("d", "a", "b", "pl", "pa", "pb")],
        )
        if i % ROUNDS == ROUNDS - 1:
            found = stage(found)
    return found


def _exits(found: DataFrame, ways: DataFrame, trie: DataFrame) -> DataFrame:
    """Where each way leaves the trie: the node above (base) and the edge that it leaves in its middle, if any.

    (rep, n, base_d, base_a, base_b, xd, xa, xb, x_rep); ways that are in the trie already are left out.
    """
    here = ways.select("rep", F.col("d").alias("ld"), F.col("a").alias("wa"), F.col("b").alias("wb"))
    passed = (F.col("ld") == 0) | ((F.col("wa") == F.col("la")) & (F.col("wb") == F.col("lb")))
    left = found.join(here, ["rep", "ld"], "left").withColumn("passed", F.coalesce(passed, F.lit(False)))
    left = left.where(~(F.col("passed") & (F.col("n") == F.col("ld"))))
    # past the last node the way may still share the beginning of one of its edges
    below = ways.select("rep", (F.col("d") - 1).alias("ld"), F.col("a").alias("ta"), F.col("b").alias("tb"))
    edges = trie.select(F.col("pl").alias("ld"), "ta", "tb", F.lit(True).alias("passed"), *[F.col(c).alias(f"e{c}") for c in PREFIX])
    more = left.join(below, ["rep", "ld"], "left").join(edges, ["ld", "ta", "tb", "passed"], "left")
    return more.select(
        "rep",
        "n",
        *[F.when(F.col("passed"), F.col(f"l{c}")).otherwise(F.col(f"lp{'l' if c == 'd' else c}")).alias(f"base_{c}") for c in PREFIX],
        *[F.when(F.col("passed"), F.col(f"e{c}")).otherwise(F.col(f"l{c}")).alias(f"x{c}") for c in PREFIX],
    )


def _insert(trie: DataFrame, exits: DataFrame, ways: DataFrame) -> DataFrame:
    """``trie`` with the ways of ``exits``."""
    base = [f"base_{c}" for c in PREFIX]
    new_ways = ways.join(exits.select("rep", "n", *base), "rep").where(F.col("d") > F.col("base_d"))
    new_ways = new_ways.select("rep", F.lit(0).alias("cut"), *PREFIX, *base, (F.col("d") == F.col("n")).alias("ends"))
    cut = exits.where(F.col("xd").isNotNull()).select(*[F.col(f"x{c}").alias(c) for c in PREFIX]).distinct()
    cut = stage(trie.join(cut, PREFIX, "left_semi"))
    edges = cut.select("rep", F.col("d").alias("cut"), *[F.col(p).alias(b) for p, b in zip(("pl", "pa", "pb"), base)])
    edges = ways.join(edges, "rep").where((F.col("d") > F.col("base_d")) & (F.col("d") <= F.col("cut")))
    edges = edges.select("rep", "cut", *PREFIX, *base, F.lit(False).alias("ends"))
    # a path is a way below its base, or an edge that is cut
    on_path = Window.partitionBy("rep", "cut").orderBy("d")
    rows = stage(new_ways.unionByName(edges).withColumn("next", F.lead("a").over(on_path)))

    met = rows.groupBy(*PREFIX).agg(
        F.min("next").alias("least"),
        F.max("next").alias("most"),
        F.bool_or("ends").alias("ends"),
        F.bool_or(F.col("d") == F.col("cut")).alias("is_node"),
        F.min(F.struct("rep", "cut")).alias("path"),
    )
    fork = F.coalesce(F.col("least") != F.col("most"), F.lit(False))
    new = met.where((fork | F.col("ends")) & ~F.col("is_node")).select(*PREFIX, "path")
    moved = cut.select(*PREFIX, F.struct("rep", F.col("d").alias("cut")).alias("path"))
    named = stage(new.unionByName(moved))

    above = rows.select("rep", "cut", *PREFIX, *base).join(named, PREFIX)
    parents = [F.coalesce(F.lag(c).over(on_path), F.col(b)).alias(p) for c, b, p in zip(PREFIX, base, ("pl", "pa", "pb"))]
    placed = above.select("rep", "cut", *PREFIX, "path", *parents)
    own = placed.where((F.col("rep") == F.col("path.rep")) & (F.col("cut") == F.col("path.cut"))).drop("cut", "path")
    own = own.withColumn("f", two_fattest(F.col("pl"), F.col("d"))).withColumn("top", F.col("pl") + 1)
    handles = ways.select("rep", F.col("d").alias("f"), F.col("a").alias("ha"), F.col("b").alias("hb"))
    tops = ways.select("rep", F.col("d").alias("top"), F.col("a").alias("ta"), F.col("b").alias("tb"))
    done = own.join(handles, ["rep", "f"]).join(tops, ["rep", "top"])
    kept = trie.join(cut.select(*PREFIX), PREFIX, "left_anti")
    return stage(kept.unionByName(done.select(*trie.columns)))


def build(ways: DataFrame, lengths: DataFrame, longest: int) -> DataFrame:
    """The nodes of the trie of ``ways`` (rep, d, a, b, bytes), less the root; ``lengths`` has (rep, n)."""
    trie = ways.sparkSession.createDataFrame([], NODE)
    some = F.pmod(F.xxhash64("rep"), F.lit(PARTS))
    for i, (low, high) in enumerate(BATCHES):
        batch = lengths.where((some >= low) & (some < high) & (F.col("n") > 0))
        found = _search(batch, ways, trie, longest.bit_length() if i else 0)
        trie = _insert(trie, stage(_exits(found, ways, trie)), ways)
    return trie


# members, ends, sums


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids sorted by (rep, conv_id) to texts of many ids."""
    rep, least, held, size = None, None, [], 0

    def text():
        return pa.record_batch([pa.array([rep], pa.int64()), pa.array([least], pa.int64()), pa.array([",".join(held)])], names=["rep", "least", "ids"])

    for batch in batches:
        for r, c in zip(batch.column("rep").to_pylist(), batch.column("conv_id").to_pylist()):
            if held and (r != rep or size > TEXT):
                yield text()
                held, size = [], 0
            if not held:
                rep, least = r, c
            held.append(str(c))
            size += len(held[-1]) + 1
    if held:
        yield text()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts sorted by (rep, least) to the hash of each rep's whole text."""
    rep, state = None, None

    def told():
        return pa.record_batch([pa.array([rep], pa.int64()), pa.array([state.hexdigest()])], names=["rep", "ends_sha256"])

    for batch in batches:
        for r, ids in zip(batch.column("rep").to_pylist(), batch.column("ids").to_pylist()):
            if state is not None and r == rep:
                state.update(b",")
            else:
                if state is not None:
                    yield told()
                rep, state = r, hashlib.sha256()
            state.update(ids.encode())
    if state is not None:
        yield told()


def end_hashes(members: DataFrame) -> DataFrame:
    """rep, ends_sha256: of the conv_ids of each rep (rep, conv_id), in order and comma-joined."""
    # ranges of ids, so that a rep that holds many is joined to text in many tasks
    ranged = members.repartitionByRange("conv_id").sortWithinPartitions("rep", "conv_id")
    texts = ranged.mapInArrow(tidy(_texts), "rep bigint, least bigint, ids string")
    return texts.repartition("rep").sortWithinPartitions("rep", "least").mapInArrow(tidy(_hashes), "rep bigint, ends_sha256 string")


def prefix_nodes(rows: DataFrame, group: int = 5, shares: int = 9) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations of ``rows`` (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, as the module's top and ``op12`` say.
    """
    turns, everyone = rebuilt(stage(turn_rows(rows)), group, shares)
    all_ways = stage(prefixes(turns))
    last = all_ways.groupBy("conv_id").agg(F.max(F.struct(*PREFIX)).alias("end"))
    ends = everyone.join(last, "conv_id", "left").select(
        "conv_id", F.coalesce("end.d", F.lit(0)).alias("n"), *[F.coalesce(f"end.{c}", F.lit(0)).alias(c) for c in "ab"]
    )
    ends = stage(ends)
    strings = stage(ends.groupBy("n", "a", "b").agg(F.min("conv_id").alias("rep"), F.count(F.lit(1)).alias("copies")))
    ways = all_ways.withColumnRenamed("conv_id", "rep").join(strings.select("rep"), "rep", "left_semi")
    ways = stage(ways.select("rep", *PREFIX, "bytes"))
    hashes = end_hashes(ends.join(strings.select("n", "a", "b", "rep"), ["n", "a", "b"]).select("rep", "conv_id"))
    hashes = stage(strings.join(hashes, "rep").select(F.col("n").alias("d"), "a", "b", "ends_sha256"))

    smallest, most, longest = strings.agg(F.min("rep"), F.sum("copies"), F.max("n")).first()
    if smallest is None:
        return _result(rows.sparkSession.createDataFrame([], RESULT))
    trie = build(ways, strings.select("rep", "n"), longest)

    # members and children of the compacted nodes
    through = ways.select("rep", *PREFIX).join(trie.select(*PREFIX), PREFIX).join(strings.select("rep", "copies"), "rep")
    members = through.groupBy(*PREFIX).agg(F.min("rep").alias("conv_id"), F.sum("copies").alias("n_convs"))
    children = trie.groupBy(*[F.col(p).alias(c) for p, c in zip(("pl", "pa", "pb"), PREFIX)]).agg(F.count(F.lit(1)).alias("n_children"))
    children = stage(children)
    nodes = stage(
        trie.select(*PREFIX, "pl", "pa", "pb")
        .join(members, PREFIX)
        .join(children, PREFIX, "left")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    )
    named = nodes.select(*[F.col(c).alias(p) for p, c in zip(("pl", "pa", "pb"), PREFIX)], F.col("conv_id").alias("parent"))
    nodes = nodes.join(named, ["pl", "pa", "pb"], "left").withColumn("parent", F.coalesce("parent", F.lit(smallest)))

    # each prefix of a way lies on the edge of the next node at or below it
    edge = ["d", "conv_id", "parent", "pl", "n_convs", "n_children"]
    at_node = nodes.select(*PREFIX, F.struct(*edge).alias("node"))
    down = Window.partitionBy("rep").orderBy(F.desc("d"))
    on_edge = ways.join(at_node, PREFIX, "left").withColumn("edge", F.last("node", ignorenulls=True).over(down))
    owned = F.col("edge.conv_id") == F.col("rep")
    saved = F.when(owned, (F.col("edge.n_convs") - 1) * F.col("bytes")).otherwise(0)
    leaf = F.first(F.col("edge.n_children") == 0).over(down).cast("bigint")
    laid = on_edge.select("rep", *PREFIX, "edge", owned.alias("owned"), F.sum(saved).over(down).alias("rest"), leaf.alias("leaf"))
    laid = stage(laid)

    # a node's sums over its members, by the node's name: its smallest member and depth
    sums = laid.where(F.col("d") == F.col("edge.d")).groupBy(F.col("edge.conv_id").alias("rep"), F.col("edge.d").alias("e")).agg(
        F.sum("rest").alias("below"),
        F.sum("leaf").alias("n_leaves"),
        F.max(F.when(F.col("edge.conv_id") == F.col("rep"), F.col("rest"))).alias("own"),
    )
    parent = F.when(F.col("d") == F.col("edge.pl") + 1, F.col("edge.parent")).otherwise(F.col("rep"))
    inner = (
        laid.where("owned")
        .withColumn("e", F.col("edge.d"))
        .join(sums, ["rep", "e"])
        .join(hashes, PREFIX, "left")
        .select(
            F.col("rep").alias("conv_id"),
            F.col("d").cast("bigint").alias("depth"),
            parent.alias("parent_conv_id"),
            F.col("edge.n_convs").alias("n_convs"),
            F.when(F.col("d") == F.col("e"), F.col("edge.n_children")).otherwise(1).alias("n_children"),
            "n_leaves",
            (F.col("below") + F.col("rest") - F.col("own")).alias("saved_tokens"),
            "ends_sha256",
        )
    )
    saved_all, leaves = laid.where("d = 1").agg(F.sum("rest"), F.sum("leaf")).first()
    n_children = children.where("d = 0").agg(F.max("n_children")).first()[0]
    turnless = hashes.where("d = 0").agg(F.max("ends_sha256")).first()[0]
    # a root without children is a leaf
    row = (smallest, 0, None, most, n_children or 0, leaves or 1, saved_all or 0, turnless)
    root = rows.sparkSession.createDataFrame([row], RESULT)
    return _result(inner.unionByName(root))


RESULT = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)


def _result(nodes: DataFrame) -> DataFrame:
    """Nodes at which nothing ends have the hash of the empty text."""
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)))
