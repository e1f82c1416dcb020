"""Near-duplicate classes by DartMinHash and banded joining.

A document is a weighted set of its five-word shingles, a shingle that occurs c
times having weight 1 + ln c. Each shingle owns a plane of position and rank on
which hashed darts lie, one to a unit of area on average (a Poisson number for
each cell, by its hash). A document sees the darts whose position is below the
weight, and looks at ever higher ranks until each of its 125 coordinates (the
dart's hash says which) has one; the earliest dart of a coordinate is kept. Two
documents keep the same dart with the probability of their weighted Jaccard
similarity, and the work is a few darts per shingle, not one hash per shingle
and coordinate.

Links are pairs at Jaccard similarity 0.8 or more of the shingle *sets*, which
repeated shingles pull apart from the weighted one. A text that repeats a shingle
therefore has a second signature, with weight 1 for each shingle; where none is
repeated the two are the same.

Texts with equal words are one node from the start. Nodes that agree in all 5
coordinates of one of 25 bands, by either signature, share a bucket. Pairs at set
similarity 0.8 share at least one with probability 0.99995, by those of weight 1.
Buckets are not expanded into pairs:

1. Each member is compared with the bucket's smallest node (its pivot), exactly,
   by the Jaccard similarity of the shingle sets. Links are joined into classes.
2. Buckets whose members all fell into one class need nothing more. In the
   others, members of other classes than the pivot's are compared with all
   members, again exactly, as blocks of arrays inside a task; only links that
   join two classes leave it.

So no link among candidates is lost, and large groups of alike texts cost one
comparison a member.

Odd rows: texts of one to four words are one shingle; texts without words (NULL,
empty, white space) are one class; repeated rows and ids are in the class of
their text; a class whose ids are all NULL has the NULL id; rows with NULL ids
have classes like others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import ceil_div, let, tidy, whole_texts, words
from histkit.llm.components import components
from histkit.llm.fingerprints import SHINGLE, shingle_hashes
from histkit.sources.tables import stage

BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
SIMILAR = 0.8
#: Members of a bucket that are compared at a time, columns of their tables, and rows of such blocks in a task.
BLOCK, COLUMNS, TASK_ROWS = 256, 8192, 4_000
#: Tasks over which the members of one bucket are dealt to meet its size.
SALTS = 32
#: Height of the lowest slab of ranks; each further slab ends at twice the rank.
LOWEST = 0.25
#: Darts after which most documents have all coordinates.
DARTS = COORDINATES * np.log(COORDINATES) + 2 * COORDINATES
#: Shingles that are handled at a time.
BATCH_WORDS = 100_000

_STEP = np.uint64(0x9E3779B97F4A7C15)  # the golden ratio as a 64-bit fraction


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters them (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _unit(x: np.ndarray) -> np.ndarray:
    """Hashes as numbers from 0 to below 1."""
    return (x >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson(area: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, ... darts in a cell."""
    out, p, n = [], np.exp(-area), 0
    total = p
    while total < 1 - 1e-15 and n < 10 * area + 40:
        out.append(total)
        n += 1
        p *= area / n
        total += p
    return np.array(out)


def _slab(s: int) -> tuple[float, float]:
    return (0.0 if s == 0 else LOWEST * 2 ** (s - 1)), LOWEST * 2**s


def shingles_of(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of several documents' word hashes, and each shingle's document.

    ``ends`` are the documents' ends in ``hashes``.
    """
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    starts = np.flatnonzero(np.arange(len(hashes)) + SHINGLE <= ends[doc])
    out = mix(hashes[starts] + _STEP)
    for k in range(1, SHINGLE):
        out = mix((out ^ hashes[starts + k]) + _STEP)
    owner = doc[starts]
    short = np.flatnonzero((sizes > 0) & (sizes < SHINGLE))
    if len(short):
        whole = []
        for d in short:
            h = np.array([sizes[d]], np.uint64)
            for w in hashes[ends[d] - sizes[d] : ends[d]]:
                h = mix((h ^ w) + _STEP)
            whole.append(h[0])
        out, owner = np.append(out, np.array(whole, np.uint64)), np.append(owner, short)
    return out, owner


def signatures(element: np.ndarray, doc: np.ndarray, weight: np.ndarray, n_docs: int) -> np.ndarray:
    """DartMinHash signatures, a row per document; zeros for documents without elements.

    Elements are 64-bit hashes, each at most once per document.
    """
    k = COORDINATES
    total = np.bincount(doc, weight, n_docs)
    least = np.full(n_docs * k, np.inf)
    kept = np.zeros(n_docs * k, np.uint64)
    has = total > 0
    # the slab in which a document has thrown its darts, if luck is average
    last = np.zeros(n_docs, np.int64)
    last[has] = np.maximum(0, np.ceil(np.log2(DARTS / total[has] / LOWEST)))
    cells = np.ceil(weight).astype(np.int64)
    s = 0
    going = has
    while going.any():
        low, high = _slab(s)
        table = _poisson(high - low)
        at = np.flatnonzero(going[doc])
        own = np.repeat(at, cells[at])
        cell = np.arange(len(own)) - np.repeat(np.cumsum(cells[at]) - cells[at], cells[at])
        seed = mix(mix(element[own] + np.array([s + 1], np.uint64) * _STEP) + _STEP * cell.astype(np.uint64))
        darts = np.searchsorted(table, _unit(seed), side="right")
        some = np.flatnonzero(darts)
        own, cell, seed, darts = own[some], cell[some], seed[some], darts[some]
        nth = np.arange(darts.sum()) - np.repeat(np.cumsum(darts) - darts, darts)
        own, cell = np.repeat(own, darts), np.repeat(cell, darts)
        dart = mix(np.repeat(seed, darts) + _STEP * (nth + 1).astype(np.uint64))
        seen = weight[own] >= cell + 1
        edge = np.flatnonzero(~seen)
        seen[edge] = cell[edge] + _unit(mix(dart[edge] + np.uint64(1))) < weight[own[edge]]
        place = doc[own] * k + (dart % np.uint64(k)).astype(np.int64)
        seen &= np.isinf(least[place])  # lower slabs come first
        place, dart = place[seen], dart[seen]
        rank = low + (high - low) * _unit(mix(dart + np.uint64(2)))
        np.minimum.at(least, place, rank)
        best = rank == least[place]
        kept[place[best]] = dart[best]
        s += 1
        unfilled = np.isinf(least).reshape(n_docs, k).any(axis=1)
        going = has & ((last >= s) | unfilled) & unfilled
    return kept.reshape(n_docs, k)


def buckets(kept: np.ndarray) -> np.ndarray:
    """A 64-bit bucket for each band of each signature."""
    rows = kept.reshape(-1, BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64) * _STEP + np.zeros((len(rows), 1), np.uint64)
    for r in range(ROWS):
        out = mix((out ^ rows[:, :, r]) + _STEP)
    return out.view(np.int64)


def _band(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of several documents, by document, and how many each has.

    A document has those of weight 1, by which links are found, and if it repeats
    a shingle those of its weights besides.
    """
    element, doc = shingles_of(hashes, ends)
    order = np.lexsort((element, doc))
    element, doc = element[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (element[1:] != element[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(doc)))
    element, doc = element[first], doc[first]
    plain = buckets(signatures(element, doc, np.ones(len(doc)), len(ends)))
    repeats = np.zeros(len(ends), bool)
    repeats[doc[times > 1]] = True
    mine = repeats[doc]
    place = np.cumsum(repeats) - 1
    weighted = buckets(signatures(element[mine], place[doc[mine]], 1 + np.log(times[mine]), int(repeats.sum())))
    some = np.diff(ends, prepend=0) > 0
    owner = np.concatenate([np.repeat(np.flatnonzero(some), BANDS), np.repeat(np.flatnonzero(repeats), BANDS)])
    values = np.concatenate([plain[some].reshape(-1), weighted.reshape(-1)])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    # a bucket that both signatures give is one
    new = np.append(True, (owner[1:] != owner[:-1]) | (values[1:] != values[:-1]))[: len(owner)]
    return values[new], np.bincount(owner[new], minlength=len(ends))


@tidy
def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, content, word hashes) to (doc_id, content, buckets)."""
    for batch in batches:
        lists = batch.column(2)
        offsets = np.asarray(lists.offsets).astype(np.int64)
        flat = np.asarray(lists.values).view(np.uint64)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_WORDS, side="right")) - 1)
            to = min(to, batch.num_rows)
            ends = offsets[at + 1 : to + 1] - offsets[at]
            values, sizes = _band(flat[offsets[at] : offsets[to]], ends)
            part = batch.slice(at, to - at)
            bands = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(values, pa.int64()))
            yield pa.record_batch([part.column(0), part.column(1), bands], ["doc_id", "content", "bands"])
            at = to


def content_of(own: Column) -> Column:
    """16 bytes that name a sequence of words."""
    return F.unhex(F.substring(F.sha2(F.array_join(own, " "), 256), 1, 32))


def with_content(docs: DataFrame) -> DataFrame:
    """doc_id, text, words and content of each document."""
    own = whole_texts(docs).withColumn("words", words(F.col("text")))
    return own.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "words", content_of(F.col("words")).alias("content"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, similarity: exact, of shingle sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return stage(
        pairs.join(left, "a")
        .join(right, "b")
        .select("a", "b", let(shared, lambda n: n / (F.size("sa") + F.size("sb") - n)).alias("similarity"))
    )


def _rooted(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``members`` of buckets that hold more than one class, with their class."""
    named = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = named.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x != y")
    return stage(named.join(mixed.select("bucket"), "bucket", "left_semi"))


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each left with each right array of distinct numbers."""
    out = np.zeros((len(left), len(right)), np.float32)
    where = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    values, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    often = np.flatnonzero(np.bincount(column) > 1)
    place = np.full(len(values), -1)
    place[often] = np.arange(len(often))
    column = place[column]
    where, column = where[column >= 0], column[column >= 0]
    for at in range(0, len(often), COLUMNS):
        mine = (column >= at) & (column < at + COLUMNS)
        table = np.zeros((len(left) + len(right), min(COLUMNS, len(often) - at)), np.float32)
        table[where[mine], column[mine] - at] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out


def _settler(similar: float):
    def settle(rows: pa.Table) -> pa.Table:
        """Links between different classes, block by block; no more than connect what is linked."""
        rows = rows.sort_by([("bucket", "ascending"), ("i", "ascending"), ("j", "ascending")])
        key = np.column_stack([np.asarray(rows[c]) for c in ("bucket", "i", "j")])
        node, root, is_left = (np.asarray(rows[c]) for c in ("node", "root", "is_left"))
        lists = rows["shingles"].combine_chunks()
        offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values)
        first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        links: list[tuple[int, int]] = []
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while up.get(x, x) != x:
                x = up[x]
            return x

        for at, to in zip(first, np.append(first[1:], len(key)), strict=True):
            mine = np.arange(at, to)
            left, right = mine[is_left[mine]], mine[~is_left[mine]]
            if not len(left) or not len(right):
                continue
            sets = [[flat[offsets[k] : offsets[k + 1]] for k in side] for side in (left, right)]
            n = [np.array([len(x) for x in side]) for side in sets]
            both = _shared(*sets)
            near = both >= similar * (n[0][:, None] + n[1][None, :] - both) - 1e-4
            for a, b in zip(*np.nonzero(near & (root[left][:, None] != root[right][None, :])), strict=True):
                x, y = top(int(root[left[a]])), top(int(root[right[b]]))
                if x != y:
                    up[max(x, y)] = min(x, y)
                    links.append((int(node[left[a]]), int(node[right[b]])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return settle


def _links_between(apart: DataFrame, roots: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """a, b: links between classes that share a bucket.

    The class of a bucket's pivot is at home there. The members of other classes
    are compared with all members, ``BLOCK`` with ``BLOCK`` at a time, so that a
    task holds two blocks, however large the bucket.
    """
    home = roots.select(F.col("node").alias("pivot"), F.col("root").alias("home"))
    away = F.col("root") != F.coalesce("home", "pivot")
    named = apart.join(home, "pivot", "left").withColumn("away", away)
    sizes = named.groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count_if("away") / BLOCK).cast("int").alias("away_blocks"),
    )
    # a bucket's members come from many tasks, and go on to as many
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    sized = named.withColumn("salt", salt).join(sizes.select("*", salts), ["bucket", "salt"]).drop("salt")

    def side(rows: DataFrame, own: str, other: str, name: str, is_left: bool) -> DataFrame:
        block = F.pmod(F.xxhash64("node"), F.col(own)).cast("int").alias(name)
        all_ = F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias("j" if is_left else "i")
        return rows.select("bucket", "node", "root", F.lit(is_left).alias("is_left"), block, all_)

    both = side(sized.where("away"), "away_blocks", "blocks", "i", True).unionByName(
        side(sized, "blocks", "away_blocks", "j", False)
    )
    both = stage(both)
    tasks = F.lit(max(1, ceil_div(both.count(), TASK_ROWS)))
    shard = F.pmod(F.xxhash64("bucket", "i", "j"), tasks).cast("int").alias("shard")
    schema = "a bigint, b bigint"
    return stage(both.join(sets, "node").withColumn("shard", shard).groupBy("shard").applyInArrow(_settler(similar), schema))


def near_duplicate_classes(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """doc_id, content, class_id (the smallest id in the class) and first (one row of a class; copies of it too).

    One row per row of ``docs``. ``first`` marks the rows of the class's first
    id and text; only rows that are equal in both share it.
    """
    prints = stage(
        with_content(docs)
        .select("doc_id", "content", F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
        .mapInArrow(_sign, "doc_id bigint, content binary, bands array<bigint>")
    )
    nodes = stage(
        prints.groupBy("content")
        .agg(F.min("doc_id").alias("least"), F.any_value("bands").alias("bands"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    slots = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = slots.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("pivot")).where("size > 1")
    members = stage(slots.join(shared, "bucket"))

    asked = members.select("node").distinct().join(nodes.select("node", "content", "least"), "node")
    # one row of each text that shares a bucket
    own = with_content(docs).withColumnRenamed("content", "name")
    texts = own.join(asked, (own["name"] == asked["content"]) & own["doc_id"].eqNullSafe(asked["least"]))
    sets = stage(
        texts.select("node", F.transform(shingle_hashes(F.col("text")), lambda h: F.shiftright(h, 32).cast("int")).alias("shingles"))
        .select("node", F.array_distinct("shingles").alias("shingles"))
        .dropDuplicates(["node"])
    )
    star = members.where("node != pivot").select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    tested = _verified(star, sets)
    edges = tested.where(F.col("similarity") >= similar).select("a", "b")
    roots = components(edges)

    more = _links_between(_rooted(members, roots), roots, sets, similar)
    if not more.isEmpty():
        roots = components(edges.unionByName(more))

    rooted = nodes.join(roots, "node", "left").select("content", "least", F.coalesce("root", "node").alias("root"))
    head = F.min_by(F.struct("least", "content"), F.struct(F.col("least").isNull(), "least", "content"))
    heads = rooted.groupBy("root").agg(head.alias("head"))
    named = rooted.join(heads, "root").select("content", F.col("head.least").alias("class_id"), F.col("head.content").alias("lead"))
    # a NULL id leads only if the class has no other
    first = (F.col("content") == F.col("lead")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return prints.select("doc_id", "content").join(named, "content").select("doc_id", "content", "class_id", first.alias("first"))


def drop_near_duplicates(docs: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """One row of each class of ``docs``, with all its columns: that of the smallest id.

    Copies of a text are reduced to one row in each task before they move.
    """
    kept = near_duplicate_classes(docs, similar).where("first").select("content").distinct()
    row = F.col("_row")
    keyed = docs.select(F.struct(*docs.columns).alias("_row")).select(
        "_row", content_of(words(F.coalesce(row["text"], F.lit("")))).alias("content")
    )
    order = F.struct(row["doc_id"].isNull(), row["doc_id"])
    each = keyed.groupBy("content").agg(F.min_by("_row", order).alias("_row"))
    return each.join(stage(kept), "content", "left_semi").select("_row.*")
