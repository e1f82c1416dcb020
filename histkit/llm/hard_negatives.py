"""Hard negatives by segment summaries.

A vector is cut into segments of four components, and each segment's mean and
deviation (the length of what is left when the mean is taken away) are stored
beside it. For two segments of n components the inner product lies within

    n * mean * mean'  -+  deviation * deviation'

so the sums of these over a pair's segments bound its score from both sides.
Segments of four are merged into segments of sixteen and sixty-four, whose
summaries follow from theirs. A pair is judged on the longest segments first; only
pairs that may still be wanted are judged on shorter ones, and what is left is
scored exactly. Summaries side by side make each of these steps a matrix product.

The anchors are searched against all rows in blocks: a chunk of anchors of bounded
size (``CHUNK_BYTES`` of vectors) is broadcast, the rows stream past it where they
are read, and a task keeps the best few rows for each question. The next chunk
takes the next pass. So that tasks do not all return rows that lose later, a first
pass over one row in ``SEED`` gives each question a score to beat; it only saves
work, all rows are looked at in the second.

1. Positives: each anchor asks for its best rows of its own label.
2. Negatives: each anchor and positive asks for the best rows of other labels in
   the window that the positive's score sets.

Scores are exact integers. Where the sum of products could pass 2^53, Python's
integers take over, and a score beyond 64 bits counts as the largest of its sign.

Odd rows: NULL labels or vectors, and NULL or non-finite components take no part, nor
do rows without an id. Of several rows with one id the first by label and vector
takes part. Shorter vectors end in zeros, so empty ones score 0 with all. A
positive with a negative score has an empty window. An anchor without positives,
or a positive without rows in its window, gives no rows; nor does an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histkit.llm.common import ceil_div, tidy
from histkit.llm.vectors import as_lists, is_finite, matrix, widened
from histkit.sources.tables import stage

POSITIVES, NEGATIVES = 5, 3
#: Components of the segments, longest first; each length divides the one before it.
SEGMENTS = (64, 16, 4)
#: Bytes of anchors that are broadcast at a time, and one row in how many gives the first scores to beat.
CHUNK_BYTES, SEED = 32 << 20, 64
#: Anchors and rows of a block of pairs.
ANCHORS, ROWS = 1024, 4096
#: Below this share of pairs left, pairs are taken one by one, else as a whole block.
SPARSE = 1 / 16
#: Candidates that a task holds before it drops those that have lost.
HELD = 200_000
LIMIT = 2**63 - 1

PREPARED = "vec_id bigint, label int, vector array<double>, means array<double>, deviations array<double>"
FOUND = "question bigint, vec_id bigint, score bigint"


def _finest(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of the shortest segments."""
    n = SEGMENTS[-1]
    whole = widened(vectors, ceil_div(max(1, vectors.shape[1]), SEGMENTS[0]) * SEGMENTS[0])
    parts = whole.reshape(len(whole), whole.shape[1] // n, n)
    means = parts.mean(axis=2)
    return means, np.sqrt(((parts - means[:, :, None]) ** 2).sum(axis=2))


def _merged(means: np.ndarray, deviations: np.ndarray, n: int, into: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments of ``into`` components from those of ``n``."""
    k = into // n
    m, d = (x.reshape(len(x), x.shape[1] // k, k) for x in (means, deviations))
    mean = m.mean(axis=2)
    return mean, np.sqrt((d**2).sum(axis=2) + n * ((m - mean[:, :, None]) ** 2).sum(axis=2))


class Summaries:
    """Vectors with their summaries of each length, ready for matrix products."""

    def __init__(self, vectors: np.ndarray, means: np.ndarray, deviations: np.ndarray):
        self.vectors = vectors
        self.size = np.sqrt((vectors**2).sum(axis=1))
        self.levels = []
        for n in SEGMENTS:
            mean, deviation = _merged(means, deviations, SEGMENTS[-1], n)
            self.levels.append((mean * np.sqrt(n), deviation))

    def take(self, rows) -> Summaries:
        out = object.__new__(Summaries)
        out.vectors, out.size = self.vectors[rows], self.size[rows]
        out.levels = [(m[rows], d[rows]) for m, d in self.levels]
        return out

    def padded(self, width: int) -> Summaries:
        """The same, as vectors of ``width`` components."""
        out = object.__new__(Summaries)
        out.size, out.vectors = self.size, widened(self.vectors, width)
        segments = ceil_div(max(1, width), SEGMENTS[0]) * SEGMENTS[0]
        out.levels = [(widened(m, segments // n), widened(d, segments // n)) for n, (m, d) in zip(SEGMENTS, self.levels)]
        return out


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            vectors = np.floor(256.0 * matrix(batch.column("vector")))
            means, deviations = _finest(vectors)
            columns = [batch.column("vec_id"), batch.column("label"), as_lists(vectors), as_lists(means), as_lists(deviations)]
            yield pa.record_batch(columns, names=["vec_id", "label", "vector", "means", "deviations"])


def prepared(rows: DataFrame, label: Column) -> DataFrame:
    """The rows that take part, as integers, with their summaries."""
    order = Window.partitionBy("vec_id").orderBy("label", "vector")
    usable = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite(F.col("embedding")))
    one_each = (
        usable.select("vec_id", label.cast("int").alias("label"), F.col("embedding").cast("array<double>").alias("vector"))
        .withColumn("_n", F.row_number().over(order))
        .where("_n = 1")
        .drop("_n")
    )
    return stage(one_each.mapInArrow(tidy(_prepare), PREPARED))


def _exact(a: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Inner products of integers, row with row; as Python's integers, cut to 64 bits."""
    out = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, r)]
    return np.array([max(-LIMIT, min(LIMIT, x)) for x in out], np.int64)


class Questions:
    """For each anchor its questions: a window of scores and the score to beat so far."""

    def __init__(self, question, anchor, low, high, floor):
        order = np.argsort(anchor, kind="stable")
        self.question, self.anchor = question[order], anchor[order]
        self.low, self.high, self.floor = low[order], high[order], floor[order]

    def widest(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The least and the largest score that any question of each of ``n`` anchors can use."""
        least, most = np.full(n, np.inf), np.full(n, -np.inf)
        np.minimum.at(least, self.anchor, np.maximum(self.low, self.floor).astype(np.float64))
        np.maximum.at(most, self.anchor, self.high.astype(np.float64))
        return least, most


def _pairs(a: Summaries, r: Summaries, wanted: np.ndarray, least: np.ndarray, most: np.ndarray):
    """The pairs of a block that may score within an anchor's limits, and their exact scores."""
    slack = 1e-9 * (1 + np.outer(a.size, r.size))
    exact = a.size.max(initial=0) * r.size.max(initial=0) < 2.0**52
    left = wanted
    for level, ((am, ad), (rm, rd)) in enumerate(zip(a.levels, r.levels)):
        if left.mean() < SPARSE:
            break
        middle, reach = am @ rm.T, ad @ rd.T + slack
        left = left & (middle + reach >= least[:, None]) & (middle - reach <= most[:, None])
    else:
        level = len(a.levels)
    if exact and left.mean() >= SPARSE:
        ia, ir = np.nonzero(left)
        return ia, ir, (a.vectors @ r.vectors.T)[ia, ir].astype(np.int64)
    ia, ir = np.nonzero(left)
    for (am, ad), (rm, rd) in zip(a.levels[level:], r.levels[level:]):
        middle = np.einsum("ij,ij->i", am[ia], rm[ir])
        reach = np.einsum("ij,ij->i", ad[ia], rd[ir]) + slack[ia, ir]
        keep = (middle + reach >= least[ia]) & (middle - reach <= most[ia])
        ia, ir = ia[keep], ir[keep]
    if exact:
        return ia, ir, np.einsum("ij,ij->i", a.vectors[ia], r.vectors[ir]).astype(np.int64)
    return ia, ir, _exact(a.vectors[ia], r.vectors[ir])


def _first(question: np.ndarray, vec_id: np.ndarray, score: np.ndarray, k: int):
    """The ``k`` best rows of each question, best first."""
    order = np.lexsort((vec_id, -score, question))
    question, vec_id, score = question[order], vec_id[order], score[order]
    starts = np.flatnonzero(np.diff(question, prepend=-1))
    place = np.arange(len(question)) - np.repeat(starts, np.diff(np.append(starts, len(question))))
    return question[place < k], vec_id[place < k], score[place < k]


def _searcher(chunk, k: int, same: bool):
    """Stream rows past a chunk of anchors; returns the task's ``k`` best rows of each question."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, packed, asked = chunk.value
        anchors, asked = Summaries(*packed), Questions(*asked)
        starts = np.searchsorted(asked.anchor, np.arange(len(ids) + 1))
        # while rows are held a question goes by its place in ``asked``
        held, fresh = (np.zeros(0, np.int64),) * 3, []

        def settle():
            nonlocal held, fresh
            held = _first(*[np.concatenate(parts) for parts in zip(held, *fresh)], k)
            full = np.bincount(held[0], minlength=len(asked.floor)) == k
            last = np.full(len(full), LIMIT)
            np.minimum.at(last, held[0], held[2])
            asked.floor[full] = np.maximum(asked.floor[full], last[full])
            fresh = []

        for batch in batches:
            if not batch.num_rows:
                continue
            everything = [matrix(batch.column(c)) for c in ("vector", "means", "deviations")]
            row_ids, row_labels = (batch.column(c).to_numpy() for c in ("vec_id", "label"))
            rows = Summaries(*everything)
            width = max(rows.vectors.shape[1], anchors.vectors.shape[1])
            rows, anchors = rows.padded(width), anchors.padded(width)
            for r0 in range(0, len(row_ids), ROWS):
                part, part_ids = rows.take(slice(r0, r0 + ROWS)), row_ids[r0 : r0 + ROWS]
                part_labels = row_labels[r0 : r0 + ROWS]
                least, most = asked.widest(len(ids))
                for a0 in range(0, len(ids), ANCHORS):
                    own = slice(a0, a0 + ANCHORS)
                    wanted = (labels[own][:, None] == part_labels) == same
                    wanted &= ids[own][:, None] != part_ids
                    ia, ir, score = _pairs(anchors.take(own), part, wanted, least[own], most[own])
                    # a pair answers each question of its anchor whose window it hits
                    n = (starts[1:] - starts[:-1])[ia + a0]
                    pair = np.repeat(np.arange(len(ia)), n)
                    q = np.repeat(starts[ia + a0] - np.cumsum(n) + n, n) + np.arange(n.sum())
                    s = score[pair]
                    hit = (s >= asked.low[q]) & (s <= asked.high[q]) & (s >= asked.floor[q])
                    fresh.append((q[hit], part_ids[ir[pair[hit]]], s[hit]))
                    if sum(len(f[0]) for f in fresh) > HELD:
                        settle()
                        least, most = asked.widest(len(ids))
        settle()
        yield pa.record_batch(
            [pa.array(asked.question[held[0]]), pa.array(held[1]), pa.array(held[2])], names=["question", "vec_id", "score"]
        )

    return tidy(search)


def _best(found: DataFrame, k: int) -> DataFrame:
    """Question, rank, row and score of the best ``k`` over all tasks."""
    order = Window.partitionBy("question").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _ask(rows: DataFrame, anchors, questions, k: int, same: bool) -> DataFrame:
    """Answers to ``questions`` (question, anchor's place, low, high) of a chunk of anchors among all rows.

    What is collected and broadcast is the chunk's and at most ``k`` rows for each of its questions.
    """
    context = rows.sparkSession.sparkContext
    numbers, place, low, high = questions
    floor = np.full(len(numbers), -LIMIT)

    def over(some: DataFrame) -> DataFrame:
        chunk = context.broadcast((*anchors, (numbers, place, low, high, floor)))
        columns = ["vec_id", "label", "vector", "means", "deviations"]
        return _best(some.select(*columns).mapInArrow(_searcher(chunk, k, same), FOUND), k)

    first = over(rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(SEED)) == 0)).where(F.col("rank") == k)
    known = first.select("question", "score").toArrow()
    at = dict(zip(known.column("question").to_pylist(), known.column("score").to_pylist()))
    floor = np.array([at.get(int(q), -LIMIT) for q in numbers], np.int64)
    return over(rows)


def hard_negatives(
    rows: DataFrame,
    label: Column | None = None,
    anchor_every: int = 50,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    low_share: int = 50,
    high_share: int = 95,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """For each anchor (``vec_id`` divisible by ``anchor_every``) and positive its hard negatives.

    ``rows`` has vec_id, label and embedding; ``label`` may name another label.
    A positive of score p allows negatives whose score is from ``low_share`` to
    ``high_share`` hundredths of p. Returns anchor_id, positive_id, rank,
    negative_id, positive_score, negative_score.
    """
    table = prepared(rows, F.col("label") if label is None else label)
    anchors = table.where(F.col("vec_id") % anchor_every == 0)
    n, width = anchors.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    # vectors, summaries, and questions for each
    chunks = max(1, ceil_div(n * (max(1, width) * 12 + 40 * (1 + n_positives)), chunk_bytes))
    out = None
    for c in range(chunks):
        own = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(chunks)) == c).toArrow()
        ids, labels = own.column("vec_id").to_numpy(), own.column("label").to_numpy()
        packed = tuple(matrix(own.column(name)) for name in ("vector", "means", "deviations"))
        place, everything = np.arange(len(ids)), np.full(len(ids), LIMIT)
        asked = (ids, place, -everything, everything)
        positives = stage(_ask(table, (ids, labels, packed), asked, n_positives, same=True))
        negatives = stage(_negatives(table, (ids, labels, packed), positives, n_negatives, low_share, high_share))
        out = negatives if out is None else out.unionByName(negatives)
    return out


def _negatives(table: DataFrame, anchors, positives: DataFrame, k: int, low_share: int, high_share: int) -> DataFrame:
    """Negatives of each positive of a chunk; positives of one anchor and score ask once."""
    ids = anchors[0]
    windows = positives.where("score >= 0").select("question", "score").distinct().toArrow()
    anchor, score = (windows.column(c).to_numpy() for c in ("question", "score"))
    order = np.argsort(ids, kind="stable")
    place = order[np.searchsorted(ids[order], anchor)]
    low = np.array([ceil_div(low_share * int(p), 100) for p in score], np.int64)
    high = np.array([high_share * int(p) // 100 for p in score], np.int64)
    numbers = np.arange(len(anchor))
    found = _ask(table, anchors, (numbers, place, low, high), k, same=False)
    schema = "question bigint, anchor_id bigint, positive_score bigint"
    rows = zip(numbers.tolist(), anchor.tolist(), score.tolist())
    named = table.sparkSession.createDataFrame(list(rows), schema)
    negatives = found.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"}).join(named, "question")
    owners = positives.select(
        F.col("question").alias("anchor_id"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    return negatives.join(owners, ["anchor_id", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
