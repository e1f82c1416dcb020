"""A log-bilinear language model of the corpus, and document scores from it.

The model predicts a token from the one before it. Tokens fall into classes:
the most frequent words and the end of a text are classes of their own, all
other words are classed by their last letters. The log-bilinear part gives

    log p(class | context) = q(context) . r(class) + b(class) - log Z(context)

with vectors q, r and biases b, and a word has its smoothed share of its class.
Both parts are normalised, so a score is a true log10 probability, with one
unseen word in each class of rare words.

Training sees all training texts, through counts: words by a shuffle, and pairs
of neighbouring classes, of which there is a bounded number (``CLASSES``
squared). Noise-contrastive estimation tells a pair that occurred from one whose
class is drawn from the class frequencies; with the pair counts at hand, its
objective is summed over all pairs and all noise instead of a sample. numpy
matrix products do the steps on the driver.

Scoring computes the normalised table of all contexts by batched products once
per worker. Counts of the ``FREQUENT`` most frequent words are broadcast, a
bounded table; those of the others are joined by word. These are rare words by
construction, so no key of the join is hot.

Odd rows: a NULL or empty text is its end token alone; NULL ids are not held
out; every row is scored, repeated or not; without training rows all words are
unseen and classes equally likely.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import whole_texts
from histkit.sources.tables import stage

#: Classes of single words (the end included) and of rare words.
WORD_CLASSES, RARE_CLASSES = 1024, 512
CLASSES = WORD_CLASSES + RARE_CLASSES
#: Words whose counts every worker gets, if they are no longer than this.
FREQUENT, LONGEST = 150_000, 64
#: Distinct words that a task counts before it passes them on.
COUNTED = 300_000
#: Size of the vectors, noise per pair, steps and step size of training.
SIZE, NOISE, STEPS, RATE = 32, 10.0, 150, 0.05
#: What holds rare contexts near the class frequencies: tokens drawn from these for each context, and shrinking vectors.
PRIOR, DECAY = 20.0, 1.0


def tokens(text: str) -> list[bytes]:
    """Words with A-Z in lower case; the end is not listed."""
    return text.encode().lower().split()


def rare_class(word: bytes) -> int:
    return WORD_CLASSES + zlib.crc32(word[-3:]) % RARE_CLASSES


# Training on counts


def noise_contrastive(pairs: np.ndarray, size: int = SIZE, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """q (contexts), r and b (classes) from the counts of (context, class).

    Adam on the whole objective; deterministic.
    """
    contexts, classes = pairs.shape
    rng = np.random.default_rng(0)
    share = ((pairs.sum(axis=0) + 0.5) / (pairs.sum() + 0.5 * classes)).astype(np.float32)
    counts = pairs + PRIOR * share
    total = counts.sum()
    seen = (counts / total).astype(np.float32)
    noise = NOISE * seen.sum(axis=1, keepdims=True) * share
    shift = np.log(NOISE * share)
    values = [
        (0.1 * rng.standard_normal((contexts, size))).astype(np.float32),
        (0.1 * rng.standard_normal((classes, size))).astype(np.float32),
        np.log(share),
    ]
    first = [np.zeros_like(v) for v in values]
    second = [np.zeros_like(v) for v in values]
    for step in range(1, steps + 1 if pairs.any() else 1):
        q, r, b = values
        true = 1 / (1 + np.exp(np.minimum(shift - b - q @ r.T, 80)))
        up = seen - (seen + noise) * true
        slopes = [up @ r - DECAY / total * q, up.T @ q - DECAY / total * r, up.sum(axis=0)]
        rate = RATE * min(1.0, 2 * (1 - (step - 1) / steps))
        for i, slope in enumerate(slopes):
            first[i] = 0.9 * first[i] + 0.1 * slope
            second[i] = 0.99 * second[i] + 0.01 * slope**2
            move = first[i] / (1 - 0.9**step) / (np.sqrt(second[i] / (1 - 0.99**step)) + 1e-9)
            values[i] = (values[i] + rate * move).astype(np.float32)
    return values[0], values[1], values[2]


@dataclass
class LogBilinear:
    """Everything a worker needs to score; its size has a bound."""

    frequent: dict  # word -> number
    counts: np.ndarray  # of the frequent words, and of the end at the last place
    classes: np.ndarray  # the same order
    rare: np.ndarray  # log10 of each class's denominator for words, 0 for classes of one word
    n_tokens: int
    n_distinct: int
    q: np.ndarray
    r: np.ndarray
    b: np.ndarray

    def table(self, batch: int = 256) -> np.ndarray:
        """log10 p(class | context), a row per context; the last context is the start."""
        rows = []
        for at in range(0, len(self.q), batch):
            s = (self.q[at : at + batch] @ self.r.T + self.b).astype(np.float64)
            s -= s.max(axis=1, keepdims=True)
            rows.append(((s - np.log(np.exp(s).sum(axis=1, keepdims=True))) / np.log(10)).astype(np.float32))
        return np.concatenate(rows)


# Passes over the texts


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word (NULL: the end) and count, of parts of a task."""

    def rows(found: Counter, ends: int) -> pa.RecordBatch:
        names = pa.array([*found, None], pa.binary())
        return pa.record_batch([names, pa.array([*found.values(), ends], pa.int64())], ["word", "n"])

    found, ends = Counter(), 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch.column(0).slice(at, 256).to_pylist():
                found.update(tokens(text))
                ends += 1
            if len(found) >= COUNTED:
                yield rows(found, ends)
                found, ends = Counter(), 0
    if ends:
        yield rows(found, ends)


def _class_totals(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tokens and distinct words of each class of rare words."""
        single = sent.value
        n, v = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for batch in batches:
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for word, count in pairs:
                if word not in single:
                    c = rare_class(word)
                    n[c] += count
                    v[c] += 1
        at = np.flatnonzero(v)
        yield pa.record_batch([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(v[at])], ["class", "n", "v"])

    return run


def _classes_of(words: list[bytes], frequent: dict, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Number (-1: rare) and class of each word, and the places of rare ones."""
    number = np.array([-1 if n is None else n for n in map(frequent.get, words)], np.int64)
    kind = classes[number]
    places = np.flatnonzero(number < 0).tolist()
    if places:
        kind[places] = [rare_class(words[i]) for i in places]
    return number, kind, places


def _pair_counts(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of (context, class) of a task, a row per context."""
        frequent, classes, end = sent.value
        pairs = np.zeros((CLASSES + 1) * CLASSES, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                keys = []
                for text in batch.column(0).slice(at, 256).to_pylist():
                    kind = np.append(_classes_of(tokens(text), frequent, classes)[1], end)
                    keys.append(np.append(CLASSES, kind[:-1]) * CLASSES + kind)
                pairs += np.bincount(np.concatenate(keys), minlength=len(pairs))
        pairs = pairs.reshape(CLASSES + 1, CLASSES)
        for context in np.flatnonzero(pairs.any(axis=1)):
            at = np.flatnonzero(pairs[context])
            lists = [pa.array([at.astype(np.int32)], pa.list_(pa.int32())), pa.array([pairs[context][at]], pa.list_(pa.int64()))]
            yield pa.record_batch([pa.array([context], pa.int32()), *lists], ["context", "classes", "n"])

    return run


def _sum_pairs(table: pa.Table) -> pa.Table:
    total = np.zeros(CLASSES, np.int64)
    for at, n in zip(table["classes"], table["n"], strict=True):
        total[np.asarray(at.values)] += np.asarray(n.values)
    at = np.flatnonzero(total)
    return pa.table(
        {
            "context": table["context"].slice(0, 1),
            "classes": pa.array([at.astype(np.int32)], pa.list_(pa.int32())),
            "n": pa.array([total[at]], pa.list_(pa.int64())),
        }
    )


_PARTS = "row bigint, doc_id bigint, held_out boolean, n_tokens bigint, known bigint, base double, score double, words array<binary>, times array<int>"


def _scorer(sent) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores but for the counts of rare words, which are listed."""
        model: LogBilinear = sent.value
        table, end = model.table(), len(model.counts) - 1
        log_counts = np.log10(model.counts + 0.5)
        # what a frequent word of a class with others adds to the score
        own = np.where(model.classes >= WORD_CLASSES, log_counts, 0.0)
        all_ = np.log10(model.n_tokens + 0.5 * (model.n_distinct + 1))
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n_tokens, known, base, score, words, times = [], [], [], [], [], []
                for text in part.column(3).to_pylist():
                    listed = tokens(text)
                    number, kind, places = _classes_of(listed, model.frequent, model.classes)
                    number, kind = np.append(number, end), np.append(kind, model.classes[end])
                    held = number[number >= 0]
                    n_tokens.append(len(number))
                    known.append(int((model.counts[held] > 0).sum()))
                    base.append(float(log_counts[held].sum() - len(number) * all_))
                    steps = table[np.append(CLASSES, kind[:-1]), kind].astype(np.float64)
                    score.append(float(steps.sum() - model.rare[kind].sum() + own[held].sum()))
                    found = Counter([listed[i] for i in places])
                    words.append(list(found))
                    times.append(list(found.values()))
                columns = [
                    pa.array(n_tokens, pa.int64()),
                    pa.array(known, pa.int64()),
                    pa.array(base, pa.float64()),
                    pa.array(score, pa.float64()),
                    pa.array(words, pa.list_(pa.binary())),
                    pa.array(times, pa.list_(pa.int32())),
                ]
                yield pa.record_batch([*part.columns[:3], *columns], [f.split()[0] for f in _PARTS.split(", ")])

    return run


# Fitting and scoring


def fit(docs: DataFrame) -> tuple[LogBilinear, DataFrame]:
    """The model of all rows of ``docs`` (column text), and its word counts (word, n; the end is NULL)."""
    context = docs.sparkSession.sparkContext
    texts = docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"))
    counts = stage(
        texts.mapInArrow(_count_words, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    )
    n_tokens, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = counts.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    known = counts.where("word IS NOT NULL")
    top = known.where(F.length("word") <= LONGEST).orderBy(F.col("n").desc(), "word").limit(FREQUENT).toArrow()
    names = top["word"].to_pylist()
    of_frequent = np.append(np.asarray(top["n"], np.int64), ends)
    classes = np.array([i if i < WORD_CLASSES - 1 else rare_class(w) for i, w in enumerate(names)] + [WORD_CLASSES - 1])
    frequent = {w: i for i, w in enumerate(names)}

    single = set(names[: WORD_CLASSES - 1])
    totals = (
        known.mapInArrow(_class_totals(context.broadcast(single)), "class int, n bigint, v bigint")
        .groupBy("class")
        .agg(F.sum("n").alias("n"), F.sum("v").alias("v"))
        .collect()
    )
    rare = np.zeros(CLASSES)
    rare[WORD_CLASSES:] = np.log10(0.5)
    for r in totals:
        rare[r["class"]] = np.log10(r["n"] + 0.5 * (r["v"] + 1))

    found = (
        texts.mapInArrow(
            _pair_counts(context.broadcast((frequent, classes, WORD_CLASSES - 1))),
            "context int, classes array<int>, n array<bigint>",
        )
        .groupBy("context")
        .applyInArrow(_sum_pairs, "context int, classes array<int>, n array<bigint>")
        .toArrow()
    )
    pairs = np.zeros((CLASSES + 1, CLASSES))
    for c, at, n in zip(found["context"].to_pylist(), found["classes"], found["n"], strict=True):
        pairs[c, np.asarray(at.values)] = np.asarray(n.values)
    q, r, b = noise_contrastive(pairs)
    return LogBilinear(frequent, of_frequent, classes, rare, n_tokens, n_distinct, q, r, b), counts


def score(docs: DataFrame, held_out: Column, model: LogBilinear, counts: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    source = whole_texts(docs).select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        held_out.alias("held_out"),
        "text",
    )
    parts = stage(source.mapInArrow(_scorer(sent), _PARTS))
    listed = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    of_row = (
        listed.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
        .join(counts.where("word IS NOT NULL"), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("log_counts"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    more = F.coalesce("log_counts", F.lit(0.0))
    return parts.drop("words", "times").join(of_row, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(model.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
