"""Toxicity scores: boosted trees over dense features, calibrated.

Features of a text (nothing but the text is used):

- lexicon densities: words, and word stems, that training rows marked toxic use
  far more often than others; how many, how different, how strong
- how near to a second-person word the lexicon's words stand
- capitals, punctuation, words in capitals, repeated marks
- obfuscation: digits or signs inside words, drawn-out letters, and lexicon
  words that appear once these are undone

The model is fitted on at most ``SAMPLE`` labelled rows, those with the smallest
hash of their id (a documented bound; scoring covers every row). The lexicon is
learned by Spark over that sample and cross-fitted: a row's training features
come from the lexicon of the other folds, so trees learn how far to trust it.
Trees are gradient boosted on histograms with logistic loss; their scores of
left-out folds are calibrated by isotonic regression. What is broadcast is the
lexicon (at most ``TERMS`` terms) and the trees.

Odd rows: a NULL or empty text has all features 0 and gets the score these
have; labels that are NULL are not used, of several labels of one id the larger
counts; without labels of both kinds every score is the share of toxic labels;
a NULL id is never held out, and repeated rows get the same score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from histkit.llm.common import tidy, whole_texts
from histkit.sources.tables import stage

#: Labelled rows that a model is fitted on, terms of its lexicon, folds.
SAMPLE = 24_000
TERMS = 20_000
FOLDS = 3
#: A term needs this many toxic rows and this log ratio; stems have so many letters.
LEAST_ROWS = 3
LEAST_RATIO = 1.5
STEMS = (4, 5, 6)
THRESHOLD = 0.7
KEPT_WORDS = 150_000
#: A lexicon word so many words from a second-person word is near it.
NEAR = 5

# Second-person words of the corpus's languages, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner deinem ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros vuestro".split()
)
LOOKALIKE = str.maketrans("013457@$!|+", "oieastasiit")

_LETTERS = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"[^\W\d_][\d@$!|+*#._-]+[^\W\d_]")
_DRAWN = re.compile(r"(\w)\1\1")

FEATURES = (
    "hits strength strong stem_hits second_person capital_words hidden drawn hidden_hits "
    "terms best near capitals digits exclaims asks marks repeats words letters"
).split()
_PER_WORD = 9


def held_out(key: Column, modulus: int) -> Column:
    """Whether crc32 of the id's text leaves 1."""
    return F.coalesce(F.crc32(key.cast("string")) % modulus == 1, F.lit(False))


def terms_of(word: str) -> list[str]:
    """What the lexicon may hold for a word: itself, and its stems ("vers*")."""
    plain = "".join(_LETTERS.findall(word.lower()))
    return [plain, *[plain[:n] + "*" for n in STEMS if len(plain) > n]] if plain else []


def _undone(word: str) -> str:
    return _DRAWN.sub(r"\1", word.lower().strip(".,;:!?\"'()").translate(LOOKALIKE))


class Features:
    """Dense features of texts under one lexicon."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon = lexicon
        self.kept: dict[str, int] = {"": 0}
        self.numbers: dict[tuple, int] = {(0.0,) * _PER_WORD + ("",): 0}
        self.rows = [(0.0,) * _PER_WORD]
        self.term = [""]

    def _best(self, word: str) -> tuple[float, str]:
        return max(((self.lexicon.get(t, 0.0), t) for t in terms_of(word)), default=(0.0, ""))

    def _profile(self, word: str) -> int:
        strength, term = self._best(word)
        hidden = bool(_HIDDEN.search(word))
        drawn = bool(_DRAWN.search(word))
        undone = self._best(_undone(word))[0] if hidden or drawn else 0.0
        letters = "".join(_LETTERS.findall(word))
        row = (
            float(strength > 0),
            strength,
            float(strength >= 3),
            float(strength > 0 and term.endswith("*")),
            float(letters.lower() in SECOND_PERSON),
            float(len(letters) > 2 and letters.isupper()),
            float(hidden),
            float(drawn),
            float(undone > 0),
        )
        key = (*row, term if strength else "")
        if key not in self.numbers:
            self.numbers[key] = len(self.rows)
            self.rows.append(row)
            self.term.append(key[-1])
        return self.numbers[key]

    def _numbers(self, words: list[str]) -> np.ndarray:
        kept = self.kept
        try:
            return np.fromiter(map(kept.__getitem__, words), np.int64, len(words))
        except KeyError:
            out = []
            for w in words:
                n = kept.get(w)
                if n is None:
                    n = self._profile(w)
                    if len(kept) < KEPT_WORDS and len(w) <= 32:
                        kept[w] = n
                out.append(n)
            return np.array(out, np.int64)

    def of(self, text: str) -> np.ndarray:
        words = text.split()
        out = np.zeros(len(FEATURES))
        if not words:
            return out
        numbers = self._numbers(words)
        n = len(words)
        used, times = np.unique(numbers, return_counts=True)
        if used[-1]:
            rows = np.array([self.rows[i] for i in used])
            out[:_PER_WORD] = times @ rows / n
            found = [self.term[i] for i in used if self.rows[i][0]]
            if found:
                out[9] = len(set(found))
                out[10] = rows[:, 1].max()
                marked = {i for i in used.tolist() if self.rows[i][0]}
                person = {i for i in used.tolist() if self.rows[i][4]}
                if person:
                    at = np.flatnonzero(np.isin(numbers, list(marked)))
                    you = np.flatnonzero(np.isin(numbers, list(person)))
                    right = np.searchsorted(you, at)
                    gap = np.minimum(
                        np.abs(at - you[np.minimum(right, len(you) - 1)]), np.abs(at - you[np.maximum(right - 1, 0)])
                    )
                    out[11] = (gap <= NEAR).mean()
        seen = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=128)[:128]
        size = max(1, len(text))
        out[12] = seen[65:91].sum() / size
        out[13] = seen[48:58].sum() / size
        out[14] = seen[33] / n
        out[15] = seen[63] / n
        out[16] = (seen[33:48].sum() + seen[58:65].sum()) / size
        out[17] = (text.count("!!") + text.count("??")) / n
        out[18] = np.log1p(n)
        out[19] = size / n
        return out


# Trees


@dataclass
class Boosted:
    """Gradient-boosted trees of equal depth over binned features, logistic loss."""

    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 32
    ridge: float = 1.0
    least: float = 1.0
    base: float = 0.0
    cuts: list = field(default_factory=list)
    trees: list = field(default_factory=list)

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(self.cuts)]).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        share = min(max(y.mean(), 1e-6), 1 - 1e-6) if len(y) else 0.5
        self.base = float(np.log(share / (1 - share)))
        self.trees = []
        if not 0 < y.sum() < len(y):
            return self
        marks = np.linspace(0, 1, self.bins + 1)[1:-1]
        self.cuts = [np.unique(np.concatenate([np.quantile(x[:, j], marks), [0.0]])) for j in range(x.shape[1])]
        binned, width = self._binned(x), max(len(c) for c in self.cuts) + 1
        raw = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-raw))
            g, h = y - p, p * (1 - p)
            node = np.zeros(len(y), np.int64)
            splits = []
            for level in range(self.depth):
                nodes = 1 << level
                best = np.full(nodes, 1e-9)
                split = np.full((nodes, 2), [0, width])  # none: all go left
                for j in range(x.shape[1]):
                    key = node * width + binned[:, j]
                    gs = np.bincount(key, g, nodes * width).reshape(nodes, width).cumsum(axis=1)
                    hs = np.bincount(key, h, nodes * width).reshape(nodes, width).cumsum(axis=1)
                    gr, hr = gs[:, -1:] - gs, hs[:, -1:] - hs
                    whole = gs[:, -1:] ** 2 / (hs[:, -1:] + self.ridge)
                    gain = gs**2 / (hs + self.ridge) + gr**2 / (hr + self.ridge) - whole
                    gain[(hs < self.least) | (hr < self.least)] = 0
                    at = gain.argmax(axis=1)
                    value = gain[np.arange(nodes), at]
                    better = value > best
                    best[better] = value[better]
                    split[better, 0], split[better, 1] = j, at[better]
                splits.append(split)
                node = node * 2 + (binned[np.arange(len(y)), split[node, 0]] > split[node, 1])
            leaves = 1 << self.depth
            value = np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge) * self.rate
            raw += value[node]
            self.trees.append((splits, value))
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if self.trees and len(x):
            binned, row = self._binned(x), np.arange(len(x))
            for splits, value in self.trees:
                node = np.zeros(len(x), np.int64)
                for split in splits:
                    node = node * 2 + (binned[row, split[node, 0]] > split[node, 1])
                out += value[node]
        return out


def isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: rising (raw, share) points of the best monotone fit."""
    places, first = np.unique(raw, return_inverse=True)
    weight = np.bincount(first).astype(float)
    mean = np.bincount(first, y) / weight
    pools: list[list[float]] = []  # mean, weight, first place, last place
    for i, (m, w) in enumerate(zip(mean, weight, strict=True)):
        pools.append([m, w, i, i])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            m2, w2, _, last = pools.pop()
            m1, w1, start, _ = pools.pop()
            pools.append([(m1 * w1 + m2 * w2) / (w1 + w2), w1 + w2, start, last])
    at = np.array([places[int(k)] for p in pools for k in (p[2], p[3])])
    return at, np.array([p[0] for p in pools for _ in range(2)])


@dataclass
class ToxicityModel:
    lexicon: dict
    trees: Boosted
    at: np.ndarray
    share: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Calibrated; a thousandth of the raw score orders what calibration pools."""
        raw = self.trees.raw(x)
        plain = 1 / (1 + np.exp(-raw))
        fitted = np.interp(raw, self.at, self.share) if len(self.at) else plain
        return np.clip(0.999 * fitted + 0.001 * plain, 0, 1)


# Fitting and scoring with Spark


def _ratio(toxic, clean, n_toxic, n_clean):
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


@tidy
def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """term, fold, toxic rows, clean rows of each batch."""
    for batch in batches:
        counts: dict[tuple, list[int]] = {}
        for text, toxic, fold in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            for term in {t for w in set(text.split()) for t in terms_of(w)}:
                counts.setdefault((term, fold), [0, 0])[0 if toxic else 1] += 1
        keys = list(counts)
        yield pa.record_batch(
            [
                pa.array([k[0] for k in keys], pa.string()),
                pa.array([k[1] for k in keys], pa.int32()),
                pa.array([counts[k][0] for k in keys], pa.int64()),
                pa.array([counts[k][1] for k in keys], pa.int64()),
            ],
            ["term", "fold", "toxic", "clean"],
        )


def _lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """A lexicon without each fold, and one of all folds."""
    sizes = np.zeros((FOLDS, 2))
    for r in sample.groupBy("fold", "toxic").count().collect():
        sizes[r["fold"], 0 if r["toxic"] else 1] = r["count"]
    n_toxic, n_clean = sizes.sum(axis=0)
    counted = sample.select("text", "toxic", "fold").mapInArrow(
        _count_terms, "term string, fold int, toxic bigint, clean bigint"
    )
    by_fold = [
        F.sum(F.when(F.col("fold") == k, F.col(c)).otherwise(0)).alias(f"{c}{k}")
        for c in ("toxic", "clean")
        for k in range(FOLDS)
    ]
    toxic = sum(F.col(f"toxic{k}") for k in range(FOLDS))
    clean = sum(F.col(f"clean{k}") for k in range(FOLDS))
    ratio = F.log((toxic + 0.5) / (n_toxic + 1)) - F.log((clean + 0.5) / (n_clean + 1))
    rows = (
        counted.groupBy("term")
        .agg(*by_fold)
        .where((toxic >= LEAST_ROWS) & (ratio >= LEAST_RATIO))
        .orderBy((toxic * ratio).desc(), "term")
        .limit(TERMS)
        .collect()
    )
    out = []
    for left in [*range(FOLDS), None]:
        ks = [k for k in range(FOLDS) if k != left]
        a, b = sizes[ks].sum(axis=0)
        lexicon = {}
        for r in rows:
            t, c = sum(r[f"toxic{k}"] for k in ks), sum(r[f"clean{k}"] for k in ks)
            weight = float(_ratio(t, c, a, b))
            if t >= LEAST_ROWS and weight >= LEAST_RATIO:
                lexicon[r["term"]] = weight
        out.append(lexicon)
    return out


def fit(docs: DataFrame, labels: DataFrame, usable: Column | None = None, sample: int = SAMPLE) -> ToxicityModel:
    """Fit on labelled rows (doc_id, toxic) of ``docs`` that are ``usable``, a condition on doc_id."""
    spark = docs.sparkSession
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    if usable is not None:
        known = known.where(usable)
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64("doc_id")
    chosen = known.orderBy(order, "doc_id").limit(sample)
    rows = stage(
        whole_texts(docs)
        .join(F.broadcast(chosen), "doc_id")
        .select(
            "text",
            (F.col("toxic") > 0).cast("int").alias("toxic"),
            F.pmod(F.shiftright(F.xxhash64("doc_id"), 8), F.lit(FOLDS)).cast("int").alias("fold"),
        )
    )
    lexicons = _lexicons(rows)
    sent = spark.sparkContext.broadcast(lexicons)

    @tidy
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        makers = [Features(x) for x in sent.value[:FOLDS]]
        for batch in batches:
            text, toxic, fold = batch.columns
            found = [makers[k].of(t).tolist() for t, k in zip(text.to_pylist(), fold.to_pylist(), strict=True)]
            yield pa.record_batch([toxic, fold, pa.array(found, pa.list_(pa.float64()))], ["toxic", "fold", "x"])

    got = rows.select("text", "toxic", "fold").mapInArrow(features, "toxic int, fold int, x array<double>").toArrow()
    y = np.asarray(got["toxic"], float)
    fold = np.asarray(got["fold"])
    x = np.asarray(got["x"].combine_chunks().flatten()).reshape(-1, len(FEATURES)) if len(y) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T, y, fold))  # the rows' order follows the partitions; the model must not
    x, y, fold = x[order], y[order], fold[order]
    trees = Boosted().fit(x, y)
    if not trees.trees:
        return ToxicityModel(lexicons[-1], trees, np.zeros(0), np.zeros(0))
    raw = np.zeros(len(y))
    for k in range(FOLDS):
        raw[fold == k] = Boosted().fit(x[fold != k], y[fold != k]).raw(x[fold == k])
    return ToxicityModel(lexicons[-1], trees, *isotonic(raw, y))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``row``, a struct of all columns of ``docs``, and ``score``. Rows do not move."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    row = docs.select(F.struct(*docs.columns).alias("row"))
    schema = T.StructType([row.schema["row"], T.StructField("score", T.DoubleType())])

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Features(sent.value.lexicon)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                texts = pc.struct_field(part.column(0), "text").to_pylist()
                x = np.array([maker.of(t or "") for t in texts])
                yield pa.record_batch([part.column(0), pa.array(sent.value.scores(x), pa.float64())], ["row", "score"])

    return row.mapInArrow(run, schema)
