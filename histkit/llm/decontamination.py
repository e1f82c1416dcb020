"""Benchmark decontamination: BM25 over test items with block maxima.

The test items are the indexed side. Items longer than ``SEGMENT`` words are
indexed in segments of that length, the last of which overlaps the one before.
A posting's weight is its BM25 weight in the segment divided by the segment's
own total, so a passage that holds all of a segment scores 1 and one threshold
holds for all. Postings are kept by blocks of ``BLOCK``
items with the largest weight of a term in each block.

Every passage of every document is a query. Passages are ``2 * SEGMENT`` words
long and begin every ``SEGMENT`` words, so each segment that a document repeats
lies whole in one. As in block-max WAND, the maxima of a passage's terms give
an upper bound for each block; blocks below the threshold are passed over, the
segments of the others are scored, and all that reach the threshold are retrieved.
This is done for many passages at a time with array operations.

A question can have less than half of its item's weight. So the word runs of
questions are a second index, in the same way, with weights that are shares of
the runs of a segment; a passage that has as much of a question as verification
asks for is retrieved by it, whatever the answer. A question of fewer than
``ALONE`` words counts without its answer only if the item's weight is reached.

Segments only retrieve. What is verified is the whole item, on the words: the
share of its question's and of its answer's word runs that the passage has, or,
if the item is longer than a segment, that the document has around the passages
in which segments were found. The last sentence of an item counts as its answer,
the rest as its question.

The index is made and broadcast in shards of a fixed size; a benchmark too large for
one is split, and the documents are read once for each. Documents do not move. Bounds
are held for a slice of the passages at a time, so a long text and a full shard need
no more room than short ones.

Odd rows: NULL and empty texts (of documents or items) match nothing; an item
id that occurs twice is two items under one id; repeated documents get a row
each; words are compared without case and punctuation.
"""

from __future__ import annotations

import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import ceil_div, tidy, whole_texts
from histkit.sources.tables import stage

SEGMENT = 64
BLOCK = 4
#: Share of an item's BM25 weight that a passage must have to be retrieved.
THRESHOLD = 0.5
K1, B = 1.2, 0.75
#: Word runs of this length are compared when an item is verified.
RUN = 4
#: Verified if the question overlaps this much, or less with as much of the answer.
QUESTION = 0.7
QUESTION_WITH_ANSWER = 0.5
ANSWER = 0.5
#: Words from which a question says enough to count alone.
ALONE = 8
#: Text of the items in one index, in bytes.
INDEX_BYTES = 16 << 20
#: Words of documents that are matched together, and bounds of (passage, block) at a time.
BATCH_WORDS = 200_000
CELLS = 4 << 20
#: Bytes of a packed index in one row.
PIECE = 8 << 20

_WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of question and answer; an item of one sentence is all question."""
    parts = [p for p in (words_of(s) for s in re.split(r"(?<=[.!?])\s+|\n", text)) if p]
    if len(parts) < 2:
        return (parts[0] if parts else []), []
    return [w for p in parts[:-1] for w in p], parts[-1]


def _runs(words: list[str], n: int) -> set[tuple]:
    n = min(n, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()


def _run_numbers(numbers: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit number of the run of n words at each place, 0 where a word is unknown (0)."""
    size = max(0, len(numbers) - n + 1)
    out, known = np.full(size, n, np.uint64), np.ones(size, bool)
    for k in range(n):
        part = numbers[k : k + size]
        out = (out ^ part.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        known &= part > 0
    return np.where(known, out | np.uint64(1), np.uint64(0))


def overlap(item: list[str], passage: list[str]) -> float:
    """Share of the item's word runs that the passage has."""
    own = _runs(item, RUN)
    return len(own & _runs(passage, min(RUN, len(item)))) / len(own) if own else 0.0


@dataclass
class Index:
    """Items, and the postings of their segments by block."""

    ids: list  # of the items
    questions: list
    answers: list
    shares: list  # word -> share of the item's weight
    item_of: list  # item of each segment
    runs: Index | None  # of the questions' word runs; its terms are sorted numbers of runs
    lengths: list  # of these runs
    terms: dict  # word -> number from 1
    starts: np.ndarray  # of each term's blocks
    blocks: np.ndarray
    maxima: np.ndarray
    weights: dict  # block -> (terms, dense weights of its segments)

    @staticmethod
    def build(items: list[tuple], n_items: int, frequency: dict[str, int], mean_length: float) -> Index:
        """``items``: (id, text). Statistics cover all shards of the benchmark."""
        ids, questions, answers, shares, item_of, segments = [], [], [], [], [], []

        def weigh(own: list[str]) -> dict[str, float]:
            scale = K1 * (1 - B + B * len(own) / max(1.0, mean_length))
            weight = {
                w: math.log1p((n_items - frequency[w] + 0.5) / (frequency[w] + 0.5)) * c * (K1 + 1) / (c + scale)
                for w, c in Counter(own).items()
            }
            total = sum(weight.values())
            return {w: v / total for w, v in weight.items()}

        for key, text in items:
            question, answer = split_item(text)
            whole = question + answer
            if not whole:
                continue
            ids.append(key)
            questions.append(question)
            answers.append(answer)
            shares.append(weigh(whole))
            last = max(0, len(whole) - SEGMENT)
            for at in (*range(0, last, SEGMENT), last):
                item_of.append(len(ids) - 1)
                segments.append(weigh(whole[at : at + SEGMENT]) if last else shares[-1])
        terms: dict[str, int] = {}
        rows = [(terms.setdefault(w, len(terms) + 1), n, v) for n, own in enumerate(segments) for w, v in own.items()]
        posted = Index._post(rows, len(segments))
        run_rows, run_items, found, lengths = [], [], {}, set()
        for item, question in enumerate(questions):
            n = min(RUN, len(question))
            lengths.add(n)
            own = _run_numbers(np.array([terms[w] for w in question], np.int64), n).tolist()
            first = {r: at for at, r in reversed(list(enumerate(own)))}  # a run belongs to the segment where it comes first
            pieces: dict[int, list] = {}
            for r, at in first.items():
                pieces.setdefault(at // (SEGMENT - RUN + 1), []).append(r)
            for piece in pieces.values():
                run_rows += [(found.setdefault(r, len(found) + 1), len(run_items), 1 / len(piece)) for r in piece]
                run_items.append(item)
        runs = Index([], [], [], [], run_items, None, [], found, *Index._post(run_rows, len(run_items)))
        return Index(ids, questions, answers, shares, item_of, runs, sorted(lengths), terms, *posted)

    @staticmethod
    def _post(rows: list[tuple], n_segments: int) -> tuple:
        """starts, blocks, maxima and weights of (term, segment, weight)."""
        postings = np.array(rows or np.zeros((0, 3)), float).reshape(-1, 3)
        n_terms = int(postings[:, 0].max()) if len(postings) else 0
        term, item, value = postings[:, 0].astype(np.int64), postings[:, 1].astype(np.int64), postings[:, 2]
        block = item // BLOCK
        n_blocks = ceil_div(n_segments, BLOCK) if n_segments else 0
        key, at = np.unique(term * max(1, n_blocks) + block, return_inverse=True)
        maxima = np.zeros(len(key))
        np.maximum.at(maxima, at, value)
        weights = {}
        by_block = np.lexsort((term, block))
        ends = np.searchsorted(block[by_block], np.arange(n_blocks + 1))
        for b in range(n_blocks):
            mine = by_block[ends[b] : ends[b + 1]]
            own, at = np.unique(term[mine], return_inverse=True)
            dense = np.zeros((len(own), BLOCK))
            dense[at, item[mine] % BLOCK] = value[mine]
            weights[b] = (own, dense)
        starts = np.searchsorted(key // max(1, n_blocks), np.arange(n_terms + 2))
        return starts, key % max(1, n_blocks), maxima, weights

    def retrieve(self, terms: np.ndarray, passage: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
        """(passage, segment, score) of all that reach ``threshold``.

        ``terms`` and ``passage`` say which known term occurs in which passage,
        each pair once, in order of passage.
        """
        n_blocks = len(self.weights)
        if not len(terms) or not n_blocks:
            return []
        n_passages = int(passage[-1]) + 1
        first = np.searchsorted(passage, np.arange(n_passages + 1))
        found = []
        # as many passages at a time as their bounds may take room
        for low in range(0, n_passages, max(1, CELLS // n_blocks)):
            high = min(n_passages, low + max(1, CELLS // n_blocks))
            own_terms, own_passage = terms[first[low] : first[high]], passage[first[low] : first[high]] - low
            count = self.starts[own_terms + 1] - self.starts[own_terms]
            pick = np.repeat(self.starts[own_terms] - np.cumsum(count) + count, count) + np.arange(count.sum())
            cell = np.repeat(own_passage, count) * n_blocks + self.blocks[pick]
            bound = np.bincount(cell, self.maxima[pick], (high - low) * n_blocks)
            for at in np.flatnonzero(bound >= threshold - 1e-9):
                p, b = divmod(int(at), n_blocks)
                own, dense = self.weights[b]
                mine = terms[first[low + p] : first[low + p + 1]]
                where = np.minimum(np.searchsorted(own, mine), len(own) - 1)
                scores = dense[where[own[where] == mine]].sum(axis=0)
                found += [(low + p, b * BLOCK + int(i), float(scores[i])) for i in np.flatnonzero(scores >= threshold - 1e-9)]
        return found


_SCHEMA = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double, n_passages bigint"


def _regions(own: list[str], begins: set[int], length: int) -> Iterator[tuple[int, list[str]]]:
    """Words in which an item of ``length`` words is verified, and how many of the passages at ``begins`` they surround.

    For an item of one segment, each passage. For longer ones, the passages that
    begin within half its length are taken together, with room for the rest of
    the item on both sides; all regions together are a few times the document.
    """
    room = 2 * max(0, length - SEGMENT)
    stride = max(SEGMENT, length // 2)
    near: dict[int, list[int]] = {}
    for b in sorted(begins):
        near.setdefault(b // stride, []).append(b)
    for group in near.values():
        yield len(group), own[max(0, group[0] - room) : group[-1] + 2 * SEGMENT + room]


def _match(index: Index, docs: list[tuple], threshold: float) -> list[tuple]:
    """Verified rows (place, item, ...) of one batch of (place, words)."""
    owner, begin = [], []
    seen: tuple[list, list] = [], []  # (term, passage), of words and of runs
    names = np.array(sorted(index.runs.terms), np.uint64)
    number_of = np.array([index.runs.terms[r] for r in names.tolist()], np.int64)
    at = 0
    for place, own in docs:
        found = np.fromiter(map(index.terms.get, own, (0 for _ in own)), np.int64, len(own))
        n = max(1, ceil_div(len(own), SEGMENT) - 1)

        def add(kind: int, where: np.ndarray, terms: np.ndarray) -> None:
            # a chunk of words belongs to the passage that it begins and to the one before
            for shift in (0, 1):
                mine = where // SEGMENT - shift
                good = (mine >= 0) & (mine < n)
                seen[kind].append(np.column_stack([mine[good] + at, terms[good]]))

        known = np.flatnonzero(found)
        add(0, known, found[known])
        for length in index.lengths:
            listed = _run_numbers(found, length)
            where = np.flatnonzero(listed)
            place_of = np.minimum(np.searchsorted(names, listed[where]), len(names) - 1)
            same = names[place_of] == listed[where]
            add(1, where[same], number_of[place_of[same]])
        owner += [place] * n
        begin += [i * SEGMENT for i in range(n)]
        at += n
    if not at:
        return []
    words = dict(docs)
    hits: dict[tuple, set] = {}
    for kind, (side, least) in enumerate(((index, threshold), (index.runs, QUESTION_WITH_ANSWER))):
        if not seen[kind]:
            continue
        width = len(side.terms) + 1
        both = np.concatenate(seen[kind])
        pairs = np.unique(both[:, 0] * width + both[:, 1])
        for p, segment, _ in side.retrieve(pairs % width, pairs // width, least):
            hits.setdefault((owner[p], side.item_of[segment]), set()).add(begin[p])
    best: dict[tuple, list] = {}
    for (place, item), begins in hits.items():
        for n, own in _regions(words[place], begins, len(index.questions[item]) + len(index.answers[item])):
            question, answer = overlap(index.questions[item], own), overlap(index.answers[item], own)
            if question < QUESTION_WITH_ANSWER:
                continue
            held = set(own)
            score = sum(v for w, v in index.shares[item].items() if w in held)
            alone = len(index.questions[item]) >= ALONE or not index.answers[item] or score >= threshold - 1e-9
            if (question >= QUESTION and alone) or answer >= ANSWER:
                row = best.setdefault((place, index.ids[item]), [0.0, 0.0, 0.0, 0])
                row[:] = *max(tuple(row[:3]), (score, question, answer)), row[3] + n
    return [(place, item, *row) for (place, item), row in best.items()]


def _match_texts(index: Index, texts: list, threshold: float) -> list[tuple]:
    rows, waiting, size = [], [], 0
    for place, text in enumerate(texts):
        own = words_of(text or "")
        if own:
            waiting.append((place, own))
            size += len(own)
        if size >= BATCH_WORDS:
            rows += _match(index, waiting, threshold)
            waiting, size = [], 0
    return rows + _match(index, waiting, threshold)


def _finder(sent, threshold: float):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = _match_texts(sent.value, part.column(1).to_pylist(), threshold)
                if rows:
                    keys = part.column(0).to_pylist()
                    columns = list(zip(*[(keys[r[0]], *r[1:]) for r in rows], strict=True))
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()]
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                        [f.split()[0] for f in _SCHEMA.split(", ")],
                    )

    return run


def _cleaner(sent, threshold: float):
    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (structs) whose text has no verified item."""
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                texts = pc.struct_field(part.column(0), "text").to_pylist()
                keep = np.ones(part.num_rows, bool)
                keep[[r[0] for r in _match_texts(sent.value, texts, threshold)]] = False
                yield part.filter(pa.array(keep))

    return run


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """shard, word, items that have it, and (word NULL) items and their words."""
    for batch in batches:
        for shard, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            own = words_of(text)
            each = list(set(own))
            yield pa.record_batch(
                [
                    pa.array([shard] * (len(each) + 1), pa.int32()),
                    pa.array([*each, None], pa.string()),
                    pa.array([1] * len(each) + [len(own)], pa.int64()),
                ],
                ["shard", "word", "n"],
            )


def _builder(n_items: int, length: float):
    def build(items: pa.Table, frequency: pa.Table) -> pa.Table:
        """A shard's items and the counts of its words to its index, packed and cut to pieces."""
        of_word = dict(zip(frequency.column("word").to_pylist(), frequency.column("n").to_pylist(), strict=True))
        ordered = items.sort_by([("item_id", "ascending"), ("text", "ascending")])
        rows = list(zip(ordered.column("item_id").to_pylist(), ordered.column("text").to_pylist(), strict=True))
        packed = pickle.dumps(Index.build(rows, n_items, of_word, length), protocol=5)
        pieces = [packed[i : i + PIECE] for i in range(0, len(packed), PIECE)]
        shard = items.column("shard")[0].as_py()
        return pa.table(
            [pa.array([shard] * len(pieces), pa.int32()), pa.array(range(len(pieces)), pa.int32()), pa.array(pieces, pa.binary())],
            ["shard", "place", "piece"],
        )

    return build


def _indexes(benchmark: DataFrame, index_bytes: int) -> Iterator:
    """A broadcast index for each shard of the benchmark.

    A shard's index is built in a task and kept as a table; the driver passes on
    the bytes of one shard at a time.
    """
    context = benchmark.sparkSession.sparkContext
    items = whole_texts(benchmark, key="item_id").withColumnRenamed("doc_id", "item_id")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, ceil_div(size, index_bytes))
    items = items.withColumn("shard", F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)).cast("int"))
    counted = items.select("shard", "text").mapInArrow(_terms, "shard int, word string, n bigint")
    n_items, n_words = counted.where("word IS NULL").agg(F.count(F.lit(1)), F.sum("n")).first()
    named = counted.where("word IS NOT NULL")
    frequency = named.groupBy("word").agg(F.sum("n").alias("n"))
    of_shard = named.select("shard", "word").distinct().join(frequency, "word").select("shard", "word", "n")
    length = min(SEGMENT, (n_words or 0) / max(1, n_items))
    built = items.groupBy("shard").cogroup(of_shard.groupBy("shard"))
    table = stage(built.applyInArrow(_builder(n_items, length), "shard int, place int, piece binary"))
    for shard in range(shards):
        rows = table.where(F.col("shard") == shard).orderBy("place").select("piece").collect()
        if rows:
            yield context.broadcast(pickle.loads(b"".join(bytes(r["piece"]) for r in rows)))


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """Verified (doc_id, item_id) pairs with score, overlaps and the passages that leak.

    One row for each row of ``docs`` and each item id it leaks.
    """
    source = whole_texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = [source.mapInArrow(_finder(sent, threshold), _SCHEMA) for sent in _indexes(benchmark, index_bytes)]
    return reduce(DataFrame.unionByName, found) if found else source.sparkSession.createDataFrame([], _SCHEMA)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """The rows of ``docs`` without a verified item, with all their columns. Rows do not move."""
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    for sent in _indexes(benchmark, index_bytes):
        rows = rows.mapInArrow(_cleaner(sent, threshold), rows.schema)
    return rows.select("row.*")
