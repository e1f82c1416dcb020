"""Removal of word passages that an earlier document has, by suffix automata.

A window is 13 words in a row. A word goes if a window that covers it also
occurs in a document with a smaller id. Windows are judged on the input.

A suffix automaton of a reference gives, for every place of a document streamed
through it, the longest match that ends there (matching statistics), and so all
maximal spans above a length. Streaming every document through automata of the
whole corpus would be quadratic, and no bound holds for broadcasting them. So
windows are hashed first, to find out which text can repeat at all and where:

1. *Route.* Each task hashes its windows and sends them, as packed arrays, to
   buckets by hash, only those of the smallest id where a task has several. A
   bucket tells the documents whose windows have the hash of an earlier
   document's, and that document (the owner).
2. *Refer.* Runs of such windows, and the owners' runs that they point to, are
   cut out as arrays of word hashes and go to shards by owner. An owner with
   very many repeats is put in several shards.
3. *Match.* A shard builds one suffix automaton over its reference runs; each
   state knows the smallest id that has its words. The other runs are streamed
   through it. A window counts if the match there has 13 words or more and the
   state of those 13 has a smaller id; touching windows make one maximal span.

Every result comes from a match of word sequences, so unequal windows with one
hash remove nothing. What they could do is hide the right owner, with a chance
of 2**-64 a pair. Words are compared by 32 bits of their own hash.

Odd rows: NULL and empty texts have no words; NULL ids count as larger than all
ids and not smaller than each other; rows with one id never remove each other's
words; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import ceil_div, whole_texts, words
from histkit.llm.near_duplicates import mix
from histkit.sources.tables import stage

WINDOW = 13
#: Words that a task hashes at a time, and words of runs in one shard.
BATCH_WORDS = 500_000
SHARD_WORDS = 150_000
#: Words of repeats that one owner may bring to a shard.
OWNER_WORDS = 50_000
#: Bytes of text whose windows make one bucket, about.
BUCKET_BYTES = 8 << 20
#: Windows of a bucket that are sorted at a time.
SORTED = 500_000

_LAST = np.iinfo(np.int64).max
_FACTOR = np.uint64(0xD6E8FEB86659FD93)  # odd; the base of the window polynomial


# Packed arrays


def _planes(x: np.ndarray) -> bytes:
    """Numbers below 2**32 as four rows of bytes, high bytes together, which shuffles compress to nothing."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4")[:, 0].astype(np.int64)


def _gaps(doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Places of one document after the other as steps; each document begins anew."""
    out = np.diff(place, prepend=0)
    new = np.flatnonzero(np.diff(doc, prepend=doc[:1] - 1 if len(doc) else 0) != 0)
    out[new] = place[new]
    return out


def pack_windows(hashes: np.ndarray, doc: np.ndarray, place: np.ndarray) -> bytes:
    """Windows in order of (doc, place)."""
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if len(doc) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(doc)))
    head = np.array([len(first), len(doc)], "<u4").tobytes()
    ids = doc[first].astype("<i8").tobytes() + counts.astype("<u4").tobytes()
    return head + ids + hashes.astype("<u8").tobytes() + _planes(_gaps(doc, place))


def unpack_windows(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    docs, n = np.frombuffer(data, "<u4", 2).astype(int)
    ids = np.frombuffer(data, "<i8", docs, 8)
    counts = np.frombuffer(data, "<u4", docs, 8 + 8 * docs).astype(np.int64)
    hashes = np.frombuffer(data, "<u8", n, 8 + 12 * docs)
    steps = np.cumsum(_from_planes(data[8 + 12 * docs + 8 * n :], n))
    begin = np.cumsum(counts) - counts
    base = np.where(begin > 0, steps[begin - 1], 0) if docs else begin
    return hashes, np.repeat(ids, counts), steps - np.repeat(base, counts)


def _pack_repeats(doc: np.ndarray, place: np.ndarray, owner: np.ndarray) -> bytes:
    order = np.lexsort((place, doc))
    doc, place, owner = doc[order], place[order], owner[order]
    return doc.astype("<i8").tobytes() + owner.astype("<i8").tobytes() + _planes(_gaps(doc, place))


def _unpack_repeats(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) // 20
    doc, owner = np.frombuffer(data, "<i8", n), np.frombuffer(data, "<i8", n, 8 * n)
    steps = np.cumsum(_from_planes(data[16 * n :], n))
    new = np.flatnonzero(np.append(True, doc[1:] != doc[:-1])) if n else np.zeros(0, np.int64)
    base = np.where(new > 0, steps[new - 1], 0)
    return doc, steps - np.repeat(base, np.diff(np.append(new, n))), owner


# Routing


def window_hashes(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, document number and place of each window of several documents' word hashes."""
    sizes = np.diff(ends, prepend=0)
    doc = np.repeat(np.arange(len(ends)), sizes)
    at = np.flatnonzero(np.arange(len(hashes)) + WINDOW <= ends[doc]) if len(hashes) else np.zeros(0, np.int64)
    whole = np.zeros(max(0, len(hashes) - WINDOW + 1), np.uint64)
    for k in range(WINDOW):
        whole = whole * _FACTOR + hashes[k : len(whole) + k]
    return mix(whole[at]), doc[at], at - (ends - sizes)[doc[at]]


def owners(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the smallest document with its hash, and whether another has it too."""
    order = np.lexsort((doc, hashes))
    h, d = hashes[order], doc[order]
    new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    least = d[new][group] if len(h) else d
    more = np.zeros(int(group[-1]) + 1 if len(h) else 0, bool)
    more[group[d != least]] = True
    owner, shared = np.empty_like(doc), np.zeros(len(doc), bool)
    owner[order], shared[order] = least, more[group] if len(h) else more
    return owner, shared


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    found = bucket[order]
    first = np.flatnonzero(np.append(True, found[1:] != found[:-1])) if len(found) else []
    for at, to in zip(first, np.append(first[1:], len(found)) if len(first) else [], strict=True):
        yield int(found[at]), order[at:to]


def _repeat_rows(doc, place, owner, parts: int) -> Iterator[tuple[int, bytes]]:
    """Packed repeats (owner another document) and references (owner the document) by bucket of document."""
    bucket = (mix(doc.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
    for b, at in _by_bucket(bucket):
        yield b, _pack_repeats(doc[at], place[at], owner[at])


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    bucket, kind, data = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.record_batch(
        [pa.array(bucket, pa.int32()), pa.array(kind, pa.int32()), pa.array(data, pa.binary())], ["bucket", "kind", "data"]
    )


def _router(parts: int):
    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(id, word hashes) to packed windows (kind 0) and repeats found here (kind 1) by bucket."""
        for batch in batches:
            lists = batch.column(1)
            offsets = np.asarray(lists.offsets).astype(np.int64)
            flat = np.asarray(lists.values).view(np.uint64)
            ids = np.asarray(batch.column(0))
            at = 0
            while at < batch.num_rows:
                to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BATCH_WORDS, side="right")) - 1)
                to = min(to, batch.num_rows)
                whole, number, place = window_hashes(flat[offsets[at] : offsets[to]], offsets[at + 1 : to + 1] - offsets[at])
                doc = ids[at:to][number]
                owner, shared = owners(whole, doc)
                rows = []
                for b, some in _repeat_rows(doc[shared], place[shared], owner[shared], parts):
                    rows.append((b, 1, some))
                least = np.flatnonzero(doc == owner)
                order = least[np.lexsort((place[least], doc[least]))]
                bucket = ((whole[order] >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                for b, mine in _by_bucket(bucket):
                    mine = order[mine]
                    rows.append((b, 0, pack_windows(whole[mine], doc[mine], place[mine])))
                yield _rows(rows)
                at = to

    return route


def _settler(parts: int):
    def settle(table: pa.Table) -> pa.Table:
        """The repeats and references of one bucket of hashes; repeats that tasks found are passed on."""
        kind, data = table["kind"].to_pylist(), table["data"].to_pylist()
        own_bucket = table["bucket"][0].as_py()
        rows = [(own_bucket, 1, d) for k, d in zip(kind, data, strict=True) if k == 1]
        found = [unpack_windows(d) for k, d in zip(kind, data, strict=True) if k == 0]
        if found:
            hashes, doc, place = (np.concatenate(c) for c in zip(*found, strict=True))
            slices = ceil_div(len(hashes), SORTED)
            part = (mix(hashes) % np.uint64(slices)).astype(np.int16)
            for k in range(slices):
                mine = np.flatnonzero(part == k)
                owner, shared = owners(hashes[mine], doc[mine])
                mine, owner = mine[shared], owner[shared]
                rows += [(b, 1, d) for b, d in _repeat_rows(doc[mine], place[mine], owner, parts)]
        return pa.Table.from_batches([_rows(rows)])

    return settle


_RUNS = "doc bigint, owner bigint, start int, n int"


def _runs(table: pa.Table) -> pa.Table:
    """Runs of touching windows of one owner, for the documents of one bucket."""
    doc, place, owner = (np.concatenate(c) for c in zip(*map(_unpack_repeats, table["data"].to_pylist()), strict=True))
    order = np.lexsort((place, owner, doc))
    doc, place, owner = doc[order], place[order], owner[order]
    keep = np.append(True, (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1]))
    doc, place, owner = doc[keep], place[keep], owner[keep]
    new = np.append(True, (doc[1:] != doc[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1))
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(doc)))
    return pa.table({"doc": doc[first], "owner": owner[first], "start": place[first].astype(np.int32), "n": n.astype(np.int32)})


# Matching


class Automaton:
    """Suffix automaton of sequences of numbers; each state knows the smallest id that has its words."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.first = [-1], [0], [_LAST]
        self.last, self.cut = 0, -1

    def add(self, sequence: list[int], key: int) -> None:
        for c in sequence:
            self._extend(c, key)
        # a number of its own ends the sequence, so that no match runs on into the next
        self._extend(self.cut, _LAST)
        self.cut -= 1

    def _extend(self, c: int, key: int) -> None:
        nexts, link, size = self.next, self.link, self.size
        state = len(size)
        nexts.append({})
        link.append(0)
        size.append(size[self.last] + 1)
        self.first.append(key)
        p = self.last
        while p >= 0 and c not in nexts[p]:
            nexts[p][c] = state
            p = link[p]
        if p >= 0:
            q = nexts[p][c]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:
                copy = len(size)
                nexts.append(dict(nexts[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                self.first.append(_LAST)
                while p >= 0 and nexts[p].get(c) == q:
                    nexts[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        self.last = state

    def finish(self) -> None:
        """A state's words occur wherever those of states that link to it do."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up = self.link[state]
            if self.first[state] < self.first[up]:
                self.first[up] = self.first[state]

    def earliest(self, sequence: list[int], least: int) -> np.ndarray:
        """For each window of ``least`` words the smallest id that has it, from the matching statistics."""
        nexts, link, size, first = self.next, self.link, self.size, self.first
        out = np.full(max(0, len(sequence) - least + 1), _LAST, np.int64)
        state, length = 0, 0
        for at, c in enumerate(sequence):
            while state and c not in nexts[state]:
                state = link[state]
                length = size[state]
            state = nexts[state].get(c, 0)
            length = length + 1 if state else 0
            if length >= least:
                while size[link[state]] >= least:  # the state of the last ``least`` words
                    state = link[state]
                    length = size[state]
                out[at - least + 1] = first[state]
        return out


_SPANS = "doc bigint, text_key bigint, start int, stop int"


def _match(table: pa.Table) -> pa.Table:
    """One shard: an automaton of its references, and the spans of its repeats."""
    automaton = Automaton()
    is_reference = table["is_reference"].to_pylist()
    data, docs = table["words"].to_pylist(), table["doc"].to_pylist()
    references = sorted({(docs[i], data[i]) for i, r in enumerate(is_reference) if r})
    known: set[bytes] = set()
    for key, sequence in references:  # by rising id, so that of equal sequences the first is enough
        if sequence not in known:
            known.add(sequence)
            automaton.add(np.frombuffer(sequence, "<i4").tolist(), key)
    automaton.finish()
    seen: dict[bytes, np.ndarray] = {}
    out: list[tuple] = []
    keys, starts = table["text_key"].to_pylist(), table["start"].to_pylist()
    for i, reference in enumerate(is_reference):
        if reference:
            continue
        if data[i] not in seen:
            seen[data[i]] = automaton.earliest(np.frombuffer(data[i], "<i4").tolist(), WINDOW)
        hit = np.flatnonzero(seen[data[i]] < docs[i])
        if len(hit):
            first = np.flatnonzero(np.append(True, np.diff(hit) > 1))
            last = np.append(first[1:], len(hit)) - 1
            out += [(docs[i], keys[i], starts[i] + int(hit[a]), starts[i] + int(hit[b]) + WINDOW) for a, b in zip(first, last, strict=True)]
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["doc", "text_key", "start", "stop"])


# The operator


def _keyed(docs: DataFrame) -> DataFrame:
    """doc (NULL ids last), doc_id, text, and a hash that tells texts of one id apart."""
    own = whole_texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return own.withColumns({"doc": F.coalesce("doc_id", F.lit(_LAST)), "text_key": F.xxhash64("text")})


def _word_hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def _cut_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, text_key, word hashes, runs) to a row per run and shard, with its words."""
    for batch in batches:
        doc, key, lists, runs = batch.columns
        offsets = np.asarray(lists.offsets).astype(np.int64)
        # the high half: windows were routed by all bits, mixed
        low = (np.asarray(lists.values) >> 32).astype("<i4")
        out: list[tuple] = []
        size = 0
        for i, (d, k, mine) in enumerate(zip(doc.to_pylist(), key.to_pylist(), runs.to_pylist(), strict=True)):
            own = low[offsets[i] : offsets[i + 1]]
            for r in mine:
                part = own[r["start"] : r["start"] + r["n"] + WINDOW - 1]
                if len(part) >= WINDOW:
                    data = part.tobytes()
                    out += [(s, r["owner"] == d, d, k, r["start"], data) for s in r["shards"]]
                    size += len(data) * len(r["shards"])
            if size > 4 << 20:
                yield _run_rows(out)
                out, size = [], 0
        if out:
            yield _run_rows(out)


def _run_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
    names = ["shard", "is_reference", "doc", "text_key", "start", "words"]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc (the id, or the largest number for NULL), text_key, start, stop: word spans that an earlier document has."""
    keyed = _keyed(docs)
    size = keyed.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0]
    parts = max(1, ceil_div(size or 0, BUCKET_BYTES))
    routed = keyed.select("doc", _word_hashes(F.col("text")).alias("h")).mapInArrow(
        _router(parts), "bucket int, kind int, data binary"
    )
    # a task has about one bucket, whatever the session's number of partitions
    settled = routed.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_settler(parts), "bucket int, kind int, data binary")
    runs = stage(settled.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_runs, _RUNS))
    n_words = runs.agg(F.sum(F.col("n") + WINDOW - 1)).first()[0]

    # owners with many repeats are referred to in several shards
    load = runs.groupBy("owner").agg(F.sum(F.col("n") + WINDOW - 1).alias("load")).where(F.col("load") > OWNER_WORDS)
    hot = load.select("owner", F.ceil(F.col("load") / OWNER_WORDS).cast("int").alias("copies"))
    shards = max(1, ceil_div(n_words or 0, SHARD_WORDS))
    copies = F.coalesce("copies", F.lit(1))

    def shard(turn: Column) -> Column:
        return F.pmod(F.xxhash64("owner", turn), F.lit(shards)).cast("int")

    chosen = F.when(
        F.col("owner") == F.col("doc"),
        F.array_distinct(F.transform(F.sequence(F.lit(0), copies - 1), shard)),
    ).otherwise(F.array(shard(F.pmod(F.xxhash64("doc"), copies).cast("int"))))
    per_doc = (
        runs.join(hot, "owner", "left")
        .groupBy("doc")
        .agg(F.collect_list(F.struct("owner", "start", "n", chosen.alias("shards"))).alias("runs"))
    )
    cut = (
        keyed.join(per_doc, "doc")
        .select("doc", "text_key", _word_hashes(F.col("text")).alias("h"), "runs")
        .mapInArrow(_cut_runs, "shard int, is_reference boolean, doc bigint, text_key bigint, start int, words binary")
    )
    return stage(cut.groupBy("shard").applyInArrow(_match, _SPANS))


_KEPT = "doc_id bigint, n_words bigint, n_removed bigint, kept string"


def _remove(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, kept = [], [], []
            for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own = text.encode().split()
                counts.append(len(own))
                if spans:
                    gone = np.zeros(len(own) + 1, np.int64)
                    np.add.at(gone, [s["start"] for s in spans], 1)
                    np.add.at(gone, [s["stop"] for s in spans], -1)
                    own = [w for w, g in zip(own, np.cumsum(gone)[:-1].tolist(), strict=True) if not g]
                removed.append(counts[-1] - len(own))
                left = b" ".join(own)
                kept.append(left.decode() if with_text else hashlib.sha256(left).hexdigest())
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, hashed: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept: the words that stay, joined by spaces (or their sha256 if ``hashed``)."""
    spans = repeated_spans(docs)
    per_doc = spans.groupBy("doc", "text_key").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    joined = _keyed(docs).join(per_doc, ["doc", "text_key"], "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(_remove(not hashed), _KEPT)
