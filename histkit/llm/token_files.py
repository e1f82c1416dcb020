"""Token-id files of patched frame-of-reference blocks.

``write_token_files`` encodes documents and writes one binary file per task, in
ascending id order over all files; ``read_token_files`` reads them back.

A file is a run of blocks of 128 ids. A block keeps its smallest id, the width
in bits that holds 90 % of the differences to it, those differences packed at
that width, and a list of (place, difference) for the outliers. The file's end
indexes the blocks (byte start, minimum, width, number of outliers) and the
documents (id, first token), so any document can be read without the rest:

    magic | blocks | index of blocks | index of documents | counts | magic

Texts are encoded by the ``tokenizers`` library. Words repeat, so the ids of a
word are kept (up to a bound) and only unseen words go to the library. A text
is cut before single spaces only, where byte-level pre-tokenization begins a
new token in any case; texts for which that does not hold go to it whole.

A file belongs to the task attempt that returned its name, so a lost or doubled
task leaves at most an unnamed file behind. Files are opened with pyarrow's
file systems, local or remote, by the scheme of the shared folder.

Odd rows: a NULL text is empty and has the end id alone; NULL ids come first;
repeated ids are kept as often as they occur, ties in order of text; an empty
table has no files and reads back as no rows.
"""

from __future__ import annotations

import gc
import json
import os
import re
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from histkit.llm.common import whole_texts
from histkit.sources.tables import shared_folder, stage

BLOCK = 128
#: Share of a block's differences that its width must hold.
PERCENTILE = 0.9
MAGIC = b"PFORIDS1"
#: Blocks packed or unpacked at a time.
CHUNK = 4_096
#: Texts encoded at a time, and their bytes, about.
TEXTS, TEXT_BYTES = 1_024, 4 << 20
#: Words whose ids a worker keeps.
KEPT_WORDS = 800_000
#: Marks at the end of a word of letters are tokens apart from it, so words with and without share ids.
MARKS = ".,"

_COUNTS = struct.Struct("<QQQQ")
_INDEX = np.dtype([("start", "<u8"), ("least", "<u4"), ("width", "u1"), ("outliers", "u1")])
_DOCS = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("first", "<u8")])


# Blocks


def _bit_length(x: np.ndarray) -> np.ndarray:
    """Bits that hold each non-negative number below 2**32."""
    return np.frexp(x.astype(np.float64))[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of 128 numbers below 2**width, as rows of 4 * width words."""
    lanes = values.reshape(-1, 32)
    out = np.zeros((len(lanes), width), np.uint32)
    for j in range(32 if width else 0):
        word, bit = divmod(j * width, 32)
        out[:, word] |= lanes[:, j] << np.uint32(bit)
        if bit + width > 32:
            out[:, word + 1] |= lanes[:, j] >> np.uint32(32 - bit)
    return out.reshape(len(values), -1)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    lanes = packed.reshape(-1, width)
    out = np.empty((len(lanes), 32), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(32):
        word, bit = divmod(j * width, 32)
        got = lanes[:, word] >> np.uint32(bit)
        if bit + width > 32:
            got = got | (lanes[:, word + 1] << np.uint32(32 - bit))
        out[:, j] = got & mask
    return out.reshape(len(packed), -1)


def pack_blocks(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` as bytes, and their index with starts from 0.

    A short last block is filled with its first id.
    """
    n = -(-len(ids) // BLOCK)
    table = np.full(n * BLOCK, ids[(n - 1) * BLOCK] if n else 0, np.uint32)
    table[: len(ids)] = ids
    table = table.reshape(n, BLOCK)
    index = np.zeros(n, _INDEX)
    if not n:
        return b"", index
    index["least"] = table.min(axis=1)
    diff = table - index["least"][:, None]
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    index["width"] = _bit_length(np.partition(diff, at, axis=1)[:, at])
    over = diff >> index["width"][:, None].astype(np.uint32).clip(0, 31) > 0
    over &= index["width"][:, None] < 32
    index["outliers"] = over.sum(axis=1)
    sizes = index["width"].astype(np.int64) * (BLOCK // 8) + index["outliers"].astype(np.int64) * 5
    ends = np.cumsum(sizes)
    index["start"] = ends - sizes
    out = np.zeros(int(ends[-1]), np.uint8)
    for width in np.unique(index["width"]):
        rows = np.flatnonzero(index["width"] == width)
        if not width:
            continue
        packed = _pack(np.where(over[rows], 0, diff[rows]).astype(np.uint32), int(width)).astype("<u4").view(np.uint8)
        out[index["start"][rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(over)
    if len(row):
        nth = np.arange(len(row)) - np.searchsorted(row, row)
        base = index["start"][row].astype(np.int64) + index["width"][row].astype(np.int64) * (BLOCK // 8)
        out[base + nth] = place
        values = diff[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
        first = base + index["outliers"][row].astype(np.int64) + 4 * nth
        out[first[:, None] + np.arange(4)] = values
    return out.tobytes(), index


def unpack_blocks(data: bytes, index: np.ndarray, base: int = 0) -> np.ndarray:
    """The ids of the blocks in ``index``; ``data`` begins at byte ``base``."""
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((len(index), BLOCK), np.uint32)
    starts = index["start"].astype(np.int64) - base
    for width in np.unique(index["width"]):
        if not width:
            continue
        rows = np.flatnonzero(index["width"] == width)
        cells = raw[starts[rows][:, None] + np.arange(int(width) * (BLOCK // 8))]
        out[rows] = _unpack(np.ascontiguousarray(cells).view("<u4"), int(width))
    counts = index["outliers"].astype(np.int64)
    row = np.repeat(np.arange(len(index)), counts)
    if len(row):
        nth = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
        first = starts[row] + index["width"][row].astype(np.int64) * (BLOCK // 8)
        place = raw[first + nth]
        at = first + counts[row] + 4 * nth
        out[row, place] = np.ascontiguousarray(raw[at[:, None] + np.arange(4)]).view("<u4")[:, 0]
    out += index["least"][:, None]
    return out.reshape(-1)


# Files


class TokenFile:
    """Appends documents to one file."""

    def __init__(self, sink):
        self.sink, self.at, self.tokens = sink, len(MAGIC), 0
        self.waiting, self.waiting_n, self.index, self.docs = [], 0, [], []
        sink.write(MAGIC)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is not None, self.tokens))
        self.tokens += len(ids)
        self.waiting.append(ids)
        self.waiting_n += len(ids)
        if self.waiting_n >= CHUNK * BLOCK:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        ids = np.concatenate([np.zeros(0, np.uint32), *self.waiting])
        whole = len(ids) if last else len(ids) // BLOCK * BLOCK
        for i in range(0, whole, CHUNK * BLOCK):
            data, index = pack_blocks(ids[i : min(whole, i + CHUNK * BLOCK)])
            index["start"] += self.at
            self.sink.write(data)
            self.at += len(data)
            self.index.append(index)
        self.waiting, self.waiting_n = [ids[whole:]], len(ids) - whole

    def close(self) -> None:
        self._flush(True)
        index = np.concatenate([np.zeros(0, _INDEX), *self.index])
        self.sink.write(index.tobytes())
        self.sink.write(np.array(self.docs, _DOCS).tobytes())
        self.sink.write(_COUNTS.pack(self.at, len(index), len(self.docs), self.tokens) + MAGIC)
        self.sink.close()


def read_file(source) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, first token, ids) of each document of an open file."""
    size = source.size()
    source.seek(size - _COUNTS.size - len(MAGIC))
    tail = source.read(_COUNTS.size + len(MAGIC))
    if tail[-len(MAGIC) :] != MAGIC:
        raise ValueError("not a whole token file")
    at, blocks, n_docs, tokens = _COUNTS.unpack(tail[: _COUNTS.size])
    source.seek(at)
    index = np.frombuffer(source.read(blocks * _INDEX.itemsize), _INDEX)
    docs = np.frombuffer(source.read(n_docs * _DOCS.itemsize), _DOCS)
    ends = np.append(docs["first"][1:], np.uint64(tokens)).astype(np.int64) if n_docs else []
    held, held_from, block = np.zeros(0, np.uint32), 0, 0
    for doc, end in zip(docs, ends, strict=True):
        first, parts = int(doc["first"]), []
        while held_from + len(held) < end:
            parts.append(held[max(0, first - held_from) :])
            held_from += len(held)
            some = index[block : block + CHUNK]
            start = int(some["start"][0])
            stop = int(index["start"][block + len(some)]) if block + len(some) < blocks else at
            source.seek(start)
            held = unpack_blocks(source.read(stop - start), some, start)
            block += len(some)
        parts.append(held[max(0, first - held_from) : end - held_from])
        yield (int(doc["doc_id"]) if doc["known"] else None), first, np.concatenate(parts)


def _open(path: str):
    fs, at = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    return fs, at


# Encoding


_UNSAFE = re.compile(r"\s \s|  ")
_SPACE = re.compile(r"\s")


def _places(values: list, wanted) -> list[int]:
    """Where ``wanted`` stands in ``values``."""
    out, at = [], -1
    for _ in range(values.count(wanted)):
        at = values.index(wanted, at + 1)
        out.append(at)
    return out


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level models: printable ones for themselves, the rest from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) if b in printable else chr(256 + rest.index(b)) for b in range(256)}


#: Packers of a few ids as little-endian 32-bit numbers.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(24)]


class WordEncoder:
    """Ids of whole texts by the ``tokenizers`` library, word by word."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a word of letters is one pre-token of a plain byte-level model, which can be asked without detours
        kind = json.loads(self.tokenizer.to_str())
        before = kind["pre_tokenizer"] or {}
        self.plain = kind["normalizer"] is None and before.get("type") == "ByteLevel" and before["use_regex"]
        self.signs = byte_signs()
        self.line = self.tokenizer.encode("\n", add_special_tokens=False).ids[-1]
        self.kept: dict[str, bytes] = {}
        self.firsts: dict[str, bytes] = {"": b""}

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    def _word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of each word with a space before it, from one text with the words on lines of their own.

        A line end before a space is a token of its own, so it shows where a word's ids end.
        """
        # white space inside words is rare, and one look at all of them tells
        whole = " ".join(words).split() == words
        odd = [] if whole else [w for w in words if not w or _SPACE.search(w)]
        of_odd = dict(zip(odd, self._ids([" " + w for w in odd]), strict=True))
        if self.plain:
            space = self.signs[ord(" ")]
            of_odd.update((w, self._letters(w, space)) for w in words if w.isalpha())
        plain = [w for w in words if w not in of_odd]
        if plain:
            text = "".join([f" {w}\n" for w in plain])
            ids = np.array(self.tokenizer.encode_batch_fast([text + " ."], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(ids == self.line)
            if len(ends) != len(plain):
                raise ValueError("this vocabulary has no token of its own for a line end")
            data, starts = ids.tobytes(), np.append(0, ends[:-1] + 1)
            of_odd.update(
                (w, data[4 * i : 4 * j]) for w, i, j in zip(plain, starts.tolist(), ends.tolist(), strict=True)
            )
        return [of_odd[w] for w in words]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        # a batch makes no cycles, but so many strings that looking for some takes a tenth of the time
        gc.disable()
        try:
            return self._encode(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
        finally:
            gc.enable()

    def _encode(self, texts: pa.Array) -> list[bytes]:
        if not len(texts):
            return []
        # words are split, told apart and put together again as columns: Python meets each once for all these texts
        split = pc.split_pattern(texts, " ")
        known = split.flatten().dictionary_encode()
        names = known.dictionary.to_numpy(zero_copy_only=False).tolist()
        places, ends = known.indices.to_numpy(), split.offsets.to_numpy().astype(np.int64)
        ends = ends - ends[0]
        ids = list(map(self.kept.get, names))
        at_unseen = _places(ids, None)
        unseen = [names[at] for at in at_unseen]
        found = self._unseen(unseen)
        for at, word in zip(at_unseen, unseen, strict=True):
            ids[at] = found[word]
        strings = texts.to_numpy(zero_copy_only=False).tolist()
        # words that begin with white space, and empty ones, are never kept
        blank = [at for at, w in zip(at_unseen, unseen, strict=True) if not w or w[0].isspace()]
        has_blank = np.zeros(len(texts), bool)
        if blank:
            is_blank = np.zeros(len(names), bool)
            is_blank[blank] = True
            has_blank = np.logical_or.reduceat(is_blank[places], ends[:-1])
        # the first word has no space before it, unless the text begins with one
        firsts = places[ends[:-1]].tolist()
        places = places.copy()
        places[ends[:-1]] = np.arange(len(ids), len(ids) + len(firsts))
        ids += [self._first(names[at]) for at in firsts]
        taken = pa.array(ids, pa.large_binary()).take(pa.array(places))
        starts = np.frombuffer(taken.buffers()[1], np.int64)[: len(taken) + 1][ends].tolist()
        data = memoryview(taken.buffers()[2] or b"")
        out: list[bytes | None] = []
        for text, look, start, end in zip(strings, has_blank.tolist(), starts, starts[1:], strict=False):
            unsafe = look and _UNSAFE.search(text)
            if not text or unsafe or any(s in text for s in self.special):
                out.append(None)
            else:
                out.append(bytes(data[start:end]))
        whole = [at for at, ids in enumerate(out) if ids is None]
        for at, ids in zip(whole, self._ids([strings[at] for at in whole]), strict=True):
            out[at] = ids
        return out

    def _letters(self, word: str, before: str) -> bytes:
        """Ids of a word of letters after ``before`` (the sign of a space, or nothing)."""
        seen = word if word.isascii() else word.encode().decode("latin-1").translate(self.signs)
        ids = [token.id for token in self.tokenizer.model.tokenize(before + seen)]
        return _PACK[len(ids)](*ids) if len(ids) < len(_PACK) else np.array(ids, "<u4").tobytes()

    def _first(self, word: str) -> bytes:
        """Ids of a word without a space before it."""
        found = self.firsts.get(word)
        if found is None:
            base = word.rstrip(MARKS)
            if self.plain and base.isalpha():
                found = self._letters(base, "") + (self._first(word[len(base) :]) if base != word else b"")
            else:
                found = self._ids([word])[0]
            if len(self.firsts) < KEPT_WORDS // 4 and len(word) <= 32:
                self.firsts[word] = found
        return found

    def _unseen(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not kept; keeps them."""
        kept, get = self.kept, self.kept.get
        # a line end between words is a token, and the word after it has no space before it
        lines = [(w, w.split("\n")) for w in words if "\n" in w]
        lines = [(w, own) for w, own in lines if w.split() == own]
        words = {*words}.difference([w for w, _ in lines]).union([own[0] for _, own in lines if own[0] not in kept])
        # letters with marks at the end are two tokens or more: those of the letters, and the marks'
        marked = [(w, w.rstrip(MARKS)) for w in words if w[-1:] in MARKS]
        marked = [(w, base) for w, base in marked if base.isalpha()]
        asked = {*words}.difference([w for w, _ in marked]).union([base for _, base in marked if base not in kept])
        asked = list(asked)
        found = dict(zip(asked, self._word_ids(asked), strict=True))
        marks = list({w[len(base) :] for w, base in marked})
        of_mark = dict(zip(marks, self._ids(marks), strict=True))
        both = [(w, (get(base) or found[base]) + of_mark[w[len(base) :]]) for w, base in marked]
        if len(kept) < KEPT_WORDS:
            kept.update((w, ids) for w, ids in found.items() if len(w) <= 32 and w and not w[0].isspace())
        found.update(both)
        end = np.array([self.line], "<u4").tobytes()
        for w, (head, *rest) in lines:
            found[w] = (get(head) or found[head]) + b"".join([end + self._first(r) for r in rest])
        return found


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder per worker and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


_MANIFEST = "path string, least bigint, has_null boolean, n_docs bigint, n_tokens bigint"


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, folder: str | None = None) -> DataFrame:
    """Write the ids of ``docs`` in ascending id order; returns the files' manifest.

    The manifest has path, n_docs, n_tokens and start (the ids in all files
    before). ``folder`` must be one that all executors share; by default a new
    one below ``spark.checkpoint.dir``.
    """
    folder = folder or shared_folder(docs.sparkSession)
    end = np.array([end_id], "<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, least, known, docs_n = None, None, None, True, 0
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            step = max(1, min(TEXTS, len(texts) * TEXT_BYTES // max(1, texts.nbytes)))
            for at in range(0, len(keys), step):
                part = texts.slice(at, step)
                if out is None:
                    fs, base = _open(folder)
                    fs.create_dir(base, recursive=True)
                    name = f"ids-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.pfor"
                    path, out = f"{folder}/{name}", TokenFile(fs.open_output_stream(f"{base}/{name}"))
                for key, ids in zip(keys[at : at + step], encoder(tokenizer).encode(part), strict=True):
                    known = known and key is not None
                    least = key if least is None else least
                    docs_n += 1
                    out.add(key, np.concatenate([np.frombuffer(ids, "<u4"), end]))
        if out is not None:
            out.close()
            columns = [[path], [least], [not known], [docs_n], [out.tokens]]
            kinds = [pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["path", "least", "has_null", "n_docs", "n_tokens"])

    ordered = (
        whole_texts(docs)
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
    )
    files = stage(ordered.mapInArrow(write, _MANIFEST))
    # one row per file, so the window holds as many rows as the job had tasks
    before = Window.orderBy(F.col("has_null").desc(), "least").rowsBetween(Window.unboundedPreceding, -1)
    return files.select("path", "n_docs", "n_tokens", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("start"))


def read_token_files(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids (little-endian 32-bit) of every document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = _open(path)
                rows, size = [], 0
                with fs.open_input_file(at) as source:
                    for key, first, ids in read_file(source):
                        rows.append((key, start + first, len(ids), ids.astype("<u4").tobytes()))
                        size += len(rows[-1][3])
                        if size > 4 << 20:
                            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, size = [], 0
                if rows:
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    listed = stage(files.select("path", "start"))
    tasks = max(1, listed.count())
    return listed.repartition(tasks, "path").mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids binary")
