"""SentencePiece BPE by backtracking, and the way back.

Merging the best pair again and again defines the encoding, but need not be
done to find it: a sequence of pieces is the encoding exactly if every two
neighbours are *compatible*, that is, if merging the text of the two alone gives
those two back. So a text is read left to right. At each place the longest
piece that an Aho-Corasick automaton found there is tried, then its shorter
prefixes; a piece is taken if it is compatible with the one before it and does
not end at a place known to fail. If none fits, the place is marked in a bit
field, and the piece before it is taken back. Compatibility is found by merging
the two pieces' text once, and kept.

Pieces that merging never makes (those whose own text merges into others) are
left out of the automaton. Characters without a piece become byte pieces.

No piece has the space mark after another character, so a text can be cut
before each run of space marks, and the pieces of a chunk that was seen before
can be used again. Where a vocabulary has such pieces, texts are not cut.

Odd rows: a NULL text is empty and has the begin and end ids alone; every row
is encoded for itself, so repeated rows and NULL ids are nothing special.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histkit.llm.common import tidy, whole_texts

MARK = "\u2581"
#: Chunks and piece pairs that a worker keeps.
KEPT_CHUNKS = 200_000
KEPT_PAIRS = 300_000


class PieceModel:
    """Encoder and decoder of one SentencePiece BPE model."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {self.pieces[i]: i for i in plain}
        self.score = {self.pieces[i]: sp.get_score(i) for i in plain}
        self.byte_ids = [0] * 256
        self.surface = [""] * size
        for i in range(size):
            if sp.is_byte(i):
                byte = int(self.pieces[i][1:-1], 16)
                self.byte_ids[byte] = i
                # a lone surrogate stands for a byte of a longer character
                self.surface[i] = chr(byte) if byte < 128 else chr(0xDC00 + byte)
            elif self.ids.get(self.pieces[i]) == i:
                self.surface[i] = self.pieces[i]
        self.cut = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.length = [len(p) for p in self.pieces]
        made = [p for p in self.ids if self.merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in made:
            self.automaton.add_word(p, (self.ids[p], len(p)))
        self.automaton.make_automaton()
        self.shorter = [-1] * size
        known = set(made)
        for p in made:
            self.shorter[self.ids[p]] = next((self.ids[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in known), -1)
        self.single = {p for p in known if len(p) == 1}
        self.fits: dict[int, bool] = {}
        self.kept: dict[str, bytes] = {}

    def merge(self, text: str) -> list[str]:
        """Merge the best pair (the first of equals) until none is left: the definition."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.fits.get(key)
        if found is None:
            if len(self.fits) >= KEPT_PAIRS:
                self.fits.clear()
            a, b = self.pieces[left], self.pieces[right]
            found = self.fits[key] = self.merge(a + b) == [a, b]
        return found

    def _backtrack(self, text: str) -> list[int]:
        """The pieces of a text all of whose characters have one."""
        n = len(text)
        longest = [-1] * n
        for stop, (piece, size) in self.automaton.iter(text):
            longest[stop - size + 1] = piece  # later stops are longer
        out: list[int] = []
        failed, at, piece = 0, 0, longest[0]
        while True:
            stop = at + self.length[piece]
            if not failed >> stop & 1 and (not out or self._compatible(out[-1], piece)):
                out.append(piece)
                at = stop
                if at == n:
                    return out
                piece = longest[at]
            elif self.shorter[piece] >= 0:
                piece = self.shorter[piece]
            else:
                failed |= 1 << at
                piece = out.pop()
                at -= self.length[piece]

    def _chunk(self, text: str) -> bytes:
        ids, run = [], []
        for c in text:
            if c in self.single:
                run.append(c)
            else:
                if run:
                    ids += self._backtrack("".join(run))
                    run = []
                ids += [self.byte_ids[b] for b in c.encode()]
        if run:
            ids += self._backtrack("".join(run))
        return np.array(ids, "<u4").tobytes()

    def _get(self, chunk: str) -> bytes:
        found = self.kept.get(chunk)
        if found is None:
            found = self._chunk(MARK + chunk)
            if len(self.kept) < KEPT_CHUNKS and len(chunk) <= 32:
                self.kept[chunk] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids of a text with begin and end id, as little-endian 32-bit numbers."""
        if not text:
            body = b""
        elif not self.cut:
            body = self._chunk(MARK + text.replace(" ", MARK))
        elif "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            chunks = re.findall(f"{MARK}+[^{MARK}]*", MARK + text.replace(" ", MARK))
            body = b"".join([self._get(c[1:]) for c in chunks])
        else:
            chunks = text.split(" ")
            try:
                body = b"".join(map(self.kept.__getitem__, chunks))
            except KeyError:
                body = b"".join(map(self._get, chunks))
        return np.array([self.begin], "<u4").tobytes() + body + np.array([self.end], "<u4").tobytes()

    def decode(self, ids: bytes) -> str:
        """The text of ids, without the space that encoding put first."""
        text = "".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        if text[:1] == MARK:
            text = text[1:]
        text = text.replace(MARK, " ")
        try:
            text.encode()
        except UnicodeEncodeError:
            text = text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")
        return text


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    """One model per worker."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def encode_pieces(docs: DataFrame, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian 32-bit), decoded, and hashes of the last two.

    ``with_ids=False`` leaves out ids and decoded, which are as large as the texts.
    """
    kinds = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    kinds += [("ids", pa.binary()), ("decoded", pa.string())] if with_ids else []
    schema = pa.schema(kinds)

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [own.encode(t) for t in part.column(1).to_pylist()]
                texts = [own.decode(i) for i in ids]
                columns = [
                    part.column(0).cast(pa.int64()),
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array([hashlib.sha256(i).hexdigest() for i in ids]),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts]),
                ]
                if with_ids:
                    columns += [pa.array(ids, pa.binary()), pa.array(texts, pa.string())]
                yield pa.record_batch(columns, schema=schema)

    spark_kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    source = whole_texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return source.mapInArrow(run, spark_kinds + (", ids binary, decoded string" if with_ids else ""))
