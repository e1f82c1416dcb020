import io
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from histkit.llm import token_files
from histkit.llm.queries import op2_token_files
from histkit.llm.token_files import (
    BLOCK,
    TokenFile,
    WordEncoder,
    pack_blocks,
    read_file,
    read_token_files,
    unpack_blocks,
    write_token_files,
)
from tests.llm.small import SF, empty, odd, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 50_000) | st.just(7), max_size=700))
def test_blocks_round_trip(ids):
    ids = np.array(ids, np.uint32)
    data, index = pack_blocks(ids)
    assert len(index) == -(-len(ids) // BLOCK)
    assert unpack_blocks(data, index)[: len(ids)].tolist() == ids.tolist()


def test_outliers_do_not_widen_a_block():
    ids = np.arange(1000, 1000 + BLOCK, dtype=np.uint32) % 16 + 5000
    ids[[3, 90]] = 4_000_000_000
    data, index = pack_blocks(ids)
    assert index["least"][0] == 5000 and index["width"][0] == 4 and index["outliers"][0] == 2
    assert len(data) == 4 * BLOCK // 8 + 2 * 5


class Sink(io.BytesIO):
    def close(self):
        self.whole = self.getvalue()


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_file_round_trip(monkeypatch):
    monkeypatch.setattr(token_files, "CHUNK", 2)
    rng = np.random.default_rng(0)
    docs = [(i if i % 5 else None, rng.integers(0, 60_000, n).astype(np.uint32)) for i, n in enumerate([0, 1, 700, 3, 0, 256, 5000, 2])]
    sink = Sink()
    out = TokenFile(sink)
    for key, ids in docs:
        out.add(key, ids)
    out.close()
    got = list(read_file(Source(sink.whole)))
    assert [(k, i.tolist()) for k, _, i in got] == [(k, i.tolist()) for k, i in docs]
    assert [f for _, f, _ in got] == np.cumsum([0, *[len(i) for _, i in docs]])[:-1].tolist()
    with pytest.raises(ValueError):
        list(read_file(Source(sink.whole[:-1])))


@settings(deadline=None)  # the first texts warm the encoder
@given(st.text(alphabet="ab é\n\t  '.1日😀", max_size=40))
def test_words_encode_as_whole_texts(text):
    whole = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.encode([text])[0], "<u4").tolist() == whole


ENCODER = WordEncoder(PATH)


def test_columns_of_texts_encode_as_whole_texts():
    texts = ["to be or not to be", "", " or not", "be  to", "be\n or\nnot", "not", "été. \tété", "<|endoftext|> to be"]
    column = pa.array(["cut off", *texts, "too"]).slice(1, len(texts))
    whole = [Tokenizer.from_file(PATH).encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(ids, "<u4").tolist() for ids in ENCODER.encode(column)] == whole
    assert ENCODER.encode(column.slice(0, 0)) == []


def brute(texts):
    """(doc_id, start, n_tokens, crc) from the library, in id order."""
    tokenizer, at, out = Tokenizer.from_file(PATH), 0, []
    for key, text in sorted(texts, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        out.append((key, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    return out


def test_query(spark):
    got = [tuple(r) for r in op2_token_files(spark, SF).collect()]
    assert sorted(got) == brute([(r["doc_id"], r["text"]) for r in rows()])


def test_odd_rows(spark):
    docs = odd(spark)
    got = read_token_files(write_token_files(docs, PATH)).collect()
    got = sorted(((r["doc_id"], r["start"], r["n_tokens"], zlib.crc32(r["ids"])) for r in got), key=lambda r: r[1])
    assert got == brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert read_token_files(write_token_files(empty(spark), PATH)).collect() == []
