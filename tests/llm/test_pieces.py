import hashlib

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from histkit.llm.pieces import PieceModel, encode_pieces
from histkit.llm.queries import op4_pieces
from tests.llm.small import SF, empty, odd, rows

PATH = public_tokenizers.path("piece_bpe_32k.model")
OWN = PieceModel(PATH)
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(text):
    ids = OWN.encode(text)
    theirs = [OWN.begin, *LIBRARY.encode(text), OWN.end]
    assert np.frombuffer(ids, "<u4").tolist() == theirs
    assert OWN.decode(ids) == LIBRARY.decode(theirs)


@settings(deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="abe \n▁.thing", max_size=60))
def test_any_text(text):
    same(text)


@settings(deadline=None)
@given(st.lists(st.sampled_from(sorted(OWN.ids)), max_size=12))
def test_joined_pieces(pieces):
    """Texts made of pieces need to go back most often."""
    same("".join(pieces).replace("▁", " "))


def test_uncut_texts():
    """Chunks change nothing: one chunk for the whole text gives the same."""
    text = rows()[0]["text"][:3000]
    own = PieceModel(PATH)
    own.cut = False
    assert own.encode(text) == OWN.encode(text)


def brute(text):
    ids = [OWN.begin, *LIBRARY.encode(text or ""), OWN.end]
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest(),
    )


def test_query(spark):
    got = sorted(tuple(r) for r in op4_pieces(spark, SF).collect())
    assert got == sorted((r["doc_id"], *brute(r["text"])) for r in rows())


def test_odd_rows(spark):
    docs = odd(spark)
    got = encode_pieces(docs, PATH).collect()
    order = lambda r: (str(r[0]), r[1], r[2])
    assert sorted((tuple(r)[:4] for r in got), key=order) == sorted(((r["doc_id"], *brute(r["text"])) for r in docs.collect()), key=order)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    assert encode_pieces(empty(spark), PATH).collect() == []
