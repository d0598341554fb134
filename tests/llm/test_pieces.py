import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)
TEXT = st.lists(st.one_of(st.sampled_from([" ", "  ", "▁", "\n", "\t", "the", "of", "\x00", "<s>", "</s>", "<0x0A>", "　",
                                           "é", "é", "日本", "😀", ");\r", "0", "ing"]), st.text(max_size=4)),
                max_size=12).map("".join)


def check(codec, text):
    chunks = codec.chunks(text)
    codec.learn(set(chunks))
    ids = LIB.encode(text, add_bos=True, add_eos=True)
    assert codec.encode(chunks) == np.array(ids, "<u4").tobytes()
    assert codec.decode(chunks) == LIB.decode(ids)


@given(TEXT)
@settings(max_examples=600, deadline=None)
def test_same_as_the_library(text):
    codec = pieces.codec(MODEL)
    assert codec.separable
    check(codec, text)


@given(TEXT)
@settings(max_examples=100, deadline=None)
def test_whole_texts_when_pieces_may_cross(text):
    codec = pieces.Codec.__new__(pieces.Codec)
    codec.__dict__.update(pieces.codec(MODEL).__dict__, separable=False, ids={}, texts={})
    check(codec, text)


def test_table_starts_anew(monkeypatch):
    monkeypatch.setattr(pieces, "TABLE", 3)
    codec = pieces.Codec(MODEL)
    for text in ["a b c d e", "f g h", "a f", "", "b  "]:
        check(codec, text)


def test_rows(docs):
    rows = [(1, None), (2, ""), (2, ""), (None, "some text\nhere"), (3, "x" * 50_000), (4, "the of " * 40_000)]
    got = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in pieces.digests(docs(rows), MODEL).collect()}
    want = set()
    for doc_id, text in rows:
        ids = LIB.encode(text or "", add_bos=True, add_eos=True)
        want.add((doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                  hashlib.sha256(LIB.decode(ids).encode()).hexdigest()))
    assert got == want
    lists = pieces.encode(docs(rows), MODEL).collect()
    assert all(r["ids"] == LIB.encode(t or "", add_bos=True, add_eos=True)
               for r in lists for i, t in rows if i == r["doc_id"])
    assert pieces.digests(docs([]), MODEL).count() == 0


@pytest.mark.parametrize("text", [" ", "  ", " a", "a ", "a  b", "▁", "\n"])
def test_lone_markers(text):
    check(pieces.Codec(MODEL), text)


def test_encoding_alone_keeps_no_decoded_texts():
    codec = pieces.Codec(MODEL)
    codec.learn({"the", "river"}, decoded=False)
    assert set(codec.ids) == {"the", "river"} and not codec.texts
    check(codec, "the river bank")
