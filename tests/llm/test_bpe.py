"""Byte-level BPE against the public library, and the exact way back."""

import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from linepareto.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(library, texts):
    ranks, cache = bpe._ranks(PATH, PATTERN)
    for text, ids in zip(texts, cache.ids(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
        assert ranks.decode(ids) == text.encode()


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r'sdmLl ab1é,.\x85\xa0　\x1c日😀ªʰǅ<|"), max_size=40), max_size=4))
def test_any_text(texts):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    same(tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), texts)


def test_long_and_odd_texts(library):
    same(library, ["", " ", "  ", "x" * 20_000, " " * 5000 + "hi", "<|endoftext|> x", "aaaa bbbb" * 300, "日本語" * 2000,
                   "don't  stop\r\n\r\n  now   ", "the, the. the? then the the,", "\x00\x01\x02", "-" * 9999])


def test_a_cache_that_is_emptied_gives_the_same(library, prose):
    ranks, _ = bpe._ranks(PATH, PATTERN)
    small = bpe.Pieces(ranks.encode_pieces, keep=50)
    for k in range(30):
        texts = [prose(k, 80), prose(k // 2, 80)]
        assert [np.frombuffer(i, "<u4").tolist() for i in small.ids(texts)] == [library.encode_ordinary(t) for t in texts]


def test_table(table, prose, library):
    rows = [(k, prose(k, k)) for k in range(40)] + [(None, "a"), (50, None), (51, ""), (3, prose(3, 3))]
    got = {(r["doc_id"], r["ids_sha256"]): r for r in bpe.round_trip(table(rows), PATH, PATTERN).collect()}
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        r = got[doc_id, hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()]
        assert r["n_tokens"] == len(ids) and r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(table([]), PATH, PATTERN).collect() == []
