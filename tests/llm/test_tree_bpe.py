import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from vittles.llm import tree_bpe

RANKS = P.path("byte_bpe_multi_50k.tiktoken")
with open(RANKS, "rb") as f:
    PLAIN = tiktoken.Encoding("plain", pat_str=P.PATTERN, special_tokens={},
                              mergeable_ranks={base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
SMALL = tree_bpe.TreeCodec(RANKS, P.PATTERN, leaf=3, window=1)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t\x1c\x85\xa0'srevml1<|.éа世"), st.characters(codec="utf-8")), max_size=80))
def test_tree_equals_whole(text):
    ids = SMALL.encode(text)
    assert ids.tolist() == PLAIN.encode_ordinary(text)
    assert SMALL.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["", "x" * 5000, " " * 5000, "we're we'll it's " * 900, "a\n \n b  c" * 700, "世" * 3000])
def test_long_and_unbroken(text):
    own = tree_bpe.TreeCodec(RANKS, P.PATTERN, leaf=64)
    assert own.encode(text).tolist() == PLAIN.encode_ordinary(text)


def test_query_shape(spark):
    rows = [(1, "Hello <|endoftext|> wörld", 5), (2, None, 6), (3, "", 7), (1, "Hello <|endoftext|> wörld", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = tree_bpe.digests(tree_bpe.encode_texts(df, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()
    got = sorted(tuple(r) for r in out)
    want = sorted((i, len(ids := PLAIN.encode_ordinary(t or "")), tree_bpe.ids_digest(ids), hashlib.sha256((t or "").encode()).hexdigest())
                  for i, t, _ in rows)
    assert got == want
    assert tree_bpe.encode_texts(df.limit(0), RANKS, P.PATTERN).count() == 0


def test_query_equals_tiktoken_on_whole_table(spark):
    from vittles.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in QUERIES["op7_tree_bpe"](spark, "/root/testdata/sf0.01").collect())
    want = sorted((r.doc_id, len(ids := PLAIN.encode_ordinary(r.text or "")), tree_bpe.ids_digest(ids), hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs)
    assert got == want


def test_ordinary_texts_are_halved(monkeypatch):
    own, joined = tree_bpe.TreeCodec(RANKS, P.PATTERN), []
    real = own._join
    monkeypatch.setattr(own, "_join", lambda *a: joined.append(a[2]) or real(*a))
    text = "Some plain words, as a document has them. " * 50
    assert own.encode(text).tolist() == PLAIN.encode_ordinary(text) and len(joined) >= 7
