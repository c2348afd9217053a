import zlib

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from vittles.llm import pow2_packing as pack

FILE = P.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(FILE)
WHOLE.encode_special_tokens = True
OWN = pack.PartEncoder(FILE)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("  \n\t\x1c\x85\xa0 's1a<|.é"), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_parts_give_the_ids_of_the_whole(texts):
    want = [np.array(WHOLE.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert OWN.encode(texts) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("  \n\t\x1c\x85\xa0 's1a<|.é"), st.characters(codec="utf-8")), max_size=60), max_size=4))
def test_whole_texts_give_the_same_ids(texts):
    assert pack.encoder(FILE)(texts) == [np.array(WHOLE.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_lengths():
    assert pack.binary_lengths(0) == [] and pack.binary_lengths(1) == [1] and pack.binary_lengths(2051) == [1024, 1024, 2, 1]
    assert all(sum(pack.binary_lengths(n, 8)) == n for n in range(99))


def test_pieces_and_sequences(spark):
    rows = [(5, "one two three " * 900, 1), (6, None, 1), (7, "", 2), (5, "one two three " * 900, 1), (None, "a b", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = pack.packed_digest(df, FILE).collect()
    for i, text, _ in rows:
        ids = np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        own = [r for r in got if r.doc_id == i and r.start == 0]
        assert len(own) == sum(r[0] == i for r in rows) and own[0].doc_tokens == len(ids)
        for r in (r for r in got if r.doc_id == i):
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.offset == 0
            assert r.length & (r.length - 1) == 0 and r.length <= 1024
        assert sum(r.length for r in got if r.doc_id == i) == len(ids) * len(own)
    assert sorted(r.sequence_id for r in got) == list(range(len(got)))
    assert [r.length for r in sorted(got, key=lambda r: r.sequence_id)] == sorted(r.length for r in got)
    assert pack.packed_digest(df.limit(0), FILE).count() == 0
