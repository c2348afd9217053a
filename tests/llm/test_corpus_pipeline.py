import re
import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_jaccard_settings import brute
from tests.llm.test_secret_crf import plain_base

D = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs, labels = spark.read.parquet(f"{D}/documents.parquet"), {r.doc_id: r for r in spark.read.parquet(f"{D}/labels.parquet").collect()}
    columns, rows = docs.columns, {r.doc_id: r for r in docs.collect()}
    kept = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, D).cache()
        assert docs.columns == columns, name
        kept.append({r.doc_id: r for r in docs.collect()})
    good, clean, single, masked = kept
    for now, before, label, bad in ((good, rows, "quality", 0), (clean, good, "toxic", 1)):
        rated = [i for i in before if i in labels]
        assert np.mean([(i in now) == (labels[i][label] != bad) for i in rated]) > 0.95
        assert all(now[i] == before[i] for i in now)
    assert sorted(single) == sorted(i for i, _, c in brute([(i, r.text) for i, r in clean.items()], 5, 80) if i == c)
    assert masked.keys() == single.keys()
    for i, r in masked.items():
        base = plain_base(single[i].text)
        assert ("[SECRET]" in r.text) >= bool(base) and not plain_base(r.text) and len(r.text) == r.n_chars
        if not base:
            assert r.text == single[i].text or "[SECRET]" in r.text


def test_run_packs_what_the_stages_keep(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001").cache()
    tokenizer = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {r.doc_id: np.array([*tokenizer.encode(r.text, add_special_tokens=False).ids, 0], "<u4") for r in docs.collect()}
    assert {r.doc_id for r in out} == want.keys()
    for r in out:
        assert zlib.crc32(want[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32
    assert sum(r.length for r in out) == sum(len(x) for x in want.values())


def test_edge_rows_pass_every_stage(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (2, "", "en", "a", 0), (None, "plain words " * 30, "en", "a", 360), (3, "x" * 200000, "en", "a", 200000)]
    edge = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("id", F.lit(7))
    for docs in (edge, edge.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, D)
            assert out.count() >= 0 and (name == "packing" or out.columns == edge.columns)
    assert re.fullmatch(r"\w+", name)
