import hashlib
import math
import random
import struct
import zlib

import xxhash

from pyspark.sql import functions as F

from vittles.llm import kd_sharding
from vittles.llm.queries import op1_kd_sharding


def test_whole_table_is_sharded_near_equally(spark):
    df = op1_kd_sharding(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").toPandas()
    got = df.toPandas()
    assert sorted(got.doc_id) == sorted(docs.doc_id)
    want = {d: (len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in zip(docs.doc_id, docs.text)}
    assert all(want[d] == (s, c) for d, s, c in zip(got.doc_id, got["size"], got.text_crc32))
    assert set(got.shard) == set(range(24)) and set(got.law) == {"bytes"} and got.grown_shard.isna().all()
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    largest, mean = got["size"].max(), got["size"].sum() / 24
    by_shard = got.groupby("shard")["size"].sum()
    assert (by_shard - mean).abs().max() <= 1.5 * largest
    small = got.groupby("text_crc32").filter(lambda g: g["size"].sum() <= mean / kd_sharding.FINE)
    assert small.groupby("text_crc32").shard.nunique().max() == 1


def test_hot_group_is_split(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "same text " * 9).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
                                  F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(1).alias("size"))
    got = kd_sharding.kd_shards(df, n_shards=7).toPandas()
    by_shard = got.groupby("shard")["size"].sum()
    assert len(by_shard) == 7 and by_shard.max() < 1.1 * by_shard.min()


def test_nulls_ties_empty(spark):
    rows = [(1, None, "en"), (1, None, "en"), (None, "a", None), (2, "", None), (3, "x" * 100000, "fr")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("source", F.lit(None).cast("string"))
    got = kd_sharding.kd_shards(df, n_shards=4).collect()
    assert sorted(r["size"] for r in got) == [8, 8, 8, 9, 100008]
    assert kd_sharding.kd_shards(df, target_bytes=50_000).count() == 5
    assert kd_sharding.kd_shards(df.limit(0), n_shards=4).count() == 0


def plain_tree(rows, shards, first=0):
    """{id: shard} by sorting each node along its widest dimension; rows are (id, size, keys)."""
    if shards == 1 or not rows:
        return {i: first for i, _, _ in rows}
    left = shards // 2
    spread = [(max(k[d] for _, _, k in rows) >> 32) - (min(k[d] for _, _, k in rows) >> 32) for d in range(len(rows[0][2]))]
    d, want, under, cut = spread.index(max(spread)), sum(s for _, s, _ in rows) * left / shards, 0, None
    by_key = {}
    for _, s, k in rows:
        by_key[k[d]] = by_key.get(k[d], 0) + s
    for key in sorted(by_key):
        if under + by_key[key] >= want:
            cut = key if want - under <= under + by_key[key] - want else key + 1
            break
        under += by_key[key]
    below, above = [r for r in rows if r[2][d] < cut], [r for r in rows if r[2][d] >= cut]
    return plain_tree(below, left, first) | plain_tree(above, shards - left, first + left)


def test_tree_equals_a_plain_recursive_one(spark):
    rng = random.Random(3)
    rows = [(i, "w" * rng.randrange(1, 400) + f" {i}", rng.choice(["de", "en", "fr", None]), rng.choice("abcdefgh")) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.shard for r in kd_sharding.kd_shards(df, n_shards=11).collect()}

    def scaled(values):
        lo, hi = min(v for v in values if v is not None), max(v for v in values if v is not None)
        return [0 if v is None else int((v - lo) / ((hi - lo) or 1.0) * (2**31 - 1)) for v in values]

    columns = [[math.log2(len(t.encode()) + 8.0) for _, t, _, _ in rows], [None if x is None else float(zlib.crc32(x.encode())) for _, _, x, _ in rows],
               [float(zlib.crc32(x.encode())) for *_, x in rows], [float(i) for i, *_ in rows]]
    limit = sum(len(t.encode()) + 8 for _, t, _, _ in rows) / 11 / kd_sharding.FINE

    def tie(i, text):
        size, hashed = len(text.encode()) + 8, xxhash.xxh64_intdigest(struct.pack("<q", i), seed=42)
        chunk = (hashed - (hashed >> 63 << 64)) % (math.ceil(size / limit) if size > limit else 1)
        return xxhash.xxh64_intdigest(struct.pack("<q", chunk), seed=xxhash.xxh64_intdigest(hashlib.md5(text.encode()).digest(), seed=42)) >> 32

    ties = [tie(i, t) for i, t, _, _ in rows]
    keys = list(zip(*[[(v << 32) + t for v, t in zip(scaled(c), ties)] for c in columns]))
    want = plain_tree([(r[0], len(r[1].encode()) + 8, k) for r, k in zip(rows, keys)], 11)
    assert got == want
