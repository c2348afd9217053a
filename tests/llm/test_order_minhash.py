import hashlib
import re
import struct

import xxhash
from pyspark.sql import functions as F

from vittles.llm import order_minhash as omh
from vittles.llm.queries import QUERIES


def h(*parts):
    seed = 42
    for p in parts:
        seed = xxhash.xxh64_intdigest(p.encode() if isinstance(p, str) else struct.pack("<q", p), seed=seed) if not isinstance(p, tuple) else \
            xxhash.xxh64_intdigest(struct.pack("<i", p[0]), seed=seed)
    return seed


def plain_sketches(text):
    """The definition, by dictionaries and sorted lists of each bucket."""
    words, seen, buckets = re.findall(r"[^ \t\n\x0b\f\r]{1,12}", text), {}, {}
    for i in range(max(len(words) - omh.K + 1, min(len(words), 1))):
        kmer = h(*words[i : i + omh.K]) >> 33
        occurrence = seen[kmer] = seen.get(kmer, -1) + 1
        own = h(kmer, (occurrence,)) >> 33
        buckets.setdefault(own >> 25, []).append((own, i))
    out, order = [], sorted(buckets)
    for k, b in enumerate(order):
        least = sorted(buckets[b])[:2]
        if len(least) == 1 and len(order) > 1:
            least.append(min(buckets[order[(k + 1) % len(order)]]))
        pair = [x for _, x in sorted((i, x) for x, i in least)]
        out.append(b << 32 | h(*pair) >> 32)
    return out


def plain_likeness(a, b):
    either = {x >> 32 for x in a} | {x >> 32 for x in b}
    return len(set(a) & set(b)) / len(either) if either else 1.0


def check(rows, got):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    want = []
    for i, (doc, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        a, e, n = plain_sketches(text), plain_sketches(edited), plain_sketches(after)
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), ",".join(f"{x:x}" for x in a), ",".join(f"{x:x}" for x in e), plain_likeness(a, e), plain_likeness(a, n)))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_query_equals_brute_force_on_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op10_order_minhash"](spark, "/root/testdata/sf0.01").collect()
    check(docs, got)
    mean = sum(r.near_edited for r in got) / len(got), sum(r.near_next for r in got) / len(got)
    assert mean[0] > 0.3 > 0.1 > mean[1]


def test_edges_ties_blocks(spark, monkeypatch):
    monkeypatch.setattr(omh, "BLOCK_ROWS", 2)
    monkeypatch.setattr(omh, "FAN", 3)
    rows = [(i * 37 % 101, f"some words number {i} " * (i % 5)) for i in range(60)]
    rows += [(5, None), (5, "a b"), (5, "a b"), (None, "x"), (None, ""), (200, "y" * 30000), (201, "é 世界 " * 3000), (202, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("sig", F.lit(1)).withColumn("block", F.lit(2))
    check(rows, omh.edits(df).collect())
    check(rows[:1], omh.edits(df.limit(1)).collect())
    assert omh.edits(df.limit(0)).count() == 0


def test_order_matters(spark):
    for n, most in ((400, 0.8), (50, 0.65), (20, 0.65)):
        rows = [(" ".join(f"w{k}x{i}" for i in range(n)), " ".join(f"w{k}x{(i + n // 2) % n}" for i in range(n))) for k in range(40)]
        near = omh.likeness(omh.signature(F.col("a")), omh.signature(F.col("b")))
        got = spark.createDataFrame(rows, "a string, b string").agg(F.avg(near)).first()[0]
        assert 0.2 < got < most, n
