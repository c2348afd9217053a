import hashlib
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vittles.llm import jaccard_join as jj
from vittles.llm.queries import QUERIES


def plain_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else ({tuple(words)} if words else set())


def brute(rows):
    sets = [(i, frozenset(plain_set(t))) for i, t in rows]
    boss = {i: i for i, _ in rows if i is not None}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    distinct = sorted({(i, s) for i, s in sets if i is not None and s}, key=lambda x: len(x[1]))
    for k, (i, s) in enumerate(distinct):
        for j, o in distinct[k + 1 :]:
            if 100 * len(s) < 85 * len(o):
                break
            if 100 * len(s & o) >= 85 * len(s | o):
                a, b = sorted((find(i), find(j)))
                boss[b] = a
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=repr)


def firsts(rows):
    """Of each group of linked texts the row with the least id (then digest); rows with a null id stay."""
    texts = sorted({(i, hashlib.sha256((t or "").encode()).hexdigest(), t) for i, t in rows if i is not None}, key=lambda x: x[:2])
    component = {i: c for i, _, c in brute([(k, t) for k, (_, _, t) in enumerate(texts)])}
    return sorted([(i, t) for k, (i, _, t) in enumerate(texts) if component[k] == k] + [r for r in rows if r[0] is None], key=repr)


def made(seed, n):
    rng = np.random.default_rng(seed)
    vocabulary, passage, out = [f"w{i}" for i in range(40)], " ".join(f"p{i}" for i in range(30)), []
    for i in range(n):
        if out and rng.random() < 0.6:
            words = out[rng.integers(len(out))][1].split(" ")
            for _ in range(rng.integers(0, 3)):
                words[rng.integers(len(words))] = str(rng.choice(vocabulary)).upper()
            text = " ".join(words)
        else:
            text = " ".join(rng.choice(vocabulary, rng.choice([2, 4, 6, 9, 12, 15, 18, 40, 90])))
            text += f" {passage}" if rng.random() < 0.3 else ""
        out.append((i, text))
    return out


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAbB \t\n\x1c\x85é世İ", max_size=30), max_size=6))
def test_set_sizes_and_equality(texts):
    got = [s.tolist() for s in jj.shingle_sets(texts)]
    want = [plain_set(t) for t in texts]
    assert [len(s) for s in got] == [len(s) for s in want]
    for (a, x), (b, y) in itertools.combinations(zip(got, want), 2):
        assert len(set(a) & set(b)) == len(x & y)


@pytest.mark.parametrize("light", [0, 7, 16])
def test_keys_meet_for_all_links(light):
    rng = np.random.default_rng(light)
    for _ in range(1500):
        n = int(rng.integers(1, 30))
        a = rng.choice(np.arange(1, 60, dtype=np.uint64), n, replace=False)
        b = np.concatenate([a[rng.integers(0, 4) :], rng.choice(np.arange(70, 90, dtype=np.uint64), rng.integers(0, 4), replace=False)])
        a, b = np.sort(a), np.sort(b)
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 85 * len(np.union1d(a, b)):
            continue
        common, rank = np.arange(1, 60, 3, dtype=np.uint64), np.arange(20)
        x, y = jj._keys(a, light, common, rank), jj._keys(b, light, common, rank)
        assert set(x[0].tolist()) & set(y[0].tolist()) or set(x[1].tolist()) & set(y[1].tolist())


def test_components_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jj, "COMMON", 20)
    rows = made(4, 260)
    rows += [(1000, None), (1001, ""), (1002, " \n"), (None, rows[0][1]), (3, rows[5][1]), (7, rows[7][1]), (1003, "z " * 30000), (1004, "z " * 29000), (1005, "one"), (1006, "ONE")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("digest", F.lit("x"))
    got = sorted((tuple(r) for r in jj.near_duplicates(df).collect()), key=repr)
    assert got == brute(rows)
    kept = sorted(((r.doc_id, r.text) for r in jj.keep_one(df).collect()), key=repr)
    assert kept == firsts(rows) and kept.count((3, rows[3][1])) + kept.count((3, rows[5][1])) >= 1 and jj.keep_one(df).columns == df.columns
    assert jj.near_duplicates(df.limit(0)).count() == 0


def test_query_equals_brute_force_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in QUERIES["op6_jaccard_join"](spark, "/root/testdata/sf0.01").collect()), key=repr)
    assert got == brute(rows)


def test_boundary_weighs_both_costs():
    assert jj.boundary({5: 10, 20: 10}, 0.0) < 20 and jj.boundary({20: 10}, 1e9) >= 20 and jj.subsets_written(5) == 1


def test_unlike_texts_of_one_id_both_stay(spark):
    rows = [(1, "a b c d e f"), (1, "u v w x y z"), (1, "a b c d e f"), (2, "u v w x y z"), (2, "one two three four five"), (None, "u v w x y z"), (3, None), (3, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text or "") for r in jj.keep_one(df).collect()), key=repr)
    assert got == sorted([(1, "a b c d e f"), (1, "u v w x y z"), (2, "one two three four five"), (None, "u v w x y z"), (3, "")], key=repr)


def test_group_of_copies_in_unlike_sizes_is_linked(spark):
    rng = np.random.default_rng(8)
    base = [f"w{i}" for i in rng.integers(0, 10**6, 300)]
    rows = [(i, " ".join(f"x{i}" if rng.random() < 0.004 else w for w in base[: 300 - int(rng.integers(0, 30))])) for i in range(150)]
    rows += [(1000 + i, " ".join([f"n{i}w{j}" for j in range(200)] + base[:40])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in jj.near_duplicates(df).collect()) == sorted(brute(rows))


def test_rounds_end_when_they_spare_little(spark, monkeypatch):
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(200):
        spots = set(rng.choice(300, int(rng.integers(0, 7)), replace=False).tolist())
        rows.append((i, " ".join(f"x{i}y{j}" if j in spots else w for j, w in enumerate(base))))
    passes, whole = [], jj.verified
    monkeypatch.setattr(jj, "verified", lambda *a: passes.append(1) or whole(*a))
    assert sorted(tuple(r) for r in jj.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()) == sorted(brute(rows))
    # neighbours by size, at most two rounds of random ones, and what is left
    assert len(passes) <= 4


def test_sieve_grows_with_the_ids(spark):
    for n in (0, 10, 100_000):
        bits = 64 * len(jj._sieve(spark.range(n), n))
        assert max(1 << 16, jj.SIEVE_SHARE * n) <= bits <= max(1 << 16, 2 * jj.SIEVE_SHARE * n)
