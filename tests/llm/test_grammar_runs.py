import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from vittles.llm import grammar_runs
from vittles.llm.queries import QUERIES


def brute(words):
    """All (start, length, period): for each distance the maximal stretches of equal words, the least distance of each."""
    seen, found = {}, {}
    codes = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
    for q in range(1, len(words) // 3 + 1):
        step = np.diff(np.concatenate([[0], (codes[:-q] == codes[q:]).astype(np.int8), [0]]))
        for s, e in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist()):
            if e - s + q >= max(24, 3 * q):
                found.setdefault((s, e - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def row(doc_id, text):
    """The query's row by its contract, written plainly."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in sorted(runs, key=lambda r: (r[0], r[2])))
    digest = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (lines, kept(words, runs))]
    return (doc_id, len(runs), *(best if best else (None,) * 3), 1000 * best[1] // best[2] if best else None, *digest)


def test_query_equals_brute_force_on_whole_table(spark):
    got = sorted(tuple(r) for r in QUERIES["op12_grammar_runs"](spark, "/root/testdata/sf0.01").collect())
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    assert got == sorted(row(r.doc_id, r.text) for r in docs)
    assert sum(r[1] > 0 for r in got) > 50


@pytest.mark.parametrize("seed", range(6))
def test_blocks_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    for _ in range(25):
        docs = []
        for _ in range(rng.integers(1, 6)):
            kinds = int(rng.integers(1, 5))
            if rng.random() < 0.5:
                docs.append(rng.integers(0, kinds, rng.integers(0, 300)))
            else:
                docs.append(np.concatenate([np.tile(rng.integers(0, kinds, rng.integers(1, 30)), rng.integers(1, 8)) for _ in range(rng.integers(1, 5))]))
        docs += docs[:1] * 3
        bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
        found = grammar_runs.runs_of(np.concatenate(docs).astype(np.int64), bounds, 5)
        got = [[] for _ in docs]
        for d, s, e, q in zip(*found):
            got[d].append((s - bounds[d], e - s, q))
        assert [sorted(g) for g in got] == [brute(d.tolist()) for d in docs]


def test_rules_derive_the_text_and_come_twice():
    rng = np.random.default_rng(9)
    words = np.concatenate([np.tile(rng.integers(0, 4, 7), 40), rng.integers(0, 4, 500)])
    bounds = np.array([0, 100, 100, 500, len(words)])
    g = grammar_runs.re_pair(words, bounds, 4)

    def expand(x):
        return [x] if x < g.first else expand(g.left[x - g.first]) + expand(g.right[x - g.first])

    for i in range(4):
        assert sum((expand(x) for x in g.symbols[g.roots[i] : g.roots[i + 1]]), []) == words[bounds[i] : bounds[i + 1]].tolist()
    rule, place = grammar_runs.derived(g, np.arange(len(g.left)))
    assert len(g.left) and (np.bincount(rule, minlength=len(g.left)) > 1).all()
    assert all(expand(g.first + r) == words[p : p + g.size[g.first + r]].tolist() for r, p in zip(rule, place))
    assert all(len(expand(g.first + i)) == g.size[g.first + i] for i in range(len(g.left)))


def test_runs_inside_a_rule_are_found_once_and_moved(monkeypatch):
    rng = np.random.default_rng(2)
    passage = np.concatenate([rng.integers(10, 500, 40), np.tile([1, 2, 3, 4, 5], 9), rng.integers(10, 500, 40)])
    docs = [np.concatenate([rng.integers(500, 9000, 30), passage, rng.integers(500, 9000, 30)]) for _ in range(50)]
    bounds = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    asked = []
    real = grammar_runs.crossing
    monkeypatch.setattr(grammar_runs, "crossing", lambda *a: asked.append(real(*a)) or asked[-1])
    doc, start, stop, q = grammar_runs.runs_of(np.concatenate(docs), bounds, 9000)
    assert doc.tolist() == list(range(50)) and set((stop - start).tolist()) == {45} and set(q.tolist()) == {5}
    assert set((start - bounds[doc]).tolist()) == {70} and len(asked[0][0]) < 10


def test_edges(spark):
    long_text = "ab cd " * 60_000 + "end"
    texts = [None, "", " \t\n", "a " * 23, "a " * 24, " x \x1fy\x0bz\x0c" * 30, "b\x85c " * 24, long_text, "x y z " * 8 + "x y", "A a " * 12]
    rows = [(i + 1000, t) for i, t in enumerate(texts)] + [(1004, "a " * 24), (None, "q " * 30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit(1)).withColumn("n_words", F.lit("x")).withColumn("start", F.lit(2))
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in grammar_runs.periodic_runs(df).collect()]
    want = []
    for i, t in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        runs = brute(words) if t != long_text else [(0, 120_000, 2)]
        want.append((i, len(words), runs, kept(words, runs)))
    key = lambda r: (r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert grammar_runs.periodic_runs(df.limit(0)).count() == 0
