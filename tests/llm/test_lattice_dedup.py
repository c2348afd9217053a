import itertools

import numpy as np
from pyspark.sql import functions as F

from vittles.llm import graph, lattice_dedup
from vittles.llm.queries import QUERIES


def brute(rows, least=0.93):
    n = len(rows)
    ok = [r[2] is not None and r[1] is not None and len(r[1]) > 0 and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    links, comp = [0] * n, list(range(n))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i, j in itertools.combinations([i for i in range(n) if ok[i]], 2):
        a, b = rows[i], rows[j]
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = np.float64(np.float32(a[1])), np.float64(np.float32(b[1]))
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= least:
                links[i] += 1
                links[j] += 1
                x, y = find(i), find(j)
                comp[max(x, y, key=lambda k: rows[k][0])] = min(x, y, key=lambda k: rows[k][0])
    return sorted((r[0], links[i], rows[find(i)][0], rows[find(i)][0] == r[0]) for i, r in enumerate(rows))


def made(n=400, width=64, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        base = rows[rng.integers(len(rows))][1] if i > 20 and i % 3 else None
        v = rng.normal(size=width) if base is None else np.array(base) + rng.choice([0, 0.1, 0.25]) * rng.normal(size=width)
        rows.append((i, [float(x) for x in np.float32(v)], int(rng.integers(2))))
    return rows


def test_lattice_point_is_the_nearest():
    x = np.random.default_rng(1).normal(size=(50, 8)) * 2
    got = lattice_dedup.nearest_e8(x)
    for row, point in zip(x, got):
        near = min((((row - point - s) ** 2).sum() for s in lattice_dedup.STEPS))
        assert ((row - point) ** 2).sum() <= near + 1e-9
    doubled = 2 * got
    assert ((doubled % 2).std(axis=1) == 0).all() and (got.sum(axis=1) % 2 == 0).all()


def test_links_equal_brute_force_on_edge_rows(spark, monkeypatch):
    rows = made()
    rows += [(1000, rows[0][1], rows[0][2]), (1001, rows[0][1], None), (1002, None, 1), (1003, [0.0] * 64, 1), (1004, [float("nan")] * 64, 1), (1005, [], 1), (1006, [None] * 64, 1),
             (1007, [1.0, 2.0], 1), (1008, [2.0, 4.0], 1), (1009, [float("inf")] * 64, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("rep", F.lit(1))
    want = brute(rows)
    monkeypatch.setattr(lattice_dedup, "BLOCK", 7)
    got = sorted(tuple(r) for r in lattice_dedup.near_copies(df).collect())
    close = sum(g == w for g, w in zip(got, want)) / len(want)
    assert len(got) == len(want) and close >= 0.98 and sum(g[1] for g in got) <= sum(w[1] for w in want)
    assert lattice_dedup.near_copies(df.limit(0)).count() == 0


def test_query_finds_the_links_of_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = sorted(tuple(r) for r in QUERIES["op4_lattice_dedup"](spark, "/root/testdata/sf0.01").collect())
    want = brute(rows)
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in want) and sum(r[3] for r in got) == sum(r[3] for r in want)


def test_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 0), (300, 299)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in [*range(61), 200]} | {100: 100, 101: 100, 299: 299, 300: 299}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
