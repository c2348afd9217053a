import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vittles.llm import bidiagonal_whitening as bw
from vittles.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"


def brute(vectors, k=8):
    """(n, deviations, whitened [row, component], explained) by a plain eigendecomposition."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(row, sums)) for row in x]
    centred = np.array([[(n * c - s) / n for c, s in zip(row, sums)] for row in x])
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:k]
    return n, deviations, centred @ turned[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def held(got, ids, want, k):
    n, deviations, whitened, explained = want
    rows = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(rows) == len(ids) * k
    for j in range(k):
        mine = np.array([rows[i, j + 1].whitened for i in ids])
        sign = np.sign(mine @ whitened[:, j])
        assert np.abs(sign * mine - whitened[:, j]).max() < 1e-7
        assert all(rows[i, j + 1].explained == pytest.approx(explained[j], rel=1e-10) for i in ids)
    assert [rows[i, 1].deviation for i in ids] == deviations
    assert {r.n for r in got} == {n} and len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_query_equals_brute_force_on_whole_table(spark):
    got = QUERIES["op13_bidiagonal_whitening"](spark, "/root/testdata/sf0.01").collect()
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    held(got, [r.vec_id for r in rows], brute([r.embedding for r in rows]), 8)


def test_steps_orthogonalise_and_find_repeated_variances():
    rng = np.random.default_rng(3)
    basis = np.linalg.qr(rng.normal(size=(40, 40)))[0][:, :12]
    deviations = np.array([9, 9, 9, 5, 4, 3, 2, 2, 2, 1, 1e-3, 1e-5])
    x = np.linalg.qr(rng.normal(size=(300, 12)))[0] * deviations @ basis.T
    vectors, values = bw.bidiagonalise(lambda q: (float((x @ q) @ (x @ q)), x.T @ (x @ q)), 40, float((x * x).sum()), 8)
    assert np.allclose(values, deviations[:8], rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(8), atol=1e-9) and np.allclose(x.T @ (x @ vectors), vectors * values**2, atol=1e-7)


def test_steps_end_early_where_the_rest_is_small():
    rng, calls = np.random.default_rng(4), []
    x = rng.normal(size=(500, 200)) * np.geomspace(100, 1e-6, 200)

    def product(q):
        calls.append(1)
        return float((x @ q) @ (x @ q)), x.T @ (x @ q)

    _, values = bw.bidiagonalise(product, 200, float((x * x).sum()), 8)
    assert len(calls) < 100 and np.allclose(values, np.linalg.svd(x)[1][:8], rtol=1e-12)


def test_edges(spark):
    rng = np.random.default_rng(5)
    good = [[float(c) for c in np.float32(rng.normal(size=6) * [3, 2, 1, 1, 0.5, 0])] for _ in range(50)]
    good += [good[0], good[0], [0.0] * 6]
    rows = list(enumerate(good)) + [(100, None), (101, []), (102, [None] * 6), (103, [float("nan")] * 6), (104, [float("inf")] + [0.0] * 5), (105, [1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("width", F.lit("x")).withColumn("n", F.lit(1)).repartition(5)
    held(bw.whiten(df).collect(), list(range(53)), brute(good, 5), 5)
    assert bw.whiten(df.limit(0)).count() == 0
    assert bw.whiten(df.where("vec_id IN (0, 50, 51)")).count() == 0
    null_id = spark.createDataFrame([(None, [1.0, 0.0]), (1, [0.0, 1.0])], SCHEMA)
    assert sorted((r.vec_id or 0, r.component, abs(round(r.whitened, 9))) for r in bw.whiten(null_id).collect()) == [(0, 1, 1.0), (1, 1, 1.0)]


def test_deviations_stay_exact_beyond_longs(spark):
    rows = [(0, [3.0e9, 1.0]), (1, [-3.0e9, 2.0]), (2, [0.0, 1e30])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.deviation for r in bw.whiten(df).collect()}
    assert got == {0: None, 1: None, 2: None}
    small = spark.createDataFrame([(i, [float(i * 1_000_000), 0.5]) for i in range(4)], "vec_id long, embedding array<double>")
    exact = {i: (4 * 1024 * i * 1_000_000 - 1024 * 6_000_000) ** 2 for i in range(4)}
    assert {r.vec_id: r.deviation for r in bw.whiten(small).collect()} == {i: v if v < 1 << 63 else None for i, v in exact.items()}
