"""Distributed operators against brute force on small random data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vittles.operators import neighbors, ranking


def _brute_topk(ids, X, k):
    U = X / np.where(np.linalg.norm(X, axis=1, keepdims=True) == 0, 1, np.linalg.norm(X, axis=1, keepdims=True))
    S = U @ U.T
    out = {}
    for i, a in enumerate(ids):
        cand = [(-S[i, j], ids[j]) for j in range(len(ids)) if ids[j] != a]
        cand.sort()
        out[a] = [(b, -s) for s, b in cand[:k]]
    return out


@pytest.mark.parametrize("block_rows", [7, 1000])
def test_cosine_top_k_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(3)
    X = rng.integers(-2, 3, size=(60, 4)).astype(float)  # small integers: many exact ties
    X[5] = 0.0  # zero vector: similarity 0 to all
    ids = list(range(100, 160))
    df = spark.createDataFrame(pd.DataFrame({"k": ids, "v": [list(r) for r in X]}))
    got = neighbors.cosine_top_k(df, "k", "v", 5, block_rows=block_rows).toPandas()
    exp = _brute_topk(ids, X, 5)
    for a, grp in got.groupby("id"):
        g = grp.sort_values("rank")
        assert list(g["neighbor_id"]) == [b for b, _ in exp[a]]
        assert np.allclose(g["sim"], [s for _, s in exp[a]])
    assert got["id"].nunique() == 60


def test_top_k_per_group_salted(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 400), "id": np.arange(400), "s": rng.integers(0, 20, 400)})
    df = spark.createDataFrame(pdf)
    got = ranking.top_k_per_group(df, ["g"], [("s", "desc"), ("id", "asc")], 4, salt_of="id", salt_buckets=8)
    got = got.toPandas().sort_values(["g", "rank"])
    exp = pdf.sort_values(["g", "s", "id"], ascending=[True, False, True]).groupby("g").head(4)
    assert list(got["id"]) == list(exp["id"])


def test_prefix_max_and_lag(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"id": np.arange(300), "score": rng.integers(0, 10, 300).astype(float),
                        "p": rng.random(300)})
    df = spark.createDataFrame(pdf)
    order = [("score", "asc"), ("id", "asc")]
    pm = ranking.prefix_max(df, order, "p", "pm", partitions=5).toPandas().set_index("id")
    lg = ranking.lag_in_order(df, order, "p", "prev", partitions=5).toPandas().set_index("id")
    s = pdf.sort_values(["score", "id"])
    assert np.allclose(pm.loc[s["id"], "pm"].to_numpy(), np.maximum.accumulate(s["p"].to_numpy()))
    exp_prev = s["p"].shift(1).to_numpy()
    got_prev = lg.loc[s["id"], "prev"].to_numpy(dtype=float)
    assert np.isnan(got_prev[0]) and np.allclose(got_prev[1:], exp_prev[1:])


def test_lag_with_null_scores_and_text_keys(spark):
    rows = [(None if i % 4 == 0 else float(i % 7), f"k{i:03d}", i) for i in range(120)]
    df = spark.createDataFrame(rows, "score double, k string, p long")
    got = {r.k: r.prev for r in ranking.lag_in_order(df, [("score", "asc"), ("k", "desc")], "p", "prev", partitions=6).collect()}
    order = sorted(rows, key=lambda r: r[1], reverse=True)
    order.sort(key=lambda r: (r[0] is None, r[0] or 0.0))
    assert got == {b[1]: (a[2] if a else None) for a, b in zip([None, *order], order)}


def test_row_number_in_group(spark):
    df = spark.range(500).select(F.col("id"), F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.lit("b")).alias("g"))
    got = {r.id: r.n for r in ranking.row_number_in_group(df, "g", [("id", "asc")], "n", partitions=7).collect()}
    hot = [i for i in range(500) if i % 5]
    assert [got[i] for i in hot] == list(range(1, 401)) and [got[i] for i in range(0, 500, 5)] == list(range(1, 101))


def test_rows_visit_few_cells(spark):
    rng = np.random.default_rng(8)
    angle = rng.uniform(0, 2 * np.pi, 1500)
    X = np.stack([np.cos(angle), np.sin(angle), 0.01 * rng.normal(size=1500)], axis=1)
    df = spark.createDataFrame(pd.DataFrame({"k": range(1500), "v": [list(r) for r in X]}))
    visits = []
    got = neighbors.cosine_top_k(df, "k", "v", 5, block_rows=50, min_block_rows=50, visits=visits).toPandas()
    exp = _brute_topk(list(range(1500)), X, 5)
    assert all(list(g.sort_values("rank")["neighbor_id"]) == [b for b, _ in exp[a]] for a, g in got.groupby("id"))
    assert visits[0] / 1500 < 6  # of 30 cells


def test_zero_vectors_alone_in_a_block(spark):
    pdf = pd.DataFrame({"k": range(12), "v": [[1.0, 0.0, float(i)] if i < 2 else [0.0, 0.0, 0.0] for i in range(12)]})
    got = neighbors.cosine_top_k(spark.createDataFrame(pdf), "k", "v", 2, block_rows=1, min_block_rows=1)
    assert got.count() == 24


def test_page(spark):
    df = spark.range(60).withColumn("s", F.col("id") % 7)
    got = [r["id"] for r in ranking.page(df, [("s", "desc"), ("id", "asc")], 2, 25).collect()]
    exp = sorted(range(60), key=lambda i: (-(i % 7), i))[25:50]
    assert got == exp


@pytest.mark.parametrize("equal", [0.0, 0.9])
def test_exact_quantiles_match_numpy(spark, equal):
    from vittles.operators import stats

    rng = np.random.default_rng(11)
    a = np.where(rng.random(997) < equal, 7.0, rng.integers(0, 50, 997).astype(float))  # heavy ties
    b = rng.normal(size=10)
    pdf = pd.DataFrame({"g": ["a"] * len(a) + ["b"] * len(b), "v": np.r_[a, b]})
    q = stats.exact_quantiles(spark.createDataFrame(pdf), "g", "v", [0.1, 0.25, 0.5, 0.9])
    got = {(r["g"], r["p"]): r["quantile"] for r in q.collect()}
    for g, x in (("a", a), ("b", b)):
        for p in (0.1, 0.25, 0.5, 0.9):
            assert got[(g, p)] == pytest.approx(np.quantile(x, p), abs=1e-12)


@pytest.mark.parametrize("cores,block_rows", [(1, 7), (4, 11), (8, 7), (8, 11), (1, 1000), (4, 1000)])
def test_cosine_ties_do_not_depend_on_the_cells(spark, monkeypatch, cores, block_rows):
    rng = np.random.default_rng(3)
    X = rng.integers(-2, 3, size=(60, 4)).astype(float)
    X[5] = 0.0
    df = spark.createDataFrame(pd.DataFrame({"k": range(100, 160), "v": [list(r) for r in X]}))
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: cores))
    got = neighbors.cosine_top_k(df, "k", "v", 5, block_rows=block_rows, min_block_rows=5).toPandas()
    exp = _brute_topk(list(range(100, 160)), X, 5)
    assert {a: list(g.sort_values("rank")["neighbor_id"]) for a, g in got.groupby("id")} == {a: [b for b, _ in e] for a, e in exp.items()}


def test_equal_vectors_visit_nothing(spark):
    n = 100_000
    same = spark.range(n).select(F.col("id").alias("k"), F.array(F.lit(1.0), F.lit(2.0), F.lit(0.5)).alias("v"))
    others = spark.range(n, n + 50).select(F.col("id").alias("k"), F.array(F.lit(1.0), F.col("id") - n + 3.0, F.lit(0.5)).alias("v"))
    visits = []
    got = neighbors.cosine_top_k(same.unionByName(others), "k", "v", 3, block_rows=1000, visits=visits)
    assert visits == [0] and got.count() == 3 * (n + 50)
    lists = {r.id: r.l for r in got.where("id IN (0, 2, 99999)").groupBy("id").agg(F.array_sort(F.collect_list("neighbor_id")).alias("l")).collect()}
    assert lists == {0: [1, 2, 3], 2: [0, 1, 3], 99999: [0, 1, 2]}
    assert got.where("sim < 0.999999 AND id < 100000").count() == 0


def test_groups_of_equal_vectors_match_brute_force(spark):
    rng = np.random.default_rng(12)
    X = rng.normal(size=(40, 3))[rng.integers(0, 40, 300)] * rng.choice([1.0, 2.0, 4.0], size=(300, 1))
    df = spark.createDataFrame(pd.DataFrame({"k": range(300), "v": [list(r) for r in X]}))
    for block_rows in (4, 1000):
        got = neighbors.cosine_top_k(df, "k", "v", 6, block_rows=block_rows).toPandas()
        U = X / np.linalg.norm(X, axis=1, keepdims=True)
        S = np.round(U @ U.T, 9)
        for a, g in got.groupby("id"):
            want = sorted((-S[a, j], j) for j in range(300) if j != a)[:6]
            assert np.allclose(g.sort_values("rank")["sim"], [-s for s, _ in want]) and set(g["neighbor_id"]) == {j for _, j in want}
