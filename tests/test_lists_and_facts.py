"""Neighbour lists of copies, and facts dealt by part."""

import numpy as np
import pandas as pd

from vittles.operators import matrix, neighbors
from vittles.plans import bindings
from vittles.plans.fdc import CANONICAL_ORDER


def test_copies_share_lists_without_a_window_of_edges(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-3, 4, (30, 4)).astype(float)
    ids = np.arange(30 * 8)
    pdf = pd.DataFrame({"k": ids, "v": [list(base[i % 30]) for i in ids]})
    got = neighbors.cosine_top_k(spark.createDataFrame(pdf).repartition(4), "k", "v", 5)
    # the lists of all rows are merged whole; no edge is exchanged or ranked by itself
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()
    got = got.toPandas().sort_values(["id", "rank"])
    v = np.stack(pdf.v)
    norm = np.linalg.norm(v, axis=1)
    unit = np.where(norm[:, None] > 0, v / np.where(norm == 0, 1, norm)[:, None], 0)
    sims = np.round(unit @ unit.T, 9)
    for i in ids:
        others = [j for j in sorted(ids, key=lambda j: (-sims[i, j], j)) if j != i][:5]
        mine = got[got.id == i]
        assert [round(sims[i, j], 9) for j in mine.neighbor_id] == [sims[i, j] for j in others]
        assert list(mine["rank"]) == [1, 2, 3, 4, 5]


def test_lines_are_dealt_by_part_before_they_are_made_facts(spark, tmp_path):
    rows = [(p, float(q), 1000.0 * q, 0.05, 0.02) for p in range(1, 6) for q in range(1, 9)]
    spark.createDataFrame(rows, "l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double").write.parquet(str(tmp_path / "lineitem.parquet"))
    facts = bindings.part_facts(spark, str(tmp_path))
    wide = matrix.long_to_wide(facts, "fdc_id", "canonical_name", "amount", CANONICAL_ORDER, colocated=True)
    plan = wide._jdf.queryExecution().executedPlan().toString()
    # one exchange, below the generator that makes seven facts of a line
    assert plan.count("Exchange ") == 1 and plan.index("Generate ") < plan.index("Exchange ")
    got = {r["fdc_id"]: r["protein_g_per100g"] for r in wide.collect()}
    assert got == {p: 4.5 for p in range(1, 6)}
