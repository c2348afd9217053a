"""A few bound queries against their DuckDB forms on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events embeddings".split()


def _norm(rows):
    out = []
    for r in rows:
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


@pytest.mark.parametrize("name", ["q03_coerce", "q05_mapping", "q08_scorecard", "q11_robust_z", "q18_neighbors",
                                  "q21_token_search", "q29_monotone"])
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    cols = sorted(df.columns)
    got = _norm([tuple(r[c] for c in cols) for r in df.collect()])
    idx = [rel.columns.index(c) for c in cols]
    exp = _norm([tuple(r[i] for i in idx) for r in rel.fetchall()])
    assert got == exp


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "nutrition_score" in df.columns
