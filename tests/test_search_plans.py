"""Requests without a match in the ranked search: right ranks, no join of items with requests."""

import pytest
from pyspark.sql import functions as F

from vittles.operators import search


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("block", [2, 256])
def test_unmatched_requests_rank_all_items_without_a_cross_join(spark, monkeypatch, block):
    monkeypatch.setattr(search, "BLOCK", block, raising=False)
    monkeypatch.setattr(search, "cut_lineage", lambda df: df, raising=False)
    items = [(i, f"food {i * 7919 % 83} {'x' * (i % 5)}", float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(items, "fdc_id long, description string, nutrition_score double")
    asked = ["zq food", "FOOD 1", "qqqq", "a", "zq food", "no such \"thing\"", "x" * 40, "z"]
    got = search.ranked_search(df, search.requests(spark, asked), limit=4)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    want = []
    for n, q in enumerate(asked, 1):
        low = q.lower()
        hits = [i for i in items if low in i[1]] or items
        rated = [(i, None if len(q) < 2 else 1 - distance(low, i[1]) / max(len(low), len(i[1]))) for i in hits]
        rated.sort(key=lambda x: (-(x[1] or 0), -x[0][2], x[0][0]))
        want += [(n, i[0], k) for k, (i, _) in enumerate(rated[:4] if len(q) > 1 else sorted(rated, key=lambda x: (-x[0][2], x[0][0]))[:4], 1)]
    assert sorted((r.query_id, r.fdc_id, r["rank"]) for r in got.select("query_id", "fdc_id", F.col("rank")).collect()) == sorted(want)


def test_few_distances_are_computed(spark):
    items = [(i, f"{'abcdefgh'[i % 8] * (1 + i % 9)} {i * 7919 % 1009} {'tail' * (i % 6)}", float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(items, "fdc_id long, description string, nutrition_score double").repartition(4)
    asked = ["zq tail", "hhhh 17z", "no 999 tailtail", "éé"]
    calls = spark.sparkContext.accumulator(0)
    got = search.ranked_search(df, search.requests(spark, asked), limit=5, calls=calls)
    want = []
    for n, q in enumerate(asked, 1):
        rated = sorted(((1 - distance(q, i[1]) / max(len(q), len(i[1])), i) for i in items), key=lambda x: (-x[0], -x[1][2], x[1][0]))
        want += [(n, i[0], k) for k, (_, i) in enumerate(rated[:5], 1)]
    assert sorted((r.query_id, r.fdc_id, r["rank"]) for r in got.select("query_id", "fdc_id", F.col("rank")).collect()) == sorted(want)
    print(calls.value); assert 0 < calls.value < 0.35 * len(items) * len(asked)


def test_pages_come_from_few_partitions(spark, tmp_path):
    from vittles.operators import ranking

    df = spark.range(5000).select("id", (F.col("id") * 7919 % 301).alias("s"), F.when(F.col("id") % 10 > 0, F.col("id") % 5).alias("t"))
    order = [("s", "desc"), ("t", "asc"), ("id", "asc")]
    ranking.write_order_index(df, order, str(tmp_path / "index"), partition_rows=400)
    want = sorted(((r.s, r.t, r.id) for r in df.collect()), key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    for page in (1, 7, 50, 200, 201):
        got = ranking.indexed_page(spark, str(tmp_path / "index"), order, page, 25)
        assert [(r.s, r.t, r.id) for r in got.collect()] == want[(page - 1) * 25 : page * 25]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(_pid" in plan or "PartitionFilters: [_pid" in plan or page == 201
        read = got._jdf.queryExecution().executedPlan().toString().count("rangepartitioning(s")
        assert read == 0


def test_index_reads_only_the_buckets_asked_for(spark, tmp_path):
    from vittles.operators import gram_index

    items = [(i, f"{'food' if i % 3 else 'meal'} number {i}", None if i % 5 else f"Acme {i % 7}") for i in range(400)]
    df = spark.createDataFrame(items, "fdc_id long, description string, brand_owner string")
    gram_index.write_gram_index(df, "fdc_id", ["description", "brand_owner"], str(tmp_path / "index"), 16)
    asked = search.requests(spark, ["food 39", "acme", "MEAL number", "number", "zzz", "n", "", "number 7 acme"])
    for call in (search.token_search, lambda *a, **k: search.ranked_search(*a, filter_cols=["description", "brand_owner"], score="fdc_id", limit=9, **k)):
        plain, found = call(df, asked), call(df, asked, index=str(tmp_path / "index"))
        assert sorted(map(str, found.collect())) == sorted(map(str, plain.select(*found.columns).collect()))
    needles = spark.createDataFrame([("food number 39",), ("number 39",)], "tok string")
    # pruning also holds where the scan is not kept in buckets; only then does the plan not tell
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", False)
    near = gram_index.candidates(spark, str(tmp_path / "index"), needles, "tok", "fdc_id")
    plan = near._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 16" in plan
    probe = {r.tok: r["_probe"] for r in gram_index.probes(spark, str(tmp_path / "index"), needles, "tok").collect()}
    assert probe == {"food number 39": " 39", "number 39": " 39"}
