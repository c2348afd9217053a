"""What tasks hold at once, and how many tasks small rounds have."""

import glob
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.test_jaccard_join import brute as brute_rows
from tests.llm.test_jaccard_join import made
from vittles.llm import graph, jaccard_join, toxicity_nb
from vittles.llm.common import trimmed


class _Captured:
    """Stands for a frame, and keeps the function that is mapped over its batches."""

    schema = None

    def mapInArrow(self, work, schema):
        self.work = work
        return self


def _peak(run) -> float:
    tracemalloc.start()
    run()
    peak = tracemalloc.get_traced_memory()[1] / 1e6
    tracemalloc.stop()
    return peak


def test_toxicity_hashes_bounded_runs():
    texts = [" ".join(f"w{(i * 7919 + j) % 5000}" for j in range(300)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    model = toxicity_nb.Model(np.arange(0, 1 << toxicity_nb.HASH_BITS, 300), np.linspace(-1, 1, len(range(0, 1 << toxicity_nb.HASH_BITS, 300))), 0.1)
    frame, kept = _Captured(), []
    toxicity_nb.keep_clean(frame, model)
    assert _peak(lambda: kept.extend(frame.work(iter([batch])))) < 100
    # the rows kept are those of every text scored by itself
    slot = toxicity_nb.slots(model.ids)
    alone = [i for i, t in enumerate(texts[:300]) if toxicity_nb.scores([t], model, slot)[0] < 0.5]
    assert [i for b in kept for i in b.column(0).to_pylist() if i < 300] == alone


def test_shingles_are_made_of_bounded_runs():
    texts = [" ".join(f"w{(i * 7919 + j) % 5000}" for j in range(300)) for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    assert max(sum(len(t) for t in texts[first : first + len(sets)]) for first, sets in jaccard_join._sets(batch, 0)) < 510_000


def test_rounds_on_few_edges_have_few_tasks(spark):
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i % 10 != 9], "a long, b long")
        found = graph.components(edges)
        rows = {r["node"]: r["component"] for r in found.collect()}
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert rows == {i: i // 10 * 10 for i in range(60)}
    folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    last = max(glob.glob(f"{folder}/rdd-*"), key=lambda p: int(p.rsplit("-", 1)[1]))
    assert len(glob.glob(f"{last}/part-*")) == 1


def test_the_sieve_lets_few_others_pass(spark):
    ids = spark.range(0, 4000).select(F.col("id") * 7)
    ids = ids.toDF("id")
    sieve = jaccard_join._sieve(ids, 4000)
    hashed = spark.range(0, 140_000).select("id", *[h.alias(f"hash{i}") for i, h in enumerate(jaccard_join._hashes())]).toArrow()
    passed = jaccard_join._passes(sieve, [hashed.column(i).to_numpy() for i in (1, 2)])
    asked = hashed.column("id").to_numpy() % 7 == 0
    asked &= hashed.column("id").to_numpy() < 28_000
    assert passed[asked].all() and passed[~asked].mean() < 0.005


def test_one_pair_of_each_two_components_comes_first(spark):
    """Of 300 pairs between three components one of each two is a head; pairs inside one component are none."""
    joined = spark.createDataFrame([(i, i // 10 * 10) for i in range(30)], "node long, component long")
    pairs = spark.createDataFrame([(i, j) for i in range(30) for j in range(i + 1, 30)], "a long, b long")
    heads, n = jaccard_join._heads(pairs, joined)
    assert n == 3 and sorted((r.a // 10, r.b // 10) for r in heads.collect()) == [(0, 1), (0, 2), (1, 2)]


def test_links_that_the_first_pairs_miss_are_found(spark, monkeypatch):
    """Two groups whose first pair does not link, though a later one does, are one component."""
    monkeypatch.setattr(jaccard_join, "FRUITFUL", 2.0)
    monkeypatch.setattr(jaccard_join, "MANY", 1)
    monkeypatch.setattr(jaccard_join, "REPEATED", 0)
    rows = made(11, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in jaccard_join.near_duplicates(df).collect()), key=repr) == brute_rows(rows)


def test_lists_of_equal_members_are_merged(spark):
    rows = [(k, 0, 10 + i, i, i % 2, 0, 5) for k in range(20) for i in range(5)] + [(k, 0, 10 + i, i, i % 2, 0, 4) for k in (30, 31) for i in range(1, 5)]
    # one id twice in a list is another list than one without it
    rows += [(40, 0, 11, 1, 1, 0, 3), (40, 0, 11, 1, 1, 0, 3), (40, 0, 12, 2, 0, 0, 3), (41, 0, 12, 2, 0, 0, 1)]
    lists = spark.createDataFrame(rows, "key long, small int, n long, id long, component long, main long, held long")
    got = jaccard_join._merged(lists).groupBy("key", "copies").count().collect()
    assert sorted(tuple(r) for r in got) == [(0, 20, 5), (30, 2, 4), (40, 1, 3), (41, 1, 1)]


def test_a_worker_gives_freed_memory_back_after_its_task():
    def resident() -> float:
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 / 1e6

    kept = []

    def work(batches):
        held = [np.ones(12_000) for _ in range(2000)]
        # what stays at the end of the heap holds all before it
        kept.extend([held[-1], resident()])
        del held
        yield from batches

    before = resident()
    assert list(trimmed(work)(iter([1, 2]))) == [1, 2]
    assert kept[1] - before > 100 and kept[1] - resident() > 100
