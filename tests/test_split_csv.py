"""Splittable CSV against Spark's multi-line reader."""

import numpy as np
import pytest

from vittles.sources import io
from vittles.sources.split_csv import read_split_csv


def field(rng):
    kind = rng.integers(7)
    words = " ".join(f"w{x}" for x in rng.integers(0, 99, rng.integers(0, 9)))
    return [words, f'"{words}"', f'"{words}\n{words},x"', '"a ""quoted"" word\n\n""end"""', "", '""""', '"\n\n"'][kind]


@pytest.fixture
def small_splits(spark):
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    old = [spark.conf.get(k) for k in keys]
    for k, v in zip(keys, ("700", "1")):
        spark.conf.set(k, v)
    yield
    for k, v in zip(keys, old):
        spark.conf.set(k, v)


def same(spark, path):
    got, want = read_split_csv(spark, path), io.read_text_csv(spark, path)
    assert got.columns == want.columns
    key = lambda r: tuple((x is not None, x or "") for x in r)
    rows = sorted((tuple(r) for r in want.collect()), key=key)
    assert sorted((tuple(r) for r in got.collect()), key=key) == rows
    return got, rows


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_equals_the_multi_line_reader_at_split_bounds(spark, tmp_path, small_splits, ending):
    rng = np.random.default_rng(4)
    lines = ["id,note,more"] + [f"{i},{field(rng)},{field(rng)}" for i in range(400)]
    (tmp_path / "t.csv").write_bytes(ending.join(lines).encode())
    got, rows = same(spark, str(tmp_path / "t.csv"))
    assert len(rows) == 400 and any("\n" in (x or "") for r in rows for x in r)
    scanned = spark.read.option("lineSep", "\n").text(str(tmp_path / "t.csv")).rdd.getNumPartitions()
    assert scanned > 8 and got.rdd.getNumPartitions() > 8


def test_several_files_long_fields_and_empty_ones(spark, tmp_path, small_splits):
    for k in range(3):
        long = '"' + "x, y\n" * 400 + '"'
        (tmp_path / f"p{k}.csv").write_text(f"a,b\n{k},{long}\n\n{k + 10},plain\n" + (f'{k + 20},"no line end"' if k else ""))
    _, rows = same(spark, str(tmp_path))
    assert len(rows) == 8
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "e.csv").write_text("a,b\n")
    assert read_split_csv(spark, str(tmp_path / "empty" / "e.csv")).count() == 0
