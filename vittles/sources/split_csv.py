"""Splittable reading of CSV whose quoted fields hold line ends.

Spark's multi-line reader gives a whole file to one task.  Here a file is read as
lines in as many splits as usual.  Whether a line begins inside a quoted field
depends on the number of quotes before it, so:

1. each split tells its parity of quotes, and how many records begin in it if it
   begins outside or inside a field (one row for each split);
2. a prefix scan over the splits of a file gives the state in which each begins and
   the number of records before it;
3. each line then knows its record.  A line that is a record of its own is parsed
   where it lies; only the lines of records with line ends meet by record number.

Doubled quotes keep the parity, so the quote is also the escape, as in RFC 4180.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vittles.sources.contracts import text_schema

QUOTE = '"'
PARSED = {"quote": QUOTE, "escape": QUOTE, "nullValue": "", "multiLine": "true", "mode": "PERMISSIVE"}


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.Array, np.ndarray, np.ndarray, bool]]:
    """Lines (line, file, start) come in order: (split, lines, quotes before each
    line in its split, quotes in each line, whether the split is new)."""
    now, before = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        quotes = pc.count_substring(batch.column(0), QUOTE).to_numpy().astype(np.int64)
        files, starts = batch.column(1).dictionary_encode(), batch.column(2).to_numpy()
        code = files.indices.to_numpy()
        cuts = np.flatnonzero(np.r_[True, (code[1:] != code[:-1]) | (starts[1:] != starts[:-1])])
        for at, end in zip(cuts, [*cuts[1:], len(code)]):
            split = (files.dictionary[int(code[at])].as_py(), int(starts[at]))
            new = split != now
            now, before = split, 0 if new else before
            inside = quotes[at:end]
            passed = before + np.cumsum(inside) - inside
            yield split, batch.column(0).slice(at, end - at), passed, inside, new
            before = int(passed[-1] + inside[-1])


def _summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, quotes, even, odd): lines of each split with an even or odd number of quotes before them."""
    now, row = None, [0, 0, 0]

    def told() -> Iterator[pa.RecordBatch]:
        if now is not None:
            yield pa.RecordBatch.from_pydict({"file": [now[0]], "start": pa.array([now[1]], pa.int64()), **{n: pa.array([v], pa.int64()) for n, v in zip(("quotes", "even", "odd"), row)}})

    for split, _, passed, inside, new in _splits(batches):
        if new:
            yield from told()
            now, row = split, [0, 0, 0]
        odd = int((passed % 2).sum())
        row = [row[0] + int(inside.sum()), row[1] + len(passed) - odd, row[2] + odd]
    yield from told()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (line, file, start, inside, records) with the number of their record,
    their place in the split, and whether they are a whole record."""

    def first_columns() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held.append(batch)
            yield batch

    held: list[pa.RecordBatch] = []
    record, place = 0, 0
    for split, lines, passed, inside, new in _splits(first_columns()):
        batch = held[-1]
        held[:] = [batch]
        if new:
            # what the scan says about this split stands beside each of its lines
            row = pc.index(pc.and_(pc.equal(batch.column(1), split[0]), pc.equal(batch.column(2), split[1])), True).as_py()
            shift, record, place = batch.column(3)[row].as_py(), batch.column(4)[row].as_py(), 0
        outside = (passed + shift) % 2 == 0
        number = record + np.cumsum(outside)
        whole = outside & (inside % 2 == 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array([split[0]] * len(lines), pa.string()), pa.array(number), pa.array(np.full(len(lines), split[1])),
             pa.array(np.arange(place, place + len(lines))), pa.array(whole), lines], names=["file", "record", "start", "place", "whole", "line"])
        record, place = int(number[-1]), place + len(lines)


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-text columns named by the header of the files, each file read by as many tasks
    as it has splits.  Fields may hold quotes (doubled), commas and line ends; only the
    empty field is NULL.  Empty lines outside quotes are skipped; lines may end
    in LF or CR LF.  A quoted field that is never closed reaches to the file's end."""
    columns = (spark.read.option("header", True).option("inferSchema", False).option("multiLine", True)
               .option("quote", QUOTE).option("escape", QUOTE).csv(path)).columns
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    splits = lines.mapInArrow(_summary, "file string, start long, quotes long, even long, odd long")
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd"))
    splits = splits.withColumn("begun", begun).withColumn("records", F.coalesce(F.sum("begun").over(before), F.lit(0)))
    # one row for each split, which the driver lists to plan the scan anyway; the lines stream past, so they keep their order
    told = F.broadcast(splits.select(F.col("file").alias("_f"), F.col("start").alias("_s"), "inside", "records"))
    placed = lines.join(told, (F.col("file") == F.col("_f")) & (F.col("start") == F.col("_s"))).select("line", "file", "start", "inside", "records")
    placed = placed.mapInArrow(_numbered, "file string, record long, start long, place long, whole boolean, line string")
    # the first record of a file is its header
    data = placed.where("record > 1")
    pieces = data.where("NOT whole").groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("start", "place", "line"))).alias("parts"))
    records = data.where("whole").select("line").unionByName(pieces.select(F.array_join(F.transform("parts", lambda p: p["line"]), "\n").alias("line")))
    records = records.select(F.regexp_replace("line", "\r$", "").alias("line")).where(F.length("line") > 0)
    return records.select(F.from_csv("line", ", ".join(f"`{c}` STRING" for c in text_schema(columns).fieldNames()), PARSED).alias("r")).select("r.*")
