"""Helpers that several operators share: lineage cuts, hashes, distributed numbering."""

from __future__ import annotations

import ctypes
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

#: rows that one task numbers in `numbered`
BLOCK_ROWS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder that ``spark.checkpoint.dir`` names.

    The folder is shared by driver and executors, so the copy survives lost
    executors. A temporary folder is used only where the setting is absent (tests).
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or tempfile.mkdtemp(prefix="vittles-llm-"))
    return df.checkpoint()


def observed(df: DataFrame, *measures: Column) -> tuple[DataFrame, tuple]:
    """`df` checkpointed, and aggregates of its rows taken in the same job."""
    seen = Observation()
    kept = checkpointed(df.observe(seen, *[m.alias(f"m{i}") for i, m in enumerate(measures)]))
    return kept, tuple(seen.get[f"m{i}"] for i in range(len(measures)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it several times in `body`."""
    return F.transform(F.array(value), body)[0]


def numbered(df: DataFrame, group: list[str], order: list[str], out: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add `out`: gapless numbers from 0 within each `group`, without one task per group.

    Rows of a group are dealt to hashed blocks, numbered in each block by `order`,
    and shifted by the rows of the blocks before. Only block counts (one row per
    group and block) meet in a window per group. `df` is read twice, so pass a
    checkpointed or cheap frame. Rows equal in every `order` column share a block.
    """
    n = df.count()
    blocks = max(1, -(-n // block_rows))
    block, before = f"{out}__block", f"{out}__before"
    dealt = df.withColumn(block, F.pmod(F.xxhash64(*order), F.lit(blocks)).cast("int"))
    counts = dealt.groupBy(*group, block).agg(F.count("*").alias(before))
    running = Window.partitionBy(*group).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(running), F.lit(0)))
    inner = Window.partitionBy(*group, block).orderBy(*order)
    local = dealt.withColumn(out, F.row_number().over(inner) - F.lit(1))
    right = counts.select(*[F.col(c).alias(f"{c}__r") for c in (*group, block)], before)
    match = [F.col(c).eqNullSafe(F.col(f"{c}__r")) for c in (*group, block)]
    joined = local.join(right, match, "left")
    return joined.select(*df.columns, (F.col(before) + F.col(out)).cast("long").alias(out))


def trimmed(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` for ``mapInArrow``, after which its worker gives freed memory back: a worker lives on, idle, beside later stages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        # glibc's own; Arrow's release of the system pool doesn't call it here
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    return run


def text_batches(batch: pa.RecordBatch, column: str, chars: int = 4_000_000) -> Iterator[tuple[int, list[str]]]:
    """Cut an Arrow batch into runs of texts of about `chars` characters: (first row, texts). Null text: empty."""
    first, size, run = 0, 0, []
    for i, text in enumerate(batch.column(batch.schema.get_field_index(column))):
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= chars:
            yield first, run
            first, size, run = i + 1, 0, []
    if run:
        yield first, run


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points of `texts` in one array, and the offset of each text (one more at the end)."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return points, np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x
