"""S2 as an incremental job: stage new raw CSV files as they land.

The reference stages its large fact file in fixed-size chunks appended to one
parquet writer.  Here the directory of raw files is a Structured Streaming
file source; each run with ``trigger(availableNow=True)`` stages every file
not yet seen (exactly once, tracked in the checkpoint) under the file's column
contract, then stops.  The checkpoint lives under ``spark.checkpoint.dir``
(a shared folder on a cluster), so a lost driver or executor resumes where
it stopped.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

from vittles.session import ensure_checkpoint_dir
from vittles.sources.contracts import Contract, text_schema


def stage_stream(spark: SparkSession, raw_dir: str, contract: Contract, out_path: str, *, name: str,
                 header_columns: list[str] | None = None, fill_empty: bool = False,
                 max_files_per_trigger: int | None = None, multi_line: bool = False) -> int:
    """Stage all new CSV files of ``raw_dir``; returns the rows written by this run.

    Columns are read by position, so a file whose header differs in names or
    order stops the run instead of being staged swapped.  ``multi_line``: fields
    may hold quoted line ends (a file is then read by one task)."""
    cols = header_columns or spark.read.option("header", True).option("inferSchema", False).csv(raw_dir).columns
    reader = (spark.readStream.schema(text_schema(cols)).option("header", True).option("multiLine", multi_line)
              .option("enforceSchema", False).option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = contract.apply(reader.csv(raw_dir), name)
    if fill_empty:
        staged = staged.na.fill("")
    before = _rows(spark, out_path)
    ckpt = f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage-{name}"
    q = (staged.writeStream.format("parquet").option("compression", "zstd").option("path", out_path)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination()
    return _rows(spark, out_path) - before


def _rows(spark: SparkSession, path: str) -> int:
    """Rows staged so far, by the files' footers."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0
