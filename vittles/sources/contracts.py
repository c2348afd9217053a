"""Column contracts and text staging.

A contract is a rename map plus the required columns in order.  Applying it
renames, checks that every required column exists (error listing missing and
present columns), and projects to exactly the required columns; extra
columns are dropped, and Catalyst prunes them from the scan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vittles.operators.quality import require_columns


@dataclass(frozen=True)
class Contract:
    required: Sequence[str]
    renames: Mapping[str, str] = field(default_factory=dict)
    optional: Sequence[str] = ()

    def apply(self, df: DataFrame, what: str = "table") -> DataFrame:
        present = {k: v for k, v in self.renames.items() if k in df.columns}
        out = df.withColumnsRenamed(present) if present else df
        require_columns(out, self.required, what)
        keep = list(self.required) + [c for c in self.optional if c in out.columns]
        return out.select(*keep)

    def empty(self, spark: SparkSession) -> DataFrame:
        """An empty all-text frame with the contract's columns."""
        return spark.createDataFrame([], text_schema(self.required))


def text_schema(cols: Sequence[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in cols])


def as_text(df: DataFrame, fill_empty: bool = False) -> DataFrame:
    """S3: every column cast to string; ``fill_empty`` writes NULL as "" (the
    reference's staged form), otherwise NULL stays NULL."""
    cols = [F.col(c).cast("string") for c in df.columns]
    if fill_empty:
        cols = [F.coalesce(c, F.lit("")) for c in cols]
    return df.select(*[c.alias(n) for c, n in zip(cols, df.columns)])


def prune(df: DataFrame, requested: Sequence[str] | None) -> DataFrame:
    """Keep requested columns that exist (missing ones are skipped)."""
    if not requested:
        return df
    return df.select(*[c for c in requested if c in df.columns])


def complete_schema(df: DataFrame, columns: Mapping[str, str], aliases: Mapping[str, str] | None = None) -> DataFrame:
    """Add typed NULL columns for absent ones; alias (e.g. score <-
    nutrition_score) when only the source exists."""
    out = df
    for target, source in (aliases or {}).items():
        if target not in out.columns and source in out.columns:
            out = out.withColumn(target, F.col(source))
    missing = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in out.columns}
    return out.withColumns(missing) if missing else out