"""Scans and sinks.

CSV is read with a header and no inference, so every column is text found by
header name; only the empty field is NULL.  Sinks never overwrite a path the
same plan reads (S9): ``versioned_path`` gives a fresh location.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType


def read_text_csv(spark: SparkSession, path: str, *, multiline: bool = True) -> DataFrame:
    """CSV as all-text columns.  ``multiline=False`` for the large
    fact file keeps the file splittable (input splits replace chunking)."""
    return (spark.read.option("header", True).option("inferSchema", False)
            .option("multiLine", multiline).option("quote", '"').option("escape", '"')
            .option("nullValue", "").option("emptyValue", None).csv(path))


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_table(spark: SparkSession, staging_dir: str, data_root: str, name: str, *,
               usecols: Sequence[str] | None = None, schema: StructType | None = None) -> DataFrame:
    """S4 + S5 + S6: staged parquet first, raw CSV second, empty frame when
    neither exists; requested columns that exist are kept, absent ones are
    named in a warning."""
    pq = f"{staging_dir}/{name}.parquet"
    csv = f"{data_root}/{name}.csv"
    if path_exists(spark, pq):
        df = spark.read.parquet(pq)
    elif path_exists(spark, csv):
        df = read_text_csv(spark, csv, multiline=name != "food_nutrient")
    else:
        cols = list(usecols or (schema.fieldNames() if schema else []))
        return spark.createDataFrame([], StructType([StructField(c, StringType()) for c in cols]))
    if usecols:
        absent = [c for c in usecols if c not in df.columns]
        if absent:
            warnings.warn(f"{name}: requested columns are absent: {absent}", stacklevel=2)
        df = df.select(*[c for c in usecols if c in df.columns])
    return df


def write_staged(df: DataFrame, path: str, *, fill_empty: bool = False) -> None:
    """S3: all-text zstd parquet; ``fill_empty`` stores NULL as ""."""
    out = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    if fill_empty:
        out = out.na.fill("")
    out.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header (one part file per task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def versioned_path(base: str) -> str:
    """A fresh path next to ``base`` for read-enrich-write jobs."""
    return f"{base.rstrip('/')}.v{uuid.uuid4().hex[:12]}"


def read_overrides(spark: SparkSession, path: str) -> DataFrame:
    """(fdc_id, form lower-cased); an absent file gives an empty table."""
    schema = StructType([StructField("fdc_id", StringType()), StructField("form", StringType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema).select(F.col("fdc_id").cast("long"), "form")
    df = read_text_csv(spark, path)
    return df.select(F.col("fdc_id").cast("double").cast("long").alias("fdc_id"), F.lower("form").alias("form"))


def read_neighbours(spark: SparkSession, path: str) -> DataFrame:
    """The neighbour edge list; empty when missing."""
    schema = "fdc_id bigint, neighbor_id bigint, cos_sim double, base_score double"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(path)


def coefficients_frame(spark: SparkSession, names: Sequence[str], coefs: Sequence[float], intercept: float) -> DataFrame:
    """(feature, coefficient) including the intercept row."""
    rows = [("intercept", float(intercept))] + [(n, float(c)) for n, c in zip(names, coefs)]
    return spark.createDataFrame(rows, StructType([StructField("feature", StringType()),
                                                   StructField("coefficient", DoubleType())]))


def metrics_frame(spark: SparkSession, metrics: dict) -> DataFrame:
    """(metric, value)."""
    rows = [(k, float(v)) for k, v in metrics.items()]
    return spark.createDataFrame(rows, "metric string, value double")


def read_coefficients(spark: SparkSession, path: str) -> DataFrame:
    """Coefficient table; empty when missing (a file that can't be read is an error)."""
    if path_exists(spark, path):
        return spark.read.json(path)
    return spark.createDataFrame([], "feature string, coefficient double")


def schema_table(spark: SparkSession, df: DataFrame, counts: bool = False) -> DataFrame:
    """(column, type) listing of a DataFrame; with ``counts`` also the
    table's rows and each column's non-null values, by one aggregation."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if not counts:
        return spark.createDataFrame(rows, "column string, type string")
    got = df.agg(F.count(F.lit(1)), *[F.count(F.col(f"`{c}`")) for c in df.columns]).first()
    return spark.createDataFrame([(*r, got[0], got[i + 1]) for i, r in enumerate(rows)],
                                 "column string, type string, rows long, non_null long")
