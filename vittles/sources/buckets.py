"""Bucketed layout of tables that are joined on one key.

Staging writes each table once, dealt to buckets of the key and sorted by it, with the
key as a long.  Joins, group-bys and first-per-key steps on the key then read their
buckets where they lie, without an exchange.  The bucket count of a folder is one
number for all its tables; it is kept in a small layout table beside them, from which a
new session opens them again.  A bucket is one task, so choose the count by the
largest table (``bucket_count``); all rows of one key share a bucket.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vittles.functions.scalar import to_long_id
from vittles.sources.io import path_exists

BUCKET_ROWS = 2_000_000


def bucket_count(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """A power of two, so that folders of unlike size still align."""
    return 1 << max(0, math.ceil(math.log2(max(1, rows / bucket_rows))))


def _table(folder: str, name: str) -> str:
    return f"vittles_{hashlib.sha256(folder.rstrip('/').encode()).hexdigest()[:12]}_{name}"


def _place(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.buckets"


def write_bucketed(df: DataFrame, folder: str, name: str, key: str, buckets: int, numeric: bool = True) -> None:
    """One file for each bucket, sorted by the key; a ``numeric`` key is a long, NULL where it is no number."""
    spark = df.sparkSession
    typed = df.withColumn(key, to_long_id(F.col(key).cast("string"))) if numeric else df
    spark.sql(f"DROP TABLE IF EXISTS {_table(folder, name)}")
    (typed.repartition(buckets, key).sortWithinPartitions(key).write.mode("overwrite").format("parquet")
     .option("compression", "zstd").option("path", _place(folder, name)).bucketBy(buckets, key).sortBy(key)
     .saveAsTable(_table(folder, name)))
    spark.createDataFrame([(name, key, buckets)], "name string, key string, buckets int").coalesce(1).write.mode("overwrite").parquet(
        f"{_place(folder, name)}.layout")


def open_bucketed(spark: SparkSession, folder: str, name: str) -> DataFrame | None:
    """The bucketed table, registered in this session if need be; None where it was not staged."""
    if not path_exists(spark, f"{_place(folder, name)}.layout"):
        return None
    if not spark.catalog.tableExists(_table(folder, name)):
        layout = spark.read.parquet(f"{_place(folder, name)}.layout").first()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(_place(folder, name)).schema)
        spark.sql(f"CREATE TABLE {_table(folder, name)} ({columns}) USING parquet OPTIONS (path '{_place(folder, name)}') "
                  f"CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`) INTO {layout['buckets']} BUCKETS")
    return spark.table(_table(folder, name))
