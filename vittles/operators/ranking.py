"""Ordering primitives with explicit tie keys.

pandas answers "first row per key" and "top k" from row order; Spark has
none, so every function here takes a total order.  Two rules hold for scale:

* "first per key" is an aggregate (``max`` of a struct), not a window, so a
  hot key is combined map-side instead of being sorted in one task;
* "top k per group" runs in two window stages, first over (group, salt) and
  then over the at most ``k * salt_buckets`` survivors per group, so a group
  holding a third of the table is split across ``salt_buckets`` tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from vittles.session import broadcast_if_small, cut_lineage

Order = Sequence[tuple[str, str]]  # (column, "asc" | "desc")


def _sort_col(c: str, direction: str) -> Column:
    if direction == "desc":
        return F.col(c).desc_nulls_last()
    return F.col(c).asc_nulls_last()


def sort_cols(order: Order) -> list[Column]:
    return [_sort_col(c, d) for c, d in order]


def first_per_key(df: DataFrame, keys: Sequence[str], order: Order, payload: Sequence[str]) -> DataFrame:
    """Keep one row per key: the first under ``order``.

    Implemented as ``max(struct(order..., payload...))`` grouped by key, which
    is partially aggregated before the shuffle.  Ascending columns must be
    numeric (they are negated); NULL sorts last in either direction.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    fields = []
    for i, (c, d) in enumerate(order):
        if d == "desc":
            # nulls are smallest inside a struct, so max() puts them last
            fields.append(F.col(c).alias(f"_o{i}"))
        else:
            if not isinstance(types[c], NumericType):
                raise TypeError(f"ascending order column {c} must be numeric")
            fields.append(F.when(F.col(c).isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias(f"_n{i}"))
            fields.append((-F.col(c)).alias(f"_o{i}"))
    fields.append(F.struct(*[F.col(p) for p in payload]).alias("_p"))
    best = F.max(F.struct(*fields)).alias("_best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"_best._p.{p}").alias(p) for p in payload])


def top_k_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Order,
    k: int,
    *,
    salt_of: str | None = None,
    salt_buckets: int = 16,
    rank_col: str = "rank",
) -> DataFrame:
    """Top ``k`` rows per group under a total ``order``.

    ``salt_of`` names a high-cardinality column (usually the row key) hashed
    into ``salt_buckets`` sub-groups for the first stage.  Exact: the global
    top k of a group is contained in the union of its sub-groups' top k.
    """
    ordered = sort_cols(order)
    if salt_of is not None and salt_buckets > 1:
        salt = F.pmod(F.xxhash64(F.col(salt_of)), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, salt).orderBy(*ordered)
        df = df.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1")
    w = Window.partitionBy(*keys).orderBy(*ordered)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def global_top_k(df: DataFrame, order: Order, k: int) -> DataFrame:
    """``orderBy(...).limit(k)``; planned as TakeOrderedAndProject,
    which keeps k rows per task and merges them, no full sort."""
    return df.orderBy(*sort_cols(order)).limit(k)


def page(df: DataFrame, order: Order, page_number: int, page_size: int = 25) -> DataFrame:
    """1-based page of a total order (``offset`` + ``limit``)."""
    start = (max(int(page_number), 1) - 1) * page_size
    return df.orderBy(*sort_cols(order)).offset(start).limit(page_size)


def write_order_index(df: DataFrame, order: Order, folder: str, partition_rows: int = 100_000) -> None:
    """The table in a total order, as a stored index for ``indexed_page``.

    Rows are range-partitioned on the full order into files of about
    ``partition_rows`` (a directory for each), and a count table holds, for each
    partition, its rows and the rows before it.  End ``order`` with a key, as rows
    equal in all its columns share a partition."""
    partitions = max(1, -(-df.count() // partition_rows))
    placed = df.repartitionByRange(partitions, *sort_cols(order)).sortWithinPartitions(*sort_cols(order))
    placed.withColumn("_pid", F.spark_partition_id()).write.mode("overwrite").partitionBy("_pid").parquet(f"{folder}/rows")
    spark = df.sparkSession
    counts = spark.read.schema("_pid int").parquet(f"{folder}/rows").groupBy("_pid").agg(F.count(F.lit(1)).alias("n"))
    # a row for each partition
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).write.mode("overwrite").parquet(f"{folder}/counts")


def indexed_page(spark: SparkSession, folder: str, order: Order, page_number: int, page_size: int = 25) -> DataFrame:
    """A 1-based page from a stored order index: the counts tell which
    partitions hold it, only these are read, and only their rows are numbered."""
    start = (max(int(page_number), 1) - 1) * page_size
    counts = spark.read.parquet(f"{folder}/counts")
    held = counts.where((F.col("before") < start + page_size) & (F.col("before") + F.col("n") > start)).collect()
    rows = spark.read.parquet(f"{folder}/rows").where(F.col("_pid").isin([r["_pid"] for r in held]))
    first = F.create_map(*[F.lit(x) for r in held for x in (r["_pid"], r["before"])]) if held else F.lit(None)
    place = F.row_number().over(Window.partitionBy("_pid").orderBy(*sort_cols(order))) - 1
    if held:
        place = place + first[F.col("_pid")]
    rows = rows.withColumn("_place", place).where((F.col("_place") >= start) & (F.col("_place") < start + page_size))
    return rows.orderBy("_place").drop("_pid", "_place")


def _range_partitioned(df: DataFrame, order: Order, partitions: int | None) -> DataFrame:
    """Range-partition on the full order so a value shared by a third of the
    rows is split by the trailing key; ``_pid`` is the ordered range index."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # checkpointed so the per-row branch and the per-partition summary read one
    # range assignment (spark_partition_id is non-deterministic, so Spark
    # would not reuse the exchange)
    return cut_lineage(df.repartitionByRange(n, *sort_cols(order)).withColumn("_pid", F.spark_partition_id()))


def row_number_in_group(df: DataFrame, group: str, order: Order, out: str, partitions: int | None = None) -> DataFrame:
    """1-based row number within each group in a total order, without one task
    per group: rows are numbered inside the range partitions of (group, order),
    and shifted by the group's rows in the partitions before (one row per group
    and partition, broadcast if small)."""
    r = _range_partitioned(df, [(group, "asc"), *order], partitions)
    w = Window.partitionBy("_pid", group).orderBy(*sort_cols(order))
    earlier = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = r.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n")).select(
        F.col(group).alias("_bg"), F.col("_pid").alias("_bp"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    r = r.withColumn("_local", F.row_number().over(w)).join(
        broadcast_if_small(counts), F.col(group).eqNullSafe(F.col("_bg")) & (F.col("_pid") == F.col("_bp")))
    return r.withColumn(out, F.col("_local") + F.col("_before")).drop("_pid", "_bg", "_bp", "_before", "_local")


def prefix_max(df: DataFrame, order: Order, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Running maximum of ``value`` in a total order, without a
    single-partition window.  Each range partition computes its local running
    max; the maxima of all earlier partitions (one row per partition) are
    folded in through a broadcast join."""
    r = _range_partitioned(df, order, partitions)
    w = Window.partitionBy("_pid").orderBy(*sort_cols(order)).rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumn("_local", F.max(value).over(w))
    pm = r.groupBy("_pid").agg(F.max(value).alias("_pmax"))
    before = pm.withColumn(
        "_before", F.max("_pmax").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
    r = r.join(F.broadcast(before.select("_pid", "_before")), "_pid", "left")
    return r.withColumn(out, F.greatest(F.col("_local"), F.col("_before"))).drop("_pid", "_local", "_before")


def lag_in_order(df: DataFrame, order: Order, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Previous row's ``value`` in a total order, distributed as in
    ``prefix_max``: local ``lag`` inside each range partition, and for a
    partition's first row the last value of the previous non-empty one."""
    r = _range_partitioned(df, order, partitions)
    w = Window.partitionBy("_pid").orderBy(*sort_cols(order))
    r = r.withColumn("_lag", F.lag(value).over(w)).withColumn("_rn", F.row_number().over(w))
    last = r.groupBy("_pid").agg(F.max_by(F.col(value), F.col("_rn")).alias("_last"))
    prev = last.withColumn("_pprev", F.lag("_last").over(Window.orderBy("_pid"))).select("_pid", "_pprev")
    r = r.join(F.broadcast(prev), "_pid", "left")
    val = F.when(F.col("_rn") == 1, F.col("_pprev")).otherwise(F.col("_lag"))
    return r.withColumn(out, val).drop("_pid", "_lag", "_rn", "_pprev")
