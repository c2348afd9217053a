"""A stored gram index of item texts.

Posting rows (gram, key) for the distinct grams of one to three characters of an
item's lower-cased texts are written once, in buckets of the gram and sorted by it,
beside a table of the grams' counts.  A needle is looked up by the rarest of its
grams, so a common beginning costs nothing, and only the buckets of the grams asked for
are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vittles.sources import buckets

GRAM = 3
# grams that are given to the scan as a list, which prunes buckets; more are joined
LISTED = 1000


def grams(text: Column, n: int) -> Column:
    places = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.substring(text, i, F.lit(n)))


def lower(c: str) -> Column:
    return F.lower(F.coalesce(F.col(c), F.lit("")))


def item_grams(cols: Sequence[str]) -> Column:
    """Distinct grams of one to ``GRAM`` characters of all text columns."""
    return F.array_distinct(F.concat(*[grams(lower(c), n) for c in cols for n in range(1, GRAM + 1)]))


def write_gram_index(items: DataFrame, key: str, text_cols: Sequence[str], folder: str, n_buckets: int) -> None:
    """Write the postings and counts of the items' texts; a key is stored as it is."""
    postings = items.select(F.explode(item_grams(text_cols)).alias("gram"), F.col(key).alias("key"))
    buckets.write_bucketed(postings, folder, "postings", "gram", n_buckets, numeric=False)
    stored = buckets.open_bucketed(items.sparkSession, folder, "postings")
    # grouped bucket by bucket, without an exchange
    stored.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{folder}/counts")


def probes(spark: SparkSession, folder: str, needles: DataFrame, needle: str) -> DataFrame:
    """The needles that may occur, each with ``_probe``, its rarest gram."""
    asked = needles.where(F.length(needle) > 0).select(needle).distinct()
    own = F.when(F.length(needle) < GRAM, F.array(F.col(needle))).otherwise(F.array_distinct(grams(F.col(needle), GRAM)))
    counts = spark.read.parquet(f"{folder}/counts").withColumnRenamed("gram", "_gram")
    found = asked.withColumn("_gram", F.explode(own)).join(counts, "_gram", "left")
    rarest = found.groupBy(needle).agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "_gram")).alias("_least"))
    rarest = rarest.where("_least.n > 0").select(F.col(needle).alias("_needle"), F.col("_least._gram").alias("_probe"))
    return needles.join(rarest, F.col(needle) == F.col("_needle")).drop("_needle")


def candidates(spark: SparkSession, folder: str, needles: DataFrame, needle: str, key: str) -> DataFrame:
    """The needles' rows with the keys of the items that hold the needle's rarest gram."""
    asked = probes(spark, folder, needles, needle)
    postings = buckets.open_bucketed(spark, folder, "postings")
    listed = [r[0] for r in asked.select("_probe").distinct().limit(LISTED + 1).collect()]
    if len(listed) <= LISTED:
        postings = postings.where(F.col("gram").isin(listed))
    return postings.select("gram", F.col("key").alias(key)).join(asked, F.col("gram") == F.col("_probe")).drop("gram", "_probe")
