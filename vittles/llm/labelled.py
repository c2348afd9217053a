"""Labelled documents to learn from, and folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: labelled rows that a classifier is fitted on, at most twice as many
SAMPLE = 12_000


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`. Null id: null."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def held_out(id_col: str, folds: int, held: int) -> Column:
    """True for rows of the fold that is never learnt from; a null id has no labels, so false."""
    return F.coalesce(fold(id_col, folds) == held, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, most: int = SAMPLE,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, label double) of a hashed sample of about `most` labelled rows outside the held fold.

    The sample is drawn from the labels, so at most 2 * `most` ids are broadcast to
    the scan of the documents. Repeated labels of an id count once, the highest; null ids
    and null labels are left out.
    """
    known = labels.select(F.col(id_col).alias("labelled"), F.col(label).cast("double").alias("label")).where("labelled IS NOT NULL AND label IS NOT NULL")
    known = known.where(fold("labelled", folds) != held).groupBy("labelled").agg(F.max("label").alias("label"))
    share = min(1.0, most / max(1, known.count()))
    drawn = known.where(F.pmod(F.xxhash64("labelled"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).limit(2 * most)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(drawn), F.col("id") == F.col("labelled")).select("text", "label")
