"""The corpus pipeline: five stages over `documents`, each working on all that the one before kept.

`STAGES` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame. `run` writes each stage's result as Parquet into the shared folder that
``spark.checkpoint.dir`` names and reads it again, so a stage survives lost
executors and starts from a plain table.

Every stage handles null and empty texts, repeated rows and an empty table as its
operator's docstring states: a null or empty text is rated by its statistics
(quality), by the bias (toxicity), links with nothing, holds no secret and packs to
the one end id.
"""

from __future__ import annotations

import tempfile
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vittles.llm import jaccard_join, pow2_packing, rule_quality, secret_crf, toxicity_nb
from vittles.llm.common import table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble, fitted on the labels, rates 0.5 or more."""
    return rule_quality.keep_good(docs, rule_quality.train(docs, table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the n-gram classifier, fitted on the labels, rates below 0.5."""
    return toxicity_nb.keep_clean(docs, toxicity_nb.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates: shingles of five words, a Jaccard of 0.8 or more."""
    return jaccard_join.keep_one(docs, words=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret span replaced by a mask and n_chars set anew."""
    return secret_crf.redact(docs, secret_crf.train(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with a checksum of their ids, and their sequences."""
    return pow2_packing.packed_digest(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("secrets", secrets), ("packing", packing)]

#: The classifiers and the tokenizer can't be expressed in SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; returns the last one's rows, read from its table."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="corpus-pipeline-")
    docs, place = table(spark, sf_dir, "documents"), f"{shared.rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        at = f"{place}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
