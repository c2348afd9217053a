"""Toxicity by a linear classifier over character n-grams, scaled by naive Bayes log-count ratios.

A document's features are the hashed n-grams it contains. On the labelled sample Spark
counts for every feature the documents of both classes that hold it; the ratio of
the smoothed shares, as a logarithm, is the feature's value. The features whose ratio
is surest enter a logistic regression. Scoring looks up every n-gram of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vittles.llm import labelled
from vittles.llm.common import checkpointed, code_points, mix64, text_batches, trimmed

ORDERS = (3, 4, 5)
HASH_BITS = 20
#: features of the regression, documents that must hold one, smoothing of the counts
FEATURES, LEAST, SMOOTH = 4096, 3, 1.0
STEPS, RIDGE = 100, 1e-3
#: characters of the texts that a task hashes at once: each costs some eighty bytes
CHARS = 200_000
FOLDS, HELD = 5, 0


@dataclass
class Model:
    """Weights by hashed feature, and the bias. `prior` alone counts if there was nothing to learn from."""

    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    prior: float | None = None


def grams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order the hashed n-gram at every place, and the offsets of texts; a gram may run over a text's end."""
    points, offsets = code_points([t.lower() for t in texts])
    points = points.astype(np.uint64)
    rolled = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        if n > len(points):
            return
        rolled = rolled[: len(points) - n + 1] * np.uint64(0x100000001B3) + points[n - 1 :]
        if n in ORDERS:
            yield n, (mix64(rolled + np.uint64(n << 56)) >> np.uint64(64 - HASH_BITS)).astype(np.int64), offsets


def present(texts: list[str], slot: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (text, feature), each once, of the features that `slot` maps a hash to; -1: none."""
    pairs = [np.zeros(0, dtype=np.int64)]
    for n, hashes, offsets in grams(texts):
        found = slot[hashes]
        at = np.flatnonzero(found >= 0)
        text = np.searchsorted(offsets, at, side="right") - 1
        inside = at + n <= offsets[text + 1]
        pairs.append(np.unique(text[inside] * width + found[at[inside]]))
    both = np.unique(np.concatenate(pairs))
    return both // width, both % width


def _counts(sample: DataFrame) -> DataFrame:
    """(feature, positive, negative): documents of each class that hold the feature."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.arange(1 << HASH_BITS, dtype=np.int32)
        counts = np.zeros((2, 1 << HASH_BITS), dtype=np.int64)
        for batch in batches:
            toxic = batch.column(1).to_numpy() > 0.5
            for first, run in text_batches(batch, "text", CHARS):
                text, feature = present(run, every, 1 << HASH_BITS)
                for side in (0, 1):
                    held, n = np.unique(feature[toxic[first + text] == side], return_counts=True)
                    counts[side][held] += n
        at = np.flatnonzero(counts.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[1][at]), pa.array(counts[0][at])], names=["feature", "positive", "negative"])

    parts = sample.mapInArrow(trimmed(work), "feature long, positive long, negative long")
    return parts.groupBy("feature").agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))


def fit(rows: np.ndarray, columns: np.ndarray, ratios: np.ndarray, labels: np.ndarray, steps: int = STEPS, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Logistic regression on the scaled features, by Adam steps over all rows; the weights are returned scaled."""
    weights, bias, n = np.zeros(len(ratios) + 1), np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)), len(labels)
    weights[-1] = bias
    m, v = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, steps + 1):
        scaled = weights[:-1] * ratios
        z = np.bincount(rows, scaled[columns], minlength=n) + weights[-1]
        gap = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels
        grad = np.append(np.bincount(columns, gap[rows], minlength=len(ratios)) * ratios / n + ridge * weights[:-1], gap.mean())
        m += 0.1 * (grad - m)
        v += 0.01 * (grad * grad - v)
        weights -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return weights[:-1] * ratios, float(weights[-1])


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = FOLDS, held: int = HELD,
          most: int = labelled.SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on a bounded sample of labelled rows outside fold `held`.

    Without labels of both classes every score is the share of positive labels, 0 if there are none.
    """
    sample = checkpointed(labelled.sample(docs, labels, label, folds, held, most, id_col, text_col).repartition(sample_parts(docs)))
    sizes = {r["label"] > 0.5: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(prior=float(True in sizes))
    with_p, with_n = F.col("positive") + SMOOTH, F.col("negative") + SMOOTH
    ratio = F.log(with_p / (sizes[True] + 2 * SMOOTH)) - F.log(with_n / (sizes[False] + 2 * SMOOTH))
    sure = F.abs(F.col("ratio")) / F.sqrt(1 / with_p + 1 / with_n)
    best = _counts(sample).where(F.col("positive") + F.col("negative") >= LEAST).withColumn("ratio", ratio)
    chosen = best.orderBy(sure.desc(), "feature").limit(FEATURES).select("feature", "ratio").collect()
    ids, ratios = np.array([r[0] for r in chosen], dtype=np.int64), np.array([r[1] for r in chosen])
    if not len(ids):
        return Model(prior=sizes[True] / (sizes[True] + sizes[False]))
    slot = slots(ids)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch.column(1).to_numpy()
            for first, run in text_batches(batch, "text", CHARS):
                text, feature = present(run, slot, len(ids))
                cells = [c.astype("<i2").tobytes() for c in np.split(feature, np.searchsorted(text, np.arange(1, len(run))))]
                yield pa.RecordBatch.from_arrays([pa.array(toxic[first : first + len(run)]), pa.array(cells, pa.binary())], names=["label", "held"])

    seen = sorted((r[0], bytes(r[1])) for r in sample.mapInArrow(trimmed(work), "label double, held binary").collect())
    target = np.array([r[0] > 0.5 for r in seen], dtype=float)
    columns = [np.frombuffer(r[1], dtype="<i2").astype(np.int64) for r in seen]
    rows = np.repeat(np.arange(len(seen)), [len(c) for c in columns])
    weights, bias = fit(rows, np.concatenate(columns), ratios, target)
    return Model(ids, weights, bias)


def sample_parts(docs: DataFrame) -> int:
    return 2 * docs.sparkSession.sparkContext.defaultParallelism


def slots(ids: np.ndarray) -> np.ndarray:
    slot = np.full(1 << HASH_BITS, -1, dtype=np.int32)
    slot[ids] = np.arange(len(ids))
    return slot


def scores(texts: list[str], model: Model, slot: np.ndarray) -> np.ndarray:
    if model.prior is not None:
        return np.full(len(texts), model.prior)
    text, feature = present(texts, slot, max(1, len(model.ids)))
    z = np.bincount(text, model.weights[feature], minlength=len(texts)) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row.

    Null text counts as empty and gets the bias alone; repeated rows give repeated rows; further columns
    are ignored; an empty table gives an empty table. A very long text costs memory for
    some numbers of each of its characters.
    """
    kind = df.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = slots(model.ids)
        for batch in batches:
            for first, run in text_batches(batch, "text", CHARS):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(run)), pa.array(scores(run, model, slot))], names=["id", "score"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(trimmed(work), f"id {kind}, score double")
    return out.withColumnRenamed("id", id_col)


def keep_clean(df: DataFrame, model: Model, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows, whole, whose score is below `limit`; a null text is scored as an empty one, repeated rows alike."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot = slots(model.ids)
        for batch in batches:
            for first, run in text_batches(batch, text_col, CHARS):
                yield batch.slice(first, len(run)).filter(pa.array(scores(run, model, slot) < limit))

    return df.mapInArrow(trimmed(work), df.schema)
