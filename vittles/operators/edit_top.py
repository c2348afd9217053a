"""Exact top rows by edit similarity, with few distances.

A request that matches nothing ranks all items by ``1 - distance / longer length``.
The similarity can be no more than the lengths and the characters allow: the distance
is at least the difference in length, and at least the number of characters that
either text has and the other lacks.  Each task keeps the best rows of each request and
takes items by falling bound, so it computes distances only while a bound can still
reach the last of these.  Distances are made for many texts at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 32     # characters are counted in so many folded bins
CHUNK = 64    # texts whose distances are computed together


def _points(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code points padded by 0, lengths, counts of characters by bin) of texts."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.zeros((len(texts), int(lengths.max(initial=0))), dtype=np.uint32)
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    row = np.repeat(np.arange(len(texts)), lengths)
    points[row, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return points, lengths, np.bincount(row * BINS + flat % BINS, minlength=len(texts) * BINS).reshape(-1, BINS)


def distances(needle: np.ndarray, points: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Edit distance of one text to each row of padded code points, a column of all tables at a time."""
    rows = np.arange(len(points))
    table = np.tile(np.arange(len(needle) + 1), (len(points), 1))
    out = np.where(lengths == 0, len(needle), 0)
    for j in range(points.shape[1]):
        before, table = table, np.empty_like(table)
        table[:, 0] = j + 1
        step = np.minimum(before[:, 1:] + 1, before[:, :-1] + (needle[None, :] != points[:, j : j + 1]))
        # what comes from the left costs one more a place
        place = np.arange(len(needle) + 1)
        table[:, 1:] = step
        table = np.minimum.accumulate(table - place, axis=1) + place
        ended = lengths == j + 1
        out[ended] = table[rows[ended], -1]
    return out


def _bounds(length: int, bins: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Greatest similarity that lengths and characters allow."""
    more = counts - bins
    least = np.maximum(np.maximum(more, 0).sum(axis=1), np.maximum(-more, 0).sum(axis=1))
    return 1.0 - np.maximum(least, np.abs(lengths - length)) / np.maximum(np.maximum(lengths, length), 1).astype(np.float64)


def best_by_edit(items: DataFrame, asked: Sequence[tuple[int, str]], key: str, text: str, score: str, limit: int, calls=None) -> DataFrame:
    """(query_id, key, score, match_score): rows that hold the ``limit`` best of each
    (query_id, request) by similarity, score (NULL last) and key, at most ``limit`` a task.

    ``asked`` is a block of requests; ``text`` is compared in lower case, NULL as
    empty.  ``calls``, an accumulator, counts the distances."""
    needles = [(q, *(x[0] for x in _points([n.lower()]))) for q, n in asked]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in needles]
        for batch in batches:
            ids, scores = batch.column(0).to_pylist(), [-np.inf if s is None else s for s in batch.column(2).to_pylist()]
            texts = batch.column(1).to_pylist()
            by_size = np.argsort([len(t) for t in texts], kind="stable")
            # like lengths together, so that padding stays small
            for part in np.array_split(by_size, max(1, len(by_size) // 2048)):
                points, lengths, counts = _points([texts[i] for i in part])
                for k, (_, needle, length, bins) in enumerate(needles):
                    bound = _bounds(length, bins, lengths, counts)
                    order = np.argsort(-bound, kind="stable")
                    for at in range(0, len(order), CHUNK):
                        some = order[at : at + CHUNK]
                        if len(best[k]) == limit:
                            last = best[k][-1]
                            if bound[some[0]] < -last[0]:
                                break
                            # a bound that only ties needs a better score or key
                            may = [b > -last[0] or (-b, -scores[part[i]], ids[part[i]]) < last for b, i in zip(bound[some].tolist(), some)]
                            some = some[may]
                        if not len(some):
                            continue
                        if calls is not None:
                            calls.add(len(some))
                        far = distances(needle[:length], points[some, : int(lengths[some].max())], lengths[some])
                        match = 1.0 - far / np.maximum(np.maximum(lengths[some], length), 1).astype(np.float64)
                        found = [(-m, -scores[part[i]], ids[part[i]]) for m, i in zip(match.tolist(), some)]
                        best[k] = sorted([*best[k], *found])[:limit]
        rows = [(q, i, -m) for (q, *_), held in zip(needles, best) for m, _, i in held]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.float64())],
                                         names=["query_id", key, "match_score"])

    kind = pa.string() if items.schema[key].dataType.simpleString() == "string" else pa.int64()
    keyed = F.col(key) if kind == pa.string() else F.col(key).cast("long")
    read = items.select(keyed.alias("k"), F.lower(F.coalesce(F.col(text), F.lit(""))).alias("t"), F.col(score).cast("double").alias("s"))
    return read.mapInArrow(work, f"query_id long, `{key}` {'string' if kind == pa.string() else 'long'}, match_score double")
