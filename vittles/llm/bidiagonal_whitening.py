"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries become whole numbers x = floor(1024 c) + 100000. Rows are packed once into
blocks of whole numbers, checkpointed, and centred on the fly: the nearest whole number
to the mean is taken off exactly, its fraction as a double.

With the centred rows as X, each step is one pass: the tasks make u = X q from their
rows, and u's square and X'u are summed. So U is never stored: a left vector is kept as
the combination q of columns that makes it. Both bases are orthogonalised in full, U by
its products with X'u, V directly; where U loses digits the pass is made again. The
bidiagonal matrix B with X V = U B is small; its singular vectors turn V into the
components, its singular values into their deviations.

Steps end when the wanted components have converged and the variance outside V is
smaller than the least of them, so none can be missing, or when V spans all dimensions.
A step that ends in a null vector starts again from a random direction orthogonal to V,
so repeated variances are found as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vittles.llm.common import checkpointed

COMPONENTS, SEED = 8, 20
#: bytes of a packed block; entries are held within this distance of 0 before the shift
BLOCK_BYTES, FARTHEST = 1 << 20, 1 << 52
#: residuals that count as converged, deviations that count as none (both of the largest), loss that repeats a pass
CONVERGED, NOTHING, LOSS = 1e-15, 1e-9, 1e-4


def whole_rows(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, floor(1024 c)) of the usable vectors, one matrix for each width."""
    offsets, valid = vectors.offsets.to_numpy().astype(np.int64), vectors.is_valid().to_numpy(zero_copy_only=False)
    entries = pc.cast(vectors.values, pa.float64()).to_numpy(zero_copy_only=False)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    widths = np.diff(offsets)
    usable = valid & (widths > 0) & (bad[offsets[1:]] == bad[offsets[:-1]])
    for width in np.unique(widths[usable]):
        at = np.flatnonzero(usable & (widths == width))
        picked = entries[offsets[at][:, None] + np.arange(width)]
        yield at, np.floor(1024.0 * np.clip(picked, -FARTHEST / 1024, FARTHEST / 1024)).astype(np.int64)


def packed(df: DataFrame, vector_col: str) -> DataFrame:
    """(width, n, wide, rows): usable vectors in blocks, four bytes an entry where these hold it, else eight."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, y in whole_rows(batch.column(0)):
                step = max(1, BLOCK_BYTES // (8 * y.shape[1]))
                for start in range(0, len(y), step):
                    part = y[start : start + step]
                    wide = bool((np.abs(part) >= 1 << 31).any())
                    raw = part.astype("<i8" if wide else "<i4").tobytes()
                    yield pa.RecordBatch.from_pydict({"width": pa.array([y.shape[1]], pa.int32()), "n": pa.array([len(part)], pa.int64()), "wide": [wide], "rows": pa.array([raw], pa.binary())})

    return df.select(vector_col).mapInArrow(work, "width int, n long, wide boolean, rows binary")


def _blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for wide, raw in zip(batch.column("wide").to_pylist(), batch.column("rows")):
            yield np.frombuffer(raw.as_buffer(), dtype="<i8" if wide else "<i4").reshape(-1, width).astype(np.int64)


def summed(blocks: DataFrame, width: int, values: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks of `values(block)`, an array of `size` doubles; each task adds up its own blocks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for y in _blocks(batches, width):
            total += values(y)
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(size), pa.int32()), "v": pa.array(total)})

    out = np.zeros(size)
    for k, v in blocks.mapInArrow(work, "k int, v double").groupBy("k").agg(F.sum("v")).collect():
        out[k] = v
    return out


@dataclass
class Whitening:
    """What the fit list gives: counts, whole sums less the shift, centre, components in columns, their variances."""

    width: int
    n: int
    sums: list[int]
    widest: int
    centre: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    def centred(self, y: np.ndarray) -> np.ndarray:
        return (y - self.centre) - self.rest

    def whitened(self, y: np.ndarray) -> np.ndarray:
        return self.centred(y) @ self.components / np.sqrt(self.variances)

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """Exact sums of (n x - S)^2; None where a long does not hold one."""
        if len(self.sums) * self.widest**2 < 1 << 63:
            part = y * self.n - np.array(self.sums, dtype=np.int64)
            return (part * part).sum(axis=1).tolist()
        exact = ((y.astype(object) * self.n - np.array(self.sums, dtype=object)) ** 2).sum(axis=1)
        return [int(x) if x < 1 << 63 else None for x in exact]


def bidiagonalise(product: Callable[[np.ndarray], tuple[float, np.ndarray]], width: int, total: float, wanted: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors in columns, singular values) of the `wanted` largest; `product(q)` gives |Xq|^2 and X'Xq.

    `total` is the sum of all squares of X.
    """
    rng = np.random.default_rng(seed)
    right, left, back = (np.zeros((width, 0)) for _ in range(3))  # V; q with U = X q; X'U
    b = np.zeros((width, width + 1))

    def fresh() -> np.ndarray:
        v = rng.normal(size=width)
        for _ in range(3):
            v -= right @ (right.T @ v)
            v /= np.linalg.norm(v)
        return v

    v, beta, scale = fresh(), 0.0, np.sqrt(total)
    for k in range(width):
        right = np.column_stack([right, v])
        q = v - beta * left[:, -1] if k else v
        square, xu = product(q)
        for _ in range(3):
            along = left.T @ xu
            q, xu, lost = q - left @ along, xu - back @ along, float(along @ along)
            if lost <= LOSS * square:
                square -= lost
                break
            square, xu = product(q)
        else:
            square = 0.0
        alpha = np.sqrt(max(square, 0.0))
        if alpha <= 1e-13 * scale:
            # X takes v to the span of U alone, what is left is rounding: there is no new left vector
            left, back, alpha = np.column_stack([left, np.zeros(width)]), np.column_stack([back, np.zeros(width)]), 0.0
        else:
            left, back = np.column_stack([left, q / alpha]), np.column_stack([back, xu / alpha])
        b[k, k] = alpha
        if k + 1 == width:
            beta = 0.0
            break
        rest = back[:, -1] - alpha * v
        for _ in range(2):
            rest = rest - right @ (right.T @ rest)
        beta = float(np.linalg.norm(rest))
        if beta <= 1e-14 * scale:
            beta, v = 0.0, fresh()
        else:
            v = rest / beta
        b[k, k + 1] = beta
        if k + 1 >= wanted:
            turn, values, _ = np.linalg.svd(b[: k + 1, : k + 1])
            outside = total - float((b[: k + 1, : k + 1] ** 2).sum())
            if (beta * np.abs(turn[-1, :wanted]) <= CONVERGED * scale).all() and outside < values[wanted - 1] ** 2:
                break
    k = right.shape[1]
    _, values, turned = np.linalg.svd(b[:k, :k])
    vectors = right @ turned.T[:, :wanted]
    vectors /= np.linalg.norm(vectors, axis=0)
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return vectors * signs, values[:wanted]


def fit(df: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, seed: int = SEED) -> tuple[Whitening, DataFrame] | None:
    """The whitening of all usable vectors of the most frequent width, and their packed blocks; None where there are none."""
    blocks = checkpointed(packed(df, vector_col))
    most = blocks.groupBy("width").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return None
    width, n = most["width"], most["n"]
    blocks = blocks.where(F.col("width") == width)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y in _blocks(batches, width):
            yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(width), pa.int32()), "s": y.sum(axis=0), "lo": y.min(axis=0), "hi": y.max(axis=0)})

    ended = blocks.mapInArrow(ends, "k int, s long, lo long, hi long").groupBy("k").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ended = sorted(ended.collect())
    sums = [int(r["s"]) for r in ended]
    whole = [(2 * s + n) // (2 * n) for s in sums]
    model = Whitening(
        width, n, sums, max(max(abs(n * r["lo"] - int(r["s"])), abs(n * r["hi"] - int(r["s"]))) for r in ended), np.array(whole, dtype=np.int64),
        np.array([(s - n * m) / n for s, m in zip(sums, whole)]), np.zeros((width, 0)), np.zeros(0), np.zeros(0))
    total = float(summed(blocks, width, lambda y: np.array([(model.centred(y) ** 2).sum()]), 1)[0])
    if total == 0:
        return model, blocks

    def product(q: np.ndarray) -> tuple[float, np.ndarray]:
        def values(y: np.ndarray) -> np.ndarray:
            x = model.centred(y)
            u = x @ q
            return np.append(u @ u, u @ x)

        got = summed(blocks, width, values, width + 1)
        return float(got[0]), got[1:]

    vectors, deviations = bidiagonalise(product, width, total, min(components, width), seed)
    real = deviations > NOTHING * deviations[0]
    model.components, model.variances = vectors[:, real], deviations[real] ** 2 / n
    model.explained = deviations[real] ** 2 / total
    return model, blocks


def identity_error(model: Whitening, blocks: DataFrame) -> float:
    """Largest absolute entry of the covariance of the whitened rows less the identity."""
    k = model.components.shape[1]

    def values(y: np.ndarray) -> np.ndarray:
        w = model.whitened(y)
        return np.append(w.T @ w, w.sum(axis=0))

    got = summed(blocks, model.width, values, k * k + k) / model.n
    mean = got[k * k :]
    return float(np.abs(got[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS, seed: int = SEED) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    A vector that is null, empty, or holds null or non-finite entries is left out, as
    are vectors of another width than the most frequent one (ties: the widest). Zero
    vectors and repeated rows count like others; a null id is a row of its own. There
    are as many components as have variance, `components` at most: none where all
    vectors are equal, so the result is empty then, as it is for an empty table. Entries
    beyond 2^42 count as 2^42. A deviation that a long does not hold is null. Very wide
    vectors cost a pass for each dimension at most, and memory for some square matrices of
    that width on the driver. Further columns are ignored.
    """
    rows = df.select(F.col(id_col).cast("long").alias(id_col), vector_col)
    schema = f"`{id_col}` long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted = fit(df, vector_col, components, seed)
    if fitted is None or not len(fitted[0].variances):
        return df.sparkSession.createDataFrame([], schema)
    model, error = fitted[0], identity_error(*fitted)
    k = len(model.variances)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, y in whole_rows(batch.column(1)):
                if y.shape[1] != model.width:
                    continue
                ids = batch.column(0).take(pa.array(at)).take(pa.array(np.repeat(np.arange(len(at)), k)))
                far = pa.array(model.deviations(y), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k)))
                columns = [ids, pa.array(np.tile(np.arange(1, k + 1), len(at)), pa.int32()), pa.array(np.full(len(ids), model.n)), far,
                           pa.array(model.whitened(y).ravel()), pa.array(np.tile(model.explained, len(at))), pa.array(np.full(len(ids), error))]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(work, schema)
