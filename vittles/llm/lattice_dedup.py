"""Near copies among embeddings by lattice hashing.

Unit vectors are turned by a random rotation whose coordinates are dealt to tables of
eight; in each table a vector is decoded to the nearest point of the E8 lattice. Two
vectors meet in a table if they share a cell, or if one's cell is among the `PROBES`
cells next nearest to the other. Vectors that meet are compared by cosine, in
matrix blocks.

Equal vectors are compared once. A cell of more than `BLOCK` rows is dealt to pairs of
blocks, so no task holds a whole cell and no pair is left out. A pair that meets in
several tables counts where it meets first, so links are counted without listing
pairs, and a block yields only counts and a forest of its links.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vittles.llm.common import checkpointed, mix64
from vittles.llm.graph import components

THRESHOLD = 0.93
#: tables, cells probed besides the own one, cells along a unit of length
TABLES, PROBES, SCALE, SEED = 8, 3, 6.0, 11
#: rows of a cell that are compared in one block
BLOCK = 1024

_PAIRS = [np.eye(8)[i] * a + np.eye(8)[j] * b for i, j in itertools.combinations(range(8), 2) for a in (1, -1) for b in (1, -1)]
_HALVES = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in s) % 2 == 0]
#: the lattice's 240 shortest vectors: steps to neighbouring cells
STEPS = np.array(_PAIRS + _HALVES)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer point with an even sum: where the sum is odd, the worst rounded coordinate goes the other way."""
    whole = np.rint(x)
    rest = x - whole
    worst, rows = np.abs(rest).argmax(axis=1), np.arange(len(x))
    way = np.where(rest[rows, worst] >= 0, 1.0, -1.0)
    whole[rows, worst] += np.where(whole.sum(axis=1) % 2 != 0, way, 0.0)
    return whole


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest E8 lattice point: of the even integer points, or of these moved by a half."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _hashed(points: np.ndarray) -> np.ndarray:
    h = np.zeros(len(points), dtype=np.uint64)
    for c in (2 * points).astype(np.int64).astype(np.uint64).T:
        h = mix64(h * np.uint64(31) + c + np.uint64(0x51ED2701))
    return (h >> np.uint64(33)).astype(np.int32)


def rotation(width: int, tables: int = TABLES, seed: int = SEED) -> np.ndarray:
    """Random directions, orthogonal in sets of `width`, eight for each table."""
    rng, out = np.random.default_rng(seed), []
    while sum(x.shape[1] for x in out) < 8 * tables:
        out.append(np.linalg.qr(rng.normal(size=(width, width)))[0])
    return np.concatenate(out, axis=1)[:, : 8 * tables]


def cells(unit: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE) -> np.ndarray:
    """Hashed cells [vector, table, own cell and probed ones] of unit vectors."""
    # eight tables' worth of coordinates keep the length of a vector; fewer dimensions make longer coordinates
    turned = unit @ rotation(unit.shape[1], tables) * scale * np.sqrt(unit.shape[1] / 64)
    out = np.zeros((len(unit), tables, 1 + probes), dtype=np.int32)
    for t in range(tables):
        x = turned[:, 8 * t : 8 * t + 8]
        own = nearest_e8(x)
        out[:, t, 0] = _hashed(own)
        order = np.argsort(-((x - own) @ STEPS.T), axis=1, kind="stable")[:, :probes]
        for j in range(probes):
            out[:, t, 1 + j] = _hashed(own + STEPS[order[:, j]])
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first event at which pairs meet: 3 x table, + 0 own cells, + 1 cell of a probed by b, + 2 cell of b probed by a."""
    own = a[:, :, 0] == b[:, :, 0]
    by_b = (a[:, :, :1] == b[:, :, 1:]).any(axis=2)
    by_a = (b[:, :, :1] == a[:, :, 1:]).any(axis=2)
    return np.stack([own, by_b, by_a], axis=2).reshape(len(a), -1).argmax(axis=1)


def _links(ids: np.ndarray, own: np.ndarray, side: np.ndarray, copies: np.ndarray, vectors: np.ndarray, codes: np.ndarray, table: int, cross: bool, least: float):
    """Links that count in this block: (places with links, their number with copies, forest edges)."""
    unit = _unit(vectors)
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if cross else (np.arange(len(ids)),) * 2
    sums, edges = np.zeros(len(ids), dtype=np.int64), []
    for start in range(0, len(left), BLOCK):
        rows = left[start : start + BLOCK]
        i, j = np.nonzero(unit[rows] @ unit[right].T >= least)
        i, j = rows[i], right[j]
        fit = (ids[i] != ids[j]) & (own[i] | own[j])
        if not cross:
            fit &= i < j
        i, j = i[fit], j[fit]
        for at in range(0, len(i), 100_000):
            x, y = i[at : at + 100_000], j[at : at + 100_000]
            x, y = np.where(ids[x] < ids[y], x, y), np.where(ids[x] < ids[y], y, x)
            event = 3 * table + np.where(own[x] & own[y], 0, np.where(own[x], 1, 2))
            here = _first_meeting(codes[x], codes[y]) == event
            x, y = x[here], y[here]
            sums += np.bincount(x, copies[y], len(ids)).astype(np.int64) + np.bincount(y, copies[x], len(ids)).astype(np.int64)
            edges.append(np.stack([x, y]))
    if not edges:
        return sums, np.zeros((2, 0), dtype=np.int64)
    x, y = np.concatenate(edges, axis=1)
    tree = np.arange(len(ids))
    while len(x):
        # every place points at the least place of a linked one, then pointers are followed to their ends
        before = tree.copy()
        low = np.minimum(tree[x], tree[y])
        np.minimum.at(tree, x, low)
        np.minimum.at(tree, y, low)
        tree = tree[tree]
        if (tree == before).all():
            break
    moved = np.flatnonzero(tree != np.arange(len(ids)))
    return sums, np.stack([moved, tree[moved]])


def near_copies(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", least: float = THRESHOLD) -> DataFrame:
    """(id, n_links, component_id, kept) of every row; see the module's text for the search.

    Only vectors with equal, non-null labels and equal dimensions are compared.
    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing; so do rows without label. Equal vectors link with each other. Repeated
    rows are vectors of their own; a null id is a row of its own. Further columns are
    ignored; an empty table gives an empty table.
    """
    v = F.col("v")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size(v) > 0) & ~bad & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")).withColumn("usable", usable)
    groups = rows.where("usable AND id IS NOT NULL").groupBy("label", "v").agg(F.min("id").alias("rep"), F.count("*").alias("copies"))
    double = "double" in df.schema[vector_col].dataType.simpleString()
    label_kind = df.schema[label_col].dataType.simpleString()

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [np.array(x.as_py(), dtype="<f8") for x in batch.column(3)]
            widths = np.array([len(x) for x in vectors])
            codes: list[bytes] = [b""] * len(vectors)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                got = cells(_unit(np.stack([vectors[i] for i in at])))
                for i, c in zip(at, got):
                    codes[i] = c.astype("<i4").tobytes()
            raw = [x.astype("<f8" if double else "<f4").tobytes() for x in vectors]
            cell_lists = [np.frombuffer(c, dtype="<i4") for c in codes]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(raw, pa.binary()), pa.array(codes, pa.binary()), pa.array(cell_lists, pa.list_(pa.int32()))],
                names=["rep", "label", "copies", "raw", "codes", "cells"])

    coded = groups.select("rep", "label", "copies", "v").mapInArrow(code, f"rep long, label {label_kind}, copies long, raw binary, codes binary, cells array<int>")
    coded = checkpointed(coded)

    entries = coded.select("rep", "label", F.octet_length("raw").alias("width"), F.posexplode("cells").alias("at", "cell"))
    entries = entries.select("rep", "label", "width", F.expr(f"at div {1 + PROBES}").cast("int").alias("tab"), (F.col("at") % (1 + PROBES) == 0).alias("own"), "cell")
    place = ["label", "width", "tab", "cell"]
    live = entries.groupBy(*place).agg(F.count("*").alias("n"), F.max("own").alias("any_own")).where("n > 1 AND any_own")
    live = live.select(*[F.col(c).alias(f"l_{c}") for c in place], F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    there = entries.join(live, [F.col(c) == F.col(f"l_{c}") for c in place]).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    # a row goes to the pairs of its block with every block
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    there = there.select("rep", *place, "own", "block", other)
    there = there.select("rep", *place, "own", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), (F.col("block") > F.col("other")).cast("int").alias("side"))
    data = coded.select(F.col("rep").alias("c_rep"), "copies", "raw", "codes")
    key = [*place, "b1", "b2"]
    dealt = there.join(data, F.col("rep") == F.col("c_rep")).repartition(*key).sortWithinPartitions(*key).select(*key, "rep", "own", "side", "copies", "raw", "codes")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def done() -> list[pa.RecordBatch]:
            if len(held) < 2:
                return []
            ids, own, side, copies = (np.array([r[k] for r in held]) for k in range(4))
            if not own.any():
                return []
            vectors = np.frombuffer(b"".join(r[4] for r in held), dtype="<f8" if double else "<f4").reshape(len(held), -1).astype(np.float64)
            codes = np.frombuffer(b"".join(r[5] for r in held), dtype="<i4").reshape(len(held), -1, 1 + PROBES)
            sums, edges = _links(ids, own, side, copies, vectors, codes, now[2], now[4] != now[5], least)
            at = np.flatnonzero(sums)
            if not len(at):
                return []
            none, zero = pa.nulls(len(at), pa.int64()), pa.array(np.zeros(edges.shape[1], dtype=np.int64))
            return [pa.RecordBatch.from_arrays([pa.array(ids[at]), none, pa.array(sums[at])], names=["rep", "hub", "links"]),
                    pa.RecordBatch.from_arrays([pa.array(ids[edges[0]]), pa.array(ids[edges[1]]), zero], names=["rep", "hub", "links"])]

        for batch in batches:
            keys = list(zip(*(c.to_pylist() for c in batch.columns[:6])))
            values = list(zip(*(c.to_pylist() for c in batch.columns[6:])))
            for k, value in zip(keys, values):
                if k != now:
                    yield from done()
                    now, held = k, []
                held.append(value)
        yield from done()

    found = checkpointed(dealt.mapInArrow(compare, "rep long, hub long, links long"))
    links = found.where("hub IS NULL").groupBy(F.col("rep").alias("l_rep")).agg(F.sum("links").alias("links"))
    joined = components(found.where("hub IS NOT NULL").select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    rated = coded_groups(groups, links, joined)
    out = rows.join(rated, F.col("usable") & (F.col("label") == F.col("g_label")) & (F.col("v") == F.col("g_v")), "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    n_links = F.when(F.col("id").isNotNull(), F.coalesce("others", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select(F.col("id").alias(id_col), n_links.alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def coded_groups(groups: DataFrame, links: DataFrame, joined: DataFrame) -> DataFrame:
    """Each group of equal vectors with the links of its members and its component."""
    rated = groups.join(links, F.col("rep") == F.col("l_rep"), "left").join(joined, F.col("rep") == F.col("node"), "left")
    return rated.select(F.col("label").alias("g_label"), F.col("v").alias("g_v"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("others"), F.coalesce("component", "rep").alias("component"))
