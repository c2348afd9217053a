"""Sharding by a K-d tree over metadata.

Every node is split along its widest metadata dimension at the weighted quantile
that gives both sides their share of the bytes, until a leaf holds the target
bytes. A quantile is found by histograms of bytes over the node's key range, each
narrowed to the one bin that holds the cut; all nodes of a level share one job, and
only histograms reach the driver. The finished tree is a Spark column expression.

A key is a dimension's scaled value with a hash of the document's group below it, so
equal values can be split too. Documents of equal text form a group, which takes
the metadata of its first document and stays in one shard; a group of more than
1/`FINE` of a shard is first dealt out in chunks.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vittles.llm.common import checkpointed, numbered

#: a chunk of a group of equal texts is at most this part of a shard
FINE = 25
#: bytes that a cut may miss its quantile by, as a part of a shard
TOLERANCE = 0.002
#: histogram bins of one level
BINS = 1 << 16
VALUE_BITS, TIE_BITS = 31, 32


@dataclass
class Node:
    """A leaf, or a split of the keys of a dimension; `shards` leaves are to come below it."""

    shards: int
    first: int
    dimension: int = -1
    cut: int = 0
    below: tuple[Node, Node] | None = None


def compile_tree(node: Node, keys: list[str]) -> Column:
    """The first shard of the leaf that a row falls into."""
    if node.below is None:
        return F.lit(node.first)
    left, right = (compile_tree(x, keys) for x in node.below)
    return F.when(F.col(keys[node.dimension]) < F.lit(node.cut), left).otherwise(right)


def leaves(node: Node) -> list[Node]:
    return [node] if node.below is None else [x for side in node.below for x in leaves(side)]


def _by_leaf(column: Column, values: dict[int, int]) -> Column:
    return reduce(lambda e, kv: e.when(column == kv[0], F.lit(kv[1])), values.items(), F.when(F.lit(False), F.lit(0)))


def _cuts(points: DataFrame, root: Node, open_nodes: list[Node], keys: list[str], tolerance: float) -> None:
    """Find the split of every node in `open_nodes` by one job for each step of the search."""
    leaf = compile_tree(root, keys).alias("leaf")
    ends = points.groupBy(leaf).agg(F.sum("size").alias("bytes"), *[f(k).alias(f"{n}_{k}") for k in keys for n, f in (("lo", F.min), ("hi", F.max))])
    stats = {r["leaf"]: r for r in ends.collect()}
    search: dict[int, list[float]] = {}
    by_first = {n.first: n for n in open_nodes}
    for first, node in by_first.items():
        left = node.shards // 2
        node.below = (Node(left, first), Node(node.shards - left, first + left))
        node.dimension, node.cut = 0, 0
        if r := stats.get(first):
            spread = [(r[f"hi_{k}"] >> TIE_BITS) - (r[f"lo_{k}"] >> TIE_BITS) for k in keys]
            node.dimension = max(range(len(keys)), key=spread.__getitem__)
            k = keys[node.dimension]
            # [low key, high key), bytes below it, bytes wanted below the cut
            search[first] = [r[f"lo_{k}"], r[f"hi_{k}"] + 1, 0, r["bytes"] * left / node.shards]
    below = {n.first: n.below for n in open_nodes}
    for n in open_nodes:
        n.below = None  # a leaf still, as long as its cut is sought
    bins = max(64, BINS // max(1, len(open_nodes)))
    while search:
        at = F.col("leaf")
        key = reduce(lambda e, f: e.when(at == f, F.col(keys[by_first[f].dimension])), search, F.when(F.lit(False), F.lit(0)))
        low = _by_leaf(at, {f: s[0] for f, s in search.items()})
        high = _by_leaf(at, {f: s[1] for f, s in search.items()})
        width = _by_leaf(at, {f: max(1, -(-(s[1] - s[0]) // bins)) for f, s in search.items()})
        rows = points.select(leaf, "size", *keys).withColumn("key", key).where((F.col("key") >= low) & (F.col("key") < high))
        rows = rows.withColumn("offset", F.col("key") - low).withColumn("width", width)
        counted = rows.groupBy("leaf", F.expr("offset div width").alias("bin")).agg(F.sum("size").alias("bytes"))
        found: dict[int, list[tuple[int, int]]] = {}
        for r in counted.collect():
            found.setdefault(r["leaf"], []).append((r["bin"], r["bytes"]))
        for first in list(search):
            lo, hi, under, want = search[first]
            step, node = max(1, -(-(hi - lo) // bins)), by_first[first]
            for b, size in sorted(found[first]):
                start, end = lo + b * step, min(hi, lo + (b + 1) * step)
                if under + size < want:
                    under += size
                    node.cut = end
                    continue
                if size <= tolerance or end - start <= 1:
                    node.cut = start if want - under <= under + size - want else end
                    del search[first]
                else:
                    search[first] = [start, end, under, want]
                break
            else:
                node.cut = hi
                del search[first]
    for n in open_nodes:
        n.below = below[n.first]


def _scaled(df: DataFrame, column: str) -> Column:
    """A metadata value as a number: numbers as they are, other values by a checksum. Null: null."""
    numeric = df.schema[column].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double") or "decimal" in df.schema[column].dataType.typeName()
    value = F.col(column).cast("double") if numeric else F.crc32(F.col(column).cast("string")).cast("double")
    return F.when(F.isnan(value), None).otherwise(value)


def kd_shards(df: DataFrame, n_shards: int | None = None, target_bytes: int | None = None, id_col: str = "doc_id",
              text_col: str = "text", dimensions: tuple[str, ...] = ("lang", "source", "doc_id")) -> DataFrame:
    """Shard every row: (id, size, text_crc32, shard, slot).

    `size` is the UTF-8 bytes of the text (null: none) plus 8. Give `n_shards`, or
    `target_bytes` of a leaf. Dimensions are the text's size on a log scale and the
    named columns; a null value lies at the low end. Null text counts as empty.
    Repeated rows are rows of their own, and a null id is one; ties in a dimension are split by a hash of
    the text. Further columns are ignored, also those with names of the result. A very long text
    is sized, hashed and left where it is. An empty table gives an empty table.
    """
    names = [f"k{i}" for i in range(len(dimensions) + 1)]
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.md5(text)).alias("group"), F.log2(F.octet_length(text) + F.lit(8.0)).alias("k0"),
        *[_scaled(df, d).alias(k) for d, k in zip(dimensions, names[1:])])
    base = checkpointed(base)
    ends = base.agg(F.sum("size").alias("bytes"), *[f(k).alias(f"{n}_{k}") for k in names for n, f in (("lo", F.min), ("hi", F.max))]).first()
    total = ends["bytes"] or 0
    if n_shards is None:
        n_shards = max(1, round(total / max(1, target_bytes or 1)))
    target = max(1.0, total / n_shards)

    # at most FINE * n_shards groups are this large
    limit = max(1.0, target / FINE)
    large = base.groupBy("group").agg(F.sum("size").alias("bytes")).where(F.col("bytes") > limit)
    large = large.select(F.col("group").alias("large"), F.ceil(F.col("bytes") / limit).alias("chunks"))
    chunk = F.pmod(F.xxhash64("id"), F.coalesce("chunks", F.lit(1)))
    dealt = base.join(F.broadcast(large), F.col("group") == F.col("large"), "left").withColumn("chunk", chunk)
    first = Window.partitionBy("group", "chunk").orderBy(F.col("id").asc_nulls_last(), *names).rowsBetween(Window.unboundedPreceding, 0)
    tie = F.shiftrightunsigned(F.xxhash64("group", "chunk"), 64 - TIE_BITS)

    def key(name: str) -> Column:
        lo, hi = ends[f"lo_{name}"] or 0.0, ends[f"hi_{name}"] or 0.0
        part = (F.first(name).over(first) - lo) / ((hi - lo) or 1.0)
        whole = F.coalesce((part * ((1 << VALUE_BITS) - 1)).cast("long"), F.lit(0))
        return (F.shiftleft(whole, TIE_BITS) + tie).alias(name)

    points = checkpointed(dealt.select("id", "size", "text_crc32", *[key(k) for k in names]))
    root = Node(n_shards, 0)
    while open_nodes := [x for x in leaves(root) if x.shards > 1]:
        _cuts(points, root, open_nodes, names, TOLERANCE * target)
    sharded = points.select("id", "size", "text_crc32", compile_tree(root, names).cast("int").alias("shard"))
    return numbered(sharded, ["shard"], ["id", "size", "text_crc32"], "slot").withColumnRenamed("id", id_col)
