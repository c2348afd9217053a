"""Near-duplicate documents by a size-aware heavy-light set join.

A document's set holds the hashes of its distinct word shingles. Two sets of sizes a
and b link at a Jaccard of t only if they share at least c(a, b) = t (a + b) / (1 + t)
members. Sets up to a boundary are light: each writes its subsets of exactly the size
c(a, b) for every partner size b it can have, and two sets that link write a common
one. Larger sets are heavy: they are found by scanning inverted lists over the members
that come first in one global order, as two sets that link share one of these. The
boundary is where writing subsets begins to cost more than scanning lists, by the
counted sizes and list lengths.

Any global order is right; the order here puts members that many documents have last,
so long lists are rare. Equal sets are joined once. Pairs are filtered by size,
by the number of lists that they must share and by bitmaps, then verified on their
whole sets.

Long lists are not crossed: first every set of a list is compared with its neighbour by
size, and the links found are closed to components, then with a random neighbour of
another component, again and again while most of them link and a round leaves far fewer
pairs to the last step. Then only sets of a list that
still are in different components are paired, those outside the list's largest
component with all others, and only pairs become rows whose sizes and bitmaps allow a
link. So no link between components is missed, however many rounds there were, and a list that is
one group of copies costs its length. Of many pairs between the same two components one is
verified first, the others only if it does not link.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vittles.llm.common import checkpointed, mix64, numbered, observed, trimmed
from vittles.llm.graph import components, tasks_for

#: defaults: Jaccard of links in percent, words of a shingle (what op6 asks for)
PERCENT, WORDS = 85, 4
#: shingles that are counted together, and the count from which one is reported as frequent
RUN, FREQUENT = 2_000_000, 8
#: a member is put last if about one of so many documents has it
COMMON = 2000
#: largest size that can be light
LIGHT = 24
#: neighbours are compared at once if they share a quarter of the lists that they must share
CHAIN = 4
#: seed of the random orders, and the share of neighbours that must link for another round
SHUFFLED, FRUITFUL = 77, 0.5
#: pairs of the last step, for each row of the lists, that a round must spare to have another after it: about what a round costs
SPARED = 8
#: pairs of the last step, in all and for each two components, from which one of each two is compared before the others: fewer aren't worth reading all texts again
MANY, REPEATED = 1000, 2
#: bits of a set's bitmap, and of its fold that list entries carry
BITMAP, FOLDED = 1024, 512
#: sets that a task takes out of a batch at once to compare them
COMPARED = 256
#: bits of the sieve for each id, and its least and greatest size; past it more texts are read than needed
SIEVE_SHARE, SIEVE = 16, (1 << 16, 1 << 27)

SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
#: a random odd multiplier, and random values of bytes
_RNG = np.random.default_rng(20240617)
BYTES = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64)
BASE = 0x9E3779B97F4A7C15
BACK = pow(BASE, -1, 1 << 64)


def least_overlap(n: int, percent: int = PERCENT) -> int:
    """Members that a set of n shares with any set it links to."""
    return -(-percent * n // 100)


def overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Members that sets of a and b share if they link."""
    return -(-percent * (a + b) // (100 + percent))


def partners(n: int, percent: int = PERCENT) -> range:
    """Sizes of sets that a set of n can link to."""
    return range(least_overlap(n, percent), 100 * n // percent + 1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = tuple(np.cumprod(np.append(np.ones(1, dtype=np.uint64), np.full(size - 1, x, dtype=np.uint64)), dtype=np.uint64) for x in (BASE, BACK))
    return _POWERS[size]


def shingle_sets(texts: list[str], words: int = WORDS) -> list[np.ndarray]:
    """Of each text the sorted, distinct 64-bit hashes of its shingles; a text of fewer words has one, without words none."""
    raw = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    data = np.frombuffer(b" ".join(raw), dtype=np.uint8)
    if not len(data):
        return [np.zeros(0, dtype=np.uint64) for _ in texts]
    up, down = _powers(len(data) + 1)
    word = np.concatenate([[False], ~SPACES[data], [False]])
    start, end = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(BYTES[data] * up[: len(data)], dtype=np.uint64)])
    hashed = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    # text i begins at begins[i] in the joined bytes
    begins = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    bounds = np.searchsorted(start, begins)
    rolled = hashed
    for i in range(1, words):
        if len(rolled) > 1:
            rolled = mix64(rolled[:-1] * np.uint64(0x100000001B3) + hashed[i:])
        else:
            rolled = np.zeros(0, dtype=np.uint64)
    out = []
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi - lo >= words:
            out.append(np.unique(rolled[lo : hi - words + 1]))
        elif hi > lo:
            digest = hashlib.blake2b(hashed[lo:hi].tobytes(), digest_size=8, person=b"short").digest()
            out.append(np.frombuffer(digest, dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _sets(batch: pa.RecordBatch, column: int, words: int = WORDS, chars: int = 500_000) -> Iterator[tuple[int, list[np.ndarray]]]:
    first, size, run = 0, 0, []
    for i, text in enumerate(batch.column(column)):
        run.append(text.as_py() or "")
        size += len(run[-1])
        if size >= chars:
            yield first, shingle_sets(run, words)
            first, size, run = i + 1, 0, []
    if run:
        yield first, shingle_sets(run, words)


# ---- statistics over all documents

_MEMBER, _SIZE, _SUM, _SQUARES = range(4)


def statistics(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(kind, key, n): counts of members that are frequent in a run, of set sizes, of documents, and sums for the list length."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.zeros(LIGHT + 2, dtype=np.int64)

        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            members, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= FREQUENT
            kinds = np.append(np.full(often.sum(), _MEMBER), [_SUM, _SQUARES])
            keys = np.append(members[often].view(np.int64), [0, 0])
            return rows(kinds, keys, np.append(counts[often], [counts.sum(), (counts * counts).sum()]))

        def rows(kinds: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (kinds, keys, counts)], names=["kind", "key", "n"])

        held, size = [], 0
        for batch in batches:
            for _, sets in _sets(batch, 0, words):
                for s in sets:
                    sizes[min(len(s), LIGHT + 1)] += 1
                    held.append(s)
                    size += len(s)
                if size >= RUN:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)
        yield rows(np.full(len(sizes), _SIZE), np.arange(len(sizes)), sizes)

    return docs.select("text").mapInArrow(trimmed(work), "kind long, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))


def subsets_written(n: int, percent: int = PERCENT) -> int:
    return sum(comb(n, overlap(n, b, percent)) for b in partners(n, percent))


def boundary(sizes: dict[int, int], list_length: float, percent: int = PERCENT) -> int:
    """The light size up to which subsets cost less than lists; a written row and a scanned entry cost the same."""

    def cost(x: int) -> float:
        light = sum(k * subsets_written(n, percent) for n, k in sizes.items() if 0 < n <= x)
        heavy = sum(k * (n - least_overlap(n, percent) + 1) * (1 + list_length) for n, k in sizes.items() if least_overlap(x, percent) <= n <= LIGHT and n in partners(x + 1, percent) or x < n <= LIGHT)
        return light + heavy

    return min(range(LIGHT + 1), key=cost)


# ---- candidates


def _keys(members: np.ndarray, light: int, common: np.ndarray, rank: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """List keys (first members in the global order) and subset keys of a set."""
    n = len(members)
    lists, subsets = np.zeros(0, dtype=np.uint64), []
    if n and (n > light or n >= least_overlap(light + 1, percent)):
        order = np.zeros(n, dtype=np.int64)
        if len(common):
            at = np.searchsorted(common, members).clip(0, len(common) - 1)
            order = np.where(common[at] == members, rank[at], 0)
        lists = members[np.argsort(order, kind="stable")][: n - least_overlap(n, percent) + 1]
    if 0 < n <= light:
        for b in partners(n, percent):
            if b <= light:
                salt = np.uint64(min(n, b) * 4096 + max(n, b) + 1)
                for some in itertools.combinations(members, overlap(n, b, percent)):
                    subsets.append(mix64(mix64(np.array(some, dtype=np.uint64) + salt).sum(keepdims=True))[0])
    return lists, np.array(sorted(set(subsets)), dtype=np.uint64)


def _bitmap(members: np.ndarray) -> np.ndarray:
    """Parity of members by hashed bit, in longs: sets that differ in d members differ in at most d bits."""
    odd = np.bincount((members >> np.uint64(20)).astype(np.int64) % BITMAP, minlength=BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def keyed(docs: DataFrame, light: int, common: list[tuple[int, int]], words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n, digest, bitmap, lists, subsets) of every document; `common` has members to put last, with their counts."""
    hashes = np.array([m for m, _ in common], dtype=np.int64).view(np.uint64)
    order = np.argsort(hashes)
    hashes, ranks = hashes[order], np.array([c for _, c in common], dtype=np.int64)[order]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, sets in _sets(batch, 1, words):
                both = [_keys(s, light, hashes, ranks, percent) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(sets)), pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()), pa.array([_bitmap(s) for s in sets], pa.list_(pa.int64())),
                     pa.array([k.view(np.int64) for k, _ in both], pa.list_(pa.int64())), pa.array([k.view(np.int64) for _, k in both], pa.list_(pa.int64()))],
                    names=["id", "n", "digest", "bitmap", "lists", "subsets"])

    return docs.select("id", "text").mapInArrow(trimmed(work), "id long, n long, digest binary, bitmap array<long>, lists array<long>, subsets array<long>")


def _need(n1: Column, n2: Column, percent: int) -> Column:
    """Members that two sets of these sizes share if they link."""
    return F.ceil(percent * (n1 + n2) / F.lit(100.0 + percent) - F.lit(1e-9))


def _sizes_fit(n1: Column, n2: Column, percent: int) -> Column:
    return 100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)


def _need_lists(n1: Column, n2: Column, percent: int) -> Column:
    """Lists that two linked sets share at least.

    At most n - need members of a set are missing in the other one, so that many at
    most of its listed ones; the rest stands in both lists for the set whose
    listed members end first in the global order.
    """

    def left(n: Column) -> Column:
        return n - F.ceil(percent * n / F.lit(100.0) - F.lit(1e-9)) + 1 - (n - _need(n1, n2, percent))

    return F.greatest(F.least(left(n1), left(n2)), F.lit(1))


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _bits_fit(m1: str, m2: str, n1: Column, n2: Column, percent: int, words: int = BITMAP // 64) -> Column:
    """Whether bitmaps of so many longs differ in no more bits than sets of these sizes may differ in members, if they link."""
    differ = sum((F.bit_count(F.get(m1, F.lit(i)).bitwiseXOR(F.get(m2, F.lit(i)))) for i in range(words)), F.lit(0))
    return differ <= n1 + n2 - 2 * _need(n1, n2, percent)


def _folded(bitmap: str) -> Column:
    """A bitmap folded to fewer bits, which differ no more often."""
    size, full = FOLDED // 64, BITMAP // 64
    return F.array(*[functools.reduce(Column.bitwiseXOR, [F.get(bitmap, F.lit(j)) for j in range(i, full, size)]) for i in range(size)])


def _similar_bitmaps(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose bitmaps allow a link."""
    one = maps.select(F.col("id").alias("a"), F.col("n").alias("n1"), F.col("bitmap").alias("m1"))
    two = maps.select(F.col("id").alias("b"), F.col("n").alias("n2"), F.col("bitmap").alias("m2"))
    return pairs.join(one, "a").join(two, "b").where(_bits_fit("m1", "m2", F.col("n1"), F.col("n2"), percent)).select("a", "b")


def _sieve(ids: DataFrame, rows: int) -> np.ndarray:
    """Bits at four hashed places of each id: a filter past which only these and a few others in a thousand come, sized by their number."""
    bits = min(max(SIEVE[0], 1 << (SIEVE_SHARE * rows - 1).bit_length() if rows else 0), SIEVE[1])
    places = F.array(*[h.bitwiseAND(F.lit(bits - 1).cast("long")) for x in _hashes() for h in (x, F.shiftrightunsigned(x, 32))])
    words = ids.select(F.explode(places).alias("at")).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("bits")).toArrow()
    sieve = np.zeros(bits // 64, dtype="<u8")
    sieve[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return sieve


def _hashes() -> list[Column]:
    return [F.xxhash64("id"), F.xxhash64("id", F.lit(1))]


def _passes(sieve: np.ndarray, hashes: list[np.ndarray]) -> np.ndarray:
    """Whether all places of these two hashes are set in the sieve."""
    inside = np.ones(len(hashes[0]), dtype=bool)
    for x in hashes:
        for h in (x.view(np.uint64), x.view(np.uint64) >> np.uint64(32)):
            at = (h & np.uint64(64 * len(sieve) - 1)).astype(np.int64)
            inside &= (sieve[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1) == 1
    return inside


def verified(pairs: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose sets link: whole sets are made again from the texts of the documents in question.

    The documents are told by a sieve of their ids in the scan, so texts are not shuffled; a set goes
    to the first documents of its pairs.
    """
    routes = pairs.select(F.col("b").alias("id"), F.col("a").alias("target"), F.col("b").alias("other"))
    routes, (rows,) = observed(routes.union(pairs.select("a", F.col("a").alias("target"), F.lit(None).cast("long")).distinct()), F.count("*"))
    routes = routes.coalesce(tasks_for(rows))
    sieve = _sieve(routes, rows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(_passes(sieve, [batch.column(i).to_numpy() for i in (2, 3)])))
            for first, sets in _sets(batch, 1, words):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "members"])

    placed = docs.where("id IS NOT NULL").select("id", "text", *[h.alias(f"hash{i}") for i, h in enumerate(_hashes())])
    sets = placed.mapInArrow(trimmed(work), "id long, members binary")
    sent = sets.join(routes, "id").select(F.col("target").alias("a"), F.col("other").alias("b"), "members")
    # a set comes before those it is compared with; they pass by one at a time
    dealt = sent.repartition("a").sortWithinPartitions("a", F.col("b").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, mine = None, []
        for batch in batches:
            links = []
            parts = (batch.slice(first, COMPARED) for first in range(0, batch.num_rows, COMPARED))
            for a, b, members in itertools.chain.from_iterable(zip(*(c.to_pylist() for c in part.columns)) for part in parts):
                members = np.frombuffer(members, dtype=np.uint64)
                if a != now:
                    now, mine = a, []
                if b is None:
                    mine.append(members)
                    continue
                for s in mine:
                    shared = len(s) + len(members) - len(np.union1d(s, members))
                    if shared and 100 * shared >= percent * (len(s) + len(members) - shared):
                        links.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return dealt.mapInArrow(trimmed(compare), "a long, b long")


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Pairs (a, b) of different components, with these, the smaller one first."""
    one, two = (joined.select(F.col("node").alias(x), F.col("component").alias(f"of_{x}")) for x in ("a", "b"))
    placed = pairs.join(one, "a", "left").join(two, "b", "left").select("a", "b", F.coalesce("of_a", "a").alias("of_a"), F.coalesce("of_b", "b").alias("of_b"))
    return placed.where("of_a <> of_b").select("a", "b", F.least("of_a", "of_b").alias("low"), F.greatest("of_a", "of_b").alias("high"))


def _heads(pairs: DataFrame, joined: DataFrame) -> tuple[DataFrame, int]:
    """One pair (a, b) of each two components that pairs lie between, checkpointed, and their number."""
    first = _apart(pairs, joined).groupBy("low", "high").agg(F.min(F.struct("a", "b")).alias("pair"))
    heads, (n,) = observed(first.select("pair.a", "pair.b"), F.count("*"))
    return heads.coalesce(tasks_for(n)), n


def _merged(lists: DataFrame) -> DataFrame:
    """Of lists with equal members one, with the number of such lists as `copies`: a passage makes a list of each of its shingles.

    Lists are equal if their size and four sums of hash halves (128 bits in all) are.
    """
    halves = [x for h in (F.xxhash64("id", "n"), F.xxhash64("n", "id")) for x in (h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32))]
    marks = [f"mark{i}" for i in range(len(halves))]
    marked = lists.groupBy("key", "small").agg(F.count("*").alias("length"), *[F.sum(x).alias(m) for x, m in zip(halves, marks)])
    kept = marked.groupBy("small", "length", *marks).agg(F.min("key").alias("k_key"), F.count("*").alias("copies")).select("k_key", F.col("small").alias("k_small"), "copies")
    return lists.join(kept, (F.col("key") == F.col("k_key")) & (F.col("small") == F.col("k_small"))).drop("k_key", "k_small")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) of every row: set size, and the smallest id reachable by links, its own included.

    Sets are of shingles of `words` words and link at a Jaccard of `percent` / 100.

    Null or empty text, or text without words, has an empty set and links with
    nothing. Rows with the same id are one document with several texts. A null id
    links with nothing and has a null component. Further columns are ignored; an empty
    table gives an empty table.
    """
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    stats = checkpointed(statistics(docs, words))
    totals = {(r["kind"], r["key"]): r["n"] for r in stats.where(F.col("kind") != _MEMBER).collect()}
    sizes = {k: n for (kind, k), n in totals.items() if kind == _SIZE}
    n_docs = sum(sizes.values())
    # their number is bounded by COMMON times the mean size of a set
    common = stats.where((F.col("kind") == _MEMBER) & (F.col("n") * COMMON >= n_docs)).select("key", "n").collect()
    light = boundary(sizes, totals.get((_SQUARES, 0), 0) / max(1, totals.get((_SUM, 0), 0)), percent)

    sets = checkpointed(keyed(docs, light, sorted((r[0], r[1]) for r in common), words, percent))
    # one row for each distinct set
    same = [F.first(c).alias(c) for c in ("n", "bitmap", "lists", "subsets")]
    own = checkpointed(sets.where("id IS NOT NULL AND n > 0").groupBy("digest").agg(F.min("id").alias("id"), *same))
    entries = own.select("id", "n", F.explode("lists").alias("key"), F.lit(0).alias("small")).unionByName(own.select("id", "n", F.explode("subsets").alias("key"), F.lit(1).alias("small")))
    # size and kind in one number: by size, a set's neighbour in a list is the one most like it in size
    spot = 2 * F.col("n") + F.col("small")
    by_list = Window.partitionBy("key", F.col("spot") % 2).orderBy("spot", "id")
    near = entries.select("key", spot.alias("spot"), "id")
    near = near.select("*", F.lag("id").over(by_list).alias("p_id"), F.lag("spot").over(by_list).alias("p_spot"), F.lead("spot").over(by_list).alias("later"))

    def size(spot: str) -> Column:
        return F.floor(F.col(spot) / 2)

    with_last, with_next = (F.col(x).isNotNull() & _sizes_fit(size("spot"), size(x), percent) for x in ("p_spot", "later"))
    near = near.withColumn("p_id", F.when(with_last, F.col("p_id"))).where(with_last | with_next)
    near = checkpointed(near.select("key", "spot", "id", "p_id", F.when(F.col("p_id").isNotNull(), F.col("p_spot")).alias("p_spot")))

    maps = checkpointed(own.join(near.select("id").distinct(), "id", "left_semi").select("id", "n", "bitmap"))

    n, p_n = size("spot"), size("p_spot")
    # neighbours in a fair part of the lists that they must share; what this passes over is found below
    beside = near.where(F.col("p_id").isNotNull() & (F.col("id") != F.col("p_id"))).withColumn("some", F.when(F.col("spot") % 2 == 1, F.lit(1.0)).otherwise(_need_lists(n, p_n, percent) / CHAIN))
    chained = beside.groupBy(*_pair("id", "p_id")).agg(F.count("*").alias("k"), F.min("some").alias("some")).where("k >= some").select("a", "b")
    compared = checkpointed(_similar_bitmaps(chained, maps, percent))
    joined = components(verified(compared, docs, words, percent))
    stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
    lists = near.select("key", (F.col("spot") % 2).alias("small"), n.alias("n"), "id")

    sizes_of = F.count("*"), F.sum(F.when(F.col("component") != F.col("main"), F.col("held")))

    def opened(lists: DataFrame, joined: DataFrame) -> tuple[DataFrame, int, int]:
        """Rows of lists that hold several components, with the largest one of the list; their number, and that of the pairs to compare if they are crossed."""
        own_columns = [c for c in ("key", "small", "n", "id", "copies") if c in lists.columns]
        placed = lists.select(*own_columns).join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("component", F.coalesce("component", "id"))
        in_list = placed.groupBy("key", "small", "component").agg(F.count("*").alias("k"))
        mixed = in_list.groupBy(F.col("key").alias("m_key"), F.col("small").alias("m_small")).agg(F.max_by("component", F.struct("k", "component")).alias("main"), F.count("*").alias("parts"), F.sum("k").alias("held")).where("parts > 1")
        found = placed.join(mixed, (F.col("key") == F.col("m_key")) & (F.col("small") == F.col("m_small")))
        found, (rows, pairs) = observed(found.select(*own_columns, "component", "main", "held"), *sizes_of)
        return found, rows, pairs or 0

    # neighbours in random orders, while most of them link and spare many pairs; the rest is paired below
    lists, (rows, pairs) = observed(_merged(opened(lists, joined)[0]), *sizes_of)
    turn, pairs = 0, pairs or 0
    while True:
        in_turn = Window.partitionBy("key", "small").orderBy(F.xxhash64(F.lit(SHUFFLED + turn), F.col("id")), "id")
        mates = lists.withColumn("p", F.lag(F.struct("id", "n", "component")).over(in_turn)).where((F.col("p.component") != F.col("component")) & _sizes_fit(F.col("n"), F.col("p.n"), percent))
        mates = mates.withColumn("some", F.when(F.col("small") == 1, F.lit(1.0)).otherwise(_need_lists(F.col("n"), F.col("p.n"), percent) / CHAIN)).withColumn("p_id", F.col("p.id"))
        mates = mates.groupBy(*_pair("id", "p_id")).agg(F.sum("copies").alias("k"), F.min("some").alias("some")).where("k >= some").select("a", "b").join(compared, ["a", "b"], "left_anti")
        mates, (tried,) = observed(_similar_bitmaps(mates, maps, percent), F.count("*"))
        if not tried:
            break
        mates = mates.coalesce(tasks_for(tried))
        compared = compared.union(mates)
        links, (linked,) = observed(verified(mates, docs, words, percent), F.count("*"))
        if linked:
            joined = components(stars.union(links.coalesce(tasks_for(linked))))
            stars, before = joined.select(F.col("node").alias("a"), F.col("component").alias("b")), pairs
            (lists, rows, pairs), turn = opened(lists, joined), turn + 1
            spared = before - pairs
        # pieces of one group link nearly always, unrelated sets that share a passage never; a few links are not worth reading all lists again
        if linked < FRUITFUL * tried or spared < SPARED * rows:
            break

    folded = maps.select(F.col("id").alias("f_id"), _folded("bitmap").alias("bits"))
    open_lists = checkpointed(lists.join(folded, F.col("id") == F.col("f_id")).drop("f_id"))
    x, y = open_lists.where("component <> main").alias("x"), open_lists.alias("y")
    # each list gives a pair of different components once
    once = (F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id"))
    may = _sizes_fit(F.col("x.n"), F.col("y.n"), percent) & _bits_fit("x.bits", "y.bits", F.col("x.n"), F.col("y.n"), percent, FOLDED // 64)
    crossed = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.small") == F.col("y.small")) & (F.col("x.component") != F.col("y.component")) & once & may)
    crossed = crossed.select(*_pair("x.id", "y.id"), F.col("x.small").alias("small"), F.col("x.copies").alias("copies"), _need_lists(F.col("x.n"), F.col("y.n"), percent).alias("need"))
    crossed = crossed.groupBy("a", "b").agg(F.sum("copies").alias("k"), F.max("small").alias("small"), F.min("need").alias("need"))
    crossed = crossed.where("small = 1 OR k >= need").select("a", "b").join(compared, ["a", "b"], "left_anti")
    crossed, (left,) = observed(_similar_bitmaps(crossed, maps, percent), F.count("*"))
    crossed = crossed.coalesce(tasks_for(left))
    # where pairs are many between few components, one of each two is compared first: if it links, the others tell nothing new
    heads, n_heads = _heads(crossed, joined) if left >= MANY else (crossed, left)
    if left >= MANY and n_heads * REPEATED <= left:
        links, (linked,) = observed(verified(heads, docs, words, percent), F.count("*"))
        if linked:
            joined = components(stars.union(links.coalesce(tasks_for(linked))))
            stars = joined.select(F.col("node").alias("a"), F.col("component").alias("b"))
        crossed, (left,) = observed(_apart(crossed, joined).select("a", "b").join(heads, ["a", "b"], "left_anti"), F.count("*"))
        crossed = crossed.coalesce(tasks_for(left))
    if left:
        stars = stars.union(verified(crossed, docs, words, percent))
    # a document with several texts ties their sets
    several = checkpointed(sets.where("id IS NOT NULL").groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least <> most").select("id"))
    ties = sets.where("n > 0").select("id", "digest").join(several, "id", "left_semi").distinct().join(own.select("digest", F.col("id").alias("b")), "digest").select(F.col("id").alias("a"), "b")
    done = checkpointed(components(stars.union(ties)))

    of_set = own.select("digest", "id").join(done, F.col("id") == F.col("node"), "left").select("digest", F.coalesce("component", "id").alias("component"))
    out = sets.select("id", "n", "digest").join(of_set, "digest", "left")
    # a row without words has the component that its id has by its other texts
    of_id = several.join(done, F.col("id") == F.col("node")).select(F.col("id").alias("tied"), F.col("component").alias("of_id"))
    out = out.join(of_id, F.col("id") == F.col("tied"), "left")
    component = F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.coalesce("component", "id")).otherwise(F.coalesce("of_id", "id")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows, whole, less those whose text has a kept copy before; of rows with one id and equal texts one stays.

    So a row goes by its own text, not by others with its id, and unlike texts under one
    id all stay. Rows with a null id stay. A null text is an empty one.
    """
    marked = df.withColumn("one__mark", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    named = marked.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("one__id"), "one__mark")
    counts = named.groupBy("one__id").agg(F.min("one__mark").alias("least"), F.max("one__mark").alias("most"), F.count("*").alias("one__n"))
    again, (several, unlike) = observed(counts.where("one__n > 1"), F.count("*"), F.count_if(F.col("least") != F.col("most")))
    if not several:
        return _firsts(df, id_col, text_col, words, percent)
    if not unlike:
        left = _firsts(marked, id_col, text_col, words, percent)
    else:
        # texts that share an id are joined as documents of their own
        texts = checkpointed(numbered(checkpointed(named.distinct()), [], ["one__id", "one__mark"], "one__node")).toDF("text__id", "text__mark", "one__node")
        placed = marked.join(texts, (F.col(id_col).cast("long") == F.col("text__id")) & (F.col("one__mark") == F.col("text__mark"))).select("one__node", F.col(text_col).alias("one__text"))
        rated = checkpointed(near_duplicates(placed.dropDuplicates(["one__node"]), "one__node", "one__text", words, percent))
        heads = rated.join(texts, "one__node").groupBy("component_id").agg(F.min(F.struct("text__id", "text__mark")).alias("head"))
        stay = heads.select(F.col("head.text__id").alias("stay__id"), F.col("head.text__mark").alias("stay__mark"))
        left = marked.join(stay, (F.col(id_col).cast("long") == F.col("stay__id")) & (F.col("one__mark") == F.col("stay__mark")), "left_semi")
        left = left.unionByName(marked.where(F.col(id_col).isNull()))
    match = F.col(id_col).cast("long") == F.col("one__id")
    one = Window.partitionBy(id_col, "one__mark").orderBy(*[F.col(c) for c in df.columns])
    repeated = left.join(again, match, "left_semi").withColumn("again__at", F.row_number().over(one)).where("again__at = 1").drop("again__at")
    return left.join(again, match, "left_anti").unionByName(repeated).drop("one__mark")


def _firsts(df: DataFrame, id_col: str, text_col: str, words: int, percent: int) -> DataFrame:
    """Rows of documents that are the first of their group, and rows with a null id."""
    rated = near_duplicates(df, id_col, text_col, words, percent).where(F.col(id_col).isNotNull())
    gone = checkpointed(rated.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone__id")).distinct())
    return df.join(gone, F.col(id_col) == F.col("gone__id"), "left_anti")
