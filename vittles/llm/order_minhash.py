"""Document fingerprints by Order MinHash, in DataFrame functions only.

Symbols are the words of a text, long ones cut every `SYMBOL_CHARS` characters. Each run
of `K` symbols is a k-mer, numbered by its occurrence in the text, so repeats count. A
hash of k-mer and number deals it to one of `BUCKETS` sketches, each with a hash order
of its own (one permutation, dealt out). A sketch takes its 2 least k-mers,
puts them back in text order and hashes the pair: moved text changes the pair although
its k-mers stay, which makes the signature follow edit distance. Where a sketch has one
k-mer only, as in short texts, the least one of the next sketch that has any, round the
end, is its partner, so short texts keep their order too. The likeness of two
texts is the share of sketches that agree, of those that either has.

Hash and place are packed into one long, so a sort of longs numbers the occurrences
and another one finds the least of every sketch, in time n log n for a text of n words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vittles.llm.common import let

K, SYMBOL_CHARS = 3, 12
BUCKETS = 64
BUCKET_BITS, HASH_BITS, PLACE_BITS = 6, 31, 32
#: rows of a block that one window holds, blocks at most, blocks looked up at once
BLOCK_ROWS, MOST_BLOCKS, FAN = 512, 4096, 64


def _indices(items: Column) -> Column:
    return F.when(F.size(items) > 0, F.sequence(F.lit(0), F.size(items) - 1)).otherwise(F.array().cast("array<int>"))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def _packed(hashed: Column, place: Column) -> Column:
    return F.shiftleft(F.shiftrightunsigned(hashed, 64 - HASH_BITS), PLACE_BITS).bitwiseOR(place.cast("long"))


def _changes(items: Column, bits: int) -> Column:
    """Indices at which the value of a sorted array without its last `bits` bits changes."""
    return F.filter(_indices(items), lambda i: (i == 0) | (F.shiftright(F.get(items, i), bits) != F.shiftright(F.get(items, i - 1), bits)))


def _numbered(kmers: Column) -> Column:
    """From sorted (k-mer, place) to (hash of k-mer and occurrence, place), all packed."""

    def run(starts: Column, start: Column, r: Column) -> Column:
        last = F.coalesce(F.get(starts, r + 1), F.size(kmers)) - 1
        own = _hash(F.get(kmers, start))
        return F.transform(F.sequence(start, last), lambda i: _packed(F.xxhash64(own, i - start), _place(F.get(kmers, i))))

    return let(_changes(kmers, PLACE_BITS), lambda starts: F.flatten(F.transform(starts, lambda start, r: run(starts, start, r))))


def _sketches(least: Column) -> Column:
    """From sorted (hash, place) to (bucket, hash of the pair in text order), packed, one for each bucket that has k-mers."""
    low = PLACE_BITS + HASH_BITS - BUCKET_BITS

    def pair(start: Column) -> Column:
        a, bucket = F.get(least, start), F.shiftright(F.get(least, start), low)
        # the next k-mer is of the same sketch, or the least one of the next sketch that has any
        b = F.coalesce(F.get(least, start + 1), F.get(least, F.lit(0)))
        pair_hash = F.when(F.size(least) == 1, F.xxhash64(_hash(a))).when(_place(a) < _place(b), F.xxhash64(_hash(a), _hash(b))).otherwise(F.xxhash64(_hash(b), _hash(a)))
        return F.shiftleft(bucket, 32).bitwiseOR(F.shiftrightunsigned(pair_hash, 32))

    return F.transform(_changes(least, low), pair)


def signature(text: Column) -> Column:
    """The sketches of a text as an array of longs, sorted by bucket. Null text and text without words: no sketches."""
    words = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(rf"(\S{{1,{SYMBOL_CHARS}}})"), F.lit(1))

    def kmers(w: Column) -> Column:
        places = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.greatest(F.size(w) - K, F.lit(0)))).otherwise(F.array().cast("array<int>"))
        return F.sort_array(F.transform(places, lambda i: _packed(F.xxhash64(*[F.get(w, i + j) for j in range(K)]), i)))

    return let(let(let(words, kmers), lambda s: F.sort_array(_numbered(s))), _sketches)


def likeness(a: Column, b: Column) -> Column:
    """Share of agreeing sketches, 0 to 1; of two texts without sketches 1."""
    buckets = F.size(F.array_union(F.transform(a, lambda x: F.shiftright(x, 32)), F.transform(b, lambda x: F.shiftright(x, 32))))
    return F.when(buckets == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.greatest(buckets, F.lit(1)))


def fingerprint(sketches: Column) -> Column:
    return F.array_join(F.transform(sketches, lambda x: F.lower(F.hex(x))), ",")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fingerprint) of every row. Null text counts as empty; equal texts have equal fingerprints."""
    return df.select(F.col(id_col), fingerprint(signature(F.col(text_col))).alias("fingerprint"))


def _block(id_col: Column, cuts: list[int]) -> Column:
    """How many of the sorted `cuts` an id has reached; a null id comes last."""
    fans = [cuts[i : i + FAN] for i in range(0, len(cuts), FAN)]

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= id_col))

    if not fans:
        return F.lit(0)
    top = F.greatest(reached(F.array(*[F.lit(f[0]) for f in fans])), F.lit(1))
    inside = F.array(*[F.array(*[F.lit(c) for c in f]) for f in fans])
    return F.coalesce(F.when(id_col.isNull(), F.lit(len(cuts))).otherwise((top - 1) * FAN + reached(F.get(inside, top - 1))), F.lit(0)).cast("int")


def with_next(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Add `sig`, and the text and signature of the next row, by ascending id, as `next_text` and `next_sig`; the first follows the last.

    Takes (id, text). A row is signed once; the first rows of blocks, which others look up, are
    picked by id and text and signed again. Rows are dealt to blocks by quantiles of the id and the next row is
    looked up in the block; the last row of a block takes the first one of the next block.
    Texts are shuffled once. At most `MOST_BLOCKS` cuts and first ids reach the
    driver. Null ids come last; rows with the same id are ordered by text.
    """
    ids = df.select(id_col)
    n = ids.count()
    parts = max(1, min(MOST_BLOCKS, n // BLOCK_ROWS))
    cuts: list[int] = []
    if parts > 1:
        shares = [i / parts for i in range(1, parts)]
        cuts = sorted(set(ids.agg(F.percentile_approx(id_col, shares, 20 * parts)).first()[0] or []))
    block = _block(F.col(id_col), cuts)
    first_ids = sorted((r[0], r[1]) for r in ids.select(block.alias("block"), id_col).groupBy("block").agg(F.min(id_col)).collect())
    before = [first_ids[i - 1][0] for i in range(len(first_ids))]
    follows = df.sparkSession.createDataFrame([(i, b) for (_, i), b in zip(first_ids, before)], "first_id long, for_block int")
    # one row for each block
    heads = df.join(F.broadcast(follows), F.col(id_col).eqNullSafe(F.col("first_id")))
    heads = heads.groupBy("for_block").agg(F.min("text").alias("text"))
    heads = heads.select("for_block", F.struct("text", signature(F.col("text")).alias("sig")).alias("head"))
    order = Window.partitionBy("block").orderBy(F.col(id_col).asc_nulls_last(), "text")
    signed = df.withColumn("sig", signature(F.col("text")))
    placed = signed.withColumn("block", block).select("*", F.lead(F.struct("text", "sig")).over(order).alias("after"))
    joined = placed.join(heads, (F.col("block") == F.col("for_block")) & F.col("after").isNull(), "left")
    after = F.coalesce("after", "head")
    return joined.select(*signed.columns, after["text"].alias("next_text"), after["sig"].alias("next_sig"))


def edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The last quarter of a text's code points is replaced by as many (or all) first ones
    of the next document. Null text counts as empty. An empty table gives an empty table. Repeated
    rows are rows of their own; further columns are ignored. A very long text costs memory for
    some arrays of its words.
    """
    base = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = with_next(base)
    n = F.length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    made = placed.select("id", n.cast("long").alias("n_chars"), "sig", "next_sig", edited.alias("edited"))
    made = made.select("id", "n_chars", "sig", "next_sig", F.sha2("edited", 256).alias("edited_sha256"), signature(F.col("edited")).alias("edited_sig"))
    return made.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", fingerprint(F.col("sig")).alias("fingerprint"), fingerprint(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
