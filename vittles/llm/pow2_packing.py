"""Packing by power-of-two decomposition.

A document's ids are cut into pieces of `max_length` and, for the rest, one piece
for each binary digit, longest first. Every piece is one training sequence, so no
sequence crosses documents and none needs padding; sequences of equal length form a
bucket, numbered without gaps, from which batches of one length are drawn.

Plain byte-level tokenizer files are merged by tiktoken's core, a whole text at a time, and
nothing is remembered. For others, texts are cut for the tokenizer only where a blank follows a character that is no
white space, and before a part's last marks where they follow a letter. The
tokenizer's splitting pattern never runs over such a place, so the ids of the parts,
joined, are those of the whole text, and a part seen before needs no second encoding.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vittles.llm.common import checkpointed, numbered, text_batches, trimmed

MAX_LENGTH = 1024
END_ID = 0
#: parts whose ids a worker remembers, some 150 bytes each, as long as it lives; beyond it only those of the texts in hand stay
REMEMBERED = 200_000
#: characters of the texts whose ids a task holds at once
RUN_CHARS = 500_000

LOOSE = re.compile(r"[\s\x1c-\x1f\x85] ")
CUT = re.compile(r"(?<=\S) ")
#: the splitting pattern of byte-level tokenizer files
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """Rank of each byte sequence in a tokenizer file, if that is plain byte-level BPE whose ids follow its merges; else None."""
    model, before = spec["model"], spec.get("pre_tokenizer") or {}
    plain = model.get("type") == "BPE" and before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
    if not plain or spec.get("normalizer") or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback")):
        return None
    vocab, merges = model["vocab"], ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
    ids = [vocab[m] for m in merges]
    if ids != sorted(ids):
        return None
    # the file writes a byte as the character of that number if it is visible, else as the next one from 256 on
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in visible]
    byte = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if token not in special}


class PartEncoder:
    """Ids of texts as little-endian unsigned 32-bit bytes, those of the tokenizers library.

    Plain byte-level vocabularies are merged by tiktoken's core, which gives the
    same ids at a fifth of the time for a part; `whole` needs less again, as it calls once for a
    text. Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, tokenizer_file: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        with open(tokenizer_file, encoding="utf-8") as f:
            ranks = byte_ranks(json.load(f))
        self.plain = ranks is not None
        if self.plain:
            self.core = tiktoken.Encoding("parts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            tokenizer = Tokenizer.from_file(tokenizer_file)
            tokenizer.encode_special_tokens = True
            self.core = lambda part: tokenizer.encode(part, add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _ids(self, parts: list[str]) -> list[bytes]:
        return [array("I", self.core(p)).tobytes() for p in parts]

    def _learn(self, words: set[str]) -> None:
        """Remember the ids of words with the blank in front; new words are put together from stems and last marks."""
        known, split, stems = self.known, {}, set()
        for w in words:
            stem = w.rstrip(MARKS)
            if len(stem) < len(w) and stem[-1:].isalpha():
                split[w] = stem
                stems.add(stem)
            else:
                stems.add(w)
        stems = [w for w in stems if w not in known]
        known.update(zip(stems, self._ids([f" {w}" for w in stems])))
        tails = [t for t in {w[len(stem) :] for w, stem in split.items()} if t not in self.tails]
        self.tails.update(zip(tails, self._ids(tails)))
        known.update((w, known[stem] + self.tails[w[len(stem) :]]) for w, stem in split.items())

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [CUT.split(t) if LOOSE.search(t) else t.split(" ") for t in texts]
        # every part but a text's first has the blank in front
        words = set().union(*(parts[1:] for parts in split))
        new = words.difference(self.known)
        if len(self.known) + 2 * len(new) > REMEMBERED:
            self.known, self.tails = {w: self.known[w] for w in words if w in self.known}, {}
        self._learn(new)
        heads = self._ids([parts[0] for parts in split])
        known = self.known.__getitem__
        return [head + b"".join(map(known, parts[1:])) for head, parts in zip(heads, split)]


    def whole(self, texts: list[str]) -> list[bytes]:
        """The same ids, each text encoded at once and nothing remembered."""
        return self._ids(texts)


@lru_cache(maxsize=4)
def encoder(tokenizer_file: str) -> Callable[[list[str]], list[bytes]]:
    """What encodes texts soonest by this file: whole ones in tiktoken's core, parts in the tokenizers library."""
    own = PartEncoder(tokenizer_file)
    return own.whole if own.plain else own.encode


def binary_lengths(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of n ids: full ones, then the binary digits of the rest, longest first."""
    if most & (most - 1) or most < 1:
        raise ValueError("the greatest length is a power of two")
    rest = n % most
    return [most] * (n // most) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pieces(df: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
           max_length: int = MAX_LENGTH, end_id: int = END_ID) -> DataFrame:
    """All pieces: (id, start, length, ids binary, doc_tokens), `end_id` after each document's ids.

    Null text counts as empty: one piece that holds `end_id` alone. Repeated rows
    give repeated pieces; further columns are ignored; an empty table has no pieces.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last = encoder(tokenizer_file), end_id.to_bytes(4, "little")
        for batch in batches:
            for first, texts in text_batches(batch, "text", RUN_CHARS):
                part = batch.column(0).slice(first, len(texts))
                docs, starts, lengths, cuts, totals = [], [], [], [], []
                for doc, ids in zip(part, encode(texts)):
                    ids += last
                    at, total = 0, len(ids) // 4
                    for n in binary_lengths(total, max_length):
                        docs.append(doc.as_py())
                        starts.append(at)
                        lengths.append(n)
                        cuts.append(ids[4 * at : 4 * (at + n)])
                        totals.append(total)
                        at += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, part.type), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()),
                     pa.array(cuts, pa.binary()), pa.array(totals, pa.int64())],
                    names=["id", "start", "length", "ids", "doc_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        trimmed(work), f"id {kind}, start long, length long, ids binary, doc_tokens long")
    return out.withColumnRenamed("id", id_col)


def sequences(cut: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Give every piece its sequence: `sequence_id` without gaps, all of one length in a row, and `offset` 0.

    `cut` has the columns of `pieces`, with or without ids, and is read more than once.
    """
    order = [c for c in (id_col, "start", "doc_tokens", "ids_crc32") if c in cut.columns]
    inside = numbered(cut, ["length"], order, "in_bucket")
    # a row for each power of two: a bounded table
    sizes = cut.groupBy("length").agg(F.count("*").alias("n"))
    lower = sizes.alias("a").join(sizes.alias("b"), F.col("a.length") > F.col("b.length"), "left")
    before = lower.groupBy(F.col("a.length").alias("bucket")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    joined = inside.join(F.broadcast(before), F.col("length") == F.col("bucket"))
    return joined.select(*cut.columns, (F.col("before") + F.col("in_bucket")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def packed_digest(df: DataFrame, tokenizer_file: str) -> DataFrame:
    """Pieces of documents with a checksum of their ids in place of the ids, and their sequences."""
    cut = pieces(df, tokenizer_file).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens")
    return sequences(checkpointed(cut))
