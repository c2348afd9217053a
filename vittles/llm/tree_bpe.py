"""Byte-level BPE as a monoid tree reduction.

A text is halved until the parts are short; parts are encoded on their own, and
neighbours are joined up the tree. A join re-encodes a window around the seam and
keeps the tokens outside it. The window grows until both of its edges are places
where the tokens of the two sides provably stay: a character that is no white
space followed by a blank, tab or line end. No alternative of the splitting pattern runs over
such a place and none looks behind, so every scan has a match boundary there, in
the halves and in the whole, and merges never cross match boundaries. If a side
has no such place, the window takes in that whole side. Decoding joins the bytes
of the halves up the same tree.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: characters of a part that is not halved further; in decoding a quarter as many tokens
LEAF_CHARS = 256
#: first width of the window on either side of a seam; doubled as needed
WINDOW_CHARS = 64

STABLE = re.compile(r"(?<=\S)[ \t\n\r]")


class TreeCodec:
    """Encoder and decoder over the ranks of one vocabulary file."""

    def __init__(self, ranks_file: str, pattern: str, leaf: int = LEAF_CHARS, window: int = WINDOW_CHARS):
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.codec = tiktoken.Encoding("tree", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.widths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.widths[rank] = len(token)
        self.leaf, self.window = max(2, leaf), max(1, window)

    def encode(self, text: str) -> np.ndarray:
        return self._encode(text, 0, len(text))

    def _encode(self, text: str, start: int, end: int) -> np.ndarray:
        if end - start <= self.leaf:
            return np.array(self.codec.encode_ordinary(text[start:end]), dtype="<u4")
        seam = (start + end) // 2
        return self._join(text, start, seam, end, self._encode(text, start, seam), self._encode(text, seam, end))

    def _join(self, text: str, start: int, seam: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        a, b = self._stable_before(text, start, seam), self._stable_after(text, seam, end)
        again = self.codec.encode_ordinary(text[a:b])
        keep = self._tokens(left[::-1], len(text[a:seam].encode()))
        skip = self._tokens(right, len(text[seam:b].encode()))
        return np.concatenate([left[: len(left) - keep], np.array(again, dtype="<u4"), right[skip:]])

    def _stable_before(self, text: str, start: int, seam: int) -> int:
        width = self.window
        while True:
            low = max(start, seam - width)
            # both characters of the place must lie in the left half
            if found := [m.start() for m in STABLE.finditer(text, low, seam)]:
                return found[-1]
            if low == start:
                return start
            width *= 2

    def _stable_after(self, text: str, seam: int, end: int) -> int:
        width = self.window
        while True:
            high = min(end, seam + width)
            # the character before the place must lie in the right half
            if found := STABLE.search(text, seam + 1, high):
                return found.start()
            if high == end:
                return end
            width *= 2

    def _tokens(self, ids: np.ndarray, n_bytes: int) -> int:
        """How many leading tokens of `ids` span exactly `n_bytes`; widens its look until they do."""
        look = 64
        while n_bytes:
            spans = np.cumsum(self.widths[ids[:look]])
            if (at := int(np.searchsorted(spans, n_bytes))) < len(spans):
                if spans[at] != n_bytes:
                    raise ValueError("a stable place lies inside a token")
                return at + 1
            look *= 2
        return 0

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) <= max(1, self.leaf // 4):
            return self.codec.decode_bytes(ids.tolist())
        half = len(ids) // 2
        return self.decode(ids[:half]) + self.decode(ids[half:])


@lru_cache(maxsize=4)
def codec(ranks_file: str, pattern: str) -> TreeCodec:
    """One codec per worker process and vocabulary."""
    return TreeCodec(ranks_file, pattern)


def encode_texts(df: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token ids of every text: (id, ids binary of little-endian unsigned 32-bit ids).

    Null text counts as empty and has no ids; repeated rows give repeated rows;
    further columns are ignored; an empty table gives an empty table.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                ids = [own.encode(t.as_py() or "").tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(work, f"id {kind}, ids binary")
    return out.withColumnRenamed("id", id_col)


def decode_ids(df: DataFrame, ranks_file: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Add the decoded bytes of an ids column (binary) as `out_col`. Null or empty ids: empty bytes."""
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != out_col]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_file, pattern)
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                done = [own.decode(np.frombuffer(x.as_py() or b"", dtype="<u4")) for x in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(done, pa.binary())], names=[*part.schema.names, out_col])

    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != out_col]).mapInArrow(work, ", ".join([*fields, f"`{out_col}` binary"]))


def digests(encoded: DataFrame, ranks_file: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of what `encode_texts` returned."""
    decoded = decode_ids(encoded, ranks_file, pattern)
    return decoded.select(
        F.col(id_col),
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def ids_digest(ids: list[int]) -> str:
    return hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
