"""Secret scan by a linear-chain conditional random field.

Tokens are tagged as begin of a secret, inside one, or outside. A token's scores come
from its own shape, the classes of its three tokens before and one behind, and
features of its file; transitions link neighbours; Viterbi decoding picks the tags.

The field is trained on a bounded sample of documents, in which the values that the
base patterns find are marked (weak labels); named values are learnt in other writings and
alphabets too, and their names without a value, so that the field finds what the patterns
lack. A scan returns the base spans and adds the decoded ones that touch none of them.

Decoding is exact, though only few tokens go through the recursion: where `outside`
beats the other tags by more than transitions can ever return, the best path is
outside there (replacing the tag would improve any other path), so the chain is cut
at such tokens and only the short runs between them are decoded.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vittles.llm.common import code_points, text_batches, trimmed

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

#: documents that the field is fitted on, at most twice as many
TRAIN_DOCS = 1200
#: windows of a document (half of them around marked values at most), tokens of a window, and training steps
DOC_WINDOWS, WINDOW, STEPS = 4, 20, 150

#: characters of the texts that are read together; some forty numbers are held for each
RUN_CHARS = 1_000_000

OUT, BEGIN, INSIDE = 0, 1, 2

# classes of characters
SPACE, LOWER, UPPER, DIGIT, JOIN, MARK, OTHER = range(7)
CLASS = np.full(129, MARK, dtype=np.uint8)
CLASS[[9, 10, 11, 12, 13, 32, 28, 29, 30, 31]] = SPACE
CLASS[97:123], CLASS[65:91], CLASS[48:58] = LOWER, UPPER, DIGIT
CLASS[[ord(c) for c in "+/_.-"]] = JOIN
CLASS[128] = OTHER
HEX = np.zeros(129, dtype=bool)
HEX[48:58] = HEX[97:103] = True
LOWERED = np.arange(129, dtype=np.uint8)
LOWERED[65:91] += 32

#: words that often name a secret; a token that ends with one is of class KEYWORD
KEYWORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "access_key", "credential", "credentials", "bearer", "auth")
#: first three letters of the base pattern's names
HEADS = ("pas", "sec", "tok", "api")

# classes of neighbouring tokens
EDGE, KEYWORD, PLAIN, CODE, LONG, SET, QUOTE, PUNCT = range(8)
NEAR = (-3, -2, -1, 1)
LENGTHS = np.array([4, 8, 12, 16, 24, 40])
SHAPES = 7 * 16 * 4 + 8
FILES = 12
#: of each shape code the features it stands for: length band, character set, texture, mark
FEATURES = 7 + 16 + 4 + 8
WORD_SHAPE = np.arange(SHAPES - 8)
SHAPE_HAS = np.zeros((SHAPES, FEATURES))
SHAPE_HAS[WORD_SHAPE, WORD_SHAPE // 64] = SHAPE_HAS[WORD_SHAPE, 7 + WORD_SHAPE // 4 % 16] = SHAPE_HAS[WORD_SHAPE, 23 + WORD_SHAPE % 4] = 1
SHAPE_HAS[np.arange(SHAPES - 8, SHAPES), np.arange(27, 35)] = 1


@dataclass
class Field:
    """Scores: own shape, each neighbour's class, the file; and transitions [from, to]."""

    shape: np.ndarray
    near: np.ndarray
    file: np.ndarray
    step: np.ndarray

    @staticmethod
    def empty() -> Field:
        field = Field(np.zeros((SHAPES, 3)), np.zeros((len(NEAR), 8, 3)), np.zeros((FILES, 3)), np.zeros((3, 3)))
        field.shape[:, OUT] = 9.0
        return field


@dataclass
class Tokens:
    """Tokens of several texts: bounds, text number, codes of shape, neighbours and file."""

    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    shape: np.ndarray
    near: np.ndarray
    file: np.ndarray


def tokens(texts: list[str], hidden: Sequence[str] = ()) -> tuple[Tokens, np.ndarray, np.ndarray]:
    """Cut texts into words (letters, digits and joiners) and single marks; also the code points and text offsets.

    Words that end with a hidden name are plain ones.
    """
    points, offsets = code_points(texts)
    small = np.minimum(points, 128).astype(np.uint8)
    kind = CLASS[small]
    word = (kind != SPACE) & (kind != MARK)
    first = np.zeros(len(points) + 1, dtype=bool)
    first[offsets] = True
    before = np.concatenate([[False], word[:-1]]) & ~first[:-1] if len(points) else word
    begins = (word & ~before) | (kind == MARK)
    start = np.flatnonzero(begins)
    if not len(start):
        none = np.zeros(0, dtype=np.int64)
        return Tokens(none, none, none, none, np.zeros((len(NEAR), 0), dtype=np.int64), none), points, offsets
    # a token ends before the next begin, space or text
    stops = np.flatnonzero(begins | (kind == SPACE) | first[:-1])
    after = np.append(stops, len(points))
    end = after[np.searchsorted(stops, start, side="right")]
    length = end - start
    text = np.searchsorted(offsets, start, side="right") - 1

    def has(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return total[end] - total[start]

    mark = kind[start] == MARK
    digits, uppers, joins = has(kind == DIGIT), has(kind == UPPER), has(kind == JOIN)
    hexes, others = has(HEX[small]), has(kind == OTHER)
    turns = has(np.concatenate([[False], kind[1:] != kind[:-1]]))
    lowers = length - digits - uppers - joins - others
    band = np.searchsorted(LENGTHS, length, side="right")
    charset = (lowers > 0) + 2 * (uppers > (lowers > 0)) + 4 * (digits > 0) + 8 * (others > 0)
    texture = (hexes == length) + 2 * (turns * 3 > length)
    shape = (band * 16 + charset) * 4 + texture
    code = small[start]
    sets, quotes = mark & ((code == ord("=")) | (code == ord(":"))), mark & ((code == ord('"')) | (code == ord("'")))
    shape = np.where(mark, 7 * 16 * 4 + np.where(sets, 1, np.where(quotes, 2, 0)), shape)

    near = np.where(length >= 12, LONG, np.where((digits > 0) & (lowers + uppers > 0), CODE, PLAIN))
    near[mark], near[sets], near[quotes] = PUNCT, SET, QUOTE
    named = np.flatnonzero(~mark & (length >= 3) & (length <= 40) & (digits == 0) & (others == 0))
    last3 = _three(small)[end[named] - 3]
    for i in named[np.isin(last3, [_packed(w[-3:]) for w in KEYWORDS])]:
        word_i = bytes(LOWERED[small[start[i] : end[i]]]).decode("latin-1")
        if word_i.endswith(KEYWORDS) and not word_i.endswith(tuple(hidden)):
            near[i] = KEYWORD
    around = np.zeros((len(NEAR), len(start)), dtype=np.int64)
    for row, shift in enumerate(NEAR):
        at = np.arange(len(start)) + shift
        inside = (at >= 0) & (at < len(start))
        at = np.clip(at, 0, len(start) - 1)
        around[row] = np.where(inside & (text[at] == text), near[at], EDGE)

    n = np.bincount(text, minlength=len(texts)).clip(1)
    coded = np.bincount(text, weights=(digits > 0), minlength=len(texts)) / n
    marks = np.bincount(text, weights=mark, minlength=len(texts)) / n
    setting = np.bincount(text, weights=sets, minlength=len(texts)) > 0
    file = (np.searchsorted([0.002, 0.02], coded) * 2 + (marks > 0.25)) * 2 + setting
    return Tokens(start, end, text, shape, around, file[text]), points, offsets


def _packed(three: str) -> int:
    return sum(ord(c) << (16 - 8 * i) for i, c in enumerate(three))


def _three(small: np.ndarray) -> np.ndarray:
    """Three lower-cased characters from each place on, packed into one number."""
    low = LOWERED[np.concatenate([small, np.zeros(2, dtype=np.uint8)])].astype(np.int32)
    return (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]


def base_spans(text: str, heads: np.ndarray, hex_runs: list[tuple[int, int]]) -> list[tuple[int, int, int, int]]:
    """(start, kind, end, start of the value) of the base patterns in one text.

    `heads`: places where a name of the assign pattern can begin; matching there in
    turn, past the last match, is the leftmost non-overlapping scan.
    """
    found, past = [], 0
    for at in heads.tolist():
        if at >= past and (m := ASSIGN.match(text, at)):
            past = m.end()
            if len(m[2]) >= ASSIGN_CHARS:
                found.append((m.start(), 0, m.end(), m.start(2)))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m.start()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    found += [(a, 2, b, a) for a, b in hex_runs]
    return sorted(found)


def _base(texts: list[str], points: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int, int]]]:
    small = np.minimum(points, 128).astype(np.uint8)
    heads = np.flatnonzero(np.isin(_three(small), [_packed(h) for h in HEADS])) if len(small) else np.zeros(0, dtype=np.int64)
    is_hex = np.concatenate([[False], HEX[small], [False]])
    # runs end with their text
    edges = np.flatnonzero(is_hex[1:] != is_hex[:-1])
    runs = edges.reshape(-1, 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= HEX_CHARS]
    pieces: list[list[tuple[int, int]]] = [[] for _ in texts]
    for a, b in runs.tolist():
        i = int(np.searchsorted(offsets, a, side="right")) - 1
        while a < b:
            stop = min(b, int(offsets[i + 1]))
            if stop - a >= HEX_CHARS:
                pieces[i].append((a - int(offsets[i]), stop - int(offsets[i])))
            a, i = max(a, stop), i + 1
    cut = np.searchsorted(heads, offsets)
    return [base_spans(t, heads[cut[i] : cut[i + 1]] - offsets[i], pieces[i]) for i, t in enumerate(texts)]


def _emissions(field: Field, t: Tokens) -> np.ndarray:
    scores = field.shape[t.shape] + field.file[t.file]
    for row in range(len(NEAR)):
        scores = scores + field.near[row][t.near[row]]
    return scores


def viterbi(scores: np.ndarray, step: np.ndarray) -> np.ndarray:
    """Best tags of chains of one length, scores [chain, token, tag]; before and behind a chain is `outside`."""
    chains, length, _ = scores.shape
    best, back = scores[:, 0] + step[OUT], np.zeros((chains, length, 3), dtype=np.int8)
    for i in range(1, length):
        ways = best[:, :, None] + step
        back[:, i] = ways.argmax(axis=1)
        best = ways.max(axis=1) + scores[:, i]
    tags = np.zeros((chains, length), dtype=np.int8)
    tags[:, -1] = (best + step[:, OUT]).argmax(axis=1)
    for i in range(length - 1, 0, -1):
        tags[:, i - 1] = back[np.arange(chains), i, tags[:, i]]
    return tags


def decode(field: Field, t: Tokens) -> np.ndarray:
    """The best tag of every token, text by text."""
    tags = np.zeros(len(t.start), dtype=np.int8)
    if not len(tags):
        return tags
    scores = _emissions(field, t)
    most = 2 * (field.step.max() - field.step.min())
    doubt = scores[:, OUT] - scores[:, 1:].max(axis=1) <= most
    joined = np.concatenate([[False], doubt[1:] & doubt[:-1] & (t.text[1:] == t.text[:-1])])
    first = np.flatnonzero(doubt & ~joined)
    last = np.flatnonzero(doubt & ~np.append(joined[1:], False)) + 1
    lengths = last - first
    for n in np.unique(lengths):
        own = first[lengths == n]
        at = own[:, None] + np.arange(n)
        tags[at] = viterbi(scores[at], field.step)
    return tags


def find_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, int]]]:
    """Of each text all spans (start, kind, end), sorted: base spans, and decoded ones that touch none of them."""
    t, points, offsets = tokens(texts)
    found = [[(a, k, b) for a, k, b, _ in spans] for spans in _base(texts, points, offsets)]
    # base spans are sorted by start: one that touches (a, b) starts before b, and some such one ends behind a
    starts = [[a for a, _, _ in spans] for spans in found]
    ends = [list(itertools.accumulate((b for _, _, b in spans), max)) for spans in found]
    for own, a, b in decoded_spans(t, offsets, field):
        before = bisect.bisect_left(starts[own], b)
        if not before or ends[own][before - 1] <= a:
            found[own].append((a, 3, b))
    return [sorted(x) for x in found]


def decoded_spans(t: Tokens, offsets: np.ndarray, field: Field) -> list[tuple[int, int, int]]:
    """(text, start, end) of what the field tags, whether or not a base pattern marks it."""
    tags, out = decode(field, t), []
    # a span begins at `begin`, or at `inside` after `outside` or another text
    tagged = np.flatnonzero(tags != OUT)
    i = 0
    while i < len(tagged):
        j = i + 1
        while j < len(tagged) and tagged[j] == tagged[j - 1] + 1 and tags[tagged[j]] == INSIDE and t.text[tagged[j]] == t.text[tagged[i]]:
            j += 1
        own = int(t.text[tagged[i]])
        out.append((own, int(t.start[tagged[i]] - offsets[own]), int(t.end[tagged[j - 1]] - offsets[own])))
        i = j
    return out


# ---- training


def _windows(texts: list[str], seed: int, hidden: Sequence[str] = ()) -> list[tuple[np.ndarray, ...]]:
    """Training windows (shape, near, file, tag) around marked values, and as many drawn anywhere, with quiet edges.

    Windows that touch a value of a hidden kind, or of a hidden name, are left out; hidden
    names are plain words here. A text shorter than a window is padded at both ends.
    """
    rng, out = np.random.default_rng(seed), []
    t, points, offsets = tokens(texts, hidden)
    tags, unseen = np.zeros(len(t.start), dtype=np.int8), np.zeros(len(t.start) + 1, dtype=np.int64)
    for i, spans in enumerate(_base(texts, points, offsets)):
        for begin, kind, end, value in spans:
            a, b = np.searchsorted(t.end, value + offsets[i], side="right"), np.searchsorted(t.start, end + offsets[i])
            if KINDS[kind] in hidden or kind == 0 and texts[i][begin:value].lower().startswith(tuple(hidden)):
                unseen[a:b] = 1
                continue
            tags[a:b] = INSIDE
            tags[a : a + 1] = BEGIN
    unseen = np.concatenate([[0], np.cumsum(unseen[:-1])])
    bounds = np.searchsorted(t.text, np.arange(len(texts) + 1))
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        if hi == lo:
            continue
        if hi - lo < WINDOW:
            if unseen[hi] == unseen[lo]:
                before = (WINDOW - (hi - lo)) // 2
                pad = (before, WINDOW - (hi - lo) - before)
                out.append((np.pad(t.shape[lo:hi], pad, constant_values=SHAPES - 8), np.pad(t.near[:, lo:hi], ((0, 0), pad), constant_values=EDGE),
                            np.pad(t.file[lo:hi], pad, mode="edge"), np.pad(tags[lo:hi], pad)))
            continue
        marked = lo + np.flatnonzero(tags[lo:hi] == BEGIN)[: DOC_WINDOWS // 2]
        firsts = np.concatenate([marked - rng.integers(4, WINDOW // 2, len(marked)), rng.integers(lo, hi - WINDOW + 1, DOC_WINDOWS - len(marked))])
        for a in np.clip(firsts, lo, hi - WINDOW):
            if unseen[a + WINDOW] == unseen[a]:
                own = slice(a, a + WINDOW)
                out.append((t.shape[own], t.near[:, own], t.file[own], tags[own]))
    return out


#: writings of a named value, lengths and alphabets of values, that marked values are varied by in training
LENGTHS_DRAWN = (16, 49)
WRITINGS = ('%s = "%s"', "%s %s", "%s: %s", "%s=%s", "%s:\n%s", "%s = '%s'")
ALPHABETS = ("0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")


def _varied(texts: list[str], seed: int, hidden: Sequence[str]) -> list[tuple[np.ndarray, ...]]:
    """More windows from the named values of a run of texts: each in all writings
    with other values, and once without its value, so that neither the quotes
    nor the name alone make a secret."""
    rng, made, values = np.random.default_rng(seed), [], []
    whole, points, offsets = tokens(texts, hidden)
    for number, (text, spans) in enumerate(zip(texts, _base(texts, points, offsets))):
        # the variants are read as in their document
        file = whole.file[np.searchsorted(whole.text, number)] if spans else 0
        named = [s for s in spans if s[1] == 0 and "assign" not in hidden and not text[s[0] : s[3]].lower().startswith(tuple(hidden))]
        for begin, _, end, value in named[: DOC_WINDOWS // 2]:
            name = re.match("[A-Za-z_]+", text[begin:])[0]
            before, after = text[max(0, begin - 150) : begin], text[end : end + 100].lstrip("\"'")
            for writing, letters in itertools.product(WRITINGS, ALPHABETS):
                drawn = "".join(rng.choice(list(letters), rng.integers(*LENGTHS_DRAWN)))
                written = writing % (name, drawn)
                at = len(before) + written.index(drawn, len(name))
                made.append(f"{before}{written}{after}")
                values.append((at, at + len(drawn), file))
            for plain in ("", " of", ": the"):
                made.append(f"{before}{name}{plain}{after}")
                values.append((0, 0, file))
    out = []
    t, _, offsets = tokens(made, hidden)
    bounds = np.searchsorted(t.text, np.arange(len(made) + 1))
    for i, (a, b, file) in enumerate(values):
        own = np.arange(bounds[i], bounds[i + 1])
        inside = (t.start[own] < b + offsets[i]) & (t.end[own] > a + offsets[i])
        tags = np.where(inside, INSIDE, OUT)
        tags[np.flatnonzero(inside)[:1]] = BEGIN
        middle = int(np.flatnonzero(inside)[0]) if inside.any() else len(own) // 2
        low = max(0, min(middle - WINDOW // 2, len(own) - WINDOW))
        own, tags = own[low : low + WINDOW], tags[low : low + WINDOW]
        if len(own):
            pad = (0, WINDOW - len(own))
            out.append((np.pad(t.shape[own], pad, constant_values=SHAPES - 8), np.pad(t.near[:, own], ((0, 0), pad), constant_values=EDGE), np.full(WINDOW, file), np.pad(tags, pad)))
    return out


def fit_field(shape: np.ndarray, near: np.ndarray, file: np.ndarray, tags: np.ndarray, steps: int = STEPS, ridge: float = 1e-4) -> Field:
    """Maximise the conditional likelihood by forward and backward sums over all windows and Adam steps."""
    field = Field.empty()
    if not (tags != OUT).any():
        return field
    chains, length = tags.shape
    features = np.zeros((FEATURES, 3))
    learnt = [features, field.near, field.file, field.step]
    hot = np.eye(3)[tags]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in learnt]
    for step in range(1, steps + 1):
        field.shape = SHAPE_HAS @ features
        scores = field.shape[shape] + field.file[file] + sum(field.near[r][near[:, r]] for r in range(len(NEAR)))
        move, top = np.exp(field.step), scores.max(axis=2, keepdims=True)
        local = np.exp(scores - top)
        ahead, behind = np.zeros((chains, length, 3)), np.zeros((chains, length, 3))
        now = local[:, 0] * move[OUT]
        ahead[:, 0] = now / now.sum(axis=1, keepdims=True)
        for i in range(1, length):
            now = (ahead[:, i - 1] @ move) * local[:, i]
            ahead[:, i] = now / now.sum(axis=1, keepdims=True)
        behind[:, -1] = move[:, OUT]
        for i in range(length - 2, -1, -1):
            now = (behind[:, i + 1] * local[:, i + 1]) @ move.T
            behind[:, i] = now / now.sum(axis=1, keepdims=True)
        share = ahead * behind
        share /= share.sum(axis=2, keepdims=True)
        pair = ahead[:, :-1, :, None] * move * (local * behind)[:, 1:, None, :]
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        gap = share - hot
        grads = [np.zeros_like(p) for p in learnt]
        for tag in range(3):
            weights = gap[:, :, tag].ravel()
            grads[0][:, tag] = SHAPE_HAS.T @ np.bincount(shape.ravel(), weights, SHAPES)
            grads[2][:, tag] = np.bincount(file.ravel(), weights, FILES)
            for r in range(len(NEAR)):
                grads[1][r, :, tag] = np.bincount(near[:, r].ravel(), weights, 8)
        grads[3] = pair.sum(axis=(0, 1)) - np.einsum("cia,cib->ab", hot[:, :-1], hot[:, 1:])
        grads[3][OUT] += (share[:, 0] - hot[:, 0]).sum(axis=0)
        grads[3][:, OUT] += (share[:, -1] - hot[:, -1]).sum(axis=0)
        for p, g, (m, v) in zip(learnt, grads, moments):
            g = g / chains + ridge * p
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    field.shape = SHAPE_HAS @ features
    return field


def train(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", docs: int = TRAIN_DOCS, hidden: Sequence[str] = ()) -> Field:
    """Fit the field on a hashed sample of about `docs` documents, twice as many at most.

    Of a document `DOC_WINDOWS` windows are learnt from, half of them at most around marked
    values. `hidden` names kinds of base values or names of the assign pattern to be
    left out, so that a test can see whether the field finds them by itself. Null and empty texts
    teach nothing; from an empty table comes a field that tags nothing. Repeated rows
    come into the sample together.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.xxhash64(F.col(id_col), text).alias("h"), text.alias("text"))
    n = max(1, df.count())
    sample = rows.where(F.pmod("h", F.lit(1 << 30)) < F.lit(int(min(1.0, docs / n) * (1 << 30)))).limit(2 * docs)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run in text_batches(batch, "text", RUN_CHARS):
                cells = [b"".join(np.ascontiguousarray(x, dtype=np.int16).tobytes() for x in w) for w in [*_windows(run, first, hidden), *_varied(run, first, hidden)]]
                yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary())], names=["window"])

    cells = sorted(bytes(r[0]) for r in sample.select("text").mapInArrow(trimmed(work), "window binary").collect())
    if not cells:
        return Field.empty()
    all_codes = np.frombuffer(b"".join(cells), dtype=np.int16).reshape(len(cells), len(NEAR) + 3, WINDOW).astype(np.int64)
    return fit_field(all_codes[:, 0], all_codes[:, 1 : 1 + len(NEAR)], all_codes[:, -2], all_codes[:, -1])


# ---- Spark operators


def scan(df: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of every text: (id, spans array of (kind, start, end)), code points, end exclusive, sorted by start and kind.

    Null text counts as empty and has no spans. Repeated rows give repeated rows;
    further columns are ignored; an empty table gives an empty table. A very long text costs
    memory for some numbers of each of its characters.
    """
    kind_of_id = df.schema[id_col].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, run in text_batches(batch, "text", RUN_CHARS):
                cells = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans] for spans in find_spans(run, field)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(run)), pa.array(cells, pa.list_(span))], names=["id", "spans"])

    out = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        trimmed(work), f"id {kind_of_id}, spans array<struct<kind:string,start:int,end:int>>")
    return out.withColumnRenamed("id", id_col)


def digests(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of what `scan` returned."""

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in KINDS[:3]]
    base = F.filter("spans", lambda s: s["kind"] != "crf")
    return scanned.select(F.col(id_col), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(df: DataFrame, field: Field, text_col: str = "text", chars_col: str = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of the text replaced by `mask` and the character count set anew.

    A null text stays null, an empty one empty; repeated rows, further columns and an empty table
    pass through; a table without `chars_col` has only its texts changed.
    """
    names = df.columns

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            for first, run in text_batches(batch, text_col, RUN_CHARS):
                part = batch.slice(first, len(run))
                clean = []
                for text, spans in zip(run, find_spans(run, field)):
                    out, past = [], 0
                    for a, _, b in spans:
                        if a >= past:
                            out += [text[past:a], mask]
                        past = max(past, b)
                    clean.append("".join([*out, text[past:]]) if spans else text)
                cells = pa.array([c if o.is_valid else None for c, o in zip(clean, part.column(at))], part.column(at).type)
                columns = [cells if i == at else c for i, c in enumerate(part.columns)]
                if chars_col in names:
                    k = names.index(chars_col)
                    columns[k] = pa.array([len(c) if n.is_valid and o.is_valid else n.as_py() for c, n, o in zip(clean, part.column(k), part.column(at))], part.column(k).type)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(trimmed(work), df.schema)


def plain_digest(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans if k < 3).encode()).hexdigest()
