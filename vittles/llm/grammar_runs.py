"""Periodic runs of words, found in a grammar of the texts.

A run is a stretch of words with smallest period q, of at least `LEAST` words and
`TIMES` periods, that no neighbouring word extends.

1. The word ids of a block of whole documents are compressed by Re-Pair. A round counts
   all neighbouring pairs and replaces each that is more frequent than the pairs it
   overlaps, until no pair comes twice; so many rules are made in one round. What is
   left of a document is the root's right side, parsed as a balanced tree.
2. For each rule X -> Y Z long enough, and each inner node of a root's tree, the runs in
   its expansion that cross the boundary of Y and Z are computed once, whatever the
   number of places where X is derived.
3. These runs are moved to all places where their nonterminal is derived.
4. Intervals with the same period that overlap in a period are one run. The whole of a
   run crosses the boundary of the least node that holds it, so the unions are maximal;
   of equal intervals the smallest period stays.

Crossing runs: one side of the boundary holds half of the run, so `GRAM` words at the
boundary come again a period away on that side. The places where they do are found in a
sorted list of the block's grams; how far the two copies agree both ways is a binary
search with prefix hashes. Runs are compared word by word in the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vittles.llm.common import mix64

#: words and periods that a run has at least
LEAST, TIMES = 24, 3
#: with 4 words a period q and a gram fit in max(12, 1.5 q) words, half of the least run
GRAM = 4
#: bytes of texts that share a grammar; candidates examined at once
BLOCK_BYTES, AT_ONCE = 6_000_000, 1 << 20
#: moduli of the prefix hashes
PRIMES = (2**31 - 1, 2**31 - 19)


@dataclass
class Grammar:
    """Rules by number (from `first` on; smaller symbols are words) and the symbols that are left."""

    first: int
    left: np.ndarray
    right: np.ndarray
    size: np.ndarray      # words in the expansion
    place: np.ndarray     # one place in the block where it is derived
    rounds: list[int]     # first rule of each round, and the number of rules
    symbols: np.ndarray   # of all documents, in order
    starts: np.ndarray    # their places in the block
    roots: np.ndarray     # where the symbols of each document begin; one more at the end


def _grouped(hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, group of each place in that order) of equal hashes; groups keep the order of places."""
    bits = max(1, (len(hashed) - 1).bit_length())
    keys = (hashed >> np.uint64(bits) << np.uint64(bits)) | np.arange(len(hashed), dtype=np.uint64)
    keys.sort()
    order = (keys & np.uint64((1 << bits) - 1)).astype(np.int64)
    change = np.diff(keys >> np.uint64(bits)) != 0
    return order, np.concatenate([[0], np.cumsum(change)])


def re_pair(words: np.ndarray, bounds: np.ndarray, n_words: int) -> Grammar:
    """The grammar of `words`, ids below `n_words`; document i is words[bounds[i]:bounds[i + 1]]."""
    symbols, starts = words.astype(np.int64), np.arange(len(words))
    head = np.zeros(len(words) + 1, dtype=bool)
    head[bounds] = True
    head, live = head[:-1], np.ones(len(words), dtype=bool)
    size = [np.ones(n_words, dtype=np.int64)]
    left, right, place, rounds, known = [], [], [], [0], n_words
    while len(symbols) > 1:
        at = np.flatnonzero(live[:-1] & ~head[1:])
        if len(at) < 2:
            break
        a, b = symbols[at], symbols[at + 1]
        order, group = _grouped(mix64((a * 0x1F123BB5 + b).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)))
        firsts = np.flatnonzero(np.diff(group, prepend=-1))
        # a pair whose hash is another's waits
        lead = order[firsts][group]
        same = (a[order] == a[lead]) & (b[order] == b[lead])
        often = np.bincount(group, same, len(firsts)).astype(np.int64)
        rank = np.zeros(len(symbols) + 1, dtype=np.int64)
        rank[at[order]] = np.where(same & (often[group] > 1), often[group] << 32 | group, 0)
        # a stretch of one pair, as in a a a a, is taken at every second place
        inside = np.zeros(len(symbols), dtype=bool)
        inside[1:] = (rank[1:-1] == rank[:-2]) & (rank[1:-1] > 0)
        index = np.arange(len(symbols))
        offset = index - np.maximum.accumulate(np.where(inside, 0, index))
        taken = (rank[:-1] > 0) & (rank[:-1] >= rank[1:]) & (offset % 2 == 0)
        taken[1:] &= rank[1:-1] >= rank[:-2]
        chosen = np.flatnonzero(taken)
        of = rank[chosen] & 0xFFFFFFFF
        used = np.bincount(of, minlength=len(firsts))
        chosen, of = chosen[used[of] > 1], of[used[of] > 1]
        if not len(chosen):
            break
        rules, first, rule = np.unique(of, return_index=True, return_inverse=True)
        left.append(symbols[chosen[first]])
        right.append(symbols[chosen[first] + 1])
        place.append(starts[chosen[first]])
        known_sizes = np.concatenate(size) if len(size) > 1 else size[0]
        size = [known_sizes, known_sizes[left[-1]] + known_sizes[right[-1]]]
        rounds.append(rounds[-1] + len(rules))
        symbols[chosen] = known + rule
        known += len(rules)
        # pairs that come once stay single unless a neighbour changes
        fresh = np.zeros(len(symbols) + 1, dtype=bool)
        fresh[chosen] = True
        stay = np.ones(len(symbols), dtype=bool)
        stay[chosen + 1] = False
        waiting = np.zeros(len(symbols), dtype=bool)
        waiting[at[order[~same]]] = True
        alive = ((rank[:-1] > 0) | waiting)[stay]
        fresh = np.append(fresh[:-1][stay], False)
        symbols, starts, head = symbols[stay], starts[stay], head[stay]
        live = alive | fresh[:-1] | fresh[1:]
    empty = [np.zeros(0, dtype=np.int64)]
    return Grammar(
        n_words, np.concatenate(left or empty), np.concatenate(right or empty), np.concatenate(size), np.concatenate(place or empty), rounds,
        symbols, starts, np.searchsorted(starts, bounds))


def nodes(g: Grammar, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(rule or -1, begin, boundary, end) of all rules and of all nodes of the roots' trees that can hold a run; places in the block."""
    rules = np.flatnonzero(g.size[g.first :] >= LEAST)
    begin = g.place[rules]
    out = [(rules, begin, begin + g.size[g.left[rules]], begin + g.size[g.first + rules])]
    starts, width = np.append(g.starts, bounds[-1]), 2
    low, high = g.roots[:-1], g.roots[1:]
    while True:
        many = -(-(high - low - width // 2) // width)
        if not (many > 0).any():
            break
        many = np.maximum(many, 0)
        doc = np.repeat(np.arange(len(low)), many)
        first = low[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * width
        begin, boundary, end = starts[first], starts[first + width // 2], starts[np.minimum(first + width, high[doc])]
        fit = end - begin >= LEAST
        out.append((np.full(fit.sum(), -1), begin[fit], boundary[fit], end[fit]))
        width *= 2
    return tuple(np.concatenate(x) for x in zip(*out))


class Hashes:
    """Prefix hashes of a block, by two moduli: tells how far two places agree."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.sums, self.powers = [], []
        for prime in PRIMES:
            base, salt = (int(x) for x in rng.integers(1 << 20, prime, 2))
            power = np.ones(1, dtype=np.uint64)
            while len(power) <= len(words):
                power = np.concatenate([power, power * np.uint64(pow(base, len(power), prime)) % np.uint64(prime)])
            values = mix64(words.astype(np.uint64) * np.uint64(2 * salt + 1) + np.uint64(salt)) % np.uint64(prime)
            terms = values * power[: len(words)] % np.uint64(prime)
            self.sums.append(np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(terms, dtype=np.uint64)]))
            self.powers.append(power)

    def equal(self, x: np.ndarray, q: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether the n words from x are those from x + q."""
        out = np.ones(len(x), dtype=bool)
        for prime, sums, power in zip(PRIMES, self.sums, self.powers):
            p = np.uint64(prime)
            out &= (sums[x + n] - sums[x]) % p * power[q] % p == (sums[x + q + n] - sums[x + q]) % p
        return out

    def agree(self, x: np.ndarray, q: np.ndarray, most: np.ndarray, back: bool = False) -> np.ndarray:
        """Words, `most` at the most, that agree from x and from x + q on, or before these."""
        low, high = np.zeros(len(x), dtype=np.int64), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            fit = self.equal(x - middle if back else x, q, middle)
            low, high = np.where(fit, middle, low), np.where(fit, high, middle - 1)
        return low


def _spread(counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, number within the row) of all items of rows with so many items, about `AT_ONCE` at a time."""
    ends = np.cumsum(counts)
    cuts = np.unique(np.searchsorted(ends, np.arange(AT_ONCE, int(ends[-1]) + AT_ONCE, AT_ONCE))) + 1 if len(ends) else []
    start = 0
    for cut in cuts:
        part = counts[start:cut]
        row = np.repeat(np.arange(len(part)), part)
        yield row + start, np.arange(len(row)) - (np.cumsum(part) - part)[row]
        start = cut


def crossing(words: np.ndarray, bounds: np.ndarray, found: tuple[np.ndarray, ...], hashes: Callable[[], Hashes]) -> tuple[np.ndarray, ...]:
    """(rule, start, end, period) of the runs inside the nodes that cross their boundaries, with smallest periods."""
    rule, begin, boundary, end = found
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    if not len(rule) or len(words) < LEAST:
        return none
    mixed, n = words.astype(np.uint64), len(words) - GRAM + 1
    hashed = np.zeros(n, dtype=np.uint64)
    for k in range(GRAM):
        hashed = hashed * np.uint64(0xD6E8FEB86659FD93) + mixed[k : k + n] + np.uint64(1)
    bits = np.uint64(max(1, (len(words) - 1).bit_length()))
    hashed = mix64(hashed) >> bits << bits
    grams = np.sort(hashed | np.arange(n, dtype=np.uint64))
    longest = (end - begin) // TIMES
    out = []
    for back in (False, True):
        # the gram after the boundary comes again later, or the one before it came earlier, a period away
        own = boundary - GRAM if back else boundary
        at = np.flatnonzero((own >= begin) & (own + GRAM <= end))
        low, high = (np.maximum(begin, own - longest), own - 1) if back else (own + 1, np.minimum(end - GRAM, own + longest))
        at = at[low[at] <= high[at]]
        key = hashed[own[at]]
        first = np.searchsorted(grams, key | low[at].astype(np.uint64))
        many = np.maximum(np.searchsorted(grams, key | high[at].astype(np.uint64), "right") - first, 0)
        for row, k in _spread(many):
            node = at[row]
            q = np.abs((grams[first[row] + k] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64) - own[node])
            # x and x + q are compared from here on and before; one way at least `need` words agree
            x = boundary[node] - q if back else boundary[node]
            need = np.maximum(LEAST // 2 - q, -(-q // 2))
            probe = np.where(need > 0, x - need if back else x + need - 1, x - 1 if back else x)
            fit = (probe >= begin[node]) & (probe + q < end[node])
            node, q, x, probe = node[fit], q[fit], x[fit], probe[fit]
            fit = words[probe] == words[probe + q]
            node, q, x = node[fit], q[fit], x[fit]
            if not len(node):
                continue
            h = hashes()
            after = h.agree(x, q, end[node] - x - q)
            before = h.agree(x, q, x - begin[node], back=True)
            fit = before + q + after >= np.maximum(LEAST, TIMES * q)
            out.append((node[fit], (x - before)[fit], (x + q + after)[fit], q[fit]))
    if not out:
        return none
    node, start, stop, q = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((q, stop, start, node))
    node, start, stop, q = node[order], start[order], stop[order], q[order]
    new = np.ones(len(node), dtype=bool)
    new[1:] = (np.diff(node) != 0) | (np.diff(start) != 0) | (np.diff(stop) != 0)
    return rule[node[new]], start[new], stop[new], q[new]


def derived(g: Grammar, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rule, place) of every place in the block where one of the wanted rules is derived."""
    target = np.zeros(len(g.left) + g.first, dtype=bool)
    target[g.first + wanted] = True
    leads = target.copy()
    spans = list(zip(g.rounds[:-1], g.rounds[1:]))
    for low, high in spans:
        leads[g.first + low : g.first + high] |= leads[g.left[low:high]] | leads[g.right[low:high]]
    keep = leads[g.symbols]
    symbols, places, out = g.symbols[keep], g.starts[keep], []
    for low, high in reversed(spans):
        mine = symbols >= g.first + low
        now, at = symbols[mine], places[mine]
        hit = target[now]
        out.append((now[hit] - g.first, at[hit]))
        left, right = g.left[now - g.first], g.right[now - g.first]
        below = np.concatenate([left, right]), np.concatenate([at, at + g.size[left]])
        fit = leads[below[0]]
        symbols, places = np.concatenate([symbols[~mine], below[0][fit]]), np.concatenate([places[~mine], below[1][fit]])
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, dtype=np.int64),) * 2


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, ...]:
    """Maximal intervals (doc, start, stop, q): those of one period that overlap in a period are one, of equal ones the least period stays."""
    order = np.lexsort((start, q, doc))
    doc, start, stop, q = doc[order], start[order], stop[order], q[order]
    change = np.ones(len(doc), dtype=bool)
    change[1:] = (np.diff(doc) != 0) | (np.diff(q) != 0)
    reach = np.maximum.accumulate(np.cumsum(change) * (int(stop.max(initial=0)) + 1) + stop) - np.cumsum(change) * (int(stop.max(initial=0)) + 1)
    change[1:] |= start[1:] + q[1:] > reach[:-1]
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(doc)) - 1 if len(first) else first
    doc, start, stop, q = doc[first], start[first], reach[last], q[first]
    order = np.lexsort((q, stop, start, doc))
    doc, start, stop, q = doc[order], start[order], stop[order], q[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (np.diff(doc) != 0) | (np.diff(start) != 0) | (np.diff(stop) != 0)
    order = np.lexsort((q[new], start[new], doc[new]))
    return tuple(x[new][order] for x in (doc, start, stop, q))


def runs_of(words: np.ndarray, bounds: np.ndarray, n_words: int) -> tuple[np.ndarray, ...]:
    """(document, start, stop, period) of all runs in a block, by document, start and period; places in the block."""
    g = re_pair(words, bounds, n_words)
    found = nodes(g, bounds)
    for seed in range(20):
        made: list[Hashes] = []

        def hashes() -> Hashes:
            if not made:
                made.append(Hashes(words, seed))
            return made[0]

        rule, start, stop, q = crossing(words, bounds, found, hashes)
        inner = rule >= 0
        wanted, row = np.unique(rule[inner], return_inverse=True)
        symbol, place = derived(g, wanted)
        # every derivation of a rule takes all runs of the rule
        order = np.argsort(row, kind="stable")
        many = np.bincount(row, minlength=len(wanted))
        begins = np.cumsum(many) - many
        which = np.searchsorted(wanted, symbol)
        parts = [(start[~inner], stop[~inner], q[~inner])]
        for k, number in _spread(many[which]):
            run = np.flatnonzero(inner)[order[begins[which[k]] + number]]
            move = place[k] - g.place[symbol[k]]
            parts.append((start[run] + move, stop[run] + move, q[run]))
        start, stop, q = (np.concatenate(x) for x in zip(*parts))
        out = merged(np.searchsorted(bounds, start, "right") - 1, start, stop, q)
        if all(np.array_equal(words[s : e - p], words[s + p : e]) for _, s, e, p in zip(*out)):
            return out
    raise ArithmeticError("prefix hashes of twenty bases collide")


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(word ids, where each text begins, words by id) of texts cut at space, tab, line feed, vertical tab, form feed and return."""
    parts = pc.ascii_split_whitespace(texts.cast(pa.large_string()))
    flat = parts.flatten()
    full = pc.greater(pc.binary_length(flat), 0)
    offsets = parts.offsets.to_numpy()
    bounds = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])[offsets - offsets[0]]
    coded = flat.filter(full).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), bounds.astype(np.int64), coded.dictionary


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rearrange: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """(id, n_words, runs, collapsed) of every row.

    `runs` holds structs (start, length, period) in words, by start and period;
    `collapsed` is the text less the words that some run contains after its first period,
    joined by one space. `rearrange(id, n)`, if given, returns the numbers of the words
    that a text of n words has in their place, or None for the text as it is; it is
    not called for a null id.

    A null, empty or wordless text has no words and no runs. Repeated rows are rows of
    their own. A very long text is in a block of its own: memory grows with the words of
    the block, work with their number times its logarithm. Further columns are ignored;
    an empty table gives an empty table.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "")
            ends = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64))
            cuts = np.append(np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1, len(ends))
            start = 0
            for cut in cuts:
                yield block(batch.column(0).slice(start, cut - start), texts.slice(start, cut - start))
                start = cut

    def block(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        words, bounds, dictionary = split_words(texts)
        if rearrange is not None:
            for i, key in enumerate(ids.to_pylist()):
                n = bounds[i + 1] - bounds[i]
                moved = rearrange(key, int(n)) if key is not None else None
                if moved is not None:
                    words[bounds[i] : bounds[i + 1]] = words[bounds[i] : bounds[i + 1]][moved]
        doc, start, stop, q = runs_of(words, bounds, len(dictionary))
        change = np.bincount(start + q, minlength=len(words) + 1) - np.bincount(stop, minlength=len(words) + 1)
        kept = np.cumsum(change[:-1]) == 0
        lengths = np.concatenate([[0], np.cumsum(kept)])[bounds]
        lists = pa.LargeListArray.from_arrays(pa.array(lengths, pa.int64()), dictionary.take(pa.array(words[kept])))
        joined = pc.binary_join(lists, pa.scalar(" ", pa.large_string()))
        runs = pa.StructArray.from_arrays([pa.array(start - bounds[doc], pa.int64()), pa.array(stop - start, pa.int64()), pa.array(q, pa.int64())], names=["start", "length", "period"])
        at = np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(np.diff(bounds), pa.int64()), pa.ListArray.from_arrays(pa.array(at), runs), joined.cast(pa.string())], names=[id_col, "n_words", "runs", "collapsed"])

    rows = df.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, f"`{id_col}` long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
