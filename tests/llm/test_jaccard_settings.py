"""The Jaccard join at other shingle lengths and thresholds than op6's own."""

import numpy as np
import pytest

from tests.llm.test_jaccard_join import made
from vittles.llm import jaccard_join as jj


def plain_set(text, words):
    w = (text or "").lower().split()
    return frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])


def brute(rows, words, percent):
    """Components by all pairs of rows; rows of one id are one document."""
    sets, boss = [(i, plain_set(t, words)) for i, t in rows], {i: i for i, _ in rows}

    def find(i):
        while boss[i] != i:
            i = boss[i]
        return i

    for k, (i, s) in enumerate(sets):
        for j, o in sets[k + 1 :]:
            if s and o and 100 * len(s & o) >= percent * len(s | o):
                a, b = sorted((find(i), find(j)))
                boss[b] = a
    return sorted((i, len(s), find(i)) for i, s in sets)


def test_five_words_at_80_percent_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(jj, "COMMON", 20)
    rows, long = made(6, 160), " ".join(f"u{i}" for i in range(200))
    rows += [(900, long), (901, f"{long} " + " ".join(f"v{i}" for i in range(38)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, want = sorted(tuple(r) for r in jj.near_duplicates(df, words=5, percent=80).collect()), brute(rows, 5, 80)
    assert got == want and got[-1] == (901, 234, 900) and want != brute(rows, 4, 85)
    assert sorted(r.doc_id for r in jj.keep_one(df, words=5, percent=80).collect()) == [i for i, _, c in want if i == c]


@pytest.mark.parametrize("light", [0, 7, 16])
def test_keys_meet_for_all_links_at_80_percent(light):
    rng, none = np.random.default_rng(light), np.zeros(0, dtype=np.uint64)
    for _ in range(1000):
        a = rng.choice(np.arange(1, 60, dtype=np.uint64), int(rng.integers(1, 24)), replace=False)
        b = np.sort(np.concatenate([a[rng.integers(0, 4) :], rng.choice(np.arange(70, 90, dtype=np.uint64), rng.integers(0, 4), replace=False)]))
        a = np.sort(a)
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        x, y = jj._keys(a, light, none, none, 80), jj._keys(b, light, none, none, 80)
        assert set(x[0].tolist()) & set(y[0].tolist()) or set(x[1].tolist()) & set(y[1].tolist())


def test_rows_that_share_an_id_but_not_a_text(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    # 5 is tied to 2 by b; a and c have no other copy; 9 has a text like c; 11 and 12 are tied by a row without words
    rows = [(5, a), (5, b), (2, b), (7, c), (9, f"{c} more"), (9, f"{a} d e f g h i j k l m"), (11, ""), (11, "one two"), (10, "one two"), (12, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in jj.near_duplicates(df).collect())
    assert got == brute(rows, 4, 85) and (5, 27, 2) in got and (11, 0, 10) in got
    kept = sorted((tuple(r) for r in jj.keep_one(df).collect()), key=repr)
    assert kept == sorted([(5, a), (2, b), (7, c), rows[5], (11, ""), (10, "one two"), (12, None)], key=repr)
