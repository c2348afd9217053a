import hashlib
import itertools
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from vittles.llm import secret_crf as crf


def plain_base(text):
    """The contract's patterns by finditer alone."""
    assign = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


PARTS = ["password", "PassWd", "token", "api_key", "ApiKey", "secret", "=", ": ", '"', "'", " ", "\n", "abcdef0123456789", "AKIA", "ABCD1234EFGH5678", "x", "ſ", "é", "0123456789abcdef" * 3, "A-b_c.d+e/f="]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), max_size=5))
def test_base_spans_equal_plain_scan(texts):
    got = crf.find_spans(texts, crf.Field.empty())
    assert [[s for s in x if s[1] < 3] for x in got] == [plain_base(t) for t in texts]
    assert all(k < 3 for x in got for _, k, _ in x)


def test_viterbi_and_anchored_decoding_equal_brute_force():
    rng = np.random.default_rng(5)
    for _ in range(60):
        field = crf.Field(rng.normal(size=(crf.SHAPES, 3)) * 3, rng.normal(size=(4, 8, 3)), rng.normal(size=(crf.FILES, 3)), rng.normal(size=(3, 3)))
        t, *_ = crf.tokens(["a token = b4 : zz"])
        scores = crf._emissions(field, t)

        def total(path):
            ends = (0, *path, 0)
            return sum(scores[i, s] for i, s in enumerate(path)) + sum(field.step[a, b] for a, b in zip(ends, ends[1:]))

        best = max(itertools.product(range(3), repeat=len(t.start)), key=total)
        assert tuple(crf.decode(field, t)) == best


def test_gradient_fits_marked_windows(spark):
    words = ["lorem", "ipsum", "the", "key", "for", "value", "12", "Nothing"]
    rng = np.random.default_rng(1)
    texts = []
    for i in range(400):
        own = [str(w) for w in rng.choice(words, 40)]
        if i % 3 == 0:
            own[20] = 'token = "%s"' % "".join(rng.choice(list("0123456789abcdef"), 40))
        texts.append(" ".join(own))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    field = crf.train(df)
    plain, held = "just the lorem ipsum value " * 8, 'the pwd : "%s" for nothing else here' % "f3ef4d6b2755Q36d7d9c25bd72Z4d5f67e061fda"
    spans = crf.find_spans([plain, held], field)
    assert spans[0] == [] and [k for _, k, _ in spans[1]] == [3] and held[spans[1][0][0] : spans[1][0][2]].startswith("f3ef")


def test_queries_handle_nulls_and_empty(spark):
    secret = 'my token = "f3ef4d6b2755a36d7d9c25bd72c4d5f67e061fda" end'
    rows = [(1, secret, 5), (1, secret, 5), (2, None, 6), (3, "", None), (None, "x" * 50000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    got = sorted((tuple(r) for r in crf.digests(crf.scan(df, crf.Field.empty())).collect()), key=repr)
    want = sorted(((i, len([s for s in b if s[1] == 0]), 0, len([s for s in b if s[1] == 2]), crf.plain_digest(b), ",".join(f"{crf.KINDS[k]}:{a}:{e}" for a, k, e in b))
                   for i, t, _ in rows for b in [plain_base(t or "")]), key=repr)
    assert got == want and any(r[4] == hashlib.sha256(b"").hexdigest() for r in got)
    clean = crf.redact(df, crf.Field.empty()).collect()
    assert {(r.text, r.n_chars) for r in clean if r.doc_id == 1} == {('my [SECRET]" end', 16)} and {r.text for r in clean if r.doc_id == 2} == {None}
    assert crf.scan(df.limit(0), crf.train(df.limit(0))).count() == 0


def planted(rng, i):
    """A value with a name that the base patterns lack, in several writings."""
    value = "".join(rng.choice(list("ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789"), 32))
    form = ['pwd = "%s"', "Authorization: Bearer %s", 'credentials: "%s"', 'passphrase:\n  "%s"', "auth =\n%s"][i % 5]
    return form % value, value


def test_field_finds_what_the_patterns_lack(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    field = crf.train(docs)
    plain = [r.text for r in docs.where("text IS NOT NULL AND length(text) BETWEEN 300 AND 3000").orderBy("doc_id").limit(600).collect()]
    plain = [t for t in plain if not plain_base(t)]
    rng, hit, texts, values = np.random.default_rng(3), 0, [], []
    for i, text in enumerate(plain):
        written, value = planted(rng, i)
        words = text.split(" ")
        at = int(rng.integers(len(words)))
        texts.append(" ".join([*words[:at], written, *words[at:]]))
        values.append(value)
    for text, value, spans in zip(texts, values, crf.find_spans(texts, field)):
        at = text.index(value)
        hit += any(a < at + len(value) and at < b for a, k, b in spans if k == 3)
    wrong = sum(bool([s for s in x if s[1] == 3]) for x in crf.find_spans(plain, field))
    print(f"planted: {hit} of {len(plain)} found; spans in {wrong} of {len(plain)} plain texts")
    assert hit >= 0.9 * len(plain) and wrong == 0


def test_hidden_names_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    plain = [r.text for r in docs.where("text IS NOT NULL AND length(text) BETWEEN 300 AND 3000").orderBy("doc_id").limit(900).collect()]
    plain = [t for t in plain if not plain_base(t)]
    rng, names, rows = np.random.default_rng(5), ["password", "secret", "token", "api_key"], []
    for i, text in enumerate(plain):
        value = "".join(rng.choice(list("0123456789ABCDEFGHJKMNPQRSTVWXYZabcdefghjkmnpqrstvwxyz"), int(rng.integers(24, 44))))
        words = text.split(" ")
        at = int(rng.integers(len(words)))
        rows.append((i, " ".join([*words[:at], ['%s = "%s"', "%s: %s"][i % 2] % (names[i % 4], value), *words[at:]]), value))
    df = spark.createDataFrame(rows, "doc_id long, text string, value string")
    for k, name in enumerate(names):
        field = crf.train(df, hidden=[name])
        asked = [r for r in rows if r[0] % 4 == k]
        t, _, offsets = crf.tokens([r[1] for r in asked])
        spans = crf.decoded_spans(t, offsets, field)
        places = [(r[1].index(r[2]), r[1].index(r[2]) + len(r[2])) for r in asked]
        right = [i for i, a, b in spans if a < places[i][1] and places[i][0] < b]
        print(f"{name} hidden: {len(set(right))} of {len(asked)} found, {len(right)} of {len(spans)} spans are right")
        assert len(set(right)) >= 0.9 * len(asked) and len(right) >= 0.9 * len(spans)
