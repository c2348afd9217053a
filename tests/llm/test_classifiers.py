import math
import re
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from vittles.llm import labelled, rule_quality, toxicity_nb
from vittles.llm import queries as q

D = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name,label,folds,held,least", [("op5_toxicity_nb", "toxic", 5, 0, 0.95), ("op8_rule_quality", "quality", 3, 1, 0.93)])
def test_held_out_accuracy(spark, name, label, folds, held, least):
    got = q.QUERIES[name](spark, D).toPandas()
    labels = spark.read.parquet(f"{D}/labels.parquet").toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and ((got.score >= 0.5) == (got.predicted == 1)).all()
    assert list(got.held_out) == [zlib.crc32(str(i).encode()) % folds == held for i in got.doc_id]
    held_rows = got[got.held_out].merge(labels, on="doc_id")
    assert (held_rows.predicted == held_rows[label]).mean() >= least


def test_edge_rows_and_missing_labels(spark):
    rows = [(1, "you idiot", 1), (1, "you idiot", 2), (2, None, 3), (3, "", 4), (None, "x y" * 40000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int").withColumn("label", F.lit("clash"))
    none = spark.createDataFrame([(None, 1, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity_nb.score(df, toxicity_nb.train(df, none)).collect()} == {0.0}
    assert {r.score for r in rule_quality.score(df, rule_quality.train(df, none)).collect()} == {0.5}
    trained = toxicity_nb.train(spark.read.parquet(f"{D}/documents.parquet"), spark.read.parquet(f"{D}/labels.parquet"))
    got = toxicity_nb.score(df, trained).collect()
    assert len(got) == 5 and len({r.score for r in got if r.doc_id in (2, 3)}) == 1
    assert toxicity_nb.keep_clean(df, trained).columns == df.columns and toxicity_nb.score(df.limit(0), trained).count() == 0
    rules = rule_quality.Rules([((("stat__capitals", None, 0.5), ("stat__chars", -1.0, None)), 2.0)], -1.0)
    assert {r.score for r in rule_quality.score(df, rules).collect()} == {1 / (1 + math.exp(-1))}
    assert rule_quality.keep_good(df, rules).columns == df.columns and rule_quality.keep_good(df, rules).count() == 5


def test_folds_are_never_learnt_from(spark):
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("toxic"))
    seen = {int(r.text) for r in labelled.sample(docs, labels, "toxic", 5, 0).collect()}
    assert seen == {i for i in range(300) if zlib.crc32(str(i).encode()) % 5}
    assert labelled.sample(docs, labels, "toxic", 5, 0, most=50).count() <= 100


def test_presence_equals_plain_grams():
    texts = ["", "ab", "Idiot idiot", "déjà"]
    every = np.arange(1 << toxicity_nb.HASH_BITS)
    text, feature = toxicity_nb.present(texts, every, 1 << toxicity_nb.HASH_BITS)
    for i, t in enumerate(texts):
        alone = toxicity_nb.present([t], every, 1 << toxicity_nb.HASH_BITS)[1] if t else []
        plain = {t.lower()[a : a + n] for n in toxicity_nb.ORDERS for a in range(len(t) - n + 1)}
        assert set(feature[text == i]) == set(alone) and len(plain) == (text == i).sum()


def test_tree_paths_merge_bounds():
    debug = "  Tree 0 (weight 1.0):\n    If (feature 0 <= 2.0)\n     If (feature 0 <= 1.0)\n      Predict: 0.0\n     Else (feature 0 > 1.0)\n      Predict: 1.0\n    Else (feature 0 > 2.0)\n     Predict: 1.0\n"
    assert rule_quality.tree_paths(debug, ["a"]) == [(("a", None, 2.0),), (("a", None, 1.0),), (("a", 1.0, 2.0),), (("a", 2.0, None),)]


def test_toxicity_model_equals_plain_dictionaries(spark):
    rng = np.random.default_rng(2)
    words, bad = ["plain", "words", "river", "green", "idea", "table"], ["idiot", "stupid fool", "hate you"]
    rows = [(i, " ".join(rng.choice(words, 8)) + (" " + str(rng.choice(bad)) if i % 3 == 0 else "") + (" tail" if i % 7 == 0 else ""), int(i % 3 == 0)) for i in range(260)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity_nb.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))

    def hashed(gram):
        return next(int(h[0]) for n, h, _ in toxicity_nb.grams([gram]) if n == len(gram))

    seen = [(t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5]
    cache, held = {}, []
    for t, _ in seen:
        held.append({cache.setdefault(g, hashed(g)) for n in toxicity_nb.ORDERS for a in range(len(t) - n + 1) for g in [t.lower()[a : a + n]]})
    total = [sum(1 for _, y in seen if y == c) for c in (0, 1)]
    counts = {}
    for grams, (_, y) in zip(held, seen):
        for g in grams:
            counts.setdefault(g, [0, 0])[y] += 1
    ratio = {g: math.log((p + 1) / (total[1] + 2)) - math.log((n + 1) / (total[0] + 2)) for g, (n, p) in counts.items() if n + p >= toxicity_nb.LEAST}
    sure = {g: abs(r) / math.sqrt(1 / (counts[g][1] + 1) + 1 / (counts[g][0] + 1)) for g, r in ratio.items()}
    chosen = sorted(ratio, key=lambda g: (-sure[g], g))[: toxicity_nb.FEATURES]
    assert sorted(chosen) == sorted(model.ids.tolist())
    x = np.array([[ratio[g] if g in grams else 0.0 for g in chosen] for grams in held])
    y = np.array([y for _, y in seen], dtype=float)
    w = np.zeros(len(chosen) + 1)
    w[-1] = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, toxicity_nb.STEPS + 1):
        gap = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30))) - y
        grad = np.append(x.T @ gap / len(y) + toxicity_nb.RIDGE * w[:-1], gap.mean())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        w -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    mine = dict(zip(chosen, w[:-1] * [ratio[g] for g in chosen]))
    assert np.allclose([mine[i] for i in model.ids.tolist()], model.weights, atol=1e-6) and abs(model.bias - w[-1]) < 1e-6
    for t in ("", "you stupid fool", "green river"):
        z = sum(mine.get(h, 0.0) for h in {hashed(t[a : a + n]) for n in toxicity_nb.ORDERS for a in range(len(t) - n + 1)}) + w[-1]
        assert abs(toxicity_nb.scores([t], model, toxicity_nb.slots(model.ids))[0] - 1 / (1 + math.exp(-z))) < 1e-6


def plain_statistics(text):
    words, lines, n = re.findall(r"[^ \t\n\x0b\f\r]+", text), text.split("\n"), max(1, len(text))
    w, rows = max(1, len(words)), max(1, len(lines))
    return {
        "chars": math.log2(len(text) + 1.0), "word_length": len(text) / w, "line_words": math.log2(len(words) / rows + 1.0),
        "capitals": len(regex.findall(r"\p{Lu}", text)) / n, "digits": len(re.findall("[0-9]", text)) / n,
        "symbols": len(regex.findall(r"[^\p{L}\p{N} \t\n\x0b\f\r]", text)) / n, "symbols_a_word": len(regex.findall(r"[^\p{L}\p{N} \t\n\x0b\f\r.,]", text)) / w,
        "distinct_words": len(set(words)) / w, "distinct_lines": len(set(lines)) / rows, "short_words": sum(len(x) <= 3 for x in words) / w}


def test_rules_equal_plain_python_on_whole_table(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    rules = rule_quality.train(docs, spark.read.parquet(f"{D}/labels.parquet"))
    assert rules.rules
    for r in rule_quality.score(docs, rules).select("text", "score").collect():
        known, z = plain_statistics(r.text or ""), rules.bias
        for bounds, weight in rules.rules:
            z += weight * all((lo is None or known[n[len(rule_quality.PREFIX) :]] > lo) and (hi is None or known[n[len(rule_quality.PREFIX) :]] <= hi) for n, lo, hi in bounds)
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9
    assert rule_quality.score(docs.limit(0), rules).count() == 0
