"""Quality by a sparse rule ensemble.

Statistics of a text are Spark column expressions. A random forest of shallow trees is
fitted on the labelled sample, every path from a root becomes a rule, a conjunction of
bounds on statistics, and a lasso logistic regression over the rules keeps few of
them. The rules and weights are compiled into one Spark column expression.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vittles.llm import labelled
from vittles.llm.common import checkpointed

FOLDS, HELD = 3, 1
TREES, DEPTH, LASSO, ITERATIONS, SEED = 12, 3, 0.003, 40, 7
PREFIX = "stat__"

#: (statistic, low, high): low < statistic <= high, either bound may be absent
Bound = tuple[str, float | None, float | None]


@dataclass
class Rules:
    """Weighted conjunctions and the bias; `prior` alone counts if there was nothing to learn from."""

    rules: list[tuple[tuple[Bound, ...], float]] = field(default_factory=list)
    bias: float = 0.0
    prior: float | None = None


def with_statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Add the statistics of a text as columns that begin with `PREFIX`. Null text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def without(pattern: str) -> Column:
        return F.length(F.regexp_replace("w__text", pattern, ""))

    base = df.withColumn("w__text", text).withColumn("w__words", F.filter(F.split("w__text", r"\s+"), lambda w: w != "")).withColumn("w__lines", F.split("w__text", "\n"))
    words, lines, chars = F.greatest(F.size("w__words"), F.lit(1)), F.greatest(F.size("w__lines"), F.lit(1)), F.greatest(F.length("w__text"), F.lit(1))
    stats = {
        "chars": F.log2(F.length("w__text") + F.lit(1.0)),
        "word_length": F.length("w__text") / words,
        "line_words": F.log2(F.size("w__words") / lines + F.lit(1.0)),
        "capitals": without(r"[^\p{Lu}]+") / chars,
        "digits": without(r"[^0-9]+") / chars,
        "symbols": without(r"[\p{L}\p{N}\s]+") / chars,
        "symbols_a_word": without(r"[\p{L}\p{N}\s.,]+") / words,
        "distinct_words": F.size(F.array_distinct("w__words")) / words,
        "distinct_lines": F.size(F.array_distinct("w__lines")) / lines,
        "short_words": F.size(F.filter("w__words", lambda w: F.length(w) <= 3)) / words,
    }
    # an empty text gives no words, so the ratios are 0
    return base.select(*[F.col(f"`{c}`") for c in df.columns], *[c.cast("double").alias(PREFIX + k) for k, c in stats.items()])


def condition(rule: tuple[Bound, ...]) -> Column:
    parts = []
    for name, low, high in rule:
        parts += [F.col(name) > F.lit(low)] * (low is not None) + [F.col(name) <= F.lit(high)] * (high is not None)
    return reduce(lambda a, b: a & b, parts)


def compile_rules(rules: Rules) -> Column:
    """The score, 0 to 1, over the statistics."""
    if rules.prior is not None:
        return F.lit(float(rules.prior))
    total = reduce(lambda z, r: z + F.when(condition(r[0]), F.lit(r[1])).otherwise(F.lit(0.0)), rules.rules, F.lit(rules.bias))
    return 1 / (1 + F.exp(-total))


def tree_paths(debug: str, names: list[str]) -> list[tuple[Bound, ...]]:
    """The conjunctions of all paths from the roots to nodes in a printed forest, bounds of a statistic merged."""
    found, path = {}, []
    for line in debug.splitlines():
        if line.strip().startswith("Tree "):
            path = []
        if not (m := re.match(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)):
            continue
        depth = len(m[1])
        path = [p for p in path if p[0] < depth] + [(depth, names[int(m[3])], m[4], float(m[5]))]
        bounds: dict[str, list[float | None]] = {}
        for _, name, sign, value in path:
            low, high = bounds.setdefault(name, [None, None])
            if sign == ">":
                bounds[name][0] = value if low is None else max(low, value)
            else:
                bounds[name][1] = value if high is None else min(high, value)
        found[tuple(sorted((n, lo, hi) for n, (lo, hi) in bounds.items()))] = None
    return list(found)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, held: int = HELD,
          most: int = labelled.SAMPLE, id_col: str = "doc_id", text_col: str = "text") -> Rules:
    """Fit on a bounded sample of labelled rows outside fold `held`.

    Without labels of both classes every score is the share of label 1, or 0.5 if there are none.
    """
    sample = labelled.sample(docs, labels, label, folds, held, most, id_col, text_col)
    known = with_statistics(sample)
    names = [c for c in known.columns if c.startswith(PREFIX)]
    # statistics and label only: a bounded table, dealt out evenly
    known = checkpointed(known.select("label", *names).repartition(2 * docs.sparkSession.sparkContext.defaultParallelism))
    classes = {r[0] for r in known.select("label").distinct().collect()}
    if len(classes) < 2:
        return Rules(prior=classes.pop() if classes else 0.5)
    seen = VectorAssembler(inputCols=names, outputCol="x").transform(known)
    forest = RandomForestClassifier(labelCol="label", featuresCol="x", numTrees=TREES, maxDepth=DEPTH, maxBins=64, featureSubsetStrategy="sqrt", seed=SEED).fit(seen)
    paths = tree_paths(forest.toDebugString, names)
    if not paths:
        return Rules(prior=known.agg(F.avg("label")).first()[0])
    held_rules = known.select("label", *[condition(p).cast("double").alias(f"r{i}") for i, p in enumerate(paths)])
    rows = VectorAssembler(inputCols=[f"r{i}" for i in range(len(paths))], outputCol="x").transform(held_rules).select("label", "x")
    lasso = LogisticRegression(labelCol="label", featuresCol="x", elasticNetParam=1.0, regParam=LASSO, maxIter=ITERATIONS, standardization=False).fit(rows)
    return Rules([(p, float(w)) for p, w in zip(paths, lasso.coefficients) if w], float(lasso.intercept))


def score(df: DataFrame, rules: Rules, text_col: str = "text", out: str = "score") -> DataFrame:
    """The rows with their score; an empty or null text is scored by its statistics, all 0.

    Repeated rows are scored alike; a column named like the score is replaced, others stay; an empty table
    gives an empty table. A very long text costs memory for its words and lines.
    """
    rated = with_statistics(df, text_col)
    return rated.select(*[F.col(f"`{c}`") for c in df.columns if c != out], compile_rules(rules).alias(out))


def keep_good(df: DataFrame, rules: Rules, text_col: str = "text", limit: float = 0.5) -> DataFrame:
    """The rows, whole, whose score is `limit` or more; nulls, repeats and an empty table as in `score`."""
    return with_statistics(df, text_col).where(compile_rules(rules) >= F.lit(limit)).select(*[F.col(f"`{c}`") for c in df.columns])
