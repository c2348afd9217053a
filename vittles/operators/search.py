"""Search, filters, paging and comparison as batch queries (R3-R6, P16-P20,
P25-P27, W7-W11, W14, F13, F14).

Queries arrive as a request table ``(query_id, q)``.  Matching a request
against item text is an equi-join on character grams, checked afterwards.
Per-query "head(n)" is a salted two-stage top-k, so a query matching a third
of the table is ranked in many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from itertools import islice

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vittles.functions.scalar import format_number, humanise, isclose, tokens
from vittles.operators import gram_index, ranking
from vittles.operators.edit_top import best_by_edit
from vittles.operators.gram_index import GRAM, item_grams
from vittles.operators.gram_index import lower as _lower
from vittles.operators.ranking import global_top_k, top_k_per_group
from vittles.session import cut_lineage

# Friendly nutrient labels, the nutrients shown by the
# compare and detail views (in order) and those where higher is better.
FRIENDLY_NAMES = {
    "energy_kcal": "Calories",
    "protein_g": "Protein",
    "carbs_g": "Carbs",
    "fiber_g": "Fiber",
    "sugar_g": "Sugar",
    "added_sugar_g": "Added Sugar",
    "sodium_mg": "Sodium",
    "sat_fat_g": "Saturated Fat",
}
PREFER_HIGH = {"protein_g", "fiber_g"}


def requests(spark: SparkSession, queries: Sequence[str]) -> DataFrame:
    """A request table (query_id from 1, q)."""
    return spark.createDataFrame([(i + 1, q) for i, q in enumerate(queries)], "query_id long, q string")


# requests without a match that are ranked against all items in one pass
BLOCK = 256


def containing(items: DataFrame, text_cols: Sequence[str], needles: DataFrame, needle: str, key: str = "fdc_id", index: str | None = None) -> DataFrame:
    """Items joined with the needles contained in any of the lower-cased text
    columns.

    Each needle is looked up by one gram, its first ``GRAM`` characters or all
    of a shorter one, among the distinct grams of an item's texts: an equi-join,
    then checked with ``contains``.  Empty needles match nothing.  With ``index``,
    the folder of a stored gram index over these columns, the needles' rarest grams
    are looked up there instead, and only items that hold them are read."""
    cols = [c for c in text_cols if c in items.columns]
    if index:
        near = gram_index.candidates(items.sparkSession, index, needles, needle, key).join(items, key)
        return near.where(coarse_filter(cols, F.col(needle)))
    grams = item_grams(cols)
    probe = needles.where(F.length(needle) > 0).withColumn("_probe", F.substring(needle, 1, GRAM))
    near = items.withColumn("_gram", F.explode(grams)).join(probe, F.col("_gram") == F.col("_probe"))
    return near.where(coarse_filter(cols, F.col(needle))).drop("_gram", "_probe")


def token_search(
    items: DataFrame,
    req: DataFrame,
    *,
    key: str = "fdc_id",
    name: str = "description",
    brand: str = "brand_owner",
    max_rows: int | None = None,
    regex: bool = False,
    index: str | None = None,
) -> DataFrame:
    """P17 + F14: per query, items where every whitespace token is contained
    in name or brand (case-insensitive); when none match, items matching the
    first token.  All of them by default, or the first ``max_rows`` by key (T1)
    for a caller that wants a page.  Literal matching by default;
    ``regex=True`` treats tokens as patterns (Q13), which only a join of every
    item with every pattern can answer."""
    toks = req.select("query_id", F.posexplode(tokens(F.col("q"))).alias("pos", "tok"))
    ntok = toks.groupBy("query_id").agg(F.count(F.lit(1)).alias("ntok"))
    toks = toks.join(ntok, "query_id")
    texts = items.select(key, name, brand)
    if regex:
        m = texts.join(toks, F.regexp(_lower(name), F.col("tok")) | F.regexp(_lower(brand), F.col("tok")))
    else:
        m = containing(texts, [name, brand], toks, "tok", key, index)
    per = m.groupBy("query_id", key).agg(
        F.count_distinct("pos").alias("n_hit"), F.max("ntok").alias("ntok"),
        F.max((F.col("pos") == 0).cast("int")).alias("first_hit"))
    per = per.withColumn("all_hit", F.col("n_hit") == F.col("ntok"))
    any_all = per.groupBy("query_id").agg(F.max(F.col("all_hit").cast("int")).alias("any_all"))
    per = per.join(any_all, "query_id")
    chosen = per.where(F.when(F.col("any_all") == 1, F.col("all_hit")).otherwise(F.col("first_hit") == 1))
    chosen = chosen.select("query_id", key)
    if max_rows is not None:
        chosen = top_k_per_group(chosen, ["query_id"], [(key, "asc")], max_rows, salt_of=key).drop("rank")
    return chosen.join(items, key)


def coarse_filter(text_cols: Sequence[str], needle: Column) -> Column:
    """Needle contained in any of the lower-cased text columns."""
    out = F.lit(False)
    for c in text_cols:
        out = out | F.contains(F.lower(F.coalesce(F.col(c), F.lit(""))), needle)
    return out


def edit_similarity(a: Column, b: Column) -> Column:
    """W8 native: ``1 - levenshtein(a, b) / max(len(a), len(b))``."""
    return F.lit(1.0) - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1)).cast("double")


def _blocks(df: DataFrame, n: int) -> Iterator[list]:
    """The rows in lists of at most ``n``; one partition at a time is on the driver."""
    rows = df.toLocalIterator()
    while block := list(islice(rows, n)):
        yield block


def ranked_search(
    items: DataFrame,
    req: DataFrame,
    *,
    key: str = "fdc_id",
    text: str = "description",
    filter_cols: Sequence[str] = ("description", "food_category", "wweia_category"),
    score: str = "nutrition_score",
    limit: int = 20,
    calls=None,
    index: str | None = None,
) -> DataFrame:
    """Per query, queries shorter than 2 characters return the ``limit``
    best-scored items; otherwise the coarse filter (all items when nothing
    passes), ranked by edit similarity desc, score desc, key (T1).  A query
    that matches nothing ranks all items, ``BLOCK`` such queries in one pass over
    them: a task computes distances only where the bounds of ``edit_top`` leave room
    (``calls``, an accumulator, counts them) and sends ``limit`` rows a query."""
    cols = [c for c in filter_cols if c in items.columns]
    r = req.select("query_id", F.lower(F.col("q")).alias("ql"), (F.length("q") < 2).alias("short"))
    long_q = r.where(~F.col("short"))
    out_cols = ["query_id", *items.columns, "match_score", "rank"]

    def best_of(cand: DataFrame) -> DataFrame:
        cand = cand.withColumn("match_score", edit_similarity(F.col("ql"), _lower(text)))
        top = top_k_per_group(cand, ["query_id"], [("match_score", "desc"), (score, "desc"), (key, "asc")], limit,
                              salt_of=key)
        return cut_lineage(top.select(*out_cols))

    ranked = best_of(containing(items, cols, long_q, "ql", key, index))
    none = long_q.join(ranked.select("query_id").distinct(), "query_id", "left_anti").select("query_id", "ql")
    for block in _blocks(none, BLOCK):
        few = best_by_edit(items, [(r["query_id"], r["ql"]) for r in block], key, text, score, limit, calls)
        # ``limit`` rows a task and query: joined with their items, then ranked
        full = few.join(items, key)
        top = top_k_per_group(full, ["query_id"], [("match_score", "desc"), (score, "desc"), (key, "asc")], limit, salt_of=key)
        ranked = ranked.unionByName(cut_lineage(top.select(*out_cols)))
    # short queries: the global top list (``limit`` rows, a fixed bound), broadcast
    # and attached through its ranks
    best = global_top_k(items, [(score, "desc"), (key, "asc")], limit)
    best = best.withColumns({"short": F.lit(True), "match_score": F.lit(None).cast("double")})
    best = best.withColumn("rank", F.row_number().over(
        Window.partitionBy("short").orderBy(F.col(score).desc(), F.col(key))))
    ranks = F.explode(F.sequence(F.lit(1), F.lit(limit))).alias("rank")
    short_rows = r.where(F.col("short")).select("query_id", ranks).join(F.broadcast(best), "rank")
    return ranked.unionByName(short_rows.select(*out_cols))


def apply_filters(df: DataFrame, *, low_sodium: bool = False, high_fiber: bool = False, form: str | None = None,
                  group: str | None = None, sodium_col: str = "sodium_mg_per100g", fiber_col: str = "fiber_g_per100g",
                  form_col: str = "form", group_col: str = "food_category", sodium_max: float = 140.0,
                  fiber_min: float = 5.0) -> DataFrame:
    """Optional low-sodium / high-fibre / form / group filters (NULL fails)."""
    cond = F.lit(True)
    if low_sodium and sodium_col in df.columns:
        cond = cond & (F.col(sodium_col) <= sodium_max)
    if high_fiber and fiber_col in df.columns:
        cond = cond & (F.col(fiber_col) >= fiber_min)
    if form is not None and form_col in df.columns:
        cond = cond & (F.col(form_col) == form)
    if group is not None and group_col in df.columns:
        cond = cond & (F.col(group_col) == group)
    return df.where(F.coalesce(cond, F.lit(False)))


def filter_options(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def search_page(items: DataFrame, *, query: str = "", page: int = 1, page_size: int = 25, key: str = "fdc_id",
                score: str = "score", filters: Mapping | None = None, name: str = "description",
                brand: str = "brand_owner") -> DataFrame:
    """The matches of a query of 2+ characters, or all items; filtered,
    then sorted by score and cut to one page."""
    base = items
    if len(query) >= 2:
        base = token_search(items, requests(items.sparkSession, [query]), key=key, name=name, brand=brand).drop("query_id")
    return ranking.page(apply_filters(base, **(filters or {})), [(score, "desc"), (key, "asc")], page, page_size)


def nutrient_long(df: DataFrame, key: str, suffix: str = "_per100g", names: Sequence[str] | None = None) -> DataFrame:
    """P25: (key, nutrient, label, value) with NULL values dropped."""
    names = [n for n in (names or list(FRIENDLY_NAMES)) if f"{n}{suffix}" in df.columns]
    pairs = F.array(*[F.struct(F.lit(n).alias("nutrient"),
                               F.lit(FRIENDLY_NAMES.get(n)).alias("_fixed"),
                               F.col(f"{n}{suffix}").cast("double").alias("value")) for n in names])
    out = df.select(key, F.inline(pairs)).where(F.col("value").isNotNull())
    return out.withColumn("label", F.coalesce(F.col("_fixed"), humanise(F.col("nutrient")))).drop("_fixed")


def compare_table(selected: DataFrame, key: str, position: str, suffix: str = "_per100g") -> DataFrame:
    """R5 + R6: nutrients as rows for the selected items (long form:
    nutrient, label, position, key, value, is_best).  Nutrients with no value
    for any selected item are dropped; the best mark is the max for
    protein/fibre and the min otherwise, by ``isclose``."""
    long = nutrient_long(selected.select(key, position, *[c for c in selected.columns if c.endswith(suffix)]),
                         key, suffix).join(selected.select(key, position), key)
    w = Window.partitionBy("nutrient")
    target = F.when(F.col("nutrient").isin(list(PREFER_HIGH)), F.max("value").over(w)).otherwise(F.min("value").over(w))
    return long.withColumn("is_best", isclose(F.col("value"), target)).select(
        "nutrient", "label", position, key, "value", "is_best")


def compare_wide(selected: DataFrame, key: str, position: str, n: int, suffix: str = "_per100g") -> DataFrame:
    """Nutrients as rows and the ``n`` selected items as columns
    (``item_1`` ... by position), with the best-marked positions as text."""
    long = compare_table(selected, key, position, suffix)
    best = F.array_join(F.array_sort(F.collect_list(F.when(F.col("is_best"), F.col(position).cast("string")))), ",")
    return long.groupBy("nutrient", "label").agg(
        *[F.max(F.when(F.col(position) == i, F.col("value"))).alias(f"item_{i}") for i in range(1, n + 1)],
        best.alias("best_positions"))


def badge(value: Column, unit: str = "", decimals: int = 0) -> Column:
    """A serving badge such as "120 kcal", a dash for NULL."""
    return format_number(value, decimals, f" {unit}" if unit else "")


def compare_options(items: DataFrame, selected: DataFrame, *, key: str = "fdc_id", score: str = "score",
                    text: str = "description", n: int | None = None) -> DataFrame:
    """W14 + J13 + P29: items not yet selected (anti join) with the option
    label ``"{text} ({id})"``; all of them, or the best ``n`` by score."""
    from vittles.functions.scalar import option_label

    rest = items.join(selected.select(key), key, "left_anti")
    top = rest if n is None else global_top_k(rest, [(score, "desc"), (key, "asc")], n)
    return top.select(key, score, option_label(F.col(text), F.col(key)).alias("label"))


def export_results(df: DataFrame, path: str, cols: Sequence[str] = ("fdc_id", "description", "food_category",
                                                                    "score", "grade")) -> None:
    """The search-result CSV (five columns, header)."""
    df.select(*[c for c in cols if c in df.columns]).write.mode("overwrite").option("header", True).csv(path)


def point_lookup(items: DataFrame, ids: DataFrame, key: str = "fdc_id", strict: bool = True) -> DataFrame:
    """P19 + P20: rows for a request table of ids (semi join); with
    ``strict`` an absent id raises, as the single-id lookup does."""
    req = ids.select(F.col(ids.columns[0]).alias(key))
    if strict:
        missing = req.join(items.select(key), key, "left_anti").limit(20).collect()
        if missing:
            raise KeyError(f"ids not found: {[r[0] for r in missing]}")
    return items.join(req, key, "left_semi")
