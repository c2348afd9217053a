"""Long nutrient facts -> one wide row per item.

The reference's row-apply functions (form inference, row conversion; U3)
are column expressions here.

Shuffle plan of ``long_to_wide``: the facts are exchanged once, by key and a
small salt of the name, so a key holding a third of them goes to ``CODE_SALTS``
tasks; duplicates go and means are made there, and only a mean for each key and
name is exchanged again, by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vittles.functions.scalar import blank_to_null, nan_to_null, to_double, to_long_id
from vittles.operators.ranking import first_per_key
from vittles.session import broadcast_if_small


CODE_SALTS = 4  # tasks over which the names of one key are dealt


def coerce_facts(df: DataFrame, key: str, item: str, amount: str) -> DataFrame:
    """P1 + P3: ids and amount from text, rows with a NULL key dropped."""
    out = df.select(
        to_long_id(F.col(key)).alias(key),
        to_long_id(F.col(item)).alias(item),
        to_double(F.col(amount)).alias(amount),
    )
    return out.where(F.col(key).isNotNull() & F.col(item).isNotNull())


def long_to_wide(
    facts: DataFrame,
    key: str,
    name: str,
    amount: str,
    names: Sequence[str],
    suffix: str = "_per100g",
    colocated: bool = False,
) -> DataFrame:
    """A1 + A2: mean of the distinct amounts per (key, name), pivoted to a
    fixed column list.  Names without data give NULL columns; +-inf -> NULL.
    ``colocated``: the facts are bucketed by the key, so nothing is exchanged."""
    # the fixed name list becomes a small integer code before the shuffles
    # (narrower rows, integer hashing); 0 = not in the list
    code = F.array_position(F.array(*[F.lit(n) for n in names]), F.col(name)).cast("int")
    coded = facts.select(key, code.alias("_code"), F.col(amount).alias("_amt")).where(F.col("_code") > 0)
    salted = coded.withColumn("_salt", F.col("_code") % CODE_SALTS)
    dealt = salted if colocated else salted.repartition(key, "_salt")
    dedup = dealt.groupBy(key, "_salt", "_code", "_amt").agg(F.lit(1).alias("_one"))
    means = dedup.groupBy(key, "_salt", "_code").agg(F.avg("_amt").alias("_mean"))
    wide = means.groupBy(key).agg(*[F.max(F.when(F.col("_code") == i + 1, F.col("_mean"))).alias(f"_{i}") for i in range(len(names))])
    return wide.select(key, *[nan_to_null(F.col(f"_{i}")).alias(f"{n}{suffix}") for i, n in enumerate(names)])


def nutrient_matrix(
    facts: DataFrame,
    mapping: DataFrame,
    names: Sequence[str],
    *,
    key: str = "fdc_id",
    item: str = "nutrient_id",
    amount: str = "amount",
    suffix: str = "_per100g",
    colocated: bool = False,
) -> DataFrame:
    """R9 (P4 + P12 + A1 + A2).

    ``mapping`` is the small dimension (item id, canonical name, factor) built
    by ``units.mapping_with_factors``; it has at most one row per canonical
    name there, and is broadcast after a check of its size.  One
    inner join both filters to mapped ids and attaches the name (P4); the
    lenient conversion (P12) multiplies by a factor that is 1.0 when no
    conversion applies.
    """
    dim = broadcast_if_small(mapping.select(F.col(item), F.col("canonical_name"), F.col("factor")))
    converted = facts.join(dim, item, "inner").select(
        F.col(key), F.col("canonical_name"), (F.col(amount) * F.col("factor")).alias("amount_target_unit")
    )
    return long_to_wide(converted, key, "canonical_name", "amount_target_unit", names, suffix, colocated)


def primary_servings(
    portions: DataFrame,
    units: DataFrame | None = None,
    *,
    key: str = "fdc_id",
    portion_id: str = "id",
    description: str = "portion_description",
    modifier: str = "gram_weight_modifier",
    unit_id: str = "measure_unit_id",
    weight: str = "gram_weight",
    blank_is_null: bool = True,
) -> DataFrame:
    """W1 + F6: one serving per item.

    Text = description, else modifier, else the measure unit name; rows with
    text beat rows without, then the larger gram weight, then the lower
    portion id (T2).  Weight text that is not a number counts as 0.
    An absent column counts as NULL.  ``blank_is_null=False`` keeps the staged-data quirk (Q6) where ``""``
    stops the fallback chain.
    """
    p = portions.withColumns({c: F.lit(None).cast("string") for c in (portion_id, description, modifier, unit_id, weight)
                              if c not in portions.columns})
    if units is not None:
        u = broadcast_if_small(units.select(F.col("id").alias("_uid"), F.col("name").alias("_unit_name")))
        p = p.join(u, F.col(unit_id) == F.col("_uid"), "left")
        unit_name = F.col("_unit_name")
    else:
        unit_name = F.lit(None).cast("string")
    if blank_is_null:
        text = F.coalesce(blank_to_null(description), blank_to_null(modifier), unit_name, F.lit(""))
    else:
        first = F.coalesce(F.col(description), F.col(modifier), F.lit(""))
        text = F.when(first == "", F.coalesce(unit_name, F.lit(""))).otherwise(first)
    p = p.select(
        F.col(key),
        to_long_id(F.col(portion_id)).alias("_pid"),
        text.alias("serving_desc"),
        F.coalesce(to_double(F.col(weight)), F.lit(0.0)).alias("serving_gram_weight"),
    ).withColumn("_has_text", (F.length("serving_desc") > 0).cast("int"))
    return first_per_key(
        p,
        [key],
        [("_has_text", "desc"), ("serving_gram_weight", "desc"), ("_pid", "asc")],
        ["serving_desc", "serving_gram_weight"],
    )


def with_servings(
    dataset: DataFrame,
    servings: DataFrame,
    *,
    key: str = "fdc_id",
    household_text: str | None = "household_serving_fulltext",
    default_weight: float = 100.0,
    default_text: str = "100 g",
) -> DataFrame:
    """J7 + P5: attach the primary serving; weight NULL -> 100, text NULL ->
    "100 g", then household text replaces "100 g" when present (Q8)."""
    out = dataset.join(servings, key, "left")
    out = out.withColumn("serving_gram_weight", F.coalesce(F.col("serving_gram_weight"), F.lit(default_weight)))
    desc = F.coalesce(F.col("serving_desc"), F.lit(default_text))
    if household_text and household_text in dataset.columns:
        desc = F.when((desc == default_text) & F.col(household_text).isNotNull(), F.col(household_text)).otherwise(desc)
    return out.withColumn("serving_desc", desc)


def per_serving(
    dataset: DataFrame,
    names: Sequence[str],
    *,
    weight: str = "serving_gram_weight",
    energy: str = "energy_kcal",
) -> DataFrame:
    """``<n>_perserving = <n>_per100g * (weight / 100)``; weight 0 -> NULL.

    The operation order (multiply by weight/100) is kept for float equality.
    """
    w = F.when(F.col(weight) != 0, F.col(weight))
    cols = {}
    for n in names:
        src = f"{n}_per100g"
        if src in dataset.columns:
            cols[f"{n}_perserving"] = F.col(src) * (w / F.lit(100.0))
    out = dataset.withColumns(cols)
    if f"{energy}_perserving" in out.columns:
        out = out.withColumns(
            {"kcal_per_serv": F.col(f"{energy}_perserving"), "kcal_per100g": F.col(f"{energy}_per100g")}
        )
    return out


def missing_flag(c: str | Column) -> Column:
    """1 when NULL else 0 (an int, not a boolean)."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNull().cast("int")


def form_tag(
    texts: Sequence[str | Column],
    keywords: Sequence[str],
    *,
    override: str | Column | None = None,
    match_label: str = "liquid",
    other_label: str = "solid",
    word_boundary: bool = False,
) -> Column:
    """Override, else ``match_label`` when any keyword is a substring of
    the lower-cased, space-joined, trimmed texts, else ``other_label``.

    Substring matching is the reference behaviour (Q12: "oil" in "boiled");
    ``word_boundary=True`` is an opt-in stricter mode.
    """
    parts = [blank_to_null(F.trim(F.col(t) if isinstance(t, str) else t)) for t in texts]
    text = F.lower(F.concat_ws(" ", *[F.trim(p) for p in parts]))
    hit = F.lit(False)
    for kw in keywords:
        if word_boundary:
            hit = hit | text.rlike(r"\b" + _re_escape(kw) + r"\b")
        else:
            hit = hit | F.contains(text, F.lit(kw))
    tag = F.when(hit, F.lit(match_label)).otherwise(F.lit(other_label))
    if override is not None:
        o = F.col(override) if isinstance(override, str) else override
        tag = F.coalesce(o, tag)
    return tag


def _re_escape(s: str) -> str:
    import re

    return re.escape(s)


def ensure_per_serving(dataset: DataFrame, names: Sequence[str], weight: str = "serving_gram_weight") -> DataFrame:
    """Add ``<n>_perserving`` for every name whose per-100 g column
    exists but whose per-serving column does not."""
    missing = [n for n in names if f"{n}_per100g" in dataset.columns and f"{n}_perserving" not in dataset.columns]
    if not missing or weight not in dataset.columns:
        return dataset
    w = F.when(F.col(weight) != 0, F.col(weight))
    return dataset.withColumns({f"{n}_perserving": F.col(f"{n}_per100g") * (w / F.lit(100.0)) for n in missing})
