"""Units and nutrient mapping.

Unit synonyms and conversion factors are tiny fixed tables, so they are
literal maps inside the expression (no join at all).  The nutrient mapping
joins the nutrient dimension with the pattern dimension (a fixed list of a few
dozen patterns, broadcast) by regular-expression match and keeps, per
canonical name, the best candidate with an aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vittles.operators.ranking import first_per_key
from vittles.plans.fdc import CONVERSION_FACTORS, UNIT_SYNONYMS


def _lit_map(d: Mapping) -> Column:
    return F.create_map(*[x for k, v in d.items() for x in (F.lit(k), F.lit(v))])


def normalize_unit(c: str | Column, synonyms: Mapping[str, str] = UNIT_SYNONYMS) -> Column:
    """P10: trim + lower, then synonyms; unknown units pass through."""
    key = F.lower(F.trim(F.col(c) if isinstance(c, str) else c))
    return F.coalesce(F.try_element_at(_lit_map(synonyms), key), key)


def conversion_factor(from_unit: Column, to_unit: Column, factors: Mapping = CONVERSION_FACTORS) -> Column:
    """Factor for normalised units; 1.0 when equal or the source is NULL;
    NULL when the pair is unknown."""
    fmap = _lit_map({f"{a}|{b}": float(v) for (a, b), v in factors.items()})
    found = F.try_element_at(fmap, F.concat_ws("|", from_unit, to_unit))
    return F.when(from_unit.isNull() | (from_unit == to_unit), F.lit(1.0)).otherwise(found)


def convert(value: str | Column, from_unit: str | Column, to_unit: str | Column, *, strict: bool = False,
            factors: Mapping = CONVERSION_FACTORS) -> Column:
    """P11 (strict: unknown pair raises) / P12 (lenient: keep the amount).

    ``value`` and ``from_unit`` are columns; ``to_unit`` is a unit literal or a column."""
    v = F.col(value) if isinstance(value, str) else value
    fu = normalize_unit(from_unit)
    tu = normalize_unit(F.lit(to_unit) if isinstance(to_unit, str) else to_unit)
    f = conversion_factor(fu, tu, factors)
    if strict:
        f = F.coalesce(f, F.raise_error(F.concat(F.lit("Unsupported conversion from '"), fu, F.lit("' to '"), tu,
                                                 F.lit("'"))).cast("double"))
        return v * f
    return v * F.coalesce(f, F.lit(1.0))


PATTERN_SCHEMA = StructType([
    StructField("canonical_name", StringType()),
    StructField("ord", IntegerType()),
    StructField("pattern", StringType()),
    StructField("pattern_ord", IntegerType()),
    StructField("target_unit", StringType()),
])


def pattern_table(spark: SparkSession, spec: Sequence[tuple[str, str, Sequence[str]]]) -> DataFrame:
    """The canonical spec as a small dimension (canonical, ord, pattern,
    pattern_ord, target_unit)."""
    rows = [(name, i, p, j, unit) for i, (name, unit, pats) in enumerate(spec) for j, p in enumerate(pats)]
    return spark.createDataFrame(rows, PATTERN_SCHEMA)


def nutrient_mapping(
    nutrients: DataFrame,
    patterns: DataFrame,
    *,
    id_col: str = "id",
    name_col: str = "name",
    unit_col: str = "unit_name",
    number_col: str | None = "nutrient_nbr",
    factors: Mapping = CONVERSION_FACTORS,
) -> DataFrame:
    """Per canonical name, the first pattern (in order) that matches any
    nutrient name (case-insensitive search); among its matches the best unit
    (exact 10, convertible 5, else 0), then the smallest nutrient number
    (a missing number scores 0 and beats all real ones, Q11), then the lower
    id (T4).  Returns (canonical_name, nutrient_id, nutrient_name, unit_name,
    matched_pattern, ord).  Canonical names with no match are absent; use
    ``unresolved`` to list them.
    """
    n = nutrients.select(
        F.col(id_col).cast("long").alias("nutrient_id"),
        F.trim(F.col(name_col).cast("string")).alias("nutrient_name"),
        F.col(unit_col).alias("_raw_unit"),
        normalize_unit(F.col(unit_col)).alias("_unit"),
        (F.col(number_col).cast("double") if number_col else F.lit(None).cast("double")).alias("_nbr"),
    )
    p = F.broadcast(patterns)
    cand = n.join(p, F.regexp(F.col("nutrient_name"), F.concat(F.lit("(?i)"), F.col("pattern"))), "inner")
    tu = normalize_unit(F.col("target_unit"))
    fmap = _lit_map({f"{a}|{b}": 1 for (a, b) in factors})
    unit_score = (F.when(F.col("_unit") == tu, F.lit(10))
                  .when(F.try_element_at(fmap, F.concat_ws("|", F.col("_unit"), tu)).isNotNull(), F.lit(5))
                  .otherwise(F.lit(0)))
    nbr_score = F.coalesce(-(F.col("_nbr").cast("long")), F.lit(0).cast("long"))
    cand = cand.select(
        "canonical_name", "ord", "pattern_ord", "nutrient_id", "nutrient_name",
        F.coalesce(F.col("_unit"), F.col("_raw_unit")).alias("unit_name"),
        F.col("pattern").alias("matched_pattern"),
        unit_score.alias("_us"), nbr_score.alias("_ns"),
    )
    best = first_per_key(
        cand, ["canonical_name"],
        [("pattern_ord", "asc"), ("_us", "desc"), ("_ns", "desc"), ("nutrient_id", "asc")],
        ["ord", "nutrient_id", "nutrient_name", "unit_name", "matched_pattern"],
    )
    return best


def mapping_with_factors(mapping: DataFrame, patterns: DataFrame, nutrients: DataFrame, *,
                         id_col: str = "id", unit_col: str = "unit_name") -> DataFrame:
    """Mapping rows with the lenient factor from each nutrient's own unit to
    the canonical target unit (P12, Q9).  When two canonical names map to
    the same id the later one wins (Q10)."""
    targets = patterns.select("canonical_name", "target_unit").distinct()
    units = nutrients.select(F.col(id_col).cast("long").alias("nutrient_id"), F.col(unit_col).alias("_src_unit"))
    m = mapping.join(F.broadcast(targets), "canonical_name").join(units, "nutrient_id", "left")
    fu, tu = normalize_unit(F.col("_src_unit")), normalize_unit(F.col("target_unit"))
    m = m.withColumn("factor", F.coalesce(conversion_factor(fu, tu), F.lit(1.0)))
    latest = first_per_key(m, ["nutrient_id"], [("ord", "desc")], ["canonical_name", "factor"])
    return latest


def unresolved(mapping: DataFrame, patterns: DataFrame) -> DataFrame:
    """Canonical names without a match (the reference raises on any)."""
    return patterns.select("canonical_name").distinct().join(mapping, "canonical_name", "left_anti")
