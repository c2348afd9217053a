"""Capped-percent scorecard (R8, F1-F5, A10) and the sanity report.

A scorecard is a list of groups; each group has a signed weight and a list of
components ``(value, reference)``.  A component is ``value / reference * 100``
clipped to [0, 100]; a group is the NULL-skipping mean of its components
(0 when all are NULL); the score is the weighted sum clipped to [0, 100]
(NULL -> 0); the grade uses left-closed cut points.  Everything is one
``select`` of built-in expressions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vittles.functions.scalar import capped_percent, clip, grade, row_mean
from vittles.operators.ranking import global_top_k


@dataclass(frozen=True)
class Component:
    value: str | Column
    reference: float


@dataclass(frozen=True)
class Group:
    name: str
    weight: float
    components: Sequence[Component]


@dataclass(frozen=True)
class Scorecard:
    groups: Sequence[Group]
    cutpoints: Sequence[tuple[str, float]]
    lowest_grade: str
    score_col: str = "nutrition_score"
    extra: dict = field(default_factory=dict)

    def apply(self, df: DataFrame, grade_col: str = "grade", alias_col: str | None = "score") -> DataFrame:
        # component percentages first, as columns: the group means then refer
        # to them instead of repeating each clipped expression (smaller code)
        comps: dict[str, Column] = {}
        for g in self.groups:
            for i, c in enumerate(g.components):
                comps[f"_{g.name}_{i}"] = capped_percent(c.value, c.reference)
        out = df.withColumns(comps)
        total = None
        cols = {f"{g.name}_score": row_mean([F.col(f"_{g.name}_{i}") for i in range(len(g.components))], null_as=0.0)
                for g in self.groups}
        out = out.withColumns(cols).drop(*comps.keys())
        for g in self.groups:
            term = F.lit(float(g.weight)) * F.col(f"{g.name}_score")
            total = term if total is None else total + term
        score = F.coalesce(clip(total, 0.0, 100.0), F.lit(0.0))
        out = out.withColumn(self.score_col, score)
        out = out.withColumn(grade_col, grade(F.col(self.score_col), self.cutpoints, self.lowest_grade))
        if alias_col:
            out = out.withColumn(alias_col, F.col(self.score_col))
        return out


# Fixed values of the food scorecard (weights, daily values, energy reference,
# estimate factor and grade cut points), stated as the reference configures them.
FOOD_WEIGHTS = {"macros": 0.45, "micros": 0.35, "penalties": 0.20}
FOOD_DAILY_VALUES = {
    "protein_g": 50.0,
    "fiber_g": 28.0,
    "potassium_mg": 4700.0,
    "added_sugar_g": 50.0,
    "sodium_mg": 2300.0,
    "sat_fat_g": 20.0,
    "energy_kcal": 2000.0,
}
ENERGY_DENSITY_REFERENCE = 275.0
PENALTY_ESTIMATE_FACTOR = 0.75
FOOD_CUTPOINTS = [("A", 85.0), ("B", 75.0), ("C", 65.0), ("D", 50.0)]
LOWEST_GRADE = "E"


def food_scorecard(
    weights: dict | None = None,
    daily_values: dict | None = None,
    energy_reference: float = ENERGY_DENSITY_REFERENCE,
    cutpoints: Sequence[tuple[str, float]] = FOOD_CUTPOINTS,
) -> Scorecard:
    """The food instance of the generic scorecard.  Expects the column
    ``_added_sugar_used`` produced by ``score_foods`` (F3)."""
    w = dict(FOOD_WEIGHTS, **(weights or {}))
    dv = dict(FOOD_DAILY_VALUES, **(daily_values or {}))
    return Scorecard(
        groups=[
            Group("macro", w["macros"], [Component("protein_g_perserving", dv["protein_g"]),
                                         Component("fiber_g_perserving", dv["fiber_g"])]),
            Group("micro", w["micros"], [Component("potassium_mg_perserving", dv["potassium_mg"])]),
            Group("penalty", -w["penalties"], [Component("_added_sugar_used", dv["added_sugar_g"]),
                                               Component("sodium_mg_perserving", dv["sodium_mg"]),
                                               Component("sat_fat_g_perserving", dv["sat_fat_g"]),
                                               Component("energy_kcal_per100g", energy_reference)]),
        ],
        cutpoints=cutpoints,
        lowest_grade=LOWEST_GRADE,
    )


def score_foods(df: DataFrame, card: Scorecard | None = None, estimate_factor: float = PENALTY_ESTIMATE_FACTOR) -> DataFrame:
    """Add penalty_estimated, macro/micro/penalty_score, nutrition_score,
    grade and score.  Absent input columns are treated as all NULL."""
    card = card or food_scorecard()
    needed = ["protein_g_perserving", "fiber_g_perserving", "potassium_mg_perserving", "added_sugar_g_perserving",
              "sugar_g_perserving", "sodium_mg_perserving", "sat_fat_g_perserving", "energy_kcal_per100g"]
    missing = {c: F.lit(None).cast("double") for c in needed if c not in df.columns}
    if "added_sugar_missing" not in df.columns:
        missing["added_sugar_missing"] = F.lit(None).cast("int")
    out = df.withColumns(missing) if missing else df
    flagged = F.coalesce(F.col("added_sugar_missing") == 1, F.lit(False))
    out = out.withColumns({
        "_added_sugar_used": F.when(flagged, F.col("sugar_g_perserving") * F.lit(float(estimate_factor)))
        .otherwise(F.col("added_sugar_g_perserving")),
        "penalty_estimated": flagged.cast("int"),
    })
    # the penalty group enters with a negative weight; clip after the sum
    out = card.apply(out)
    out = out.drop("_added_sugar_used")
    if missing:
        out = out.drop(*missing.keys())
    return out


def sanity_report(df: DataFrame, key: str, score: str, columns: Sequence[str], n: int = 50) -> DataFrame:
    """R7 = W6 + U1: top ``n`` and bottom ``n`` by score with a ``rank_type``
    tag; duplicates between the two kept (UNION ALL).  Ties by key."""
    top = global_top_k(df, [(score, "desc"), (key, "asc")], n).withColumn("rank_type", F.lit("top"))
    bottom = global_top_k(df, [(score, "asc"), (key, "asc")], n).withColumn("rank_type", F.lit("bottom"))
    cols = ["rank_type", *columns]
    return top.select(*cols).unionByName(bottom.select(*cols))
