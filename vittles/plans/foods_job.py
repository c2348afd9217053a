"""The FoodData-Central job: stage -> build -> score -> neighbours -> models.

This binds the generic operators to the FDC column names.  Each step is one
lazy plan ending in a write; the only driver round trips are the checks
(one row each), the nutrient mapping (one row per canonical nutrient) and
the per-column statistics (a few scalars per column).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vittles.functions.scalar import blank_to_null, to_double, to_long_id
from vittles.operators import matrix, models, neighbors, quality, scorecard, stats, units
from vittles.plans.fdc import CANONICAL_NUTRIENTS, CANONICAL_ORDER, LIQUID_KEYWORDS, NEIGHBOUR_FEATURES, RECO_DEFAULTS
from vittles.sources import buckets, io
from vittles.sources.contracts import Contract
from vittles.sources.split_csv import read_split_csv
from vittles.session import broadcast_if_small, cut_lineage

# Per-file renames applied before the contract check, and the
# required columns of each raw file, in order.
FDC_RENAMES = {
    "foundation_food": {"NDB_number": "ndb_number"},
    "sr_legacy_food": {"NDB_number": "ndb_number"},
    "food_portion": {"modifier": "gram_weight_modifier"},
    "wweia_food_category": {"wweia_food_category": "wweia_food_category_id"},
}
FDC_REQUIRED = {
    "food": ["fdc_id", "data_type", "description", "food_category_id", "publication_date"],
    "foundation_food": ["fdc_id", "ndb_number", "footnote"],
    "sr_legacy_food": ["fdc_id", "ndb_number"],
    "branded_food": ["fdc_id", "brand_owner", "brand_name", "subbrand_name", "gtin_upc", "ingredients",
                     "not_a_significant_source_of", "serving_size", "serving_size_unit", "household_serving_fulltext",
                     "branded_food_category", "data_source", "package_weight", "modified_date", "available_date",
                     "market_country", "discontinued_date", "preparation_state_code", "trade_channel",
                     "short_description", "material_code"],
    "food_nutrient": ["id", "fdc_id", "nutrient_id", "amount", "data_points", "derivation_id", "min", "max", "median",
                      "loq", "footnote", "min_year_acquired", "percent_daily_value"],
    "nutrient": ["id", "name", "unit_name", "nutrient_nbr", "rank"],
    "food_portion": ["id", "fdc_id", "seq_num", "amount", "measure_unit_id", "portion_description",
                     "gram_weight_modifier", "gram_weight", "data_points", "footnote", "min_year_acquired"],
    "measure_unit": ["id", "name"],
    "food_category": ["id", "code", "description"],
    "wweia_food_category": ["wweia_food_category_id", "wweia_food_category_description"],
}
# Optional columns carried through staging when present (Q5).
FDC_OPTIONAL = {"food": ["wweia_food_category_id"]}
MAX_UNMATCHED_UNIT_SHARE = 0.02


def contract(name: str) -> Contract:
    return Contract(required=FDC_REQUIRED[name], renames=FDC_RENAMES.get(name, {}), optional=FDC_OPTIONAL.get(name, ()))


@dataclass(frozen=True)
class Paths:
    data_root: str
    staging_dir: str
    processed_dir: str
    dictionaries_dir: str
    #: staged tables that are joined by fdc_id are also written in so many buckets; None: plain files only
    buckets: int | None = None


# tables joined by fdc_id
KEYED = ("food", "branded_food", "food_portion", "food_nutrient")


def stage(spark: SparkSession, paths: Paths, *, fill_empty: bool = False) -> list[str]:
    """Every present raw CSV as all-text zstd
    parquet under its contract; then the fact x nutrient unit coverage check.
    Returns the staged table names (absent sources are skipped)."""
    staged = []
    for name in FDC_REQUIRED:
        src = f"{paths.data_root}/{name}.csv"
        if not io.path_exists(spark, src):
            continue
        # the facts hold no quoted line ends; the other tables by food may, and are large
        raw = read_split_csv(spark, src) if name in KEYED and name != "food_nutrient" else io.read_text_csv(
            spark, src, multiline=name != "food_nutrient")
        io.write_staged(contract(name).apply(raw, name), f"{paths.staging_dir}/{name}.parquet", fill_empty=fill_empty)
        staged.append(name)
        if paths.buckets and name in KEYED:
            plain = spark.read.parquet(f"{paths.staging_dir}/{name}.parquet")
            buckets.write_bucketed(plain, paths.staging_dir, name, "fdc_id", paths.buckets)
    if {"food_nutrient", "nutrient"} <= set(staged):
        fn = spark.read.parquet(f"{paths.staging_dir}/food_nutrient.parquet")
        nu = spark.read.parquet(f"{paths.staging_dir}/nutrient.parquet").select(
            to_long_id("id").alias("id"), blank_to_null("unit_name").alias("unit_name"))
        quality.enforce(quality.report([
            quality.many_to_one(nu, "id"),
            quality.unmatched_share(fn.select(to_long_id("nutrient_id").alias("nutrient_id")), nu, "nutrient_id",
                                    "unit_name", MAX_UNMATCHED_UNIT_SHARE, right_key="id"),
        ]))
    return staged


def _load(spark: SparkSession, paths: Paths, name: str, cols: list[str] | None = None) -> DataFrame:
    return io.load_table(spark, paths.staging_dir, paths.data_root, name, usecols=cols,
                         schema=contract(name).empty(spark).schema)


def _load_keyed(spark: SparkSession, paths: Paths, name: str, cols: list[str]) -> DataFrame:
    """A table with fdc_id as a long: the bucketed one where it was staged, so
    that joins on fdc_id need no exchange, else the plain one."""
    df = buckets.open_bucketed(spark, paths.staging_dir, name) if paths.buckets else None
    if df is not None:
        return df.select(*[c for c in cols if c in df.columns])
    df = _load(spark, paths, name, cols)
    return df.withColumn("fdc_id", to_long_id("fdc_id"))


def joined_foods(spark: SparkSession, paths: Paths, *, blank_is_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """R9 + W1 + J3-J7 + P5-P8: the wide foods dataset, and the nutrient mapping
    (P9b).  Over bucketed tables its joins on fdc_id, the matrix and the primary
    servings are made bucket by bucket."""
    nutrients = _load(spark, paths, "nutrient", ["id", "name", "unit_name", "nutrient_nbr"])
    patterns = units.pattern_table(spark, CANONICAL_NUTRIENTS)
    mapping = units.nutrient_mapping(nutrients.withColumn("nutrient_nbr", to_double("nutrient_nbr")), patterns)
    missing = units.unresolved(mapping, patterns).collect()
    if missing:
        raise LookupError(f"Unable to resolve nutrient ids for {[r[0] for r in missing]}")

    food = _load_keyed(spark, paths, "food", FDC_REQUIRED["food"] + FDC_OPTIONAL["food"])
    cat = _load(spark, paths, "food_category")
    food, numeric = _category(food, cat)
    food = _wweia(spark, paths, food)
    branded = _load_keyed(spark, paths, "branded_food",
                          ["fdc_id", "brand_owner", "household_serving_fulltext", "serving_size", "serving_size_unit"])
    if blank_is_null:
        branded = branded.withColumn("household_serving_fulltext", blank_to_null("household_serving_fulltext"))
    meta = food.join(branded, "fdc_id", "left")

    facts = _load_keyed(spark, paths, "food_nutrient", ["fdc_id", "nutrient_id", "amount"])
    facts = facts.select("fdc_id", to_long_id("nutrient_id").alias("nutrient_id"), to_double("amount").alias("amount"))
    facts = facts.where(F.col("fdc_id").isNotNull() & F.col("nutrient_id").isNotNull())
    quality.enforce(quality.non_empty(facts, "food_nutrient_non_empty"))
    nu_ids = nutrients.select(to_long_id("id").alias("id"), blank_to_null("unit_name").alias("unit_name"))
    quality.enforce(quality.report([
        quality.many_to_one(nu_ids, "id"),
        quality.unmatched_share(facts.join(F.broadcast(mapping.select("nutrient_id")), "nutrient_id", "left_semi"),
                                nu_ids, "nutrient_id", "unit_name", MAX_UNMATCHED_UNIT_SHARE, right_key="id"),
    ]))
    dim = units.mapping_with_factors(mapping, patterns, nu_ids)
    wide = matrix.nutrient_matrix(facts, dim, CANONICAL_ORDER, colocated=bool(paths.buckets))

    portions = _load_keyed(spark, paths, "food_portion", FDC_REQUIRED["food_portion"])
    servings = matrix.primary_servings(portions, _load(spark, paths, "measure_unit").withColumn("id", to_long_id("id")),
                                       blank_is_null=blank_is_null)
    ds = meta.join(wide, "fdc_id", "left")
    ds = matrix.with_servings(ds, servings)
    ds = matrix.per_serving(ds, CANONICAL_ORDER)
    ds = ds.withColumn("added_sugar_missing", matrix.missing_flag("added_sugar_g_per100g"))
    overrides = io.read_overrides(spark, f"{paths.dictionaries_dir}/form_overrides.csv")
    ds = ds.join(broadcast_if_small(overrides.withColumnRenamed("form", "_override")), "fdc_id", "left")
    ds = ds.withColumn("form", matrix.form_tag(["description", "food_category", "wweia_category"], LIQUID_KEYWORDS,
                                               override="_override")).drop("_override")
    return ds, mapping.orderBy("canonical_name")


def build_foods(spark: SparkSession, paths: Paths, *, blank_is_null: bool = True) -> tuple[DataFrame, DataFrame]:
    """``joined_foods`` with the robust z-scores (A3) of every nutrient."""
    ds, mapping = joined_foods(spark, paths, blank_is_null=blank_is_null)
    per100 = [f"{n}_per100g" for n in CANONICAL_ORDER]
    # the build is materialised once, then read by the statistics and the result
    ds = cut_lineage(ds)
    ds = stats.robust_z(ds, per100, z_suffix="_z", clipped_suffix=None)
    ds = ds.withColumns({f"{c}_clipped": matrix_clip(F.col(f"{c}_z")) for c in per100})
    return ds, mapping


def matrix_clip(c):
    from vittles.functions.scalar import clip

    return clip(c, -2.5, 2.5)


def _category(food: DataFrame, cat: DataFrame) -> tuple[DataFrame, bool]:
    """Join category names when the id is numeric, else use the text."""
    nonnum = food.where(F.col("food_category_id").isNotNull() & to_double("food_category_id").isNull()).limit(1).count()
    if nonnum or not cat.columns:
        return food.withColumnRenamed("food_category_id", "food_category"), False
    c = cat.select(to_long_id("id").alias("_cid"), F.col("description").alias("food_category"))
    out = food.withColumn("_fcid", to_long_id("food_category_id"))
    out = out.join(broadcast_if_small(c), out["_fcid"] == c["_cid"], "left")
    return out.drop("_fcid", "_cid"), True


def _wweia(spark: SparkSession, paths: Paths, food: DataFrame) -> DataFrame:
    """Wweia names when the key is present, else a NULL column."""
    w = _load(spark, paths, "wweia_food_category")
    if "wweia_food_category_id" not in food.columns or not w.columns:
        return food.withColumn("wweia_category", F.lit(None).cast("string"))
    w = w.select(to_long_id("wweia_food_category_id").alias("_wid"),
                 F.col("wweia_food_category_description").alias("wweia_category"))
    out = food.withColumn("_wk", to_long_id("wweia_food_category_id"))
    return out.join(broadcast_if_small(w), out["_wk"] == w["_wid"], "left").drop("_wk", "_wid")


def diagnostics(dataset: DataFrame) -> dict[str, DataFrame]:
    """Missingness, nutrient stats, group counts, schema."""
    per100 = [c for c in dataset.columns if c.endswith("_per100g")]
    canon = [f"{n}_per100g" for n in CANONICAL_ORDER if f"{n}_per100g" in dataset.columns]
    return {
        "missingness": stats.missingness(dataset, per100),
        "nutrient_stats": stats.nutrient_stats(dataset, canon, [c[: -len("_per100g")] for c in canon]),
        "food_groups": stats.group_counts(dataset, ["food_category", "wweia_category"]),
        "schema": io.schema_table(dataset.sparkSession, dataset),
    }


def run(spark: SparkSession, paths: Paths, *, k: int = RECO_DEFAULTS["n_neighbors"]) -> dict[str, str]:
    """End to end with writes; returns the output paths."""
    out = paths.processed_dir
    stage(spark, paths)
    ds, mapping = build_foods(spark, paths)
    io.write_parquet(ds, f"{out}/foods_nutrients.parquet")
    built = spark.read.parquet(f"{out}/foods_nutrients.parquet")
    io.write_csv(built, f"{out}/foods_nutrients.csv")
    for name, df in diagnostics(built).items():
        io.write_parquet(df, f"{out}/{name}.parquet")
        if name == "food_groups":
            io.write_csv(df, f"{out}/food_groups_csv")  # S11
    io.write_parquet(mapping, f"{out}/nutrient_mapping.parquet")
    # Scoring reads the built table and writes a new version next to it
    scored_path = io.versioned_path(f"{out}/foods_scored")
    scored = scorecard.score_foods(spark.read.parquet(f"{out}/foods_nutrients.parquet"))
    io.write_parquet(scored, scored_path)
    scored = spark.read.parquet(scored_path)
    io.write_csv(scorecard.sanity_report(scored, "fdc_id", "nutrition_score",
                                         ["fdc_id", "description", "grade", "nutrition_score", "kcal_per_serv",
                                          "sodium_mg_perserving", "sugar_g_perserving"]), f"{out}/score_sanity_sample")
    quality.require_columns(scored, ["fdc_id", "score", "form", "food_category", "kcal_per_serv",
                                     "sodium_mg_perserving"], "foods dataset")
    edges = neighbors.build_index(scored, NEIGHBOUR_FEATURES, min_feats=RECO_DEFAULTS["min_features_present"],
                                  k=k)
    io.write_parquet(edges.drop("rank"), f"{out}/nn_index.parquet")
    ff = models.feature_frame(scored)
    cal = models.train_calibration(ff)
    enet = models.train_driver_model(ff)
    io.coefficients_frame(spark, enet["features"], enet["coef"], enet["intercept"]).write.mode("overwrite").json(
        f"{out}/elastic_net_coefficients.json")
    io.metrics_frame(spark, {"calibration_log_loss": cal["cv_log_loss"], "elastic_net_rmse": enet["cv_rmse"]}) \
        .write.mode("overwrite").json(f"{out}/metrics.json")
    models.save_models(cal, enet, f"{out}/models")
    return {"foods": f"{out}/foods_nutrients.parquet", "scored": scored_path, "neighbours": f"{out}/nn_index.parquet"}


def main(argv: list[str] | None = None) -> None:
    """Thin job entry point: ``python -m vittles.plans.foods_job --data-root ... --out ...``.

    Uses the active SparkSession (spark-submit) and its ``spark.checkpoint.dir``."""
    import argparse
    import json

    ap = argparse.ArgumentParser(description="Stage, build, score, index and train on FDC-shaped tables.")
    ap.add_argument("--data-root", required=True)
    ap.add_argument("--staging-dir", required=True)
    ap.add_argument("--out", required=True, help="processed output folder")
    ap.add_argument("--dictionaries", default="", help="folder with form_overrides.csv (optional)")
    ap.add_argument("--neighbours", type=int, default=RECO_DEFAULTS["n_neighbors"])
    ap.add_argument("--buckets", type=int, default=None, help="bucket the staged tables by fdc_id (optional)")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("vittles-foods").getOrCreate()
    from vittles.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    paths = Paths(a.data_root, a.staging_dir, a.out, a.dictionaries or f"{a.data_root}/dictionaries", a.buckets)
    print(json.dumps(run(spark, paths, k=a.neighbours)))


if __name__ == "__main__":
    main()
