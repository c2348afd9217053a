"""Hand-computed rows (FIXTURES section 4) against the operators."""

import math

import pytest
from pyspark.sql import functions as F

from vittles.functions.scalar import grade, half_even_int, to_double, to_long_id
from vittles.operators import matrix, models, scorecard, stats, substitute, units
from vittles.operators.ranking import first_per_key
from vittles.plans.fdc import LIQUID_KEYWORDS

SCHEMA = ("protein_g_perserving double, fiber_g_perserving double, potassium_mg_perserving double, "
          "added_sugar_g_perserving double, added_sugar_missing int, sugar_g_perserving double, "
          "sodium_mg_perserving double, sat_fat_g_perserving double, energy_kcal_per100g double, case string")


def test_scorecard_rows(spark):
    rows = [
        (50.0, 28.0, 4700.0, 0.0, 0, 0.0, 0.0, 0.0, 0.0, "ceiling"),
        (25.0, None, None, None, 1, 20.0, 460.0, 5.0, 137.5, "nulls"),
        (None, None, None, None, 1, None, None, None, None, "all_null"),
        (0.0, 0.0, 0.0, 100.0, 0, 0.0, 5000.0, 40.0, 600.0, "floor"),
        (50.0, 28.0, 0.0, None, 0, 20.0, 1150.0, None, None, "flag0"),
    ]
    df = scorecard.score_foods(spark.createDataFrame(rows, SCHEMA))
    got = {r["case"]: r for r in df.collect()}
    exp = {"ceiling": (100, 100, 0, 80.0, "B"), "nulls": (50, 0, 31.25, 16.25, "E"), "all_null": (0, 0, 0, 0.0, "E"),
           "floor": (0, 0, 100, 0.0, "E"), "flag0": (100, 0, 50, 35.0, "E")}
    for case, (ma, mi, pe, sc, gr) in exp.items():
        r = got[case]
        assert r["macro_score"] == pytest.approx(ma)
        assert r["micro_score"] == pytest.approx(mi)
        assert r["penalty_score"] == pytest.approx(pe)
        assert r["nutrition_score"] == pytest.approx(sc)
        assert r["grade"] == gr
    assert got["nulls"]["penalty_estimated"] == 1 and got["flag0"]["penalty_estimated"] == 0


def test_grade_edges(spark):
    df = spark.createDataFrame([(49.999,), (50.0,), (65.0,), (75.0,), (85.0,), (None,)], "s double")
    out = [r[0] for r in df.select(grade("s", scorecard.FOOD_CUTPOINTS, "E")).collect()]
    assert out == ["E", "D", "C", "B", "A", "E"]


def test_robust_z_and_mad_zero(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 2.0, 5.0), (3, 3.0, 5.0), (4, 10.0, None), (5, None, 5.0)],
                               "id int, x double, c double")
    z = {r["id"]: r for r in stats.robust_z(df, ["x", "c"]).collect()}
    assert [z[i]["x_z"] for i in (1, 2, 3, 4)] == pytest.approx([-1.011736, -0.337245, 0.337245, 5.058681], abs=1e-6)
    assert z[5]["x_z"] is None and z[4]["x_z_clipped"] == 2.5
    assert all(z[i]["c_z"] == 0.0 for i in range(1, 6))


def test_robust_scale(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    out = [r[0] for r in stats.robust_scale(df, ["x"]).select("x_scaled").collect()]
    assert out == pytest.approx([-0.5, -1 / 6, 1 / 6, 2.5, 0.0])


def test_distinct_mean(spark):
    facts = spark.createDataFrame([(1, "a", 1.0), (1, "a", 1.0), (1, "a", 4.0), (2, "a", None)],
                                  "k long, n string, v double")
    out = {r["k"]: r["a"] for r in matrix.long_to_wide(facts, "k", "n", "v", ["a", "b"], suffix="").collect()}
    assert out == {1: 2.5, 2: None}


def test_primary_serving_and_per_serving(spark):
    portions = spark.createDataFrame(
        [(1, 1, "", None, None, "900"), (2, 1, "cup", None, None, "240"), (3, 1, "slice", None, None, "30"),
         (4, 2, "bar", None, None, "abc")],
        "id long, fdc_id long, portion_description string, gram_weight_modifier string, measure_unit_id long, "
        "gram_weight string")
    s = {r["fdc_id"]: r for r in matrix.primary_servings(portions).collect()}
    assert (s[1]["serving_desc"], s[1]["serving_gram_weight"]) == ("cup", 240.0)
    assert s[2]["serving_gram_weight"] == 0.0
    ds = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 10.0)], "fdc_id long, protein_g_per100g double")
    ds = matrix.per_serving(matrix.with_servings(ds, matrix.primary_servings(portions), household_text=None),
                            ["protein_g"])
    got = {r["fdc_id"]: r for r in ds.collect()}
    assert got[1]["protein_g_perserving"] == pytest.approx(24.0)
    assert got[2]["protein_g_perserving"] is None
    assert (got[3]["serving_desc"], got[3]["serving_gram_weight"]) == ("100 g", 100.0)


def test_units(spark):
    df = spark.createDataFrame([(5.0, "MCG", "mg"), (100.0, "kJ", "kcal"), (3.0, None, "mg"), (3.0, "IU", "mg")],
                               "v double, u string, t string")
    out = [r[0] for r in df.select(units.convert(F.col("v"), F.col("u"), F.col("t"))).collect()]
    assert out == pytest.approx([0.005, 23.9005736, 3.0, 3.0])
    with pytest.raises(Exception):
        df.select(units.convert(F.col("v"), F.col("u"), F.col("t"), strict=True)).collect()


def test_coercion(spark):
    df = spark.createDataFrame([("12.0",), ("5d",), ("abc",), (" 7 ",), ("",)], "t string")
    out = df.select(to_long_id("t").alias("i"), to_double("t").alias("d")).collect()
    assert [r["i"] for r in out] == [12, None, None, 7, None]
    assert [r["d"] for r in out] == [12.0, None, None, 7.0, None]


def test_form(spark):
    df = spark.createDataFrame([(1, "Boiled eggs", None), (2, "Beef steak", None), (3, "Chicken breast", None),
                                (4, "Milk", "solid")], "id int, d string, o string")
    out = [r[0] for r in df.select(matrix.form_tag(["d"], LIQUID_KEYWORDS, override="o")).collect()]
    assert out == ["liquid", "liquid", "solid", "solid"]


def test_objective_and_why(spark):
    df = spark.createDataFrame([(0.9, 30.0, None, None), (0.5, 12.5, 99.5, None)], "c double, g double, s double, k double")
    r = df.select(substitute.objective(F.col("c"), F.col("g"), 0.6, 0.4).alias("o"),
                  substitute.why_text(F.col("g"), F.col("s"), F.col("k")).alias("w")).collect()
    assert r[0]["o"] == pytest.approx(0.66)
    assert r[1]["w"] == "score +12, sodium 100mg"
    assert [x[0] for x in spark.createDataFrame([(2.5,), (3.5,)], "x double").select(half_even_int("x")).collect()] == [2, 4]


def test_monotone_step(spark):
    df = spark.createDataFrame([(1, 10.0, 0.1, 0.9), (2, 20.0, 0.5, 0.5), (3, 30.0, 0.3, 0.7)],
                               "id long, score double, prob_B double, prob_E double")
    out = {r["id"]: r["prob_AB"] for r in models.monotone_ab(df, "score", ["prob_B", "prob_E"], "id").collect()}
    assert [out[i] for i in (1, 2, 3)] == pytest.approx([0.1, 0.5, 0.5 / 1.2])


def test_drivers(spark):
    df = spark.createDataFrame([(1.0, -2.0, 3.0, 0.0)], "p double, q double, r double, s double")
    pos, neg = models.top_drivers([(c, F.col(c)) for c in "pqrs"])
    r = df.select(pos.alias("pos"), neg.alias("neg")).first()
    assert list(r["pos"]) == ["r", "p"] and list(r["neg"]) == ["q"]


def test_first_per_key_tie(spark):
    df = spark.createDataFrame([(1, 5.0, 3, "a"), (1, 5.0, 2, "b"), (1, 4.0, 1, "c")], "k int, w double, id int, t string")
    r = first_per_key(df, ["k"], [("w", "desc"), ("id", "asc")], ["t"]).first()
    assert r["t"] == "b"


def test_substitution_tiers(spark):
    foods = spark.createDataFrame(
        [(1, 20.0, "E", "liquid", "X", 100.0, 100.0), (2, 35.0, "E", "liquid", "X", 150.0, 400.0),
         (3, 35.0, "E", "liquid", "X", 150.0, None), (4, 75.0, "B", "solid", "Y", 100.0, 10.0)],
        "fdc_id long, score double, grade string, form string, food_category string, kcal_per_serv double, "
        "sodium_mg_perserving double")
    edges = spark.createDataFrame([(1, 2, 0.9, 20.0)], "fdc_id long, neighbor_id long, cos_sim double, base_score double")
    got = substitute.substitutions(foods, edges, k=5).where("fdc_id = 1").collect()
    assert [(r["neighbor_id"], r["tier"]) for r in got] == [(2, 1)]
    edges3 = spark.createDataFrame([(1, 3, 0.9, 20.0)], "fdc_id long, neighbor_id long, cos_sim double, base_score double")
    got = substitute.substitutions(foods, edges3, k=5).where("fdc_id = 1").orderBy("rank").collect()
    assert [(r["neighbor_id"], r["tier"]) for r in got] == [(2, 2), (3, 2)]
    only = foods.where("fdc_id in (1, 4)")
    got = substitute.substitutions(only, edges.limit(0), k=5).where("fdc_id = 1").collect()
    assert [(r["neighbor_id"], r["tier"], r["why"]) for r in got] == [(4, 3, "score +55")]


def test_small_operators(spark, tmp_path):
    from vittles.operators import search

    foods = spark.createDataFrame(
        [(1, "Apple", 80.0, "B", "fruit"), (2, "Soda", 10.0, "E", "drink"), (3, "Kale", 85.0, "A", "veg")],
        "fdc_id long, description string, score double, grade string, food_category string")
    sel = spark.createDataFrame([(3,)], "fdc_id long")
    opts = [r["label"] for r in search.compare_options(foods, sel).collect()]
    assert opts == ["Apple (1)", "Soda (2)"]
    search.export_results(foods, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 3
    subs = spark.createDataFrame([(2, 1, 80.0, 70.0, "B", "score +70", 3, 1)],
                                 "fdc_id long, neighbor_id long, score double, score_gain double, grade string, "
                                 "why string, tier int, rank int")
    assert substitute.worst_have_swaps(foods, subs, n=1).first()["passed"]
    assert substitute.low_grade_coverage(foods, subs).first()["value"] == 1.0
    e = substitute.enrich(subs, foods, ["fdc_id", "description", "score"]).first()
    assert e["description"] == "Apple" and e["score_nb"] == 80.0
    ds = spark.createDataFrame([(1, 10.0, 50.0)], "fdc_id long, protein_g_per100g double, serving_gram_weight double")
    assert matrix.ensure_per_serving(ds, ["protein_g"]).first()["protein_g_perserving"] == 5.0
    raw = spark.createDataFrame([(1, 20.0, 1.0, None, 4.0, 100.0)],
                                "fdc_id long, protein_g_perserving double, fiber_g_perserving double, "
                                "added_sugar_missing int, energy_kcal_per100g double, protein_g_per100g double")
    ff = models.load_feature_frame(raw.withColumn("added_sugar_missing", F.lit(1)))
    assert "is_healthy" in ff.columns and ff.first()["protein_g"] == 100.0


def test_substitution_null_base_groups(spark):
    foods = spark.createDataFrame(
        [(1, 20.0, "E", None, None, 100.0, 100.0), (2, 35.0, "E", "liquid", "X", 150.0, 400.0),
         (3, 31.0, "E", "solid", "Y", 150.0, None), (4, 25.0, "E", "solid", "Y", 100.0, 10.0),
         (5, 40.0, "D", "solid", None, 10.0, 10.0)],
        "fdc_id long, score double, grade string, form string, food_category string, kcal_per_serv double, "
        "sodium_mg_perserving double")
    edges = spark.createDataFrame([], "fdc_id long, neighbor_id long, cos_sim double, base_score double")
    got = substitute.substitutions(foods, edges, k=2).where("fdc_id = 1").orderBy("rank").collect()
    # no form and no group on the base: tier 2 ranks every food with score >= 30
    assert [(r["neighbor_id"], r["tier"]) for r in got] == [(5, 2), (2, 2)]
    got = substitute.substitutions(foods, edges, k=5).where("fdc_id = 4").orderBy("rank").collect()
    # solid / Y: only food 3 (31 < 35) fails the gain; tier 3 returns foods >= 35 anywhere
    assert [(r["neighbor_id"], r["tier"]) for r in got] == [(5, 3), (2, 3)]


def test_point_lookup(spark):
    from vittles.operators import search

    items = spark.createDataFrame([(1, "a"), (2, "b")], "fdc_id long, d string")
    assert [r[0] for r in search.point_lookup(items, spark.createDataFrame([(2,)], "x long")).collect()] == [2]
    with pytest.raises(KeyError):
        search.point_lookup(items, spark.createDataFrame([(3,)], "x long"))


def test_labels_and_formats(spark):
    from vittles.functions.scalar import format_number, humanise, option_label, parse_id, sanitize, tokens

    df = spark.createDataFrame([("sat_fat_g", "Apple pie (123)", 12.345, None, "  Hot  Rod ")],
                               "n string, lbl string, v double, nv double, q string")
    r = df.select(humanise("n").alias("h"), parse_id("lbl").alias("id"), option_label(F.lit("Apple"), F.lit(7)).alias("o"),
                  format_number("v", 1, " kcal").alias("f"), format_number("nv").alias("dash"),
                  sanitize("nv").alias("s"), tokens("q").alias("t")).first()
    assert (r["h"], r["id"], r["o"], r["f"], r["dash"], r["s"]) == ("Sat Fat G", 123, "Apple (7)", "12.3 kcal", "—", "")
    assert list(r["t"]) == ["hot", "rod"]


def test_search_semantics(spark):
    from vittles.operators import search

    items = spark.createDataFrame(
        [(1, "Red Apple", "Acme", 50.0), (2, "Green apple juice", "Juicy", 70.0), (3, "Kale", "Acme", 90.0)],
        "fdc_id long, description string, brand_owner string, nutrition_score double")
    req = search.requests(spark, ["apple acme", "apple zzz", "", "k.le"])
    got = {}
    for r in search.token_search(items, req).collect():
        got.setdefault(r["query_id"], set()).add(r["fdc_id"])
    assert got == {1: {1}, 2: {1, 2}}  # AND over tokens; fallback to the first token; empty query -> nothing
    rx = search.token_search(items, search.requests(spark, ["k.le"]), regex=True).collect()
    assert [r["fdc_id"] for r in rx] == [3]
    assert search.token_search(items, search.requests(spark, ["k.le"])).count() == 0  # literal by default
    ranked = search.ranked_search(items, search.requests(spark, ["a", "apple"]), filter_cols=["description"], limit=2)
    rows = sorted(ranked.collect(), key=lambda r: (r["query_id"], r["rank"]))
    assert [(r["query_id"], r["fdc_id"]) for r in rows] == [(1, 3), (1, 2), (2, 1), (2, 2)]
    assert rows[0]["match_score"] is None


def test_compare_best_marks(spark):
    from vittles.operators import search

    sel = spark.createDataFrame([(1, 1, 10.0, 300.0, None), (2, 2, 12.0, 200.0, None), (3, 3, None, 200.000001, None)],
                                "fdc_id long, position int, protein_g_per100g double, sodium_mg_per100g double, "
                                "carbs_g_per100g double")
    rows = search.compare_table(sel, "fdc_id", "position").collect()
    best = {(r["nutrient"], r["fdc_id"]) for r in rows if r["is_best"]}
    assert best == {("protein_g", 2), ("sodium_mg", 2), ("sodium_mg", 3)}  # max for protein, min (isclose) for sodium
    assert not any(r["nutrient"] == "carbs_g" for r in rows)  # all-null nutrient dropped
    assert {r["label"] for r in rows} == {"Protein", "Sodium"}


def test_mapping_rules(spark):
    pats = units.pattern_table(spark, [("energy", "kcal", [r"\benergy\b"]), ("prot", "g", [r"\bnothing\b", r"protein"]),
                                       ("also_prot", "g", [r"protein"])])
    nut = spark.createDataFrame(
        [(1, "Energy", "kJ", 100.0), (2, "Energy", "KCAL", 300.0), (3, "Energy", "kcal", None),
         (4, "Protein", "G", 203.0), (5, "Protein", "mg", 1.0)],
        "id long, name string, unit_name string, nutrient_nbr double")
    m = {r["canonical_name"]: r for r in units.nutrient_mapping(nut, pats).collect()}
    assert m["energy"]["nutrient_id"] == 3  # exact unit, and a missing number scores 0 (beats -300)
    assert m["prot"]["nutrient_id"] == 4 and m["prot"]["matched_pattern"] == "protein"  # first matching pattern
    f = {r["nutrient_id"]: r["canonical_name"] for r in units.mapping_with_factors(
        units.nutrient_mapping(nut, pats), pats, nut).collect()}
    assert f[4] == "also_prot"  # two names on one id: the later one wins


def test_options_word_boundary_and_unit_passthrough(spark):
    df = spark.createDataFrame([("Boiled eggs", " Oz "), ("Olive oil", "µg")], "d string, u string")
    r = df.select(matrix.form_tag(["d"], LIQUID_KEYWORDS, word_boundary=True).alias("f"),
                  units.normalize_unit("u").alias("n")).collect()
    assert [x["f"] for x in r] == ["solid", "liquid"]  # "oil" no longer matches inside "boiled"
    assert [x["n"] for x in r] == ["oz", "ug"]  # unknown units pass through, trimmed and lower-cased
