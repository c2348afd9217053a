"""End to end on a small FDC-shaped fixture written by the test."""

import pandas as pd
import pytest

from vittles.operators import quality, scorecard
from vittles.plans import foods_job
from vittles.plans.fdc import CANONICAL_ORDER
from vittles.sources import buckets

NUTRIENTS = [
    (1008, "Energy", "KCAL", 208), (1062, "Energy", "kJ", 268), (1003, "Protein", "G", 203),
    (1004, "Total lipid (fat)", "G", 204), (1258, "Fatty acids, total saturated", "G", 606),
    (1292, "Fatty acids, total monounsaturated", "G", 645), (1293, "Fatty acids, total polyunsaturated", "G", 646),
    (1005, "Carbohydrate, by difference", "G", 205), (1079, "Fiber, total dietary", "G", 291),
    (2000, "Sugars, total including NLEA", "G", 269), (1235, "Sugars, added", "G", 539),
    (1093, "Sodium, Na", "MG", 307), (1092, "Potassium, K", "MG", 306), (1087, "Calcium, Ca", "MG", 301),
]
FOODS = [
    (1, "Foundation", "Boiled eggs", 1), (2, "SR Legacy", "Beef steak", 2), (3, "Branded", "Chicken breast", 2),
    (4, "Branded", "Orange juice", 3), (5, "Foundation", "Plain rice", 4), (6, "Branded", "Mystery bar", 4),
]


def _write(tmp, name, rows, cols):
    pd.DataFrame(rows, columns=cols).to_csv(tmp / f"{name}.csv", index=False)


@pytest.fixture(scope="module")
def fdc(tmp_path_factory, spark):
    root = tmp_path_factory.mktemp("fdc")
    raw, dic = root / "raw", root / "dict"
    raw.mkdir()
    dic.mkdir()
    _write(raw, "nutrient", [(i, n, u, nb, 1) for i, n, u, nb in NUTRIENTS], ["id", "name", "unit_name", "nutrient_nbr", "rank"])
    _write(raw, "food", [(i, t, d, c, "2020-01-01") for i, t, d, c in FOODS],
           ["fdc_id", "data_type", "description", "food_category_id", "publication_date"])
    _write(raw, "food_category", [(1, "a", "Eggs"), (2, "b", "Meat"), (3, "c", "Beverages"), (4, "d", "Grains")],
           ["id", "code", "description"])
    facts = []
    fid = 0
    amounts = {1008: 150, 1003: 12, 1258: 3, 1079: 0.5, 2000: 1, 1093: 120, 1092: 130, 1004: 10, 1005: 1}
    for f, *_ in FOODS:
        for n, a in amounts.items():
            if f == 6 and n != 1008:
                continue
            fid += 1
            facts.append([fid, f, n, a * f] + [""] * 9)
    facts.append([fid + 1, 1, 1003, 12 * 1] + [""] * 9)  # duplicate amount: averaged once
    facts.append([fid + 2, 1, 1003, 24] + [""] * 9)
    _write(raw, "food_nutrient", facts, foods_job.FDC_REQUIRED["food_nutrient"])
    portions = [(1, 1, 1, 1, "", "", "", 900), (2, 1, 2, 1, 2, "cup", "", 240), (3, 1, 3, 1, 3, "slice", "", 30),
                (4, 2, 1, 1, 1, "", "", "abc"), (5, 3, 1, 1, 1, "", "", 50)]
    _write(raw, "food_portion", [list(p) + ["", "", ""] for p in portions],
           ["id", "fdc_id", "seq_num", "amount", "measure_unit_id", "portion_description", "modifier", "gram_weight",
            "data_points", "footnote", "min_year_acquired"])
    _write(raw, "measure_unit", [(1, "piece"), (2, "cup"), (3, "slice")], ["id", "name"])
    branded = [[3, "Acme"] + [""] * 7 + ["2 pieces"] + [""] * 11, [4, "Juicy"] + [""] * 19]
    _write(raw, "branded_food", branded, foods_job.FDC_REQUIRED["branded_food"])
    _write(dic, "form_overrides", [(5, "LIQUID")], ["fdc_id", "form"])
    paths = foods_job.Paths(str(raw), str(root / "staging"), str(root / "processed"), str(dic))
    staged = foods_job.stage(spark, paths)
    ds, mapping = foods_job.build_foods(spark, paths)
    return staged, ds.cache(), mapping.toPandas(), paths


def test_stage_and_contracts(fdc):
    staged, *_ = fdc
    assert "food" in staged and "food_nutrient" in staged and "sr_legacy_food" not in staged


def test_mapping(fdc):
    _, _, mapping, _ = fdc
    m = dict(zip(mapping["canonical_name"], mapping["nutrient_id"]))
    assert m["energy_kcal"] == 1008 and m["sat_fat_g"] == 1258 and m["sugar_g"] == 2000 and m["added_sugar_g"] == 1235
    assert len(m) == len(CANONICAL_ORDER)


def test_dataset(fdc, spark):
    _, ds, _, _ = fdc
    rows = {r["fdc_id"]: r for r in ds.collect()}
    assert len(rows) == 6
    assert rows[1]["protein_g_per100g"] == pytest.approx(18.0)  # distinct mean of 12, 24
    assert (rows[1]["serving_desc"], rows[1]["serving_gram_weight"]) == ("cup", 240.0)
    assert rows[2]["protein_g_perserving"] is None  # weight text "abc" -> 0 -> NULL
    assert rows[3]["serving_desc"] == "piece"
    assert rows[6]["serving_desc"] == "100 g"
    assert rows[1]["form"] == "liquid" and rows[3]["form"] == "solid" and rows[5]["form"] == "liquid"
    assert rows[1]["food_category"] == "Eggs"
    assert rows[1]["added_sugar_missing"] == 1
    for c in ["protein_g_per100g_z", "protein_g_per100g_clipped", "wweia_category", "kcal_per_serv"]:
        assert c in ds.columns
    scored = scorecard.score_foods(ds)
    checks = quality.report([quality.key_unique(scored, "fdc_id"), quality.flag_domain(scored, "added_sugar_missing"),
                             quality.flag_domain(scored, "penalty_estimated")])
    quality.enforce(checks)
    assert scored.where("nutrition_score < 0 or nutrition_score > 100").count() == 0


def test_run_writes_outputs(fdc, spark):
    _, _, _, paths = fdc
    out = foods_job.run(spark, paths, k=3)
    edges = spark.read.parquet(out["neighbours"])
    assert set(edges.columns) == {"fdc_id", "neighbor_id", "cos_sim", "base_score"}
    assert edges.where("fdc_id = neighbor_id").count() == 0
    scored = spark.read.parquet(out["scored"])
    assert scored.count() == 6 and "grade" in scored.columns
    for name in ("missingness", "nutrient_stats", "food_groups", "schema", "nutrient_mapping"):
        assert spark.read.parquet(f"{paths.processed_dir}/{name}.parquet").count() > 0
    metrics = {r["metric"]: r["value"] for r in spark.read.json(f"{paths.processed_dir}/metrics.json").collect()}
    assert set(metrics) == {"calibration_log_loss", "elastic_net_rmse"}


def test_cli_entry_point(fdc, spark, tmp_path, capsys):
    _, _, _, paths = fdc
    out = str(tmp_path / "cli_out")
    foods_job.main(["--data-root", paths.data_root, "--staging-dir", str(tmp_path / "stage"), "--out", out,
                    "--dictionaries", paths.dictionaries_dir, "--neighbours", "2"])
    printed = capsys.readouterr().out.strip().splitlines()[-1]
    assert '"neighbours"' in printed
    assert spark.read.parquet(f"{out}/nn_index.parquet").groupBy("fdc_id").count().agg({"count": "max"}).first()[0] <= 2


def test_bucketed_tables_join_without_an_exchange(fdc, spark, tmp_path):
    _, ds, _, paths = fdc
    laid = foods_job.Paths(paths.data_root, str(tmp_path / "staging"), paths.processed_dir, paths.dictionaries_dir, 4)
    foods_job.stage(spark, laid)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined, _ = foods_job.joined_foods(spark, laid)
        rows = {r["fdc_id"]: r for r in joined.collect()}
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("SortMergeJoin") >= 3 and "hashpartitioning(fdc_id" not in plan and plan.count("Bucketed: true") >= 4
        plain, _ = foods_job.joined_foods(spark, paths)
        assert "hashpartitioning(fdc_id" in plain._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    for r in ds.collect():
        assert all(rows[r["fdc_id"]][c] == r[c] for c in joined.columns)
    for name in foods_job.KEYED:  # a new session opens them from the layout
        spark.sql(f"DROP TABLE {buckets._table(laid.staging_dir, name)}")
    assert buckets.open_bucketed(spark, laid.staging_dir, "food").count() == 6
    assert buckets.open_bucketed(spark, laid.staging_dir, "sr_legacy_food") is None
    assert [buckets.bucket_count(n) for n in (0, 1, 2_000_000, 2_000_001, 10**9)] == [1, 1, 1, 2, 512]
