"""Contracts, schema completion and data-quality checks."""

import pytest
from pyspark.sql import functions as F

from vittles.operators import matrix, quality
from vittles.sources import contracts, io


def test_contract_rename_check_project(spark):
    df = spark.createDataFrame([(1, "a", "x", 9)], "id long, NDB_number string, extra string, footnote int")
    c = contracts.Contract(required=["id", "ndb_number", "footnote"], renames={"NDB_number": "ndb_number"})
    assert c.apply(df).columns == ["id", "ndb_number", "footnote"]
    with pytest.raises(quality.CheckFailed, match="missing required columns"):
        contracts.Contract(required=["id", "nope"]).apply(df)


def test_text_staging_and_completion(spark):
    df = spark.createDataFrame([(1, None)], "a long, b string")
    t = contracts.as_text(df, fill_empty=True).first()
    assert (t["a"], t["b"]) == ("1", "")
    done = contracts.complete_schema(spark.createDataFrame([(1, 5.0)], "fdc_id long, nutrition_score double"),
                                     {"brand_owner": "string", "fiber_g_per100g": "double"}, {"score": "nutrition_score"})
    r = done.first()
    assert r["score"] == 5.0 and r["brand_owner"] is None and "fiber_g_per100g" in done.columns


def test_csv_reads_text_and_keeps_na(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('id,name,note\n1,NA,"line one\nline two"\n2,,"say ""hi"""\n')
    rows = io.read_text_csv(spark, str(p)).orderBy("id").collect()
    assert rows[0]["name"] == "NA" and rows[0]["note"] == "line one\nline two"
    assert rows[1]["name"] is None and rows[1]["note"] == 'say "hi"'


def test_checks(spark):
    right = spark.createDataFrame([(1, "g"), (1, "mg"), (2, None)], "id long, unit string")
    left = spark.createDataFrame([(1,), (2,), (2,), (3,)], "nid long")
    assert quality.many_to_one(right, "id").first()["value"] == 1
    share = quality.unmatched_share(left, right, "nid", "unit", right_key="id").first()
    assert share["value"] == pytest.approx(0.75) and not share["passed"]
    edges = spark.createDataFrame([(0.5,), (1.0,), (0.0,)], "s double")
    assert quality.similarity_range(edges, "s").first()["value"] == 1
    flags = spark.createDataFrame([(0,), (1,), (2,)], "f int")
    assert quality.flag_domain(flags, "f").first()["value"] == 1
    probs = spark.createDataFrame([(0.2, 0.8), (0.5, 0.6)], "a double, b double")
    assert quality.probabilities_valid(probs, ["a", "b"]).first()["value"] == 1
    with pytest.raises(quality.CheckFailed):
        quality.enforce(quality.flag_domain(flags, "f"))
    dup = spark.createDataFrame([(1, 2.0, "x"), (1, 3.0, "y")], "k long, o double, v string")
    assert quality.keep_first(dup, "k", [("o", "desc")]).first()["v"] == "y"
    sr = quality.score_range(spark.createDataFrame([(None,), (50.0,), (101.0,)], "s double"), "s").first()
    assert (sr["score_min"], sr["score_max"], sr["in_range"]) == (0.0, 101.0, False)


def test_absent_columns_warn_and_portions_default(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "fdc_id long, note string").write.parquet(str(tmp_path / "t.parquet"))
    with pytest.warns(UserWarning, match="brand"):
        df = io.load_table(spark, str(tmp_path), str(tmp_path), "t", usecols=["fdc_id", "brand"])
    assert df.columns == ["fdc_id"]
    portions = spark.createDataFrame([(1, 7, "cup"), (1, 8, None), (2, 9, "")], "fdc_id long, id long, portion_description string")
    got = {r.fdc_id: (r.serving_desc, r.serving_gram_weight) for r in matrix.primary_servings(portions).collect()}
    assert got == {1: ("cup", 0.0), 2: ("", 0.0)}
    listed = io.schema_table(spark, portions, counts=True).collect()
    assert [(r.column, r.rows, r.non_null) for r in listed] == [("fdc_id", 3, 3), ("id", 3, 3), ("portion_description", 3, 2)]
