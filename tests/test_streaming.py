"""Incremental staging picks up only new files, exactly once."""

import uuid

import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException

from vittles.plans.foods_job import contract
from vittles.streaming.staging import stage_stream


def test_stage_stream_incremental(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    cols = ["id", "fdc_id", "nutrient_id", "amount", "data_points", "derivation_id", "min", "max", "median", "loq",
            "footnote", "min_year_acquired", "percent_daily_value", "extra"]
    pd.DataFrame([[1, 10, 1003, 5.0] + [""] * 10, [2, 10, 1004, 1.0] + [""] * 10], columns=cols).to_csv(
        raw / "part-1.csv", index=False)
    out = str(tmp_path / "staged")
    name = f"food_nutrient_{uuid.uuid4().hex[:6]}"
    c = contract("food_nutrient")
    assert stage_stream(spark, str(raw), c, out, name=name) == 2
    pd.DataFrame([[3, 11, 1003, 7.0] + [""] * 10], columns=cols).to_csv(raw / "part-2.csv", index=False)
    assert stage_stream(spark, str(raw), c, out, name=name, header_columns=cols) == 1
    swapped = [cols[1], cols[0], *cols[2:]]
    pd.DataFrame([[11, 4, 1003, 7.0] + [""] * 10], columns=swapped).to_csv(raw / "part-3.csv", index=False)
    with pytest.raises(StreamingQueryException):
        stage_stream(spark, str(raw), c, out, name=name, header_columns=cols)
    df = spark.read.parquet(out)
    assert df.count() == 3 and df.columns == c.required
