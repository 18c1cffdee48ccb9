import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import round_half_away, whole_division


@pytest.mark.parametrize("digits", [2, 3, 4])
def test_rounding_equals_binary_rounding(spark, digits):
    rng = np.random.default_rng(1)
    values = np.concatenate(
        [
            rng.normal(0, 100, 20_000),
            rng.integers(-10_000, 10_000, 20_000) / 1000,
            np.array([1.005, 0.285, 1.0045, -1.005, 0.5, -0.5, 2.5, 0.0, -0.0, 1e17, -1e17]),
        ]
    )
    frame = pd.DataFrame({"n": range(len(values)), "x": values})
    got = (
        spark.createDataFrame(frame)
        .select("n", round_half_away(F.col("x"), digits).alias("r"))
        .toPandas()
        .sort_values("n")["r"]
        .to_numpy()
    )
    want = duckdb.sql(f"SELECT round(x, {digits}) AS r FROM frame ORDER BY n").df()["r"].to_numpy()
    np.testing.assert_array_equal(got, want)


def test_rounding_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    first, second = [r[0] for r in df.select(round_half_away(F.col("x"), 2)).collect()]
    assert first is None and second != second


def test_whole_division_is_exact_for_large_numbers(spark):
    big = 3_600_000_000 * 10**9
    df = spark.createDataFrame([(big,), (big - 1,)], "x bigint")
    assert [r[0] for r in df.select(whole_division(F.col("x"), 3_600_000_000)).collect()] == [
        10**9,
        10**9 - 1,
    ]


def test_number_text_prints_as_python_does(spark):
    from tidemark.functions.text import number_text

    numbers = [0.0, -0.0, 1.0, -1.5, 0.001, 0.0005, -0.00012345, 0.0001, 0.00009999, 1e-5, -2.5e-10, 9999999.0,
               1e7, 12345678.0, 123456789.125, 9007199254740993.0, 1e15, 1e16, -1.25e16, 1e22, 1.5e300, 1e-300,
               float("inf"), float("-inf"), float("nan"), None]
    rows = spark.createDataFrame([(n,) for n in numbers], "v double").select("v", number_text(F.col("v")).alias("t"))
    for row in rows.collect():
        assert row["t"] == (None if row["v"] is None else repr(row["v"]))
