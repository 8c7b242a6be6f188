"""Parsing and plausibility rules (traps T1, T2, T6, T8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from obsengine.functions import scalars as S


def _one(spark, expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_to_double_accepts_plain_numbers_only(spark):
    vals = ["1.5", " 2 ", "1e3", "-4.", ".5", "inf", "-Infinity", "abc", "", None, "1.5d", "1.5f", "NaN", "1,5"]
    got = _one(spark, S.to_double, vals)
    assert got[:7] == [1.5, 2.0, 1000.0, -4.0, 0.5, float("inf"), float("-inf")]
    assert got[7:] == [None] * 7


def test_to_double_folds_nan_of_numeric_input(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    got = [r[0] for r in df.select(S.to_double("v", df.schema["v"].dataType)).collect()]
    assert got == [1.0, None, None]


def test_to_utc_timestamp_each_value_alone(spark):
    vals = ["2025-09-08T19:54:37Z", "2025-09-08 19:54", "2025-09-08T05:00:00+02:00", "2025-09-08T00:00",
            "junk", "", None, "2025"]
    got = _one(spark, S.to_utc_timestamp, vals)
    # Compared as UTC wall clock (session zone is UTC).
    assert got[0] == dt.datetime(2025, 9, 8, 19, 54, 37)
    assert got[1] == dt.datetime(2025, 9, 8, 19, 54)
    assert got[2] == dt.datetime(2025, 9, 8, 3, 0)
    assert got[3] == dt.datetime(2025, 9, 8, 0, 0)
    assert got[4:] == [None, None, None, None]


def test_ranges(spark):
    assert _one(spark, lambda c: S.in_range_or_null(c, -80, 80), [-80.0, 80.0, 80.01, -80.5, None], "double") == [
        -80.0, 80.0, None, None, None]
    assert _one(spark, S.non_negative_or_null, [0.0, -0.01, 3.0], "double") == [0.0, None, 3.0]


def test_normalize_url(spark):
    got = _one(spark, S.normalize_url, ["  https://a/1 ", "\thttps://a/2\n", None])
    assert got == ["https://a/1", "https://a/2", "nan"]
    got = _one(spark, lambda c: S.normalize_url(c, None), [None])
    assert got == [None]


def test_price_text(spark):
    vals = ["£51.77", "£1,50", "Â£51.77", "", None, "£1,234.50"]
    assert _one(spark, S.price_text_to_double, vals) == [51.77, 1.5, None, None, None, None]
    lenient = _one(spark, lambda c: S.price_text_to_double(c, lenient=True), vals)
    assert lenient[:3] == [51.77, 1.5, 51.77]


def test_rating_words(spark):
    assert _one(spark, S.rating_word_to_int, ["One", "Five", "Zero", None, "three"]) == [1, 5, None, None, None]


def test_ensure_columns(spark):
    from pyspark.sql import types as T

    df = spark.createDataFrame([(1,)], "a int")
    out = S.ensure_columns(df, T.StructType([T.StructField("b", T.DoubleType())]))
    assert out.columns == ["a", "b"] and out.first()["b"] is None
