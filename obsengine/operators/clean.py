"""Cleaning chains and keep-last deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import scalars as S

WEATHER_MEASURES = ("temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m")


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per ``keys``: the row that sorts last in ``order`` (ascending,
    NULLs last).  NULL keys equal each other, as in a pandas dedup.

    Written as ``row_number() = 1`` over the reversed order, which Spark
    plans with a partial group limit before the shuffle: every map task
    keeps only its own last row per key, so a key with millions of
    duplicates costs one row per map task on the wire, not millions in one
    reducer.
    """
    win = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_first() for c in order])
    return df.withColumn("_rn", F.row_number().over(win)).where(F.col("_rn") == 1).drop("_rn")


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values of ``keys`` (hash aggregate with map-side combine)."""
    return df.select(*keys).distinct()


def clean_products(
    df: DataFrame,
    ordinal: str | None = None,
    null_url_token: str | None = S.NULL_URL_TOKEN,
    drop_ordinal: bool = True,
) -> DataFrame:
    """Products cleaning, in the reference's order:

    1. ``scraped_at`` to UTC timestamp, ``price_gbp`` to number;
    2. rating to number, outside [1, 5] becomes NULL;
    3. drop rows with a negative price (a NULL price stays);
    4. url text-cast and trimmed (missing -> ``null_url_token``);
    5. keep the last row per (url, scraped_at); ties broken by ``ordinal``.

    A time or price column that the files lack is NULL throughout.  Range
    checks and the price filter run before the dedup, so a negative
    duplicate never hides a valid one.  The ordinal column is dropped unless
    ``drop_ordinal=False``.
    """
    df = S.ensure_columns(df, T.StructType([T.StructField(c, T.StringType()) for c in ("scraped_at", "price_gbp")]))
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = df
    out = out.withColumn("scraped_at", S.to_utc_timestamp("scraped_at", types.get("scraped_at")))
    out = out.withColumn("price_gbp", S.to_double("price_gbp", types.get("price_gbp")))
    if "rating_1to5" in types:
        rating = S.to_double("rating_1to5", types["rating_1to5"])
        out = out.withColumn("rating_1to5", S.in_range_or_null(rating, *S.RATING_RANGE))
    out = out.where(F.col("price_gbp").isNull() | (F.col("price_gbp") >= 0))
    if "url" in types:
        out = out.withColumn("url", S.normalize_url("url", null_url_token))
        order = ["scraped_at"] + ([ordinal] if ordinal else [])
        out = keep_last(out, ["url", "scraped_at"], order)
    if drop_ordinal and ordinal and ordinal in out.columns:
        out = out.drop(ordinal)
    return out


def clean_weather(df: DataFrame, ordinal: str | None = None, drop_ordinal: bool = True) -> DataFrame:
    """Weather cleaning: ``time`` to UTC, measures to numbers, plausibility
    (temperature in [-80, 80], humidity in [0, 100], precipitation and wind
    >= 0; else NULL), then keep the last row per (city, time).
    """
    df = S.ensure_columns(df, _weather_measure_schema())
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    out = df.withColumn("time", S.to_utc_timestamp("time", types.get("time")))
    for c in WEATHER_MEASURES:
        out = out.withColumn(c, S.to_double(c, types[c]))
    out = (
        out.withColumn("temperature_2m", S.in_range_or_null("temperature_2m", *S.TEMPERATURE_RANGE))
        .withColumn("relative_humidity_2m", S.in_range_or_null("relative_humidity_2m", *S.HUMIDITY_RANGE))
        .withColumn("precipitation", S.non_negative_or_null("precipitation"))
        .withColumn("wind_speed_10m", S.non_negative_or_null("wind_speed_10m"))
    )
    if "city" in types:
        order = ["time"] + ([ordinal] if ordinal else [])
        out = keep_last(out, ["city", "time"], order)
    if drop_ordinal and ordinal and ordinal in out.columns:
        out = out.drop(ordinal)
    return out


def _weather_measure_schema():
    return T.StructType([T.StructField("time", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in WEATHER_MEASURES)])
