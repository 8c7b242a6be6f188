"""Serving reads over the star schema: counts, samples, latest row per key,
hourly city averages for one day, ordered top-k."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import hour_of
from ..operators.clean import keep_last


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, n_rows); all counts in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_sample(df: DataFrame, key: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (a checkable ``TABLE t LIMIT n``)."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in key]).limit(n)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: Sequence[str]) -> DataFrame:
    """``DISTINCT ON (keys) ... ORDER BY keys, order_desc DESC``: the row with
    the greatest ``order_desc`` per key (list every column there to break
    ties).  A top-1 per key, which map tasks pre-reduce before the shuffle."""
    return keep_last(df, keys, order_desc)


def latest_price(dim_product: DataFrame, fact_price: DataFrame, tie_break: Sequence[str] = ()) -> DataFrame:
    """Latest fact row per product joined to its dimension row."""
    latest = latest_per_key(fact_price, ["product_id"], ["scraped_at", *tie_break])
    return dim_product.select("product_id", "product_name", "url").join(latest, on="product_id", how="inner")


def top_k(df: DataFrame, order: Sequence[str], k: int = 20) -> DataFrame:
    """Ordered top ``k`` (planned as a single TakeOrderedAndProject: each task
    keeps its own k best, the driver merges k x tasks rows)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(k)


def hourly_city_avg(fact_weather: DataFrame, dim_city: DataFrame, day) -> DataFrame:
    """Per (city, hour) of one UTC day: mean temperature, mean humidity,
    total rain (NULL when every value is missing, as SQL SUM is)."""
    f = fact_weather.where(F.to_date("time_at") == F.lit(day).cast("date"))
    j = f.join(dim_city.select("city_id", "city_name"), on="city_id", how="inner")
    return j.groupBy(F.col("city_name").cast("string").alias("city"), hour_of("time_at").alias("hour_bucket")).agg(
        F.avg("temperature_2m").alias("avg_temp"),
        F.avg("relative_humidity_2m").alias("avg_rh"),
        F.sum("precipitation").alias("rain"),
    )
