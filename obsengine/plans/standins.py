"""Star-schema stand-ins derived from the driver tables (Spark side).

dim_product <- part, fact_price <- lineitem (l_partkey, l_shipdate),
dim_city <- nation (+ region), fact_weather_hourly <- events through
customer's nation.  Existing vs new keys are split by attributes
(part size, region, dates), so every batch has updates and inserts; with
``whole`` a stand-in has all rows of its tables instead.
The SQL twins live next to the queries in ``queries_store``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.clean import keep_last
from .adapters import table

T0 = "2023-01-01 00:00:00"
AS_OF = "2024-06-01 00:00:00"
URL_BASE = "https://shop.example/p/"
LINEITEM_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]


def ts(text: str):
    return F.lit(text).cast("timestamp")


def product_url(col: str):
    return F.concat(F.lit(URL_BASE), F.col(col).cast("string"))


def dim_product(spark, sf, whole: bool = False) -> DataFrame:
    """Existing products: parts of size <= 30."""
    part = table(spark, sf, "part")
    if not whole:
        part = part.where(F.col("p_size") <= 30)
    return part.select(
        F.col("p_partkey").alias("product_id"),
        product_url("p_partkey").alias("url"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("source"),
        ts(T0).alias("first_seen_at"),
        ts(T0).alias("last_seen_at"),
    )


def product_batch(spark, sf, whole: bool = False) -> DataFrame:
    """A products load: one row per line item of parts of size >= 20 (many
    rows per url; the last in line-item order wins)."""
    li = table(spark, sf, "lineitem")
    part = table(spark, sf, "part")
    if not whole:
        part = part.where(F.col("p_size") >= 20)
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    return j.select(
        product_url("l_partkey").alias("url"),
        F.concat(F.col("p_name"), F.lit(" #"), F.col("l_linenumber").cast("string")).alias("product_name"),
        F.col("p_type").alias("source"),
        "l_shipdate",
        *LINEITEM_ORDER,
    )


def fact_price(spark, sf) -> DataFrame:
    """Existing price facts: line items shipped before 1999, one per
    (part, ship day) (the last in line-item order)."""
    li = table(spark, sf, "lineitem").where(F.col("l_shipdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    rows = li.select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").cast("timestamp").alias("scraped_at"),
        F.col("l_extendedprice").cast("decimal(10,2)").alias("price_gbp"),
        F.col("l_returnflag").alias("availability"),
        F.when(F.col("l_linenumber") <= 5, F.col("l_linenumber")).cast("smallint").alias("rating_1to5"),
        *LINEITEM_ORDER,
    )
    return keep_last(rows, ["product_id", "scraped_at"], LINEITEM_ORDER).drop(*LINEITEM_ORDER)


def price_batch(spark, sf, whole: bool = False) -> DataFrame:
    """A prices load: line items shipped from 1998 on, by url; returned
    items carry a negative price, line numbers 6 and 7 an invalid rating."""
    li = table(spark, sf, "lineitem")
    if not whole:
        li = li.where(F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
    return li.select(
        product_url("l_partkey").alias("url"),
        F.col("l_shipdate").cast("timestamp").alias("scraped_at"),
        F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice"))
        .otherwise(F.col("l_extendedprice"))
        .alias("price_gbp"),
        F.col("l_linestatus").alias("availability"),
        F.col("l_linenumber").cast("double").alias("rating_1to5"),
        *LINEITEM_ORDER,
    )


def dim_city(spark, sf) -> DataFrame:
    """Existing cities: nations of regions 0..2, country = region name."""
    n = table(spark, sf, "nation").where(F.col("n_regionkey") <= 2)
    r = table(spark, sf, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").cast("bigint").alias("city_id"),
        F.col("n_name").alias("city_name"),
        F.col("r_name").alias("country"),
        (F.col("n_nationkey") * 3 - 40).cast("decimal(8,5)").alias("latitude"),
        (F.col("n_nationkey") * 7).cast("decimal(8,5)").alias("longitude"),
    )


def city_batch(spark, sf) -> DataFrame:
    """A cities load: one row per customer naming its nation; region 0 has
    no country (becomes ''), so those are new (name, '') cities."""
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    r = table(spark, sf, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("n_name").alias("city_name"),
        F.when(F.col("n_regionkey") == 0, F.lit(None).cast("string")).otherwise(F.col("r_name")).alias("country"),
        (F.col("c_acctbal") / 100).alias("latitude"),
        (F.col("c_acctbal") / 10).alias("longitude"),
        "c_custkey",
    )


def weather_rows(spark, sf, shift: float) -> DataFrame:
    """Hourly weather fact rows from events: city = customer's nation, hour
    of the event; ``shift`` moves the temperature (so a second load differs)."""
    e = table(spark, sf, "events")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    k = F.get_json_object("props", "$.k").cast("double")
    return e.join(c, e.user_id == c.c_custkey).select(
        F.col("c_nationkey").cast("bigint").alias("city_id"),
        F.date_trunc("hour", "ts").cast("timestamp").alias("time_at"),
        (F.col("value") - F.lit(shift)).alias("temperature_2m"),
        k.alias("relative_humidity_2m"),
        F.col("value").alias("precipitation"),
        (k / 2).alias("wind_speed_10m"),
        "event_id",
        "ts",
    )


def _weather_decimals(df: DataFrame) -> DataFrame:
    return df.select(
        "city_id",
        "time_at",
        F.col("temperature_2m").cast("decimal(5,2)").alias("temperature_2m"),
        F.col("relative_humidity_2m").cast("decimal(5,2)").alias("relative_humidity_2m"),
        F.col("precipitation").cast("decimal(6,2)").alias("precipitation"),
        F.col("wind_speed_10m").cast("decimal(6,2)").alias("wind_speed_10m"),
        "event_id",
    )


def fact_weather(spark, sf, whole: bool = False) -> DataFrame:
    """Existing hourly facts: events before Jan 20, temperature = value-60."""
    w = weather_rows(spark, sf, 60.0)
    if not whole:
        w = w.where(F.col("ts") < F.lit("2024-01-20").cast("timestamp_ntz"))
    return keep_last(_weather_decimals(w), ["city_id", "time_at"], ["event_id"]).drop("event_id")


def weather_batch(spark, sf) -> DataFrame:
    """A weather load: events from Jan 15 on, temperature = value-50."""
    w = weather_rows(spark, sf, 50.0).where(F.col("ts") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    return _weather_decimals(w)
