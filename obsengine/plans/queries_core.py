"""Queries for the cleaning, aggregate and anomaly operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import aggregate as A
from ..operators import anomaly as N
from ..operators import clean as C
from . import adapters as AD
from .registry import query, rounded

# ---------------------------------------------------------------- SQL parts
# Oracle-side twins of the adapters and the cleaning chains (DuckDB).

W_SQL = """
w AS (
  SELECT concat('city_', CAST(user_id % 20 AS VARCHAR)) AS city,
         date_trunc('hour', ts) AS time,
         event_id AS ordinal,
         value - 60 AS temperature_2m,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1.2 AS relative_humidity_2m,
         CASE event_type WHEN 'error' THEN NULL WHEN 'click' THEN 0.0
                         ELSE value - 5 END AS precipitation,
         value / 10 - 0.5 AS wind_speed_10m
  FROM events)"""

W_PLAUSIBLE_SQL = """
wp AS (
  SELECT city, time, ordinal,
         CASE WHEN temperature_2m BETWEEN -80 AND 80 THEN temperature_2m END AS temperature_2m,
         CASE WHEN relative_humidity_2m BETWEEN 0 AND 100 THEN relative_humidity_2m END
           AS relative_humidity_2m,
         CASE WHEN precipitation >= 0 THEN precipitation END AS precipitation,
         CASE WHEN wind_speed_10m >= 0 THEN wind_speed_10m END AS wind_speed_10m
  FROM w)"""

CW_SQL = """
cw AS (
  SELECT city, time, temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m
  FROM (SELECT *, row_number() OVER (PARTITION BY city, time ORDER BY ordinal DESC) AS rn
        FROM wp)
  WHERE rn = 1)"""

P_SQL = """
p AS (
  SELECT 'events' AS source,
         concat('Product ', CAST(user_id AS VARCHAR)) AS product_name,
         CASE WHEN event_id % 50 = 0 THEN 'n/a'
              WHEN event_id % 37 = 0 THEN concat('-', CAST(value AS VARCHAR))
              ELSE CAST(value AS VARCHAR) END AS price_gbp,
         event_type AS availability,
         CAST(event_id % 7 AS VARCHAR) AS rating_1to5,
         concat('  p_', CAST(user_id AS VARCHAR), ' ') AS url,
         date_trunc('hour', ts) AS scraped_at,
         event_id AS ordinal
  FROM events)"""

P_PARSED_SQL = """
pp AS (
  SELECT source, product_name, TRY_CAST(price_gbp AS DOUBLE) AS price_gbp, availability,
         CASE WHEN TRY_CAST(rating_1to5 AS DOUBLE) BETWEEN 1 AND 5
              THEN TRY_CAST(rating_1to5 AS DOUBLE) END AS rating_1to5,
         trim(coalesce(url, 'nan')) AS url, scraped_at, ordinal
  FROM p
  WHERE TRY_CAST(price_gbp AS DOUBLE) IS NULL OR TRY_CAST(price_gbp AS DOUBLE) >= 0)"""

CP_SQL = """
cp AS (
  SELECT source, product_name, price_gbp, availability, rating_1to5, url, scraped_at
  FROM (SELECT *, row_number() OVER (PARTITION BY url, scraped_at ORDER BY ordinal DESC) AS rn
        FROM pp)
  WHERE rn = 1)"""

PS_SQL = """
ps AS (
  SELECT concat('p_', CAST(user_id AS VARCHAR)) AS url, ts AS scraped_at, value AS price_gbp
  FROM events)"""


def zsql(x: str, m: str, sd: str) -> str:
    return (
        f"CASE WHEN {sd} IS NULL THEN NULL "
        f"WHEN {sd} <= 1e-12 * greatest(1.0, abs({m})) THEN 0.0 "
        f"ELSE ({x} - {m}) / {sd} END"
    )


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


WEATHER = with_(W_SQL, W_PLAUSIBLE_SQL, CW_SQL)
PRODUCTS = with_(P_SQL, P_PARSED_SQL, CP_SQL)


# ---------------------------------------------------------- Spark helpers


def _weather(spark, sf):
    return AD.weather_obs(AD.table(spark, sf, "events"))


def _clean_weather(spark, sf):
    return C.clean_weather(_weather(spark, sf), ordinal="ordinal")


def _products(spark, sf):
    return AD.price_obs(AD.table(spark, sf, "events"))


def _clean_products(spark, sf):
    return C.clean_products(_products(spark, sf), ordinal="ordinal")


# ------------------------------------------------------------- P: scalars


@query(
    "parse_numeric",
    with_(P_SQL)
    + """
SELECT ordinal, price_gbp AS price_text,
       round(TRY_CAST(price_gbp AS DOUBLE), 6) AS price_num,
       round(TRY_CAST(rating_1to5 AS DOUBLE), 6) AS rating_num
FROM p""",
)
def q_parse_numeric(spark, sf):
    p = _products(spark, sf)
    return rounded(
        p.select(
            "ordinal",
            F.col("price_gbp").alias("price_text"),
            S.to_double("price_gbp").alias("price_num"),
            S.to_double("rating_1to5").alias("rating_num"),
        )
    )


@query(
    "parse_timestamp",
    """
SELECT event_id,
       TRY_CAST(CAST(ts AS VARCHAR) AS TIMESTAMP) AS ts_plain,
       TRY_CAST(concat(replace(CAST(ts AS VARCHAR), ' ', 'T'), 'Z') AS TIMESTAMP) AS ts_iso_z,
       TRY_CAST(CASE WHEN event_type = 'error' THEN 'not a time'
                     ELSE strftime(ts, '%Y-%m-%d %H:%M') END AS TIMESTAMP) AS ts_minute
FROM events""",
)
def q_parse_timestamp(spark, sf):
    ev = AD.table(spark, sf, "events")
    text = F.col("ts").cast("string")
    minute = F.when(F.col("event_type") == "error", F.lit("not a time")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm")
    )
    return rounded(
        ev.select(
            "event_id",
            S.to_utc_timestamp(text).alias("ts_plain"),
            S.to_utc_timestamp(F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("Z"))).alias(
                "ts_iso_z"
            ),
            S.to_utc_timestamp(minute).alias("ts_minute"),
        )
    )


@query(
    "plausibility_null",
    with_(W_SQL, W_PLAUSIBLE_SQL)
    + """
SELECT ordinal, round(temperature_2m, 6) AS temperature_2m,
       round(relative_humidity_2m, 6) AS relative_humidity_2m,
       round(precipitation, 6) AS precipitation, round(wind_speed_10m, 6) AS wind_speed_10m
FROM wp""",
)
def q_plausibility_null(spark, sf):
    w = _weather(spark, sf)
    return rounded(
        w.select(
            "ordinal",
            S.in_range_or_null("temperature_2m", *S.TEMPERATURE_RANGE).alias("temperature_2m"),
            S.in_range_or_null("relative_humidity_2m", *S.HUMIDITY_RANGE).alias("relative_humidity_2m"),
            S.non_negative_or_null("precipitation").alias("precipitation"),
            S.non_negative_or_null("wind_speed_10m").alias("wind_speed_10m"),
        )
    )


@query(
    "filter_price",
    with_(P_SQL, P_PARSED_SQL)
    + """
SELECT ordinal, round(price_gbp, 6) AS price_gbp FROM pp""",
)
def q_filter_price(spark, sf):
    p = _products(spark, sf)
    x = p.select("ordinal", S.to_double("price_gbp").alias("price_gbp"))
    return rounded(x.where(F.col("price_gbp").isNull() | (F.col("price_gbp") >= 0)))


@query(
    "normalize_url",
    with_(P_SQL)
    + """
SELECT ordinal, trim(coalesce(url, 'nan')) AS url,
       trim(coalesce(CASE WHEN availability = 'error' THEN NULL ELSE url END, 'nan')) AS url_or_token
FROM p""",
)
def q_normalize_url(spark, sf):
    p = _products(spark, sf)
    gappy = F.when(F.col("availability") == "error", F.lit(None)).otherwise(F.col("url"))
    return p.select(
        "ordinal",
        S.normalize_url("url").alias("url"),
        S.normalize_url(gappy).alias("url_or_token"),
    )


# --------------------------------------------------------- D: dedup / B


@query(
    "dedup_keep_last",
    with_(P_SQL)
    + """
SELECT url, scraped_at, ordinal, price_gbp, rating_1to5
FROM (SELECT *, row_number() OVER (PARTITION BY url, scraped_at ORDER BY ordinal DESC) AS rn FROM p)
WHERE rn = 1""",
)
def q_dedup_keep_last(spark, sf):
    p = _products(spark, sf).select("url", "scraped_at", "ordinal", "price_gbp", "rating_1to5")
    return rounded(C.keep_last(p, ["url", "scraped_at"], ["scraped_at", "ordinal"]))


@query(
    "dedup_keep_last_weather",
    with_(W_SQL)
    + """
SELECT city, time, ordinal, round(temperature_2m, 6) AS temperature_2m
FROM (SELECT *, row_number() OVER (PARTITION BY city, time ORDER BY ordinal DESC) AS rn FROM w)
WHERE rn = 1""",
)
def q_dedup_keep_last_weather(spark, sf):
    w = _weather(spark, sf).select("city", "time", "ordinal", "temperature_2m")
    return rounded(C.keep_last(w, ["city", "time"], ["time", "ordinal"]))


@query(
    "distinct_keys",
    with_(P_SQL) + "SELECT DISTINCT trim(url) AS url FROM p",
)
def q_distinct_keys(spark, sf):
    p = _products(spark, sf).select(S.normalize_url("url").alias("url"))
    return C.distinct_keys(p, ["url"])


@query(
    "clean_products",
    PRODUCTS
    + """
SELECT source, product_name, round(price_gbp, 6) AS price_gbp, availability,
       round(rating_1to5, 6) AS rating_1to5, url, scraped_at
FROM cp""",
)
def q_clean_products(spark, sf):
    return rounded(_clean_products(spark, sf))


@query(
    "clean_weather",
    WEATHER
    + """
SELECT city, time, round(temperature_2m, 6) AS temperature_2m,
       round(relative_humidity_2m, 6) AS relative_humidity_2m,
       round(precipitation, 6) AS precipitation, round(wind_speed_10m, 6) AS wind_speed_10m
FROM cw""",
)
def q_clean_weather(spark, sf):
    return rounded(_clean_weather(spark, sf))


# ----------------------------------------------------------- A: aggregates


DAILY_PRICE_SQL = (
    PRODUCTS
    + """
SELECT url, CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS day,
       round(min(price_gbp), 6) AS min_price, round(avg(price_gbp), 6) AS avg_price,
       round(max(price_gbp), 6) AS max_price,
       round(arg_max(price_gbp, scraped_at) FILTER (WHERE price_gbp IS NOT NULL), 6) AS last_price,
       count(*) AS n_obs
FROM cp WHERE url IS NOT NULL AND scraped_at IS NOT NULL
GROUP BY url, CAST(scraped_at AS DATE)"""
)


@query("daily_price", DAILY_PRICE_SQL)
def q_daily_price(spark, sf):
    return rounded(A.daily_price(_clean_products(spark, sf)))


@query(
    "last_non_null",
    with_(P_SQL, P_PARSED_SQL)
    + """
SELECT url, CAST(CAST(scraped_at AS DATE) AS VARCHAR) AS day,
       round(arg_max(price_gbp, ordinal) FILTER (WHERE price_gbp IS NOT NULL), 6) AS last_price
FROM pp GROUP BY url, CAST(scraped_at AS DATE)""",
)
def q_last_non_null(spark, sf):
    p = _products(spark, sf)
    x = p.select(
        S.normalize_url("url").alias("url"),
        F.to_date("scraped_at").alias("day"),
        "ordinal",
        S.to_double("price_gbp").alias("price_gbp"),
    ).where(F.col("price_gbp").isNull() | (F.col("price_gbp") >= 0))
    return rounded(x.groupBy("url", "day").agg(A.last_non_null("price_gbp", "ordinal").alias("last_price")))


DAILY_WEATHER_SQL = (
    WEATHER
    + """
SELECT city, CAST(CAST(time AS DATE) AS VARCHAR) AS day,
       round(avg(temperature_2m), 6) AS avg_temp, round(avg(relative_humidity_2m), 6) AS avg_rh,
       round(coalesce(sum(precipitation), 0), 6) AS total_precip,
       round(avg(wind_speed_10m), 6) AS avg_wind, count(*) AS n_obs
FROM cw WHERE city IS NOT NULL AND time IS NOT NULL
GROUP BY city, CAST(time AS DATE)"""
)


@query("daily_weather", DAILY_WEATHER_SQL)
def q_daily_weather(spark, sf):
    return rounded(A.daily_weather(_clean_weather(spark, sf)))


@query(
    "group_stats",
    WEATHER
    + """
SELECT city, round(avg(temperature_2m), 6) AS mean, round(stddev_pop(temperature_2m), 6) AS std
FROM cw WHERE city IS NOT NULL GROUP BY city""",
)
def q_group_stats(spark, sf):
    return rounded(A.group_stats(_clean_weather(spark, sf), ["city"], "temperature_2m"))


@query(
    "group_quartiles",
    WEATHER
    + """
SELECT city, round(quantile_cont(precipitation, 0.25), 6) AS q1,
       round(quantile_cont(precipitation, 0.75), 6) AS q3
FROM cw WHERE city IS NOT NULL AND precipitation IS NOT NULL GROUP BY city""",
)
def q_group_quartiles(spark, sf):
    return rounded(A.group_quartiles(_clean_weather(spark, sf), ["city"], "precipitation"))


# ----------------------------------------------------------- W: windows


@query(
    "price_delta",
    with_(PS_SQL)
    + """
SELECT url, scraped_at, round(price_gbp, 6) AS price_gbp, round(price_prev, 6) AS price_prev,
       round(price_gbp - price_prev, 6) AS delta
FROM (SELECT *, lag(price_gbp) OVER (PARTITION BY url
                                     ORDER BY scraped_at NULLS LAST, price_gbp NULLS LAST)
                AS price_prev FROM ps)""",
)
def q_price_delta(spark, sf):
    return rounded(N.price_delta(AD.price_series(AD.table(spark, sf, "events"))))


@query(
    "zscore_by_group",
    WEATHER
    + f"""
, s AS (SELECT city, avg(temperature_2m) AS m, stddev_pop(temperature_2m) AS sd
        FROM cw WHERE city IS NOT NULL GROUP BY city)
SELECT cw.city, cw.time, round(cw.temperature_2m, 6) AS temperature_2m,
       round({zsql('cw.temperature_2m', 's.m', 's.sd')}, 6) AS temp_z
FROM cw LEFT JOIN s ON cw.city = s.city""",
)
def q_zscore_by_group(spark, sf):
    x = _clean_weather(spark, sf).select("city", "time", "temperature_2m")
    return rounded(N.zscore_by_group(x, ["city"], "temperature_2m", out="temp_z"))


@query(
    "iqr_outlier",
    WEATHER
    + """
, q AS (SELECT city, quantile_cont(precipitation, 0.25) AS q1, quantile_cont(precipitation, 0.75) AS q3
        FROM cw WHERE city IS NOT NULL AND precipitation IS NOT NULL GROUP BY city)
SELECT cw.city, cw.time, round(cw.precipitation, 6) AS precipitation,
       CASE WHEN cw.city IS NULL THEN NULL
            ELSE NOT coalesce(cw.precipitation BETWEEN q.q1 - 1.5 * (q.q3 - q.q1)
                                                 AND q.q3 + 1.5 * (q.q3 - q.q1), false) END
         AS precip_outlier
FROM cw LEFT JOIN q ON cw.city = q.city""",
)
def q_iqr_outlier(spark, sf):
    x = _clean_weather(spark, sf).select("city", "time", "precipitation")
    return rounded(N.iqr_outlier(x, "precipitation", ["city"], out="precip_outlier"))


@query(
    "price_anomaly",
    with_(PS_SQL)
    + f"""
, d AS (SELECT url, scraped_at, price_gbp, price_prev, price_gbp - price_prev AS delta
        FROM (SELECT *, lag(price_gbp) OVER (PARTITION BY url
                                             ORDER BY scraped_at NULLS LAST, price_gbp NULLS LAST)
                        AS price_prev FROM ps))
, s AS (SELECT url, avg(delta) AS m, stddev_pop(delta) AS sd FROM d GROUP BY url)
, z AS (SELECT d.*, {zsql('d.delta', 's.m', 's.sd')} AS delta_z FROM d JOIN s ON d.url = s.url)
SELECT url, scraped_at, round(price_gbp, 6) AS price_gbp, round(price_prev, 6) AS price_prev,
       round(delta, 6) AS delta, round(delta_z, 6) AS delta_z
FROM z WHERE delta IS NOT NULL AND abs(delta_z) >= 3.0""",
)
def q_price_anomaly(spark, sf):
    return rounded(N.price_anomalies(AD.price_series(AD.table(spark, sf, "events"))))


WEATHER_ANOMALY_SQL = (
    WEATHER
    + f"""
, s AS (SELECT city, avg(temperature_2m) AS m, stddev_pop(temperature_2m) AS sd
        FROM cw WHERE city IS NOT NULL GROUP BY city)
, q AS (SELECT city, quantile_cont(precipitation, 0.25) AS q1, quantile_cont(precipitation, 0.75) AS q3
        FROM cw WHERE city IS NOT NULL AND precipitation IS NOT NULL GROUP BY city)
, x AS (SELECT cw.*, {zsql('cw.temperature_2m', 's.m', 's.sd')} AS temp_z,
               CASE WHEN cw.city IS NULL THEN NULL
                    ELSE NOT coalesce(cw.precipitation BETWEEN q.q1 - 1.5 * (q.q3 - q.q1)
                                                         AND q.q3 + 1.5 * (q.q3 - q.q1), false)
               END AS precip_outlier
        FROM cw LEFT JOIN s ON cw.city = s.city LEFT JOIN q ON cw.city = q.city)
SELECT city, time, round(temperature_2m, 6) AS temperature_2m, round(temp_z, 6) AS temp_z,
       round(precipitation, 6) AS precipitation, precip_outlier,
       round(wind_speed_10m, 6) AS wind_speed_10m
FROM x WHERE abs(temp_z) >= 3.0 OR precip_outlier"""
)


@query("weather_anomaly", WEATHER_ANOMALY_SQL)
def q_weather_anomaly(spark, sf):
    return rounded(N.weather_anomalies(_clean_weather(spark, sf)))
