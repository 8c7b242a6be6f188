"""Queries over the warehouse, serving, quality and document operators."""

from __future__ import annotations

import posixpath
import uuid
from functools import partial

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import documents as D
from ..operators import quality as Q
from ..operators import upsert as U
from ..operators.ranking import dense_ids
from ..session import checkpoint_dir
from . import adapters as AD
from . import serving as SV
from . import standins as SI
from . import tables as TB
from .queries_core import P_SQL, W_SQL, with_
from .registry import ORACLE, query, rounded

# ---------------------------------------------------------------- SQL twins

LI_DESC = (
    "l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, "
    "l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC"
)

DIM_PRODUCT_SQL = """
dp AS (
  SELECT p_partkey AS product_id, concat('https://shop.example/p/', CAST(p_partkey AS VARCHAR)) AS url,
         p_name AS product_name, p_brand AS source,
         TIMESTAMP '2023-01-01 00:00:00' AS first_seen_at, TIMESTAMP '2023-01-01 00:00:00' AS last_seen_at
  FROM part WHERE p_size <= 30)"""

PRODUCT_BATCH_SQL = f"""
pb AS (
  SELECT url, product_name, source FROM (
    SELECT concat('https://shop.example/p/', CAST(l_partkey AS VARCHAR)) AS url,
           concat(p_name, ' #', CAST(l_linenumber AS VARCHAR)) AS product_name, p_type AS source,
           row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC, {LI_DESC}) AS rn
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size >= 20)
  WHERE rn = 1)"""

UPSERT_DIM_SQL = """
udp AS (
  SELECT dp.product_id, dp.url,
         CASE WHEN pb.url IS NOT NULL THEN pb.product_name ELSE dp.product_name END AS product_name,
         CASE WHEN pb.url IS NOT NULL THEN pb.source ELSE dp.source END AS source,
         dp.first_seen_at,
         CASE WHEN pb.url IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' ELSE dp.last_seen_at END
           AS last_seen_at
  FROM dp LEFT JOIN pb ON dp.url = pb.url
  UNION ALL
  SELECT (SELECT max(product_id) FROM dp) + row_number() OVER (ORDER BY url) AS product_id, url,
         product_name, source,
         TIMESTAMP '2024-06-01 00:00:00' AS first_seen_at, TIMESTAMP '2024-06-01 00:00:00' AS last_seen_at
  FROM pb WHERE url NOT IN (SELECT url FROM dp))"""

FACT_PRICE_SQL = f"""
fp AS (
  SELECT product_id, scraped_at, price_gbp, availability, rating_1to5 FROM (
    SELECT l_partkey AS product_id, l_shipdate AS scraped_at,
           CAST(l_extendedprice AS DECIMAL(10,2)) AS price_gbp, l_returnflag AS availability,
           CAST(CASE WHEN l_linenumber <= 5 THEN l_linenumber END AS SMALLINT) AS rating_1to5,
           row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY {LI_DESC}) AS rn
    FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')
  WHERE rn = 1)"""

PRICE_BATCH_SQL = """
prb AS (
  SELECT concat('https://shop.example/p/', CAST(l_partkey AS VARCHAR)) AS url, l_shipdate AS scraped_at,
         CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS price_gbp,
         l_linestatus AS availability, CAST(l_linenumber AS DOUBLE) AS rating_1to5,
         l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')"""

CONFORM_SQL = """
prc AS (
  SELECT url, scraped_at, CAST(price_gbp AS DECIMAL(10,2)) AS price_gbp, availability,
         CAST(CASE WHEN rating_1to5 BETWEEN 1 AND 5 THEN rating_1to5 END AS SMALLINT) AS rating_1to5,
         l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus
  FROM prb WHERE price_gbp IS NULL OR price_gbp >= 0)"""

UPSERT_FACT_SQL = f"""
fb AS (
  SELECT product_id, scraped_at, price_gbp, availability, rating_1to5 FROM (
    SELECT dp.product_id, prc.*,
           row_number() OVER (PARTITION BY dp.product_id, prc.scraped_at ORDER BY {LI_DESC}) AS rn
    FROM prc JOIN dp ON prc.url = dp.url)
  WHERE rn = 1),
ufp AS (
  SELECT fp.product_id, fp.scraped_at,
         CASE WHEN fb.product_id IS NOT NULL THEN fb.price_gbp ELSE fp.price_gbp END AS price_gbp,
         CASE WHEN fb.product_id IS NOT NULL THEN fb.availability ELSE fp.availability END AS availability,
         CASE WHEN fb.product_id IS NOT NULL THEN fb.rating_1to5 ELSE fp.rating_1to5 END AS rating_1to5
  FROM fp LEFT JOIN fb ON fp.product_id = fb.product_id AND fp.scraped_at = fb.scraped_at
  UNION ALL
  SELECT * FROM fb
  WHERE NOT EXISTS (SELECT 1 FROM fp WHERE fp.product_id = fb.product_id AND fp.scraped_at = fb.scraped_at))"""

DIM_CITY_SQL = """
dc AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS country,
         CAST(n_nationkey * 3 - 40 AS DECIMAL(8,5)) AS latitude,
         CAST(n_nationkey * 7 AS DECIMAL(8,5)) AS longitude
  FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey <= 2)"""

CITY_BATCH_SQL = """
cb AS (
  SELECT city_name, country, latitude, longitude FROM (
    SELECT n_name AS city_name, coalesce(CASE WHEN n_regionkey = 0 THEN NULL ELSE r_name END, '') AS country,
           c_acctbal / 100 AS latitude, c_acctbal / 10 AS longitude,
           row_number() OVER (PARTITION BY n_name,
                              coalesce(CASE WHEN n_regionkey = 0 THEN NULL ELSE r_name END, '')
                              ORDER BY c_custkey DESC) AS rn
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
  WHERE rn = 1)"""

WEATHER_ROWS_SQL = """
wr AS (
  SELECT CAST(c_nationkey AS BIGINT) AS city_id, date_trunc('hour', ts) AS time_at, value,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, event_id, ts
  FROM events JOIN customer ON user_id = c_custkey)"""

FACT_WEATHER_SQL = """
fw AS (
  SELECT city_id, time_at, CAST(value - 60 AS DECIMAL(5,2)) AS temperature_2m,
         CAST(k AS DECIMAL(5,2)) AS relative_humidity_2m, CAST(value AS DECIMAL(6,2)) AS precipitation,
         CAST(k / 2 AS DECIMAL(6,2)) AS wind_speed_10m
  FROM (SELECT *, row_number() OVER (PARTITION BY city_id, time_at ORDER BY event_id DESC) AS rn
        FROM wr WHERE ts < TIMESTAMP '2024-01-20')
  WHERE rn = 1)"""

WEATHER_BATCH_SQL = """
wb AS (
  SELECT city_id, time_at, CAST(value - 50 AS DECIMAL(5,2)) AS temperature_2m,
         CAST(k AS DECIMAL(5,2)) AS relative_humidity_2m, CAST(value AS DECIMAL(6,2)) AS precipitation,
         CAST(k / 2 AS DECIMAL(6,2)) AS wind_speed_10m, event_id
  FROM wr WHERE ts >= TIMESTAMP '2024-01-15')"""


def dbl(c: str) -> str:
    return f"round(CAST({c} AS DOUBLE), 6) AS {c}"


DIM_OUT = "product_id, url, product_name, source, first_seen_at, last_seen_at"
FACT_OUT = f"product_id, scraped_at, {dbl('price_gbp')}, availability, rating_1to5"
CITY_OUT = f"city_id, city_name, country, {dbl('latitude')}, {dbl('longitude')}"
WEATHER_OUT = (
    f"city_id, time_at, {dbl('temperature_2m')}, {dbl('relative_humidity_2m')}, "
    f"{dbl('precipitation')}, {dbl('wind_speed_10m')}"
)

# ------------------------------------------------------------ M: upserts


@query("upsert_dim", with_(DIM_PRODUCT_SQL, PRODUCT_BATCH_SQL, UPSERT_DIM_SQL) + f"SELECT {DIM_OUT} FROM udp")
def q_upsert_dim(spark, sf):
    out = U.upsert_dim_product(
        SI.dim_product(spark, sf), SI.product_batch(spark, sf), SI.AS_OF, batch_order=["l_shipdate", *SI.LINEITEM_ORDER]
    )
    return rounded(out)


@query(
    "upsert_fact",
    with_(DIM_PRODUCT_SQL, FACT_PRICE_SQL, PRICE_BATCH_SQL, CONFORM_SQL, UPSERT_FACT_SQL)
    + f"SELECT {FACT_OUT} FROM ufp",
)
def q_upsert_fact(spark, sf):
    out = U.upsert_fact_price(
        SI.fact_price(spark, sf), SI.dim_product(spark, sf), SI.price_batch(spark, sf), SI.LINEITEM_ORDER
    )
    return rounded(out)


@query(
    "upsert_city",
    with_(DIM_CITY_SQL, CITY_BATCH_SQL)
    + f"""
, uc AS (
  SELECT dc.city_id, dc.city_name, dc.country,
         CASE WHEN cb.city_name IS NOT NULL THEN CAST(cb.latitude AS DECIMAL(8,5)) ELSE dc.latitude END
           AS latitude,
         CASE WHEN cb.city_name IS NOT NULL THEN CAST(cb.longitude AS DECIMAL(8,5)) ELSE dc.longitude END
           AS longitude
  FROM dc LEFT JOIN cb ON dc.city_name = cb.city_name AND dc.country = cb.country
  UNION ALL
  SELECT (SELECT max(city_id) FROM dc) + row_number() OVER (ORDER BY city_name, country), city_name,
         country, CAST(latitude AS DECIMAL(8,5)), CAST(longitude AS DECIMAL(8,5))
  FROM cb WHERE NOT EXISTS (SELECT 1 FROM dc WHERE dc.city_name = cb.city_name AND dc.country = cb.country))
SELECT {CITY_OUT} FROM uc""",
)
def q_upsert_city(spark, sf):
    out = U.upsert_dim_city(SI.dim_city(spark, sf), SI.city_batch(spark, sf), batch_order=["c_custkey"])
    return rounded(out)


@query(
    "upsert_weather_fact",
    with_(WEATHER_ROWS_SQL, FACT_WEATHER_SQL, WEATHER_BATCH_SQL)
    + f"""
, wbl AS (SELECT * EXCLUDE (rn, event_id) FROM (
            SELECT *, row_number() OVER (PARTITION BY city_id, time_at ORDER BY event_id DESC) AS rn FROM wb)
          WHERE rn = 1)
, uw AS (
  SELECT fw.city_id, fw.time_at,
         CASE WHEN wbl.city_id IS NOT NULL THEN wbl.temperature_2m ELSE fw.temperature_2m END AS temperature_2m,
         CASE WHEN wbl.city_id IS NOT NULL THEN wbl.relative_humidity_2m ELSE fw.relative_humidity_2m END
           AS relative_humidity_2m,
         CASE WHEN wbl.city_id IS NOT NULL THEN wbl.precipitation ELSE fw.precipitation END AS precipitation,
         CASE WHEN wbl.city_id IS NOT NULL THEN wbl.wind_speed_10m ELSE fw.wind_speed_10m END AS wind_speed_10m
  FROM fw LEFT JOIN wbl ON fw.city_id = wbl.city_id AND fw.time_at = wbl.time_at
  UNION ALL
  SELECT * FROM wbl
  WHERE NOT EXISTS (SELECT 1 FROM fw WHERE fw.city_id = wbl.city_id AND fw.time_at = wbl.time_at))
SELECT {WEATHER_OUT} FROM uw""",
)
def q_upsert_weather_fact(spark, sf):
    out = U.upsert_fact_weather(SI.fact_weather(spark, sf), SI.weather_batch(spark, sf), batch_order=["event_id"])
    return rounded(out)


LITERAL_ROWS = [
    (SI.URL_BASE + "5", "Sample product 5", "shop.example"),
    (SI.URL_BASE + "999999", "Sample product 999999", "shop.example"),
]


@query(
    "upsert_literal",
    with_(DIM_PRODUCT_SQL)
    + f"""
, lit(url, product_name, source) AS (
  VALUES ('https://shop.example/p/5', 'Sample product 5', 'shop.example'),
         ('https://shop.example/p/999999', 'Sample product 999999', 'shop.example'))
, ul AS (
  SELECT dp.product_id, dp.url, coalesce(lit.product_name, dp.product_name) AS product_name,
         coalesce(lit.source, dp.source) AS source, dp.first_seen_at,
         CASE WHEN lit.url IS NOT NULL THEN TIMESTAMP '2024-06-01 00:00:00' ELSE dp.last_seen_at END
           AS last_seen_at
  FROM dp LEFT JOIN lit ON dp.url = lit.url
  UNION ALL
  SELECT (SELECT max(product_id) FROM dp) + row_number() OVER (ORDER BY url), url, product_name, source,
         TIMESTAMP '2024-06-01 00:00:00', TIMESTAMP '2024-06-01 00:00:00'
  FROM lit WHERE url NOT IN (SELECT url FROM dp))
SELECT {DIM_OUT} FROM ul""",
)
def q_upsert_literal(spark, sf, whole=False):
    batch = spark.createDataFrame(LITERAL_ROWS, "url string, product_name string, source string")
    return rounded(U.upsert_dim_product(SI.dim_product(spark, sf, whole), batch, SI.AS_OF))


@query(
    "update_where",
    with_(DIM_PRODUCT_SQL)
    + f"""
SELECT product_id, url,
       CASE WHEN source = 'Brand#13' THEN concat('[ADJ] ', product_name) ELSE product_name END AS product_name,
       source, first_seen_at,
       CASE WHEN source = 'Brand#13' THEN TIMESTAMP '2024-06-01 00:00:00' ELSE last_seen_at END AS last_seen_at
FROM dp""",
)
def q_update_where(spark, sf, whole=False):
    dim = SI.dim_product(spark, sf, whole)
    out = U.update_where(
        dim,
        F.col("source") == "Brand#13",
        {"product_name": S.prefixed("[ADJ] ", "product_name"), "last_seen_at": SI.ts(SI.AS_OF)},
    )
    return rounded(out)


@query(
    "delete_using",
    with_(WEATHER_ROWS_SQL, FACT_WEATHER_SQL)
    + f"""
SELECT {WEATHER_OUT} FROM fw
WHERE NOT EXISTS (SELECT 1 FROM nation c
                  WHERE fw.city_id = c.n_nationkey AND c.n_name = 'NATION_3'
                    AND CAST(fw.time_at AS DATE) = DATE '2024-01-17' - INTERVAL 7 DAY)""",
)
def q_delete_using(spark, sf, whole=False):
    fw = SI.fact_weather(spark, sf, whole)
    city = AD.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"), F.col("n_name").alias("city_name")
    )
    day = F.date_sub(F.lit("2024-01-17").cast("date"), 7)
    doomed = fw.join(city, "city_id").where((F.col("city_name") == "NATION_3") & (F.to_date("time_at") == day))
    return rounded(U.delete_using(fw, doomed.select("city_id", "time_at"), ["city_id", "time_at"]))


# -------------------------------------------------------------- J: joins


@query(
    "key_lookup",
    with_(DIM_PRODUCT_SQL, PRICE_BATCH_SQL)
    + """
SELECT dp.product_id, prb.url, prb.scraped_at, round(prb.price_gbp, 6) AS price_gbp, prb.l_orderkey,
       prb.l_linenumber, prb.l_suppkey
FROM prb JOIN dp ON prb.url = dp.url""",
)
def q_key_lookup(spark, sf, whole=False):
    b = SI.price_batch(spark, sf, whole).select("url", "scraped_at", "price_gbp", "l_orderkey", "l_linenumber", "l_suppkey")
    return rounded(U.lookup_key(b, SI.dim_product(spark, sf, whole), "url", "product_id"))


@query(
    "semi_filter",
    with_(DIM_PRODUCT_SQL, PRODUCT_BATCH_SQL)
    + f"SELECT {DIM_OUT} FROM dp WHERE url IN (SELECT url FROM pb)",
)
def q_semi_filter(spark, sf, whole=False):
    members = SI.product_batch(spark, sf, whole).select("url")
    return rounded(U.semi_filter(SI.dim_product(spark, sf, whole), members, "url"))


@query(
    "surrogate_key",
    with_(DIM_PRODUCT_SQL, PRODUCT_BATCH_SQL)
    + """
SELECT (SELECT max(product_id) FROM dp) + row_number() OVER (ORDER BY url) AS product_id, url
FROM pb WHERE url NOT IN (SELECT url FROM dp)""",
)
def q_surrogate_key(spark, sf):
    dim = SI.dim_product(spark, sf)
    new = SI.product_batch(spark, sf).select("url").distinct().join(dim.select("url"), "url", "left_anti")
    start = U._next_id(dim, "product_id")
    return dense_ids(new, ["url"], start=start, id_col="product_id")


@query(
    "city_lookup",
    with_(DIM_CITY_SQL, CITY_BATCH_SQL)
    + """
, ids AS (SELECT city_name, count(*) AS m, min(city_id) AS city_id FROM dc GROUP BY city_name)
SELECT cb.city_name, cb.country, CASE WHEN ids.m = 1 THEN ids.city_id END AS city_id,
       CASE WHEN ids.m IS NULL THEN 'no match' WHEN ids.m > 1 THEN 'ambiguous' ELSE 'ok' END AS status
FROM cb LEFT JOIN ids ON cb.city_name = ids.city_name""",
)
def q_city_lookup(spark, sf):
    dim = SI.dim_city(spark, sf)
    b = SI.city_batch(spark, sf).withColumn("country", S.fill_default("country", ""))
    b = U.keep_last(b, ["city_name", "country"], ["c_custkey"]).select("city_name", "country")
    ok, bad = U.lookup_single_key(b, dim, "city_name", "city_id")
    return ok.select("city_name", "country", "city_id", F.lit("ok").alias("status")).unionByName(
        bad.select("city_name", "country", F.lit(None).cast("bigint").alias("city_id"), F.col("reason").alias("status"))
    )


# ------------------------------------------------- P7 / P9 / C: conformance


@query(
    "fact_conform",
    with_(PRICE_BATCH_SQL, CONFORM_SQL)
    + """
SELECT url, scraped_at, l_orderkey, l_linenumber, l_suppkey, round(CAST(price_gbp AS DOUBLE), 6) AS price_gbp,
       rating_1to5
FROM prc""",
)
def q_fact_conform(spark, sf, whole=False):
    c = U.conform_price_rows(SI.price_batch(spark, sf, whole))
    return rounded(c.select("url", "scraped_at", "l_orderkey", "l_linenumber", "l_suppkey", "price_gbp", "rating_1to5"))


@query(
    "fill_default",
    with_(CITY_BATCH_SQL) + "SELECT city_name, country, round(latitude, 6) AS latitude FROM cb",
)
def q_fill_default(spark, sf):
    b = SI.city_batch(spark, sf).withColumn("country", S.fill_default("country", ""))
    b = U.keep_last(b, ["city_name", "country"], ["c_custkey"])
    return rounded(b.select("city_name", "country", "latitude"))


@query(
    "constraint_report",
    with_(DIM_PRODUCT_SQL, PRICE_BATCH_SQL)
    + """
, raw AS (SELECT prb.*, dp.product_id AS known FROM prb LEFT JOIN dp ON prb.url = dp.url)
SELECT 'price_batch' AS table_name, rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'not_null(url)' AS rule, count(*) FILTER (WHERE url IS NULL) AS violations FROM raw
  UNION ALL SELECT 'check(price_gbp >= 0)', count(*) FILTER (WHERE price_gbp < 0) FROM raw
  UNION ALL SELECT 'check(rating_1to5 between 1 and 5)',
                   count(*) FILTER (WHERE NOT (rating_1to5 BETWEEN 1 AND 5)) FROM raw
  UNION ALL SELECT 'numeric(price_gbp,7,2)', count(*) FILTER (WHERE abs(price_gbp) >= 100000) FROM raw
  UNION ALL SELECT 'unique(url,scraped_at)', coalesce(sum(n - 1), 0) FROM (
              SELECT count(*) AS n FROM raw GROUP BY url, scraped_at)
  UNION ALL SELECT 'foreign_key(url)', count(*) FILTER (WHERE known IS NULL) FROM raw)""",
)
def q_constraint_report(spark, sf, whole=False):
    b = SI.price_batch(spark, sf, whole)
    rules = [
        Q.not_null("url"),
        Q.in_range("price_gbp", lo=0),
        Q.in_range("rating_1to5", 1, 5),
        Q.fits_decimal("price_gbp", 7, 2),
        Q.unique("url", "scraped_at"),
        Q.foreign_key(["url"], SI.dim_product(spark, sf, whole)),
    ]
    return Q.constraint_report(b, rules, table="price_batch")


# ------------------------------------------------------------ serving reads


LATEST_SQL = f"""
lp AS (
  SELECT DISTINCT ON (l_partkey) p_partkey AS product_id, p_name AS product_name,
         concat('https://shop.example/p/', CAST(p_partkey AS VARCHAR)) AS url,
         l_shipdate AS scraped_at, l_extendedprice AS price_gbp, l_returnflag AS availability,
         l_linenumber AS rating_1to5
  FROM part JOIN lineitem ON p_partkey = l_partkey
  ORDER BY l_partkey, l_shipdate DESC, {LI_DESC})"""


def _latest(spark, sf):
    part = AD.table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        SI.product_url("p_partkey").alias("url"),
    )
    fact = AD.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.col("l_shipdate").alias("scraped_at"),
        F.col("l_extendedprice").alias("price_gbp"),
        F.col("l_returnflag").alias("availability"),
        F.col("l_linenumber").alias("rating_1to5"),
        *SI.LINEITEM_ORDER,
    )
    out = SV.latest_price(part, fact, tie_break=SI.LINEITEM_ORDER)
    return out.select("product_id", "product_name", "url", "scraped_at", "price_gbp", "availability", "rating_1to5")


@query(
    "latest_price",
    with_(LATEST_SQL)
    + "SELECT product_id, product_name, url, scraped_at, round(price_gbp, 6) AS price_gbp, availability, "
    "rating_1to5 FROM lp",
)
def q_latest_price(spark, sf):
    return rounded(_latest(spark, sf))


@query(
    "topk_latest",
    with_(LATEST_SQL)
    + "SELECT product_id, product_name, url, scraped_at, round(price_gbp, 6) AS price_gbp, availability, "
    "rating_1to5 FROM lp ORDER BY product_id LIMIT 20",
)
def q_topk_latest(spark, sf):
    return rounded(SV.top_k(_latest(spark, sf), ["product_id"], 20))


@query(
    "table_counts",
    """
SELECT 'dim_product' AS table_name, count(*) AS n_rows FROM part
UNION ALL SELECT 'fact_price', count(*) FROM lineitem
UNION ALL SELECT 'dim_city', count(*) FROM nation
UNION ALL SELECT 'fact_weather_hourly', count(*) FROM events""",
)
def q_table_counts(spark, sf):
    t = {
        "dim_product": AD.table(spark, sf, "part"),
        "fact_price": AD.table(spark, sf, "lineitem"),
        "dim_city": AD.table(spark, sf, "nation"),
        "fact_weather_hourly": AD.table(spark, sf, "events"),
    }
    return SV.table_counts(t)


@query(
    "table_sample",
    """
SELECT * FROM (SELECT 'part' AS table_name, p_partkey AS k, p_name AS label FROM part ORDER BY p_partkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation ORDER BY n_nationkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'customer', c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'orders', o_orderkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 5)""",
)
def q_table_sample(spark, sf):
    specs = [
        ("part", "p_partkey", "p_name"),
        ("nation", "n_nationkey", "n_name"),
        ("customer", "c_custkey", "c_name"),
        ("orders", "o_orderkey", "o_orderstatus"),
    ]
    parts = [
        SV.table_sample(AD.table(spark, sf, t), [k]).select(
            F.lit(t).alias("table_name"), F.col(k).cast("bigint").alias("k"), F.col(lab).alias("label")
        )
        for t, k, lab in specs
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query(
    "hourly_city_avg",
    with_(WEATHER_ROWS_SQL, FACT_WEATHER_SQL)
    + """
SELECT CAST(n_name AS VARCHAR) AS city, date_trunc('hour', time_at) AS hour_bucket,
       round(CAST(avg(temperature_2m) AS DOUBLE), 6) AS avg_temp,
       round(CAST(avg(relative_humidity_2m) AS DOUBLE), 6) AS avg_rh,
       round(CAST(sum(precipitation) AS DOUBLE), 6) AS rain
FROM fw JOIN nation ON fw.city_id = n_nationkey
WHERE CAST(time_at AS DATE) = DATE '2024-01-10'
GROUP BY n_name, date_trunc('hour', time_at)""",
)
def q_hourly_city_avg(spark, sf, whole=False):
    fw = SI.fact_weather(spark, sf, whole)
    city = AD.table(spark, sf, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("city_id"), F.col("n_name").alias("city_name")
    )
    out = SV.hourly_city_avg(fw, city, "2024-01-10")
    return rounded(out.select("city", "hour_bucket", *[F.col(c).cast("double").alias(c) for c in ("avg_temp", "avg_rh", "rain")]))


# ------------------------------------------------------------- documents

DOC_A = "2024-01-16"  # first load: events before this day; second: from Jan 10 on


def _price_loads(spark, sf):
    p = AD.price_obs(AD.table(spark, sf, "events"))
    p = p.withColumn("url", S.normalize_url("url")).withColumn("price_gbp", S.to_double("price_gbp"))
    cut = F.lit(DOC_A).cast("timestamp_ntz")
    return p.where(F.col("scraped_at") < cut), p.where(F.col("scraped_at") >= F.lit("2024-01-10").cast("timestamp_ntz"))


@query(
    "documents_history",
    with_(P_SQL)
    + """
, pq AS (SELECT trim(url) AS url, product_name, source, TRY_CAST(price_gbp AS DOUBLE) AS price_gbp,
                scraped_at, ordinal FROM p)
, la AS (SELECT *, 0 AS load_no FROM pq WHERE scraped_at < TIMESTAMP '2024-01-16')
, lb AS (SELECT *, 1 AS load_no FROM pq WHERE scraped_at >= TIMESTAMP '2024-01-10')
, h AS (SELECT * FROM la UNION ALL SELECT * FROM lb)
, heads AS (
  SELECT url, arg_max(product_name, load_no * 1000000000 + ordinal) AS product_name,
         arg_max(source, load_no * 1000000000 + ordinal) AS source,
         CASE WHEN min(load_no) = 0 THEN TIMESTAMP '2024-01-16 00:00:00'
              ELSE TIMESTAMP '2024-06-01 00:00:00' END AS created_at
  FROM h GROUP BY url)
, s AS (
  SELECT url, count(*) AS n_prices,
         arg_min(scraped_at, (load_no, scraped_at, ordinal)) AS first_scraped_at,
         arg_max(scraped_at, (load_no, scraped_at, ordinal)) AS last_scraped_at,
         arg_max_null(price_gbp, (load_no, scraped_at, ordinal)) AS last_price
  FROM h GROUP BY url)
SELECT heads.url, product_name, source, created_at, n_prices, first_scraped_at, last_scraped_at,
       round(last_price, 6) AS last_price
FROM heads JOIN s ON heads.url = s.url""",
)
def q_documents_history(spark, sf):
    # Two loads, each written as a table version and read back by the next,
    # as the document load job does (lineage cut at every version).
    a, b = _price_loads(spark, sf)
    root = posixpath.join(checkpoint_dir(spark), f"documents-{uuid.uuid4().hex}")
    for batch, as_of, batch_id in ((a, "2024-01-16 00:00:00", "load-a"), (b, SI.AS_OF, "load-b")):
        heads = TB.read_current(spark, root, "product_heads", D.PRODUCT_HEAD)
        hist = TB.read_current(spark, root, "price_history", D.PRICE_HISTORY)
        heads, hist = D.upsert_product_docs(heads, hist, batch, as_of, batch_id, ["ordinal"])
        TB.write_version(heads, root, "product_heads")
        TB.write_version(hist, root, "price_history")
    heads = TB.read_current(spark, root, "product_heads", D.PRODUCT_HEAD)
    hist = TB.read_current(spark, root, "price_history", D.PRICE_HISTORY)
    return rounded(D.history_summary(heads, hist))


@query(
    "documents_weather",
    with_(W_SQL)
    + """
, wa AS (SELECT * FROM w WHERE time < TIMESTAMP '2024-01-16')
, wb AS (SELECT * FROM w WHERE time >= TIMESTAMP '2024-01-10')
, da AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, time ORDER BY ordinal DESC) rn
                                     FROM wa) WHERE rn = 1)
, db AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY city, time ORDER BY ordinal DESC) rn
                                     FROM wb) WHERE rn = 1)
SELECT city, time, round(temperature_2m, 6) AS temperature_2m,
       round(relative_humidity_2m, 6) AS relative_humidity_2m, round(precipitation, 6) AS precipitation,
       round(wind_speed_10m, 6) AS wind_speed_10m
FROM (SELECT * FROM db
      UNION ALL SELECT * FROM da WHERE NOT EXISTS (SELECT 1 FROM db WHERE db.city = da.city AND db.time = da.time))""",
)
def q_documents_weather(spark, sf):
    w = AD.weather_obs(AD.table(spark, sf, "events"))
    a = w.where(F.col("time") < F.lit("2024-01-16").cast("timestamp_ntz"))
    b = w.where(F.col("time") >= F.lit("2024-01-10").cast("timestamp_ntz"))
    docs = D.weather_documents_from(a, ["ordinal"])
    return rounded(D.upsert_weather_docs(docs, b, order=["time", "ordinal"]).drop("ordinal"))


# ---------------------------------------------------------- whole tables

# The operators above that need no split of existing and new rows, over all rows.
CUTS = (
    " WHERE p_size <= 30",
    " WHERE p_size >= 20",
    " WHERE l_shipdate >= TIMESTAMP '1998-01-01'",
    " WHERE ts < TIMESTAMP '2024-01-20'",
)


def uncut(sql: str) -> str:
    for cut in CUTS:
        sql = sql.replace(cut, "")
    return sql


for _name, _fn in (
    ("fact_conform", q_fact_conform),
    ("key_lookup", q_key_lookup),
    ("constraint_report", q_constraint_report),
    ("update_where", q_update_where),
    ("semi_filter", q_semi_filter),
    ("upsert_literal", q_upsert_literal),
    ("hourly_city_avg", q_hourly_city_avg),
    ("delete_using", q_delete_using),
):
    query(f"{_name}_whole", uncut(ORACLE[_name]))(partial(_fn, whole=True))
