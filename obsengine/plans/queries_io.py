"""Queries over sources, extraction, folder jobs and streaming operators."""

from __future__ import annotations

import posixpath
import uuid

from pyspark.sql import functions as F

from ..functions import markup as M
from ..functions import scalars as S
from ..functions.urls import resolve_url_sql, with_resolved_url
from ..operators import aggregate as A
from ..operators import clean as C
from ..session import checkpoint_dir
from ..sources import csvfolder as CF
from ..sources import listing as L
from ..sources import pages as PG
from ..sources import payloads as PL
from ..streaming import daily as SD
from ..streaming import watch as SW
from . import adapters as AD
from . import batch_job as BJ
from .queries_core import DAILY_PRICE_SQL, DAILY_WEATHER_SQL, PRODUCTS, WEATHER, zsql
from .registry import query, rounded

AS_OF = "2024-06-01 00:00:00"

# ------------------------------------------------------ pages (SQL twins)

SLUG_SQL = "lower(regexp_replace(trim({c}), '[^A-Za-z0-9]+', '-', 'g'))"

CARD_TRUTH_SQL = f"""
ct AS (
  SELECT p_partkey, p_brand, p_size,
         'https://shop.example/catalogue/category/books/' || {SLUG_SQL.format(c='p_brand')} || '/' AS source,
         CASE WHEN p_size % 7 = 0 THEN p_name || ' & Co' ELSE p_name END AS product_name,
         CASE WHEN p_size IN (1, 2) THEN NULL ELSE round(p_retailprice, 2) END AS price_gbp,
         CASE WHEN p_size % 2 = 0 THEN 'In stock' ELSE 'Out of stock' END AS availability,
         CASE WHEN p_size % 6 = 0 THEN NULL ELSE CAST(p_size % 6 AS INTEGER) END AS rating_1to5,
         'https://shop.example/catalogue/' || {SLUG_SQL.format(c='p_name')} || '_' || CAST(p_partkey AS VARCHAR)
           || '/index.html' AS url
  FROM part)"""


def _listing(spark, sf):
    return AD.listing_pages(AD.table(spark, sf, "part"))


@query(
    "html_card_extract",
    "WITH" + CARD_TRUTH_SQL + """
SELECT source, product_name, round(price_gbp, 6) AS price_gbp, availability, rating_1to5, url,
       TIMESTAMP '2024-06-01 00:00:00' AS scraped_at
FROM ct""",
)
def q_html_card_extract(spark, sf):
    cards = PG.product_cards(_listing(spark, sf), as_of=AS_OF)
    return rounded(cards.drop("page_id", "card_no"))


@query(
    "category_crawl",
    "WITH" + CARD_TRUTH_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM ct)
SELECT source || 'page-1.html' AS start_url, CAST(pos // 20 AS INTEGER) AS hop, source, product_name,
       round(price_gbp, 6) AS price_gbp, availability, rating_1to5, url,
       TIMESTAMP '2024-06-01 00:00:00' AS scraped_at
FROM r WHERE pos < 60""",
)
def q_category_crawl(spark, sf, max_pages=PG.MAX_PAGES):
    # Fetched pages live in a table: store the built listing pages first.
    path = _scratch(spark, "listing-pages")
    _listing(spark, sf).write.parquet(path)
    pages = spark.read.parquet(path)
    starts = pages.where(F.col("url").endswith("/page-1.html")).select(F.col("url").alias("start_url"))
    return rounded(PG.category_cards(pages, starts, max_pages, as_of=AS_OF))


@query(
    "category_crawl_whole",
    "WITH" + CARD_TRUTH_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM ct)
SELECT source || 'page-1.html' AS start_url, CAST(pos // 20 AS INTEGER) AS hop, source, product_name,
       round(price_gbp, 6) AS price_gbp, availability, rating_1to5, url,
       TIMESTAMP '2024-06-01 00:00:00' AS scraped_at
FROM r""",
)
def q_category_crawl_whole(spark, sf):
    return q_category_crawl(spark, sf, max_pages=None)


@query(
    "category_crawl_shared",
    "WITH" + CARD_TRUTH_SQL + """
, r AS (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM ct)
SELECT source || 'page-' || s || '.html' AS start_url, CAST(pos // 20 - s + 1 AS INTEGER) AS hop, source, product_name,
       round(price_gbp, 6) AS price_gbp, availability, rating_1to5, url,
       TIMESTAMP '2024-06-01 00:00:00' AS scraped_at
FROM r, (VALUES (1), (2)) AS t(s) WHERE pos // 20 - s + 1 BETWEEN 0 AND 2""",
)
def q_category_crawl_shared(spark, sf):
    """Crawls from the first and from the second page of each category: most
    pages are visited by both, and their cards belong to each visit once."""
    path = _scratch(spark, "listing-pages")
    _listing(spark, sf).write.parquet(path)
    pages = spark.read.parquet(path)
    starts = pages.where(F.col("url").rlike(r"/page-[12]\.html$")).select(F.col("url").alias("start_url"))
    return rounded(PG.category_cards(pages, starts, as_of=AS_OF))


@query(
    "price_text_parse",
    """
SELECT p_partkey,
       CASE WHEN p_size IN (1, 2) THEN NULL ELSE round(p_retailprice, 2) END AS price_strict,
       CASE WHEN p_size = 1 THEN NULL ELSE round(p_retailprice, 2) END AS price_lenient
FROM part""",
)
def q_price_text_parse(spark, sf):
    part = AD.table(spark, sf, "part")
    price = F.format_string("%.2f", F.col("p_retailprice"))
    price = F.when(F.col("p_size") % 5 == 0, F.replace(price, F.lit("."), F.lit(","))).otherwise(price)
    text = (
        F.when(F.col("p_size") == 1, F.lit(None).cast("string"))  # card without a price
        .when(F.col("p_size") == 2, F.concat(F.lit("Â£"), price))  # stray character before the sign
        .otherwise(F.concat(F.lit("£"), price))
    )
    return rounded(
        part.select(
            "p_partkey",
            S.price_text_to_double(text).alias("price_strict"),
            S.price_text_to_double(text, lenient=True).alias("price_lenient"),
        )
    )


@query(
    "rating_word_map",
    """
SELECT p_partkey, CASE WHEN p_size % 6 = 0 THEN NULL ELSE CAST(p_size % 6 AS INTEGER) END AS rating_1to5
FROM part""",
)
def q_rating_word_map(spark, sf):
    part = AD.table(spark, sf, "part")
    words = F.array(*[F.lit(w) for w in AD.RATING_WORD_CYCLE])
    word = F.element_at(words, (F.col("p_size") % 6 + 1).cast("int"))
    return part.select("p_partkey", S.rating_word_to_int(word).cast("int").alias("rating_1to5"))


@query(
    "next_page_link",
    """
WITH pg AS (
  SELECT p_brand, unnest(range(0, CAST(ceil(count(*) / 20.0) AS BIGINT))) AS page_no,
         CAST(ceil(count(*) / 20.0) AS BIGINT) AS n_pages
  FROM part GROUP BY p_brand)
SELECT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS BIGINT) * 1000000 + page_no AS page_id,
       'https://shop.example/catalogue/category/books/' || lower(regexp_replace(trim(p_brand), '[^A-Za-z0-9]+', '-', 'g'))
         || '/page-' || CAST(page_no + 1 AS VARCHAR) || '.html' AS url,
       CASE WHEN page_no + 1 < n_pages THEN
         'https://shop.example/catalogue/category/books/' || lower(regexp_replace(trim(p_brand), '[^A-Za-z0-9]+', '-', 'g'))
         || '/page-' || CAST(page_no + 2 AS VARCHAR) || '.html' END AS next_url
FROM pg""",
)
def q_next_page_link(spark, sf):
    return PG.next_links(_listing(spark, sf))


def _links_sql() -> str:
    return f"""
WITH l AS (
  SELECT page_id, url, generate_subscripts(hs, 1) - 1 AS link_no, unnest(hs) AS raw_href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a [^>]*href="([^"]*)"', 1) AS hs FROM pages)),
d AS (
  SELECT page_id, url, link_no,
         replace(replace(replace(replace(replace(replace(raw_href, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'),
                 '&#39;', ''''), '&apos;', ''''), '&amp;', '&') AS href
  FROM l)"""


@query(
    "page_links",
    _links_sql() + f"""
SELECT page_id, link_no, href, {resolve_url_sql('url', 'href')} AS link FROM d""",
)
def q_page_links(spark, sf):
    return PG.page_links(AD.table(spark, sf, "pages"))


# Reference forms derived from each page link: relative, dot segments,
# network-path, absolute, query-only, fragment-only and empty.
VARIANTS = (
    ("root", "{h}"),
    ("relative", "{t}"),
    ("parent", "../{t}"),
    ("dots", "./{t}/../x/./y"),
    ("deep_parent", "../../../../{t}"),
    ("network", "//cdn.example.com{h}"),
    ("absolute", "https://abs.example{h}"),
    ("query", "?q={t}"),
    ("fragment", "#{t}"),
    ("empty", ""),
)


def _variant_spark(tpl: str, h, t):
    parts, rest = [], tpl
    while rest:
        i = min([p for p in (rest.find("{h}"), rest.find("{t}")) if p >= 0], default=-1)
        if i < 0:
            parts.append(F.lit(rest))
            break
        if i:
            parts.append(F.lit(rest[:i]))
        parts.append(h if rest[i:i + 3] == "{h}" else t)
        rest = rest[i + 3:]
    return F.concat(*parts) if parts else F.lit("")


def _variant_sql(tpl: str) -> str:
    out = "'" + tpl.replace("'", "''") + "'"
    out = out.replace("{h}", "' || href || '").replace("{t}", "' || substr(href, 2) || '")
    return out


@query(
    "url_resolve",
    _links_sql() + """
, v AS (SELECT page_id, link_no, url, unnest([""" + ", ".join(f"'{k}'" for k, _ in VARIANTS) + """]) AS form,
               unnest([""" + ", ".join(_variant_sql(t) for _, t in VARIANTS) + f"""]) AS ref FROM d)
SELECT page_id, link_no, form, ref, {resolve_url_sql('url', 'ref')} AS resolved FROM v""",
)
def q_url_resolve(spark, sf):
    pages = AD.table(spark, sf, "pages")
    links = pages.select("page_id", "url", F.posexplode(M.anchors("html")).alias("link_no", "href"))
    links = links.withColumn("link_no", F.col("link_no").cast("bigint"))
    h = F.col("href")
    t = F.substring(h, 2, 1 << 30)
    forms = F.array(*[F.struct(F.lit(k).alias("form"), _variant_spark(tpl, h, t).alias("ref")) for k, tpl in VARIANTS])
    x = links.select("page_id", "link_no", "url", F.inline(forms))
    return with_resolved_url(x, "url", "ref", "resolved").select("page_id", "link_no", "form", "ref", "resolved")


# ------------------------------------------------------------- payloads


@query(
    "json_hourly_explode",
    """
WITH r AS (
  SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 48 AS chunk FROM events)
SELECT 'city_' || CAST(user_id AS VARCHAR) AS city, ts AS time,
       round(value - 60, 6) AS temperature_2m,
       round(CASE WHEN event_type = 'error' THEN NULL ELSE value / 10 END, 6) AS precipitation,
       round(CAST(json_extract_string(props, '$.k') AS DOUBLE), 6) AS relative_humidity_2m,
       round(CASE WHEN user_id % 17 <> 0 THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) / 4 END, 6)
         AS wind_speed_10m
FROM r WHERE (user_id + chunk) % 13 <> 0""",
)
def q_json_hourly_explode(spark, sf):
    payloads = AD.hourly_payloads(AD.table(spark, sf, "events"))
    rows, _rejects = PL.hourly_rows(payloads)
    return rounded(rows.withColumn("time", S.to_utc_timestamp("time")))


@query(
    "json_first_result",
    """
SELECT c_custkey AS query,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c_name END AS name,
       round(CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE c_acctbal / 100 END, 6) AS latitude,
       round(CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL ELSE CAST(c_nationkey AS DOUBLE) + 0.5 END, 6) AS longitude,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN NULL
            WHEN c_nationkey % 5 = 0 THEN '' ELSE n_name END AS country,
       CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'no result' ELSE 'ok' END AS status
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def q_json_first_result(spark, sf):
    payloads = AD.geocode_payloads(AD.table(spark, sf, "customer"), AD.table(spark, sf, "nation"))
    found, missing = PL.first_geocode(payloads)
    miss = missing.select(
        "query",
        F.lit(None).cast("string").alias("name"),
        F.lit(None).cast("double").alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("string").alias("country"),
        F.col("reason").alias("status"),
    )
    return rounded(found.withColumn("status", F.lit("ok")).unionByName(miss))


# ------------------------------------------------------ files and listings


@query(
    "latest_batch",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderdate,
       o_orderpriority
FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
)
def q_latest_batch(spark, sf):
    return rounded(CF.latest_batch(AD.table(spark, sf, "orders"), "o_orderdate"))


@query(
    "path_key_extract",
    """
SELECT o_orderkey, 'weather_hourly_' || n_name || '_' || strftime(o_orderdate, '%Y-%m-%d') || '.csv' AS file_name,
       n_name AS city, strftime(o_orderdate, '%Y-%m-%d') AS day
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
def q_path_key_extract(spark, sf):
    o = AD.table(spark, sf, "orders")
    c = AD.table(spark, sf, "customer")
    n = AD.table(spark, sf, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    name = F.concat(F.lit("weather_hourly_"), F.col("n_name"), F.lit("_"),
                    F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(".csv"))
    x = j.select("o_orderkey", name.alias("file_name"))
    return x.select(
        "o_orderkey",
        "file_name",
        CF.path_key("file_name").alias("city"),
        CF.path_key("file_name", CF.DATE_IN_NAME_RE).alias("day"),
    )


@query(
    "union_by_name",
    """
SELECT c_custkey AS key, c_name AS name, round(c_acctbal, 6) AS balance, c_mktsegment AS segment FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS key, s_name AS name, round(s_acctbal, 6) AS balance, s_nationkey AS nation FROM supplier""",
)
def q_union_by_name(spark, sf):
    c = AD.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"),
    )
    s = AD.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"),
    )
    return rounded(CF.union_by_name([c, s]))


@query(
    "snapshot_signature",
    """
WITH lines AS (SELECT concat_ws('|', p_name || '.csv', CAST(p_size AS VARCHAR), CAST(p_partkey AS VARCHAR)) AS line
               FROM part)
SELECT CAST(coalesce(sum(CAST(('0x' || substr(md5(line), 1, 12)) AS BIGINT)), 0) AS VARCHAR) AS signature,
       count(*) AS n_files
FROM lines""",
)
def q_snapshot_signature(spark, sf):
    part = AD.table(spark, sf, "part")
    lines = part.select(
        F.concat_ws("|", F.concat(F.col("p_name"), F.lit(".csv")), F.col("p_size").cast("string"),
                    F.col("p_partkey").cast("string")).alias("line")
    )
    return L.signature_of(lines)


# ------------------------------------------------------ batch job summary


def _scratch(spark, name: str) -> str:
    return posixpath.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def write_family_csvs(spark, sf: str, folder: str) -> None:
    """Write the adapters' rows as dated CSV family members: one products
    member, two weather members whose headers differ in column order (one
    with an extra column), all as Spark part-file directories."""
    ev = AD.table(spark, sf, "events")
    p = AD.price_obs(ev)
    p.write.option("header", "true").csv(posixpath.join(folder, "products_2024-01-31.csv"))
    w = AD.weather_obs(ev)
    north = w.where(F.col("city") < "city_5")
    south = w.where(F.col("city") >= "city_5")
    north.select("city", "time", "temperature_2m", "relative_humidity_2m", "precipitation", "wind_speed_10m",
                 "ordinal").write.option("header", "true").csv(
        posixpath.join(folder, "weather_hourly_north_2024-01-31.csv"))
    south.select("ordinal", F.lit("synthetic").alias("note"), "wind_speed_10m", "precipitation",
                 "relative_humidity_2m", "temperature_2m", "time", "city").write.option("header", "true").csv(
        posixpath.join(folder, "weather_hourly_south_2024-01-31.csv"))


PRICE_ALERTS_ON_CLEAN = f"""
, d AS (SELECT url, scraped_at, price_gbp, price_gbp - lag(price_gbp) OVER (
          PARTITION BY url ORDER BY scraped_at NULLS LAST, price_gbp NULLS LAST) AS delta FROM cp)
, s AS (SELECT url, avg(delta) AS m, stddev_pop(delta) AS sd FROM d GROUP BY url)
, pa AS (SELECT d.* FROM d JOIN s ON d.url = s.url
         WHERE delta IS NOT NULL AND abs({zsql('d.delta', 's.m', 's.sd')}) >= 3.0)
, dp AS (SELECT url, CAST(scraped_at AS DATE) AS day FROM cp WHERE url IS NOT NULL AND scraped_at IS NOT NULL
         GROUP BY ALL)"""

WEATHER_ALERTS_ON_CLEAN = f"""
, ws AS (SELECT city, avg(temperature_2m) AS m, stddev_pop(temperature_2m) AS sd FROM cw
         WHERE city IS NOT NULL GROUP BY city)
, wq AS (SELECT city, quantile_cont(precipitation, 0.25) AS q1, quantile_cont(precipitation, 0.75) AS q3
         FROM cw WHERE city IS NOT NULL AND precipitation IS NOT NULL GROUP BY city)
, wa AS (SELECT cw.* FROM cw LEFT JOIN ws ON cw.city = ws.city LEFT JOIN wq ON cw.city = wq.city
         WHERE abs({zsql('cw.temperature_2m', 'ws.m', 'ws.sd')}) >= 3.0
            OR (cw.city IS NOT NULL AND NOT coalesce(cw.precipitation BETWEEN wq.q1 - 1.5 * (wq.q3 - wq.q1)
                                                    AND wq.q3 + 1.5 * (wq.q3 - wq.q1), false)))
, dw AS (SELECT city, CAST(time AS DATE) AS day FROM cw WHERE city IS NOT NULL AND time IS NOT NULL GROUP BY ALL)"""


@query(
    "run_summary",
    PRODUCTS
    + PRICE_ALERTS_ON_CLEAN.replace("\n, d AS", ", d AS", 1)
    + ", " + WEATHER[len("WITH "):].rstrip("\n")
    + WEATHER_ALERTS_ON_CLEAN
    + """
SELECT 'products_curated' AS output, count(*) AS n_rows FROM cp
UNION ALL SELECT 'daily_price_stats', count(*) FROM dp
UNION ALL SELECT 'price_anomalies', count(*) FROM pa
UNION ALL SELECT 'weather_hourly_curated', count(*) FROM cw
UNION ALL SELECT 'weather_daily_stats', count(*) FROM dw
UNION ALL SELECT 'weather_anomalies', count(*) FROM wa""",
)
def q_run_summary(spark, sf):
    base = _scratch(spark, "run-summary")
    data, out = posixpath.join(base, "data"), posixpath.join(base, "out")
    write_family_csvs(spark, sf, data)
    return BJ.run_batch(spark, data, out, ordinal=lambda raw: F.struct(F.col("ordinal").cast("long")))


# ------------------------------------------------------------- streaming


@query("stream_recompute", DAILY_WEATHER_SQL)
def q_stream_recompute(spark, sf):
    base = _scratch(spark, "watch")
    out = posixpath.join(base, "out")

    def job():
        w = C.clean_weather(AD.weather_obs(AD.table(spark, sf, "events")), ordinal="ordinal")
        A.daily_weather(w).write.mode("overwrite").parquet(out)

    q = SW.watch(spark, sf, job, checkpoint=posixpath.join(base, "ckpt"), glob="*.parquet", available_now=True)
    q.awaitTermination()
    return rounded(spark.read.parquet(out))


@query("stream_daily_agg", DAILY_WEATHER_SQL)
def q_stream_daily_agg(spark, sf):
    base = _scratch(spark, "stream-daily")
    schema = AD.table(spark, sf, "events").schema
    src = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 1)
        .parquet(sf)
    )
    q = SD.stream_daily_weather(spark, AD.weather_obs(src), posixpath.join(base, "out"),
                                checkpoint=posixpath.join(base, "ckpt"))
    q.awaitTermination()
    return rounded(SD.read_daily(spark, posixpath.join(base, "out")))


@query("stream_daily_price", DAILY_PRICE_SQL)
def q_stream_daily_price(spark, sf):
    base = _scratch(spark, "stream-price")
    schema = AD.table(spark, sf, "events").schema
    src = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .option("maxFilesPerTrigger", 1)
        .parquet(sf)
    )
    q = SD.stream_daily_price(spark, AD.price_obs(src), posixpath.join(base, "out"),
                              checkpoint=posixpath.join(base, "ckpt"))
    q.awaitTermination()
    return rounded(SD.read_daily(spark, posixpath.join(base, "out"), family="products"))
