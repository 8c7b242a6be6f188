"""Adapters: observation-shaped inputs derived from the driver's tables.

The driver tables are clean, so these derive observation streams with
deterministic dirt (out-of-range values, negative prices, bad text,
padded urls, duplicate (key, hour) rows) using expressions that the SQL
oracle writes the same way.  Each adapter reads a whole table; its work
grows with the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def weather_obs(events: DataFrame) -> DataFrame:
    """Hourly weather readings: 20 cities, hour-truncated times (so several
    readings share a (city, time) key), ordinal = event_id.

    Out-of-range values: temperature above 80, humidity above 100, negative
    precipitation and wind; precipitation is missing for 'error' events.
    """
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.concat(F.lit("city_"), (F.col("user_id") % 20).cast("string")).alias("city"),
        F.date_trunc("hour", "ts").alias("time"),
        F.col("event_id").alias("ordinal"),
        (F.col("value") - 60).alias("temperature_2m"),
        (k * 1.2).alias("relative_humidity_2m"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double"))
        .when(F.col("event_type") == "click", F.lit(0.0))
        .otherwise(F.col("value") - 5)
        .alias("precipitation"),
        (F.col("value") / 10 - 0.5).alias("wind_speed_10m"),
    )


def price_obs(events: DataFrame) -> DataFrame:
    """Raw product price rows as text, one product per user: padded urls,
    hour-truncated scrape times (duplicate keys), prices as text with
    junk ('n/a') and negative values, ratings '0'..'6' (0 and 6 invalid).
    """
    v = F.col("value").cast("string")
    price = (
        F.when(F.col("event_id") % 50 == 0, F.lit("n/a"))
        .when(F.col("event_id") % 37 == 0, F.concat(F.lit("-"), v))
        .otherwise(v)
    )
    return events.select(
        F.lit("events").alias("source"),
        F.concat(F.lit("Product "), F.col("user_id").cast("string")).alias("product_name"),
        price.alias("price_gbp"),
        F.col("event_type").alias("availability"),
        (F.col("event_id") % 7).cast("string").alias("rating_1to5"),
        F.concat(F.lit("  p_"), F.col("user_id").cast("string"), F.lit(" ")).alias("url"),
        F.date_trunc("hour", "ts").alias("scraped_at"),
        F.col("event_id").alias("ordinal"),
    )


def price_series(events: DataFrame) -> DataFrame:
    """Clean price series: one product per user, every event a price."""
    return events.select(
        F.concat(F.lit("p_"), F.col("user_id").cast("string")).alias("url"),
        F.col("ts").alias("scraped_at"),
        F.col("value").alias("price_gbp"),
    )


# ------------------------------------------------------------------ pages

SHOP = "https://shop.example/catalogue/"
CARDS_PER_PAGE = 20
RATING_WORD_CYCLE = ("Zero", "One", "Two", "Three", "Four", "Five")  # 'Zero' is not a rating


def slug(c):
    return F.lower(F.regexp_replace(F.trim(c), "[^A-Za-z0-9]+", "-"))


def listing_pages(part: DataFrame) -> DataFrame:
    """Product listing pages (page_id, url, html) built from ``part``: one
    category folder per brand, 20 cards per page in part-key order, a next
    link on every page but a brand's last.

    Card dirt, by part size: '& Co' titles (escaped as &amp;), decimal-comma
    prices, a missing price, a stray character before the pound sign, an
    unknown rating word; hrefs relative (../../../), root-relative or
    absolute, all naming the same product page.
    """
    from ..operators.ranking import rank_within

    size = F.col("p_size")
    title = F.when(size % 7 == 0, F.concat(F.col("p_name"), F.lit(" & Co"))).otherwise(F.col("p_name"))
    attr = F.replace(title, F.lit("&"), F.lit("&amp;"))
    price = F.format_string("%.2f", F.col("p_retailprice"))
    price = F.when(size % 5 == 0, F.replace(price, F.lit("."), F.lit(","))).otherwise(price)
    price_html = (
        F.when(size == 1, F.lit(""))
        .when(size == 2, F.concat(F.lit('<p class="price_color">Â£'), price, F.lit("</p>")))
        .otherwise(F.concat(F.lit('<p class="price_color">£'), price, F.lit("</p>")))
    )
    word = F.element_at(F.array(*[F.lit(w) for w in RATING_WORD_CYCLE]), (size % 6 + 1).cast("int"))
    avail = F.when(size % 2 == 0, F.lit("In stock")).otherwise(F.lit("Out of stock"))
    target = F.concat(slug(F.col("p_name")), F.lit("_"), F.col("p_partkey").cast("string"), F.lit("/index.html"))
    href = (
        F.when(size % 9 == 0, F.concat(F.lit(SHOP), target))
        .when(size % 11 == 0, F.concat(F.lit("/catalogue/"), target))
        .otherwise(F.concat(F.lit("../../../"), target))
    )
    card = F.concat(
        F.lit('<article class="product_pod"><div class="image_container"><a href="'), href,
        F.lit('"><img src="thumb.jpg" alt="'), attr, F.lit('"></a></div><p class="star-rating '), word,
        F.lit('"><i class="icon-star"></i></p><h3><a href="'), href, F.lit('" title="'), attr, F.lit('">'),
        F.substring(attr, 1, 20), F.lit('...</a></h3><div class="product_price">'), price_html,
        F.lit('<p class="instock availability">\n    <i class="icon-ok"></i>\n    '), avail,
        F.lit("\n</p></div></article>"),
    )
    cards = part.select("p_brand", "p_partkey", card.alias("card"))
    ranked = rank_within(cards, ["p_brand"], ["p_partkey"])
    per_page = ranked.groupBy("p_brand", F.floor(F.col("_rank") / CARDS_PER_PAGE).alias("page_no")).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", "card"))).alias("cards"),
        F.max(F.ceil(F.col("_group_n") / CARDS_PER_PAGE)).alias("n_pages"),
    )
    folder = F.concat(F.lit(SHOP + "category/books/"), slug(F.col("p_brand")), F.lit("/"))
    nxt = F.when(
        F.col("page_no") + 1 < F.col("n_pages"),
        F.concat(F.lit('<li class="next"><a href="page-'), (F.col("page_no") + 2).cast("string"),
                 F.lit('.html">next</a></li>')),
    ).otherwise(F.lit(""))
    html = F.concat(
        F.lit('<html><body><section><ol class="row">'),
        F.array_join(F.transform("cards", lambda c: c["card"]), ""),
        F.lit('</ol><ul class="pager">'), nxt, F.lit("</ul></section></body></html>"),
    )
    brand_no = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("bigint")
    return per_page.select(
        (brand_no * 1_000_000 + F.col("page_no")).alias("page_id"),
        F.concat(folder, F.lit("page-"), (F.col("page_no") + 1).cast("string"), F.lit(".html")).alias("url"),
        html.alias("html"),
    )


# --------------------------------------------------------------- payloads

HOURS_PER_PAYLOAD = 48


def hourly_payloads(events: DataFrame) -> DataFrame:
    """Forecast-style payloads (city, payload) from ``events``: each user's
    events in time order, 48 per payload, as an object of parallel arrays.
    Some payloads lose their wind array (absent variable) and some have one
    precipitation value fewer (unequal lengths)."""
    from ..operators.ranking import rank_within

    k = F.get_json_object("props", "$.k").cast("double")
    rows = events.select(
        "user_id",
        "ts",
        "event_id",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("t"),
        (F.col("value") - 60).alias("temperature_2m"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("double")).otherwise(F.col("value") / 10).alias(
            "precipitation"
        ),
        k.alias("relative_humidity_2m"),
        (k / 4).alias("wind_speed_10m"),
    )
    r = rank_within(rows, ["user_id"], ["ts", "event_id"])
    chunk = F.floor(F.col("_rank") / HOURS_PER_PAYLOAD).alias("chunk")
    g = r.groupBy("user_id", chunk).agg(
        F.array_sort(
            F.collect_list(
                F.struct("ts", "event_id", "t", "temperature_2m", "precipitation", "relative_humidity_2m",
                         "wind_speed_10m")
            )
        ).alias("e")
    )
    short = (F.col("user_id") + F.col("chunk")) % 13 == 0
    precip = F.transform("e", lambda x: x["precipitation"])
    precip = F.when(short, F.slice(precip, 1, F.size(precip) - 1)).otherwise(precip)
    wind = F.when(F.col("user_id") % 17 != 0, F.transform("e", lambda x: x["wind_speed_10m"]))
    hourly = F.struct(
        F.transform("e", lambda x: x["t"]).alias("time"),
        F.transform("e", lambda x: x["temperature_2m"]).alias("temperature_2m"),
        precip.alias("precipitation"),
        F.transform("e", lambda x: x["relative_humidity_2m"]).alias("relative_humidity_2m"),
        wind.alias("wind_speed_10m"),
    )
    return g.select(
        F.concat(F.lit("city_"), F.col("user_id").cast("string")).alias("city"),
        F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"),
    )


RESULTS_TYPE = "array<struct<name:string,latitude:double,longitude:double,country:string>>"


def geocode_payloads(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Geocoding-style payloads (query, payload), one per customer: two
    results, no results, or no results key at all (by market segment); the
    country is left out for every fifth nation."""
    j = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    country = F.when(F.col("c_nationkey") % 5 != 0, F.col("n_name"))
    first = F.struct(
        F.col("c_name").alias("name"),
        (F.col("c_acctbal") / 100).alias("latitude"),
        (F.col("c_nationkey") + 0.5).alias("longitude"),
        country.alias("country"),
    )
    second = F.struct(
        F.concat(F.col("c_name"), F.lit(" (2)")).alias("name"),
        F.lit(0.0).alias("latitude"),
        F.lit(0.0).alias("longitude"),
        F.lit("ELSEWHERE").alias("country"),
    )
    seg = F.col("c_mktsegment")
    results = (
        F.when(seg == "BUILDING", F.array().cast(RESULTS_TYPE))
        .when(seg == "AUTOMOBILE", F.lit(None))
        .otherwise(F.array(first, second))
    )
    return j.select(
        F.col("c_custkey").alias("query"),
        F.to_json(F.struct(results.alias("results"))).alias("payload"),
    )
