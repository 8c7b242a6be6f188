"""Keyed upserts (M1-M4, M7, M8), lookups, constraints and documents (F5, F6)."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from obsengine.operators import documents as D
from obsengine.operators import quality as Q
from obsengine.operators import upsert as U

T0 = dt.datetime(2025, 1, 1)
AS_OF = "2025-09-08 12:00:00"


def dim(spark):
    return spark.createDataFrame(
        [(1, "https://x/a", "A", "s", T0, T0), (2, "https://x/b", "B", "s", T0, T0)], U.DIM_PRODUCT
    )


def test_upsert_dim_product(spark):
    batch = spark.createDataFrame(
        [("https://x/b", "B2", "s2", 1), ("https://x/c", "C", "s", 2), ("https://x/c", "C2", "s", 3),
         ("https://x/d", "D", "s", 4)],
        "url string, product_name string, source string, o int",
    )
    out = U.upsert_dim_product(dim(spark), batch, AS_OF, batch_order=["o"])
    got = {r["url"]: r for r in out.collect()}
    asof = dt.datetime(2025, 9, 8, 12)
    assert (got["https://x/a"]["product_name"], got["https://x/a"]["last_seen_at"]) == ("A", T0)
    b = got["https://x/b"]
    assert (b["product_id"], b["product_name"], b["source"], b["first_seen_at"], b["last_seen_at"]) == (
        2, "B2", "s2", T0, asof)
    assert (got["https://x/c"]["product_id"], got["https://x/c"]["product_name"]) == (3, "C2")  # last row wins
    assert got["https://x/d"]["product_id"] == 4 and got["https://x/d"]["first_seen_at"] == asof
    # Idempotent apart from last_seen_at: applying the batch again changes nothing else.
    again = U.upsert_dim_product(out, batch, AS_OF, batch_order=["o"])
    assert rows(again) == rows(out)


def test_upsert_fact_price(spark):
    fact = spark.createDataFrame([(1, T0, Decimal("10.00"), "In stock", 4)], U.FACT_PRICE)
    batch = spark.createDataFrame(
        [("https://x/a", T0, None, None, "4", 1),            # NULL overwrites
         ("https://x/b", T0, "-3", "x", "4", 2),             # negative price: dropped
         ("https://x/b", T0, "7.5", "In stock", "9", 3),     # rating out of range -> NULL
         ("https://x/zzz", T0, "1", "x", "1", 4)],           # unknown url: dropped
        "url string, scraped_at timestamp, price_gbp string, availability string, rating_1to5 string, o int",
    )
    out = {r["product_id"]: r for r in U.upsert_fact_price(fact, dim(spark), batch, ["o"]).collect()}
    assert set(out) == {1, 2}
    assert (out[1]["price_gbp"], out[1]["availability"], out[1]["rating_1to5"]) == (None, None, 4)
    assert (out[2]["price_gbp"], out[2]["rating_1to5"]) == (Decimal("7.50"), None)


def test_upsert_city_and_single_key_lookup(spark):
    cities = spark.createDataFrame([(1, "Cuiaba", "", None, None)], U.DIM_CITY)
    batch = spark.createDataFrame(
        [("Cuiaba", None, 1.5, 2.5), ("Cuiaba", "BR", None, None), ("Florianópolis", None, None, None)],
        "city_name string, country string, latitude double, longitude double",
    )
    out = U.upsert_dim_city(cities, batch)
    got = {(r["city_name"], r["country"]): r for r in out.collect()}
    assert got[("Cuiaba", "")]["latitude"] == Decimal("1.50000")
    assert {got[("Cuiaba", "BR")]["city_id"], got[("Florianópolis", "")]["city_id"]} == {2, 3}
    obs = spark.createDataFrame([("Cuiaba",), ("Florianópolis",), ("Nowhere",)], "city_name string")
    ok, bad = U.lookup_single_key(obs, out, "city_name", "city_id")
    assert rows(ok, "city_name", "city_id") == [("Florianópolis", got[("Florianópolis", "")]["city_id"])]
    assert rows(bad, "city_name", "reason") == [("Cuiaba", "ambiguous"), ("Nowhere", "no match")]


def test_update_and_delete(spark):
    d = dim(spark)
    up = U.update_where(d, F.col("url") == "https://x/a", {"product_name": F.concat(F.lit("[ADJ] "), "product_name")})
    assert rows(up, "product_name") == [("B",), ("[ADJ] A",)]
    gone = U.delete_using(d, d.where("product_id = 2").select("product_id"), "product_id")
    assert rows(gone, "product_id") == [(1,)]


def test_constraint_report_and_quarantine(spark):
    fact = spark.createDataFrame(
        [(1, T0, 5.0, 3), (1, T0, 6.0, 9), (3, None, -1.0, None), (None, T0, 123456789.0, 1)],
        "product_id bigint, scraped_at timestamp, price_gbp double, rating_1to5 int",
    )
    rules = [
        Q.not_null("product_id"), Q.not_null("scraped_at"), Q.in_range("price_gbp", lo=0),
        Q.in_range("rating_1to5", 1, 5), Q.fits_decimal("price_gbp", 10, 2),
        Q.unique("product_id", "scraped_at"), Q.foreign_key(["product_id"], dim(spark)),
    ]
    rep = {r["rule"]: r["violations"] for r in Q.constraint_report(fact, rules, "fact").collect()}
    assert rep == {
        "not_null(product_id)": 1, "not_null(scraped_at)": 1, "check(price_gbp >= 0)": 1,
        "check(rating_1to5 between 1 and 5)": 1, "numeric(price_gbp,10,2)": 1,
        "unique(product_id,scraped_at)": 1, "foreign_key(product_id)": 1,
    }
    good, bad = Q.quarantine(fact, rules)
    assert good.count() + bad.count() == fact.count() and good.count() == 1


def test_product_documents_history(spark):
    heads0 = spark.createDataFrame([], D.PRODUCT_HEAD)
    hist0 = spark.createDataFrame([], D.PRICE_HISTORY)
    b1 = spark.createDataFrame(
        [("https://x/a", "A", "s", "2025-09-08T10:00:00", "5.0", "In stock", "4", 1),
         ("https://x/a", "A1", "s", "2025-09-08T09:00:00", "-2", "In stock", "7", 2)],
        "url string, product_name string, source string, scraped_at string, price_gbp string, "
        "availability string, rating_1to5 string, o int",
    )
    b1 = b1.withColumn("scraped_at", F.col("scraped_at").cast("timestamp"))
    h1, hist1 = D.upsert_product_docs(heads0, hist0, b1, "2025-09-08 00:00:00", "b1", ["o"])
    h1, hist1 = spark.createDataFrame(h1.collect(), D.PRODUCT_HEAD), spark.createDataFrame(hist1.collect(), D.PRICE_HISTORY)
    # Same batch id again (a retried load): nothing appended, created_at kept.
    h2, hist2 = D.upsert_product_docs(h1, hist1, b1, "2025-09-09 00:00:00", "b1", ["o"])
    assert hist2.count() == 2
    assert h2.first()["created_at"] == dt.datetime(2025, 9, 8)
    # The same file under a new id appends again (history doubles), in time order.
    h3, hist3 = D.upsert_product_docs(h2, hist2, b1, "2025-09-09 00:00:00", "b2", ["o"])
    s = D.history_summary(h3, hist3).first()
    assert (s["n_prices"], s["product_name"], s["last_price"]) == (4, "A1", 5.0)  # negative kept (T14)
    docs = D.product_documents(h3, hist3, segment_size=3).collect()
    assert sorted(len(d["prices"]) for d in docs) == [1, 3]


def test_weather_documents(spark):
    w = spark.createDataFrame(
        [(None, T0, 1.0, 2.0, 3.0, 4.0, 1), ("X", T0, 1.0, 2.0, 3.0, 4.0, 2), ("X", T0, 9.0, None, 3.0, 4.0, 3)],
        "city string, time timestamp, temperature_2m double, relative_humidity_2m double, precipitation double, "
        "wind_speed_10m double, o int",
    )
    docs = D.weather_documents_from(w, ["o"])
    assert rows(docs, "city", "temperature_2m", "relative_humidity_2m") == [("Cidade", 1.0, 2.0), ("X", 9.0, None)]
    upd = D.upsert_weather_docs(docs, w.where("o = 2"), order=["o"])
    assert rows(upd, "city", "temperature_2m") == [("Cidade", 1.0), ("X", 1.0)]


def test_lookup_with_a_hot_key(spark):
    from obsengine.operators import ranking as R

    rows = spark.createDataFrame([("https://x/a", i) for i in range(50)] + [("https://x/b", 1), ("https://x/z", 2)],
                                 "url string, o int")
    spark.conf.set(R.HOT_ROWS_CONF, "10")
    try:
        got = U.lookup_key(rows, dim(spark), "url", "product_id").groupBy("product_id").count().collect()
        ok, bad = U.lookup_single_key(rows, dim(spark), "url", "product_id")
        n_ok, n_bad = ok.count(), bad.count()
    finally:
        spark.conf.unset(R.HOT_ROWS_CONF)
    assert sorted((r["product_id"], r["count"]) for r in got) == [(1, 50), (2, 1)]
    assert (n_ok, n_bad) == (51, 1)
