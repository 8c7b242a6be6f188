"""Cleaning chains, keep-last dedup and daily aggregates (F1, F2; T4, T5, T16)."""

from __future__ import annotations

import datetime as dt

from conftest import rows

from obsengine.operators import aggregate as A
from obsengine.operators import clean as C

PRODUCT_COLS = "source string, product_name string, price_gbp string, availability string, " \
               "rating_1to5 string, url string, scraped_at string, ord int"


def products(spark):
    data = [
        ("s", "A", "10.0", "In stock", "4", " https://x/a ", "2025-09-08T10:00:00Z", 1),
        ("s", "A", "12.0", "In stock", "6", "https://x/a", "2025-09-08T10:00:00Z", 2),   # later dup wins
        ("s", "B", "5.0", "In stock", "0", "https://x/b", "2025-09-08T11:00:00Z", 3),
        ("s", "B", "-1", "In stock", "5", "https://x/b", "2025-09-08T11:00:00Z", 4),     # negative: dropped first
        ("s", "C", "abc", "In stock", "", "\thttps://x/c", "2025-09-08T12:00:00Z", 5),   # NULL price kept
        ("s", "C", "7.5", "In stock", "5", "https://x/c", "2025-09-08T13:00:00Z", 6),
        ("s", "D", "1.0", "Out", "3", None, "junk", 7),                                 # nan url, NULL time
        ("s", "E", "2.0", "Out", "3", "https://x/e", "2025-09-09T00:30:00+01:00", 8),  # offset -> 8th, 23:30
    ]
    return spark.createDataFrame(data, PRODUCT_COLS)


def test_clean_products(spark):
    out = C.clean_products(products(spark), ordinal="ord")
    assert "ord" not in out.columns
    got = {(r["url"], r["scraped_at"]): (r["price_gbp"], r["rating_1to5"]) for r in out.collect()}
    assert got[("https://x/a", dt.datetime(2025, 9, 8, 10))] == (12.0, None)  # rating 6 out of range
    assert got[("https://x/b", dt.datetime(2025, 9, 8, 11))] == (5.0, None)   # negative dup never hides it
    assert got[("https://x/c", dt.datetime(2025, 9, 8, 12))] == (None, None)
    assert got[("nan", None)] == (1.0, 3.0)
    assert got[("https://x/e", dt.datetime(2025, 9, 8, 23, 30))] == (2.0, 3.0)
    assert len(got) == 6


def test_daily_price_last_non_null_and_counts(spark):
    cur = C.clean_products(products(spark), ordinal="ord")
    got = {(r["url"], str(r["day"])): r for r in A.daily_price(cur).collect()}
    c = got[("https://x/c", "2025-09-08")]
    assert (c["min_price"], c["max_price"], c["last_price"], c["n_obs"]) == (7.5, 7.5, 7.5, 2)
    assert ("nan", "None") not in got  # no day: left out (T5)
    assert got[("https://x/e", "2025-09-08")]["n_obs"] == 1


def test_last_non_null_skips_trailing_null(spark):
    df = spark.createDataFrame(
        [("u", dt.datetime(2025, 1, 1, 1), 1.0), ("u", dt.datetime(2025, 1, 1, 2), None)],
        "url string, scraped_at timestamp, price_gbp double",
    )
    r = A.daily_price(df).first()
    assert (r["last_price"], r["n_obs"], r["avg_price"]) == (1.0, 2, 1.0)


WEATHER_COLS = "city string, time string, temperature_2m string, relative_humidity_2m string, " \
               "precipitation string, wind_speed_10m string, ord int"


def weather(spark):
    data = [
        ("X", "2025-09-08T00:00", "80", "100", "0", "0", 1),
        ("X", "2025-09-08T01:00", "80.1", "100.1", "-0.1", "-1", 2),
        ("X", "2025-09-08T01:00", "-80", "0", "1.5", "3", 3),          # dup (city, time): last wins
        ("X", "2025-09-08T02:00", "-80.5", "-1", None, "2", 4),
        (None, "2025-09-08T02:00", "10", "50", "1", "1", 5),           # NULL city
        ("Y", None, "10", "50", "1", "1", 6),                          # NULL time
        ("Y", "2025-09-08T03:00", "10", "50", None, "1", 7),
    ]
    return spark.createDataFrame(data, WEATHER_COLS)


def test_clean_weather_limits(spark):
    out = C.clean_weather(weather(spark), ordinal="ord")
    got = {(r["city"], str(r["time"])): r for r in out.collect()}
    a = got[("X", "2025-09-08 00:00:00")]
    assert (a["temperature_2m"], a["relative_humidity_2m"], a["precipitation"], a["wind_speed_10m"]) == (80, 100, 0, 0)
    b = got[("X", "2025-09-08 01:00:00")]
    assert (b["temperature_2m"], b["relative_humidity_2m"], b["precipitation"]) == (-80, 0, 1.5)
    c = got[("X", "2025-09-08 02:00:00")]
    assert (c["temperature_2m"], c["relative_humidity_2m"]) == (None, None)
    assert len(got) == 6  # NULL city and NULL time rows are kept (one each)


def test_daily_weather_all_missing_precip_is_zero(spark):
    cur = C.clean_weather(weather(spark), ordinal="ord")
    got = {(r["city"], str(r["day"])): r for r in A.daily_weather(cur).collect()}
    assert got[("Y", "2025-09-08")]["total_precip"] == 0.0
    assert got[("X", "2025-09-08")]["n_obs"] == 3
    assert all(k[0] is not None and k[1] != "None" for k in got)


def test_empty_inputs_keep_output_schema(spark):
    empty = spark.createDataFrame([], WEATHER_COLS)
    out = A.daily_weather(C.clean_weather(empty, ordinal="ord"))
    assert out.columns == ["city", "day", "avg_temp", "avg_rh", "total_precip", "avg_wind", "n_obs"]
    assert out.count() == 0


def test_keep_last_is_order_free(spark):
    df = spark.createDataFrame([(k % 3, i, f"v{i}") for i, k in enumerate(range(60))], "k int, o int, v string")
    a = rows(C.keep_last(df, ["k"], ["o"]))
    b = rows(C.keep_last(df.repartition(7).orderBy("v"), ["k"], ["o"]))
    assert a == b == [(0, 57, "v57"), (1, 58, "v58"), (2, 59, "v59")]
