"""Composite jobs over folders: batch job (B1, K1-K5), warehouse load (B4),
document load (B5)."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import functions as F

from obsengine.plans import batch_job as BJ
from obsengine.plans import tables
from obsengine.operators import documents as D
from obsengine.operators import upsert as U
from obsengine.sources import csvfolder as CF

PRODUCTS_HEADER = "source,product_name,price_gbp,availability,rating_1to5,url,scraped_at\n"


def _products(folder, day, rows):
    with open(os.path.join(folder, f"products_{day}.csv"), "w", encoding="utf-8") as f:
        f.write(PRODUCTS_HEADER + "".join(rows))


def _raw(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    _products(d, "2025-09-08", [
        'https://s/cat/,"Kettle, large",10.0,In stock,4,https://s/p/1,2025-09-08T10:00:00Z\n',
        "https://s/cat/,Cup,abc,In stock,9,https://s/p/2,2025-09-08T10:00:00Z\n",
        "https://s/cat/,Cup,-3,In stock,3,https://s/p/2,2025-09-08T11:00:00Z\n",
    ])
    _products(d, "2025-09-09", [
        'https://s/cat/,"Kettle, large",12.5,Out,5,https://s/p/1,2025-09-09T10:00:00Z\n',
        "https://s/cat/,Plate,3.0,In stock,2,https://s/p/3,2025-09-09T10:00:00Z\n",
    ])
    (d / "weather_hourly_Maringá_2025-09-08.csv").write_text(
        "city,time,temperature_2m,precipitation,relative_humidity_2m,wind_speed_10m\n"
        "Maringá,2025-09-08T00:00,20.5,0.0,50,3\nMaringá,2025-09-08T01:00,95,1.0,40,2\n", encoding="utf-8")
    (d / "weather_hourly_Maringá_2025-09-09.csv").write_text(
        "time,city,wind_speed_10m,relative_humidity_2m,precipitation,temperature_2m\n"
        "2025-09-09T00:00,Maringá,4,60,1.5,18.0\n", encoding="utf-8")
    return d


def test_run_batch_outputs(spark, tmp_path):
    raw = _raw(tmp_path)
    out = tmp_path / "out"
    summary = {r["output"]: r["n_rows"] for r in BJ.run_batch(spark, str(raw), str(out)).collect()}
    assert summary["products_curated"] == 4        # the negative-price row is dropped
    assert summary["weather_hourly_curated"] == 3
    assert summary["weather_daily_stats"] == 2
    cur = spark.read.parquet(str(out / "curated/products_curated"))
    assert {r["product_name"] for r in cur.collect()} == {"Kettle, large", "Cup", "Plate"}
    w = spark.read.parquet(str(out / "curated/weather_hourly_curated"))
    assert sorted(r["temperature_2m"] for r in w.collect() if r["temperature_2m"] is not None) == [18.0, 20.5]
    report = spark.read.text(str(out / "reports")).collect()
    assert report[0]["value"] == BJ.REPORT_HEADING
    empty = tmp_path / "empty"
    empty.mkdir()
    assert BJ.run_batch(spark, str(empty), str(tmp_path / "out2")).count() == 0   # families skipped


def test_load_warehouse_twice(spark, tmp_path):
    raw = _raw(tmp_path)
    wh = str(tmp_path / "wh")
    first = BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-09 12:00:00")
    assert set(first) == {"dim_product", "fact_price", "dim_city", "fact_weather_hourly"}
    dim = tables.read_current(spark, wh, "dim_product", U.DIM_PRODUCT)
    assert sorted((r["product_id"], r["url"]) for r in dim.collect()) == [(1, "https://s/p/1"), (2, "https://s/p/3")]
    city = tables.read_current(spark, wh, "dim_city", U.DIM_CITY).first()
    assert (city["city_name"], city["country"]) == ("Maringá", "")
    _products(raw, "2025-09-10", ["https://s/cat/,Bowl,4.0,In stock,1,https://s/p/4,2025-09-10T09:00:00Z\n",
                                  "https://s/cat/,Plate v2,3.5,In stock,2,https://s/p/3,2025-09-09T10:00:00Z\n"])
    BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-10 12:00:00")
    dim = {r["url"]: r for r in tables.read_current(spark, wh, "dim_product", U.DIM_PRODUCT).collect()}
    assert (dim["https://s/p/4"]["product_id"], dim["https://s/p/3"]["product_name"]) == (3, "Plate v2")
    assert dim["https://s/p/3"]["first_seen_at"] == dt.datetime(2025, 9, 9, 12)
    fact = tables.read_current(spark, wh, "fact_price", U.FACT_PRICE).collect()
    assert len(fact) == 3 and {float(r["price_gbp"]) for r in fact} == {12.5, 3.5, 4.0}
    fw = tables.read_current(spark, wh, "fact_weather_hourly", U.FACT_WEATHER).collect()
    assert len(fw) == 1  # newest weather file only, loaded twice: idempotent


def test_load_documents_retry_safe(spark, tmp_path):
    raw = _raw(tmp_path)
    docs = str(tmp_path / "docs")
    BJ.load_documents(spark, str(raw), docs, as_of="2025-09-09 12:00:00", batch_id="2025-09-09")
    BJ.load_documents(spark, str(raw), docs, as_of="2025-09-09 13:00:00", batch_id="2025-09-09")  # retry
    hist = tables.read_current(spark, docs, "price_history", D.PRICE_HISTORY)
    assert hist.count() == 2
    BJ.load_documents(spark, str(raw), docs, as_of="2025-09-10 12:00:00", batch_id="2025-09-10")  # same file again
    heads = tables.read_current(spark, docs, "product_heads", D.PRODUCT_HEAD)
    hist = tables.read_current(spark, docs, "price_history", D.PRICE_HISTORY)
    s = {r["url"]: r["n_prices"] for r in D.history_summary(heads, hist).collect()}
    assert s == {"https://s/p/1": 2, "https://s/p/3": 2}


def test_dated_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", dt.datetime(2025, 9, 8, 1)), ("b", dt.datetime(2025, 9, 9, 2))], "url string, scraped_at timestamp"
    )
    paths = BJ.write_dated_csv(df, str(tmp_path), "products", "scraped_at")
    assert [os.path.basename(p) for p in paths] == ["products_2025-09-08.csv", "products_2025-09-09.csv"]
    back = CF.read_csv_family(spark, str(tmp_path), CF.PRODUCTS_GLOB)
    assert sorted((r["url"], r["_file"]) for r in back.collect()) == [
        ("a", "products_2025-09-08.csv"), ("b", "products_2025-09-09.csv")]
    files = CF.list_files(spark, str(tmp_path), CF.PRODUCTS_GLOB)
    assert CF.latest_file(files).endswith("products_2025-09-09.csv")


def test_write_sorted_layout(spark, tmp_path):
    df = spark.createDataFrame([(k, dt.datetime(2025, 1, 1, h)) for k in range(3) for h in range(5)],
                               "k int, t timestamp")
    tables.write_sorted(df, str(tmp_path / "s"), ["k"], "t")
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 15 and back.select(F.max("t")).first()[0] == dt.datetime(2025, 1, 1, 4)


def test_version_rerun_after_failed_attempt(spark, tmp_path):
    from obsengine.plans import tables as TB

    root = str(tmp_path / "t")
    df = spark.createDataFrame([(1,)], "x int")
    # A failed attempt left data for v000001 but no commit marker.
    df.write.parquet(os.path.join(root, "tab", "data", "v000001"))
    assert TB.read_current(spark, root, "tab", df.schema).count() == 0
    TB.write_version(spark.createDataFrame([(2,), (3,)], "x int"), root, "tab")
    assert sorted(r["x"] for r in TB.read_current(spark, root, "tab", df.schema).collect()) == [2, 3]
    TB.write_version(df, root, "tab")
    assert [r["x"] for r in TB.read_current(spark, root, "tab", df.schema).collect()] == [1]


def test_run_batch_same_when_every_key_is_hot(spark, tmp_path):
    from obsengine.operators import ranking as R

    raw = _raw(tmp_path)
    _products(raw, "2025-09-10", [f"https://s/cat/,Cup,{1.0 + i % 7},In stock,3,https://s/p/2,"
                                  f"2025-09-10T{i % 24:02d}:{i % 60:02d}:00Z\n" for i in range(40)])

    def outputs(out):
        BJ.run_batch(spark, str(raw), str(out))
        res = {}
        for name in ("agg/daily_price_stats", "alerts/price_anomalies", "agg/weather_daily_stats",
                     "alerts/weather_anomalies"):
            df = spark.read.option("header", "true").csv(str(out / name))
            res[name] = sorted(tuple(r) for r in df.collect())
        return res

    cold = outputs(tmp_path / "cold")
    spark.conf.set(R.HOT_ROWS_CONF, "2")
    try:
        hot = outputs(tmp_path / "hot")
    finally:
        spark.conf.unset(R.HOT_ROWS_CONF)
    assert hot == cold and len(cold["agg/daily_price_stats"]) > 0
