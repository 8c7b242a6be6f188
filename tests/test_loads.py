"""Loads: untouched days, file order, quarantine, nested documents."""

from __future__ import annotations

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from obsengine.operators import documents as D
from obsengine.operators import upsert as U
from obsengine.plans import batch_job as BJ
from obsengine.plans import daily_tables as DT
from obsengine.plans import tables

HEADER = "source,product_name,price_gbp,availability,rating_1to5,url,scraped_at\n"
KEYS = (["product_id", "scraped_at"], "scraped_at", ["price_gbp", "availability", "rating_1to5"])


def products(folder, day, *rows):
    (folder / f"products_{day}.csv").write_text(HEADER + "".join(r + "\n" for r in rows), encoding="utf-8")


def facts(spark, *rows):
    days = [(k, dt.datetime(2025, 9, d, h), p, a, None) for k, d, h, p, a in rows]
    return spark.createDataFrame(days, "product_id long, scraped_at timestamp, price_gbp double, availability string, rating_1to5 short").select(
        *[F.col(f.name).cast(f.dataType) for f in U.FACT_PRICE.fields]
    )


def test_untouched_days_keep_their_files(spark, tmp_path):
    root = str(tmp_path)
    first = facts(spark, *[(k, d, 1, 10.0 * k + d, "old") for k in range(5) for d in range(1, 8)])
    assert DT.merge_days(first, root, "f", U.FACT_PRICE, *KEYS) == [dt.date(2025, 9, d) for d in range(1, 8)]
    before = {r["path"]: (r["day"], r["mtime"]) for r in DT.day_files(spark, root, "f").collect()}
    batch = facts(spark, (1, 3, 1, 99.0, "new"), (1, 3, 2, 98.0, "new"), (7, 9, 1, 5.0, "new"))
    again = [DT.merge_days(batch, root, "f", U.FACT_PRICE, *KEYS) for _ in range(2)]  # a retried load changes nothing
    assert again[0] == again[1] == [dt.date(2025, 9, 3), dt.date(2025, 9, 9)]
    after = {r["path"]: (r["day"], r["mtime"]) for r in DT.day_files(spark, root, "f").collect()}
    old = {p: x for p, x in before.items() if x[0] != dt.date(2025, 9, 3)}
    assert {p: x for p, x in after.items() if x[0] not in again[0]} == old
    got = {(r["product_id"], r["scraped_at"]): float(r["price_gbp"]) for r in tables.read_current(spark, root, "f", U.FACT_PRICE).collect()}
    assert len(got) == 35 + 2
    assert got[(1, dt.datetime(2025, 9, 3, 1))] == 99.0 and got[(2, dt.datetime(2025, 9, 3, 1))] == 23.0
    assert DT.merge_days(facts(spark), root, "f", U.FACT_PRICE, *KEYS) == []


def test_scan_of_a_merge_is_pruned(spark, tmp_path):
    DT.merge_days(facts(spark, *[(1, d, 1, 1.0, "x") for d in range(1, 8)]), str(tmp_path), "f", U.FACT_PRICE, *KEYS)
    current = tables.read_days(spark, str(tmp_path), "f", U.FACT_PRICE).where(F.col("day").isin([dt.date(2025, 9, 3)]))
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [(day" in plan
    assert len(current.inputFiles()) == 7 and current.select(F.input_file_name()).distinct().count() == 1


def test_whole_table_moves_to_days(spark, tmp_path):
    root = str(tmp_path)
    tables.write_version(facts(spark, (1, 1, 1, 1.0, "a"), (2, 2, 1, 2.0, "a")), root, "f")
    DT.merge_days(facts(spark, (2, 2, 1, 3.0, "b")), root, "f", U.FACT_PRICE, *KEYS)
    got = sorted((r["product_id"], float(r["price_gbp"])) for r in tables.read_current(spark, root, "f", U.FACT_PRICE).collect())
    assert got == [(1, 1.0), (2, 3.0)]


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    products(
        folder, "2025-09-08",
        "s,Zebra,9.99,In stock,4,u1,2025-09-08T10:00:00",
        's,"Apple, ""red""\nand green",10.50,In stock,4,u1,2025-09-08T10:00:00',
        "s,Cup,-1,In stock,9,u2,2025-09-08T10:00:00",
        "s,Cup,abc,In stock,9,u2,2025-09-08T11:00:00",
        "s,Cup,123456789012,In stock,9,u2,2025-09-08T12:00:00",
        "s,Cup,3,In stock,9,u2,no time",
        "s,Cup,4,In stock,9,u2,2025-09-08T13:00:00",
        "s,No url,5,In stock,3,,2025-09-08T10:00:00",
        "s,,5,In stock,3,u3,2025-09-08T10:00:00",
    )
    (folder / "weather_hourly_Maringá_2025-09-08.csv").write_text(
        "city,time,temperature_2m,precipitation,relative_humidity_2m,wind_speed_10m\n"
        "M,2025-09-08T00:00,20.5,0.0,50,3\nM,2025-09-08T01:00,95,-1.0,40,2\nM,2025-09-08T02:00,x,1,40,2\n"
        "M,2025-09-08T00:00,21.5,NA,50,3\nM,,1,1,1,1\n", encoding="utf-8")
    return folder


def test_last_line_of_the_file_wins(spark, raw, tmp_path):
    """The later line has the greater place, though it sorts first by value."""
    wh = str(tmp_path / "wh")
    BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-09 12:00:00")
    dim = {r["url"]: r["product_name"] for r in tables.read_current(spark, wh, "dim_product", U.DIM_PRODUCT).collect()}
    assert dim == {"u1": 'Apple, "red"\nand green', "u2": "Cup"}
    fact = tables.read_current(spark, wh, "fact_price", U.FACT_PRICE).collect()
    assert sorted((float(r["price_gbp"]), r["rating_1to5"]) for r in fact) == [(4.0, None), (10.5, 4)]
    weather = tables.read_current(spark, wh, "fact_weather_hourly", U.FACT_WEATHER).collect()
    assert [(float(r["temperature_2m"]), r["precipitation"]) for r in weather] == [(21.5, None)]
    BJ.run_batch(spark, str(raw), str(tmp_path / "out"))
    cur = spark.read.parquet(str(tmp_path / "out/curated/products_curated")).where("url = 'u1'").collect()
    assert [(r["product_name"], r["price_gbp"]) for r in cur] == [('Apple, "red"\nand green', 10.5)]


def test_no_row_of_a_file_vanishes(spark, raw, tmp_path):
    wh = str(tmp_path / "wh")
    for _ in range(2):  # loading a file again replaces its rejects
        BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-09 12:00:00")
    why = {}
    for r in BJ.read_rejects(spark, wh, "fact_price").collect():
        row = json.loads(r["row"])
        why[row.get("product_name"), row.get("price_gbp"), row.get("scraped_at")] = r["reasons"]
        assert r["source_file"] == "products_2025-09-08.csv"
    day = "2025-09-08T"
    assert why == {
        ("Cup", "-1", day + "10:00:00"): ["check(price_gbp >= 0)"],
        ("Cup", "abc", day + "11:00:00"): ["number(price_gbp)"],
        ("Cup", "123456789012", day + "12:00:00"): ["numeric(price_gbp,10,2)"],
        ("Cup", "3", "no time"): ["time(scraped_at)"],
        ("No url", "5", day + "10:00:00"): ["not_null(url)"],
        (None, "5", day + "10:00:00"): ["url: no match"],
    }
    names = {json.loads(r["row"]).get("url"): r["reasons"] for r in BJ.read_rejects(spark, wh, "dim_product").collect()}
    assert names == {None: ["not_null(url)"], "u3": ["not_null(product_name)"]}
    weather = [r["reasons"] for r in BJ.read_rejects(spark, wh, "fact_weather_hourly").collect()]
    assert sorted(weather) == [
        ["check(temperature_2m between -80 and 80)", "check(precipitation >= 0)"], ["number(temperature_2m)"], ["time(time)"],
    ]
    assert BJ.read_rejects(spark, wh, "nothing").count() == 0


def test_ambiguous_city_is_quarantined(spark, raw, tmp_path):
    wh = str(tmp_path / "wh")
    cities = spark.createDataFrame([(1, "Maringá", "BR", None, None)], U.DIM_CITY)
    tables.write_version(cities, wh, "dim_city")
    BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-09 12:00:00")
    reasons = [r["reasons"] for r in BJ.read_rejects(spark, wh, "fact_weather_hourly").collect()]
    assert reasons.count(["city: ambiguous"]) == 2 and len(reasons) == 5


def test_nested_documents_are_written(spark, raw, tmp_path):
    docs = str(tmp_path / "docs")
    for batch in ("b1", "b1", "b2"):  # b1 twice: a retried load
        out = BJ.load_documents(spark, str(raw), docs, as_of="2025-09-09 12:00:00", batch_id=batch)
    nested = {r["url"]: r for r in spark.read.parquet(out["products"]).collect()}
    assert {u: len(r["prices"]) for u, r in nested.items()} == {"u1": 4, "u2": 10, "u3": 2}
    assert nested["u1"]["product_name"] == 'Apple, "red"\nand green'
    assert sorted(p["price_gbp"] for p in nested["u2"]["prices"] if p["price_gbp"] is not None) == [-1, -1, 3, 3, 4, 4, 123456789012, 123456789012]
    assert [json.loads(r["row"])["product_name"] for r in BJ.read_rejects(spark, docs, "products").collect()] == ["No url"]
    weather = tables.read_current(spark, docs, "weather_docs", BJ.WEATHER_DOC).collect()
    assert sorted((r["time"].hour, r["temperature_2m"]) for r in weather if r["temperature_2m"] is not None) == [(0, 21.5), (1, 95.0)]
    assert len(weather) == 3


def test_absent_columns_are_null(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "products_2025-09-08.csv").write_text("url,product_name\nu1,A\nu2,B\n")
    (folder / "weather_hourly_X_2025-09-08.csv").write_text("time,city\n2025-09-08T00:00,X\n")
    n = {r["output"]: r["n_rows"] for r in BJ.run_batch(spark, str(folder), str(tmp_path / "out")).collect()}
    assert (n["products_curated"], n["weather_hourly_curated"]) == (2, 1)
    wh = str(tmp_path / "wh")
    BJ.load_warehouse(spark, str(folder), wh, as_of="2025-09-09 12:00:00")
    assert BJ.read_rejects(spark, wh, "dim_product").count() == 2


def test_rows_without_a_day_are_kept(spark, tmp_path):
    df = spark.createDataFrame([("a", dt.datetime(2025, 9, 8, 1)), ("b", None)], "url string, scraped_at timestamp")
    for _ in range(2):
        paths = BJ.write_dated_csv(df, str(tmp_path), "products", "scraped_at")
    assert [os.path.basename(p) for p in paths] == ["products_2025-09-08.csv", "undated_products.csv"]
    assert sorted(os.listdir(tmp_path)) == ["products_2025-09-08.csv", "undated_products.csv"]
    assert [r["url"] for r in spark.read.option("header", "true").csv(paths[1]).collect()] == ["b"]


def test_documents_take_junk_and_missing_urls(spark):
    batch = spark.createDataFrame([("u", "P", "s", "junk", "junk", None, "x", 1), (None, "Q", "s", None, "1", None, None, 2)],
                                  "url string, product_name string, source string, scraped_at string, price_gbp string, "
                                  "availability string, rating_1to5 string, o int")
    heads, hist = (spark.createDataFrame([], s) for s in (D.PRODUCT_HEAD, D.PRICE_HISTORY))
    heads, hist = D.upsert_product_docs(heads, hist, batch, "2025-09-08 00:00:00", "b", ["o"])
    assert [tuple(r)[3:] for r in hist.collect()] == [(None, None, None, None)]
    heads, hist = D.upsert_product_docs(heads, hist, batch, "2025-09-08 00:00:00", "b", ["o"])
    assert hist.count() == 1 and heads.count() == 1


def test_upsert_without_an_order_keeps_one_row_a_key(spark):
    target = spark.createDataFrame([(1, 1)], "k int, v int")
    batch = spark.createDataFrame([(1, 5), (1, 7), (2, 3), (2, 2)], "k int, v int")
    assert sorted(map(tuple, U.upsert(target, batch, ["k"], ["v"]).collect())) == [(1, 7), (2, 3)]


def shared(spark):
    return set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))


def test_a_load_writes_its_facts_once(spark, raw, tmp_path):
    """rows are parsed, checked and looked up once; the merge takes them as they were written."""
    before = {x for x in shared(spark) if x.split("-")[0] in ("parsed", "checked", "named", "incoming")}
    (raw / "weather_hourly_Maringá_2025-09-08.csv").unlink()
    wh = str(tmp_path / "wh")
    BJ.load_warehouse(spark, str(raw), wh, as_of="2025-09-09 12:00:00")
    assert {x for x in shared(spark) if x.split("-")[0] in ("parsed", "checked", "named", "incoming")} == before
    assert tables.read_current(spark, wh, "fact_price", U.FACT_PRICE).count() == 2


def test_rejects_keep_columns_of_any_name(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "products_2025-09-08.csv").write_text(HEADER.replace("source", "reason,source", 1) + "why,s,,5,In stock,3,u3,2025-09-08T10:00:00\n")
    wh = str(tmp_path / "wh")
    BJ.load_warehouse(spark, str(folder), wh, as_of="2025-09-09 12:00:00")
    found = BJ.read_rejects(spark, wh, "fact_price").collect()
    assert [(json.loads(r["row"])["reason"], r["reasons"]) for r in found] == [("why", ["url: no match"])]


def test_loads_remove_their_scratch_tables(spark, raw, tmp_path):
    """the parsed copy of a file goes when its load ends."""
    before = {x for x in shared(spark) if x.split("-")[0] in ("parsed", "load", "records")}
    for batch in ("b1", "b1"):
        BJ.load_documents(spark, str(raw), str(tmp_path / "docs"), as_of="2025-09-09 12:00:00", batch_id=batch)
    assert {x for x in shared(spark) if x.split("-")[0] in ("parsed", "load", "records")} == before
