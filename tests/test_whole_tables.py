"""Queries that read every row of their tables: counts against the tables themselves."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from obsengine.plans import standins as SI
from obsengine.sources import pages as PG

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_whole_stand_ins_have_every_row(spark):
    size = {t: spark.read.parquet(f"{SF}/{t}.parquet").count() for t in ("part", "lineitem")}
    assert SI.dim_product(spark, SF, whole=True).count() == size["part"] > SI.dim_product(spark, SF).count()
    assert SI.price_batch(spark, SF, whole=True).count() == size["lineitem"] > SI.price_batch(spark, SF).count()
    hours = SI.weather_rows(spark, SF, 0.0).select("city_id", "time_at").distinct().count()
    assert SI.fact_weather(spark, SF, whole=True).count() == hours > SI.fact_weather(spark, SF).count()


def test_whole_queries_lose_no_row(spark):
    q = E.queries()
    part = spark.read.parquet(f"{SF}/part.parquet").count()
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert q["update_where_whole"](spark, SF).count() == part
    assert q["upsert_literal_whole"](spark, SF).count() == part + 1
    assert q["key_lookup_whole"](spark, SF).count() == li.count()
    assert q["fact_conform_whole"](spark, SF).count() == li.where("l_returnflag <> 'R' OR l_extendedprice = 0").count()
    assert q["semi_filter_whole"](spark, SF).count() == li.select("l_partkey").distinct().count()
    assert {r.rule: r.violations for r in q["constraint_report_whole"](spark, SF).collect()}["foreign_key(url)"] == 0
    day = F.to_date("time_at")
    gone = SI.fact_weather(spark, SF, whole=True).where((F.col("city_id") == 3) & (day == F.lit("2024-01-10").cast("date")))
    left = q["delete_using_whole"](spark, SF).count()
    assert left + gone.count() == SI.fact_weather(spark, SF, whole=True).count()


def test_crawl_to_the_end(spark):
    link = '<li class="next"><a href="{}">next</a></li>'
    page = lambda site, i, to: (f"{site}{i}", f"https://x.example/{site}/{i}.html", link.format(f"{to}.html") if to else "")
    rows = [page("a", i, i + 1 if i < 37 else None) for i in range(1, 38)]
    rows += [page("b", i, i % 5 + 1) for i in range(1, 6)]  # a circle
    rows += [page("c", 1, None)]
    pages = spark.createDataFrame(rows, "page_id string, url string, html string")
    starts = pages.where("url LIKE '%/1.html'").select(F.col("url").alias("start_url"))
    got = sorted((r.page_id, r.hop) for r in PG.crawl(pages, starts, max_pages=None).collect())
    assert got == sorted([(f"a{i}", i - 1) for i in range(1, 38)] + [(f"b{i}", i - 1) for i in range(1, 6)] + [("c1", 0)])
    short = PG.crawl(pages, starts)
    assert short.count() == 3 + 3 + 1


def test_category_crawl_whole_loses_no_card(spark):
    part = spark.read.parquet(f"{SF}/part.parquet").count()
    assert E.queries()["category_crawl_whole"](spark, SF).count() == part
