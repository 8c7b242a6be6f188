"""Sources: CSV families (T7, T11, S4), listings (R1, T10, T19), JSON payloads
(F3), HTML cards and links (F4, P18)."""

from __future__ import annotations

import hashlib
import itertools
import os
import time
from urllib.parse import urljoin

from pyspark.sql import functions as F

from conftest import rows
from obsengine.functions.urls import resolve_url, with_resolved_url
from obsengine.sources import csvfolder as CF
from obsengine.sources import listing as L
from obsengine.sources import pages as PG
from obsengine.sources import payloads as PL


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_family_unites_by_header_name(spark, tmp_path):
    d = tmp_path / "data"
    d.mkdir()
    _write(d / "weather_hourly_Maringá_2025-09-08.csv",
           "city,time,temperature_2m,precipitation,relative_humidity_2m,wind_speed_10m\n"
           "Maringá,2025-09-08T00:00,20.5,0.0,50,3\n")
    _write(d / "weather_hourly_Sao_Paulo_2025-09-09.csv",
           "time,city,wind_speed_10m,relative_humidity_2m,precipitation,temperature_2m,extra\n"
           "2025-09-09T01:00,Sao Paulo,4,60,1.5,18.0,x\n")
    _write(d / "notes.txt", "ignore me\n")
    df = CF.read_csv_family(spark, str(d), CF.WEATHER_GLOB)
    got = rows(df, "city", "time", "temperature_2m", "wind_speed_10m", "extra")
    assert got == [("Maringá", "2025-09-08T00:00", "20.5", "3", None),
                   ("Sao Paulo", "2025-09-09T01:00", "18.0", "4", "x")]
    assert CF.read_csv_family(spark, str(d), CF.PRODUCTS_GLOB) is None  # family absent: skipped


def test_latest_file_and_city_from_name(spark, tmp_path):
    for name in ["weather_hourly_Zurich_2025-01-01.csv", "weather_hourly_Aracaju_2025-09-08.csv",
                 "weather_hourly_Sao_Paulo_2025-05-05.csv"]:
        _write(tmp_path / name, "city,time\n")
    files = CF.list_files(spark, str(tmp_path), CF.WEATHER_GLOB)
    assert CF.latest_file(files).endswith("Zurich_2025-01-01.csv")          # by name: city first (T11)
    assert CF.latest_file(files, by="date").endswith("Aracaju_2025-09-08.csv")
    got = rows(files.select(CF.path_key("file_name").alias("c")))
    assert got == [("Aracaju",), ("Sao_Paulo",), ("Zurich",)]


def test_signature_changes_and_md5_parity(spark, tmp_path):
    d = tmp_path / "w"
    d.mkdir()
    empty = L.snapshot_signature(spark, str(d)).first()
    assert (empty["signature"], empty["n_files"]) == ("0", 0)
    _write(d / "a.csv", "x\n1\n")
    _write(d / "b.csv", "x\n")
    _write(d / "skip.txt", "x\n")
    s1 = L.snapshot_signature(spark, str(d)).first()
    exact = L.snapshot_signature(spark, str(d), exact=True).first()
    lines = sorted(f"{p.name}|{p.stat().st_size}|{int(p.stat().st_mtime)}" for p in d.glob("*.csv"))
    assert exact["signature"] == hashlib.md5("\n".join(lines).encode()).hexdigest()
    assert s1["n_files"] == 2
    assert L.snapshot_signature(spark, str(d)).first() == s1          # unchanged
    _write(d / "a.csv", "x\n1\n2\n")                                  # rewritten with another size
    s2 = L.snapshot_signature(spark, str(d)).first()
    assert s2 != s1
    os.remove(d / "b.csv")                                            # removed
    s3 = L.snapshot_signature(spark, str(d)).first()
    assert s3 != s2 and s3["n_files"] == 1


def test_hourly_payloads(spark):
    payloads = spark.createDataFrame(
        [
            ("A", '{"hourly": {"time": ["2025-09-08T00:00", "2025-09-08T01:00"], "temperature_2m": [20.5, null],'
                  ' "precipitation": [0, 1], "relative_humidity_2m": [50, 51], "wind_speed_10m": [3, 4]}}'),
            ("B", "{}"),
            ("C", '{"hourly": {"time": [], "temperature_2m": []}}'),
            ("D", '{"hourly": {"time": ["2025-09-08T00:00"], "temperature_2m": [1, 2]}}'),
            ("E", '{"hourly": {"time": ["2025-09-08T00:00"], "temperature_2m": [7]}}'),
        ],
        "city string, payload string",
    )
    ok, bad = PL.hourly_rows(payloads)
    assert rows(ok, "city", "time", "temperature_2m", "wind_speed_10m") == [
        ("A", "2025-09-08T00:00", 20.5, 3.0), ("A", "2025-09-08T01:00", None, 4.0), ("E", "2025-09-08T00:00", 7.0, None)]
    assert rows(bad, "city") == [("D",)]


def test_geocode_payloads(spark):
    payloads = spark.createDataFrame(
        [
            (1, '{"results": [{"name": "X", "latitude": 1.0, "longitude": 2.0, "country": "Y"},'
                ' {"name": "Z", "latitude": 0, "longitude": 0}]}'),
            (2, '{"results": []}'),
            (3, "{}"),
            (4, '{"results": [{"name": "N", "latitude": -1.5, "longitude": 3}]}'),
        ],
        "query int, payload string",
    )
    found, missing = PL.first_geocode(payloads)
    assert rows(found) == [(1, "X", 1.0, 2.0, "Y"), (4, "N", -1.5, 3.0, "")]
    assert rows(missing, "query") == [(2,), (3,)]


CARD = (
    '<article class="product_pod"><p class="star-rating {r}"></p><h3><a href="{h}" title="{t}">x</a></h3>'
    '<div class="product_price">{p}<p class="instock availability">\n <i class="icon-ok"></i>\n In   stock\n</p>'
    "</div></article>"
)


def test_product_cards(spark):
    html = "<ol>" + "".join([
        CARD.format(r="Three", h="../../a-book_1/index.html", t="Tea &amp; Cake", p='<p class="price_color">£51.77</p>'),
        CARD.format(r="Five", h="/b_2/index.html", t="B", p='<p class="price_color">£1,50</p>'),
        CARD.format(r="Seven", h="https://other.example/c", t="C", p='<p class="price_color">Â£3.00</p>'),
        CARD.format(r="One", h="?page=2", t="D", p=""),
    ]) + '</ol><li class="next"><a href="page-2.html">next</a></li>'
    pages = spark.createDataFrame(
        [(1, "https://shop.example/cat/books/travel/index.html", html),
         (2, "https://shop.example/empty.html", "<p>no cards</p>")],
        "page_id int, url string, html string",
    )
    cards = PG.product_cards(pages, as_of="2025-09-08 00:00:00")
    got = rows(cards, "product_name", "price_gbp", "rating_1to5", "availability", "url")
    assert got == [
        ("B", 1.5, 5, "In stock", "https://shop.example/b_2/index.html"),
        ("C", None, None, "In stock", "https://other.example/c"),
        ("D", None, 1, "In stock", "https://shop.example/cat/books/travel/?page=2"),
        ("Tea & Cake", 51.77, 3, "In stock", "https://shop.example/cat/a-book_1/index.html"),
    ]
    lenient = {r["product_name"]: r["price_gbp"] for r in PG.product_cards(pages, lenient=True).collect()}
    assert lenient["C"] == 3.0
    nxt = {r["page_id"]: r["next_url"] for r in PG.next_links(pages).collect()}
    assert nxt == {1: "https://shop.example/cat/books/travel/page-2.html", 2: None}


def test_resolve_url_matches_urljoin(spark):
    bases = ["http://h.ex/a/b/c", "https://h.ex/a/b/", "http://h.ex", "http://h.ex/a/b?q=1#f",
             "https://m.h.ex/en/25#top", "http://h.ex/x/y/z.html?page=2&r=x"]
    refs = ["../d", "..", ".", "./", "../../x", "x", "?p=2", "#g", "", "//c.ex/y", "/x/../y/./z", "x/..",
            "../../../../e", "a/./b/../c?z=1#k", "https://abs.ex/p", "mailto:x@y.z", "/", "g;x?y#s", "../g",
            "a//b", "//", "///", "///a/../b", "//?x", "//#y", "////a/b", "//a/../b"]
    pairs = list(itertools.product(bases, refs))
    df = spark.createDataFrame(pairs, "base string, href string")
    got = {(r["base"], r["href"]): r["u"] for r in df.select("base", "href", resolve_url("base", "href").alias("u")).collect()}
    bad = [(b, h, got[(b, h)], urljoin(b, h)) for b, h in pairs if got[(b, h)] != urljoin(b, h)]
    assert not bad, bad[:5]
    staged = {(r["base"], r["href"]): r["u"] for r in with_resolved_url(df, "base", "href", "u").collect()}
    assert staged == got


def test_ignore_missing_files_on_listing(spark, tmp_path):
    # A listing never fails because a file vanished between listing and read.
    _write(tmp_path / "a.csv", "x\n")
    files = CF.list_files(spark, str(tmp_path), "*.csv")
    os.remove(tmp_path / "a.csv")
    time.sleep(0.01)
    assert files.count() in (0, 1)


def test_header_sniffing_path_equals_scan_path(spark, tmp_path):
    d = tmp_path / "fam"
    d.mkdir()
    _write(d / "products_2025-09-08.csv", "url,price_gbp\nhttps://x/1,2.0\n")
    _write(d / "products_2025-09-09.csv", "price_gbp,url,extra\n3.5,https://x/2,e\n")
    scan = rows(CF.read_csv_family(spark, str(d), CF.PRODUCTS_GLOB), "url", "price_gbp", "extra")
    sniff = rows(CF.read_csv_family(spark, str(d), CF.PRODUCTS_GLOB, sniff_min_bytes=0), "url", "price_gbp", "extra")
    assert scan == sniff == [("https://x/1", "2.0", None), ("https://x/2", "3.5", "e")]


def test_capped_crawl_reads_visited_pages_alone(spark, monkeypatch):
    page = '<li class="next"><a href="{}">next</a></li><article class="product_pod"><h3><a href="c{}" title="t"></a></h3></article>'
    pages = [(k, f"https://s.example/{k}", page.format(k + 1, k)) for k in range(9)] + [(9, "https://s.example/9", page.format(0, 9))]
    pages = spark.createDataFrame(pages, "page_id long, url string, html string")
    read, own = [], PG.next_links
    monkeypatch.setattr(PG, "next_links", lambda some: read.append(sorted(r["page_id"] for r in some.collect())) or own(some))
    starts = pages.where("page_id IN (0, 8)").select(pages.url.alias("start_url"))
    found = PG.category_cards(pages, starts, as_of="2024-06-01 00:00:00")
    got = sorted((r["start_url"][-1], r["hop"], r["url"][-2:]) for r in found.collect())
    assert got == [("0", 0, "c0"), ("0", 1, "c1"), ("0", 2, "c2"), ("8", 0, "c8"), ("8", 1, "c9"), ("8", 2, "c0")]
    assert read == [[0, 8], [1, 9]]
