"""Streaming: incremental daily aggregate equals the batch result; the watcher
re-runs on new, changed and removed files only (R1-R5, T10, T20)."""

from __future__ import annotations

import datetime as dt
import os

from conftest import rows
from obsengine.operators import aggregate as A
from obsengine.operators import clean as C
from obsengine.plans.registry import rounded
from obsengine.streaming import daily as SD
from obsengine.streaming import watch as SW

SCHEMA = ("city string, time timestamp, temperature_2m double, relative_humidity_2m double, "
          "precipitation double, wind_speed_10m double, ordinal long")


def _readings():
    t0 = dt.datetime(2025, 9, 8)
    out = []
    for i in range(90):
        city = f"c{i % 3}"
        out.append((city, t0 + dt.timedelta(hours=i % 40), float(i % 50) - 10, 50.0, float(i % 7) - 1, 2.0, i))
    out.append(("c0", t0, 99.0, 1.0, 1.0, 1.0, 1000))   # latest reading of an early key, in the first file
    out.append((None, t0, 1.0, 1.0, 1.0, 1.0, 1001))
    return out


def test_stream_daily_equals_batch(spark, tmp_path):
    data = _readings()
    src_dir = tmp_path / "src"
    # Three files; the one holding the highest ordinals lands first.
    chunks = [data[60:] + [data[0]], data[:30], data[30:60]]
    for n, chunk in enumerate(chunks):
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.parquet(str(src_dir / f"f{n}"))
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src_dir)))
    q = SD.stream_daily_weather(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = rows(rounded(SD.read_daily(spark, str(tmp_path / "out"))))
    batch = A.daily_weather(C.clean_weather(spark.createDataFrame(data, SCHEMA), ordinal="ordinal"))
    assert got == rows(rounded(batch)) and len(got) > 0


def test_stream_daily_keeps_cities_of_other_batches(spark, tmp_path):
    data = [r for r in _readings() if r[0] is not None]
    for n, city in enumerate(("c0", "c1", "c2")):  # the same days, one city a file and batch
        chunk = [r for r in data if r[0] == city]
        spark.createDataFrame(chunk, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "src" / f"f{n}"))
    stream = (spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(tmp_path / "src")))
    SD.stream_daily_weather(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination()
    got = rows(rounded(SD.read_daily(spark, str(tmp_path / "out"))))
    batch = A.daily_weather(C.clean_weather(spark.createDataFrame(data, SCHEMA), ordinal="ordinal"))
    assert got == rows(rounded(batch)) and {r[0] for r in got} == {"c0", "c1", "c2"}


def test_watcher_reacts_to_changes(spark, tmp_path):
    d = tmp_path / "watched"
    d.mkdir()
    runs = []
    tick = SW.make_batch_fn(spark, str(d), lambda: runs.append(1), str(tmp_path / "sig"))
    tick(None, 0)                                   # first run before watching
    tick(None, 1)                                   # unchanged: nothing
    assert len(runs) == 1
    (d / "a.csv").write_text("x\n1\n")
    tick(None, 2)
    tick(None, 3)
    assert len(runs) == 2                           # new file: one re-run
    (d / "a.csv").write_text("x\n1\n22\n")
    tick(None, 4)
    assert len(runs) == 3                           # rewritten with another size
    (d / "note.txt").write_text("not csv")
    tick(None, 5)
    assert len(runs) == 3                           # non-CSV files are not watched
    os.remove(d / "a.csv")
    tick(None, 6)
    assert len(runs) == 4                           # removed


def test_watch_runs_once_available_now(spark, tmp_path):
    d = tmp_path / "w2"
    d.mkdir()
    (d / "a.csv").write_text("x\n")
    runs = []
    q = SW.watch(spark, str(d), lambda: runs.append(1), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert len(runs) == 1
    # A restarted watcher keeps the stored signature: no redundant run.
    q = SW.watch(spark, str(d), lambda: runs.append(1), str(tmp_path / "ck"), available_now=True)
    q.awaitTermination()
    assert len(runs) == 1


PRICE_SCHEMA = ("source string, product_name string, price_gbp string, availability string, rating_1to5 string, "
                "url string, scraped_at timestamp, ordinal long")


def test_stream_daily_price_equals_batch(spark, tmp_path):
    t0 = dt.datetime(2025, 9, 8)
    data = [("s", "P", str(10 + i % 9) if i % 11 else "-1", "x", "3", f" u{i % 4} ",
             t0 + dt.timedelta(hours=i % 30), i) for i in range(80)]
    data.append(("s", "P", "99", "x", "3", "u0", t0, 500))   # a late, newer reading of an early key
    src_dir = tmp_path / "src"
    for n, chunk in enumerate([data[60:], data[:30], data[30:60]]):
        spark.createDataFrame(chunk, PRICE_SCHEMA).coalesce(1).write.parquet(str(src_dir / f"f{n}"))
    stream = (spark.readStream.schema(PRICE_SCHEMA).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(str(src_dir)))
    q = SD.stream_daily_price(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"))
    q.awaitTermination()
    got = rows(rounded(SD.read_daily(spark, str(tmp_path / "out"), family="products")))
    batch = A.daily_price(C.clean_products(spark.createDataFrame(data, PRICE_SCHEMA), ordinal="ordinal"))
    assert got == rows(rounded(batch)) and len(got) > 0
