"""Archives: round trip, revisits, and what is salvaged from damaged ones."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.llm import warc

SCHEMA = "page_id long, url string, html string"
BIG = "<p>same</p>" * 30
PAGES = [
    (1, "http://a.ex/1", "<p>one\r\n\r\nWARC/1.1\r\nWARC-Type: response</p>"),
    (2, None, None),
    (3, "http://a.ex/ü 3\r\nX: y", ""),
    (9, "http://a.ex/9", BIG),
    (7, "http://a.ex/7", BIG),
    (7, "http://a.ex/7", BIG),
    (None, "http://a.ex/n", BIG),
    (8, "http://a.ex/8", "short"),
    (10, "http://a.ex/10", "short"),
    (11, "http://a.ex/11", "Üñí 世界 " * 40_000),
    (12, "http://a.ex/12", "\x00\x1f\x8b\x08 controls"),
]


def digest(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def expected(pages):
    """One row a page, by comparing all of them."""
    out = []
    for i, _, html in pages:
        n = len((html or "").encode())
        ids = [k for k, _, h in pages if (h or "") == (html or "") and k is not None]
        first = min(ids, default=None) if n >= 100 else None
        again = first is not None and (i is None or i > first)
        out.append((i, n, digest(html), "revisit" if again else "response", first if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    pages = spark.createDataFrame(PAGES, SCHEMA).repartition(3)
    got = warc.archive_digest(pages.withColumn("d", F.lit(1)).withColumn("first", F.lit(2)))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(PAGES)
    read = warc.read_archives(spark, warc.write_archives(pages, archive_bytes=500))
    assert read.where("gap IS NOT NULL").count() == 0
    assert read.select("archive").distinct().count() > 3
    body = {warc.page_of(r.record_id): r.payload for r in read.where("record_type = 'response'").collect()}
    for i, _, html in PAGES:
        if i != 9 and i is not None:
            assert bytes(body[i]).decode() == (html or "")
    uris = [r.target_uri for r in read.collect()]
    assert "http://a.ex/ü%203%0D%0AX:%20y" in uris and None in uris


def test_empty(spark):
    assert warc.archive_digest(spark.createDataFrame([], SCHEMA)).collect() == []


def records(plain, n=30, seed=5):
    """Records one after another, plain or in members, and where each begins."""
    rng = random.Random(seed)
    out, at = [], []
    for i in range(n):
        body = bytes(rng.choices(b"abc <>\r\nWARC/1.1", k=rng.randrange(0, 900)))
        record = warc.make_record(i, f"http://a.ex/{i}", body, None, hashlib.sha256(body).hexdigest())
        at.append(sum(map(len, out)))
        if not plain:
            squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
            record = squeeze.compress(record) + squeeze.flush()
        out.append(record)
    return out, at


def check(data, whole, at):
    """All records in ``whole`` are found in place, and gaps and records tile the data."""
    found = list(warc.salvage(data))
    end = 0
    for offset, length, _ in found:
        assert offset == end
        end += length
    assert end == len(data)
    got = {o: warc.page_of(r.fields["warc-record-id"]) for o, _, r in found if not isinstance(r, str)}
    for i in whole:
        assert got.get(at[i]) == i
    assert set(got.values()) == set(whole)
    return [(o, n, why) for o, n, why in found if isinstance(why, str)]


@pytest.mark.parametrize("plain", [True, False])
def test_whole_archive_has_no_gap(plain):
    out, at = records(plain)
    assert check(b"".join(out), range(30), at) == []


@pytest.mark.parametrize("plain", [True, False])
@settings(max_examples=60, deadline=None)
@given(hit=st.integers(0, 29), where=st.floats(0, 0.999), flip=st.integers(1, 255))
def test_changed_byte_costs_one_record(plain, hit, where, flip):
    out, at = records(plain)
    record = bytearray(out[hit])
    place = int(where * len(record))
    if not plain and 4 <= place < 10:
        return  # time and system of a member's header carry no check
    record[place] ^= flip
    if plain:
        # of a plain header only what a check covers counts as damage
        if place < len(record) - 4 and place < bytes(out[hit]).index(b"\r\n\r\n"):
            return
    out[hit] = bytes(record)
    gaps = check(b"".join(out), [i for i in range(30) if i != hit], at)
    assert gaps == [(at[hit], len(out[hit]), gaps[0][2])]


@pytest.mark.parametrize("plain", [True, False])
def test_lost_and_foreign_bytes(plain):
    out, at = records(plain)
    foreign = b"\x1f\x8b\x08 no member WARC/1.1\r\nno record" * 50
    data = b"".join(out[:10]) + foreign + b"".join(out[10:20]) + out[20][: len(out[20]) // 2]
    place = at[:10] + [a + len(foreign) for a in at[10:20]]
    gaps = check(data, range(20), place)
    assert [(o, n) for o, n, _ in gaps] == [(at[10], len(foreign)), (at[20] + len(foreign), len(out[20]) // 2)]
    assert check(foreign, [], []) == [(0, len(foreign), gaps[0][2])]
    assert list(warc.salvage(b"")) == []


def test_damaged_files_are_read_by_spark(spark, tmp_path):
    out, at = records(False)
    (tmp_path / "a.warc.gz").write_bytes(b"".join(out[:5]) + b"\x00" * 77 + b"".join(out[5:]))
    plain, _ = records(True)
    (tmp_path / "b.warc").write_bytes(b"".join(plain)[:-3])
    (tmp_path / "c.warc").write_bytes(b"")
    read = warc.read_archives(spark, str(tmp_path)).cache()
    gaps = [tuple(r) for r in read.where("gap IS NOT NULL").select("archive", "offset", "length").orderBy("archive").collect()]
    assert gaps[0] == ("a.warc.gz", at[5], 77) and gaps[1][0] == "b.warc" and len(gaps) == 2
    assert warc.pages_of(read).groupBy("record_type").count().collect()[0]["count"] == 59
