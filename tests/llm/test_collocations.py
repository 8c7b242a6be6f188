"""Collocations against counting every phrase."""

from __future__ import annotations

import collections
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, longest=5, top=2000):
    """All collocations of (text, lang) rows."""
    n, f = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for d in range(1, min(longest, len(words) - i) + 1):
                    f[lang, tuple(words[i : i + d])] += 1
    f = {k: v for k, v in f.items() if v >= least}
    out = collections.defaultdict(list)
    for (lang, p), a in f.items():
        if len(p) < 2:
            continue
        around = [
            v for (other, q), v in f.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
        ]
        if any(100 * v >= 100 * a for v in around):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, le, r, n[lang], -s)
        for lang, rows in out.items() for i, (s, a, p, le, r) in enumerate(sorted(rows)[:top], 1)
    )


TEXTS = [
    ("New York is big. new york, New York! The new\tyork times", "en"),
    ("new york times and new york times; new york times", "en"),
    ("A b c d e f g\x0ba b c d e f\x0ca b c d e f", "en"),
    ("x x x x x x x x x x x x", None),
    ("x x x X x", "und"),
    (None, "en"),
    ("", None),
    ("über über Über ÜBER  über", "de"),
    ("w " * 3000 + "v u " * 500, "fr"),
    ("Same row again, same row again", "en"),
    ("Same row again, same row again", "en"),
    (" \t .,;:!?\r\n", "en"),
]


def frame(spark, rows):
    rows = [(i, t, la, "s", None) for i, (t, la) in enumerate(rows)]
    return spark.createDataFrame(rows, SCHEMA)


def test_against_counting(spark, monkeypatch):
    docs = frame(spark, TEXTS).repartition(3)
    clash = docs.select("*", *(F.lit(1).alias(c) for c in ("ids", "word", "score", "block", "n")))
    for least, block, rows in ((2, 1 << 20, 1_000_000), (3, 40, 5)):
        monkeypatch.setattr(C, "BUCKET_ROWS", rows)
        got = C.collocations(clash, least=least, block_bytes=block)
        assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, got.collect())) == brute(TEXTS, least)


def test_few_of_many_and_ties(spark):
    rows = [(f"p{i:02d} q{i:02d}. p{i:02d} q{i:02d}", "en") for i in range(30)]
    got = C.collocations(frame(spark, rows), least=2, top=7).collect()
    assert sorted(map(tuple, got)) == brute(rows, 2, top=7)
    assert [r.phrase for r in sorted(got, key=lambda r: r["rank"])] == [f"p{i:02d} q{i:02d}" for i in range(7)]


def test_empty(spark):
    for rows in ([], [(None, None)], [("rare words only", "en")]):
        assert C.collocations(frame(spark, rows)).collect() == []


def test_products_beyond_64_bits(spark):
    """The score's division, at counts no test table reaches."""
    a, n, le, r = 123_456_789_012, 987_654_321_098_765, 223_456_789_012, 323_456_789_012
    exact = lambda c: f"CAST({c} AS DECIMAL(18, 0))"
    row = spark.createDataFrame([(a, n, le, r)], "a long, n long, l long, r long")
    got = row.select(F.expr(f"CAST({C.SCALE} * {exact('a')} AS DECIMAL(20, 0)) * {exact('n')} div ({exact('l')} * {exact('r')})")).first()[0]
    assert got == 1000 * a * n // (le * r)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=200), st.integers(1, 5))
def test_partition_sizes_are_counts(words, depth):
    words = np.array(words, np.int32)
    at = np.arange(len(words))
    length = np.minimum(len(words) - at, depth)
    got = collections.Counter()
    for d, pointer, size in C.multikey_quicksort(words, at, length, depth):
        for p, n in zip(pointer.tolist(), size.tolist(), strict=True):
            phrase = tuple(words[p : p + d].tolist())
            assert phrase not in got
            got[phrase] = n
    want = collections.Counter(
        tuple(words[i : i + d].tolist()) for i in range(len(words)) for d in range(1, depth + 1) if i + d <= len(words)
    )
    assert got == want


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(-(2**63) + 1, 2**63 - 1), st.integers(0, 5)), max_size=50))
def test_packing(rows):
    columns = [np.array([r[k] for r in rows], np.int64) for k in (0, 1)]
    with np.errstate(over="ignore"):
        assert np.array_equal(C.unpack(C.pack(columns), 2), np.array(columns))


def test_reach():
    linked = np.array([1, 1, 0, 1, 1, 1, 1, 1, 0], bool)
    assert C._reach(linked, 5).tolist() == [3, 2, 1, 5, 5, 4, 3, 2, 1]
    assert C._reach(linked[:0], 5).tolist() == []
