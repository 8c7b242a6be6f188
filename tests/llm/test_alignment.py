"""Alignment against the plain libraries, token by token."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obsengine.llm import alignment as L
from obsengine.llm import queries, tokens

from .conftest import LONG, TEXTS

FILE_A, FILE_B = queries.tokenizer_file(queries.BYTE_BPE), queries.tokenizer_file(queries.PIECES)
MORE = [
    (20, "tab\tand　space, a▁b"),
    (21, "a ▁ b"),
    (22, " leading and trailing "),
    (23, "\n\nlines\n of\n\n\ntext \n"),
    (24, "<s> </s> <unk> <0x0A> <|endoftext|>"),
    (25, "\x00 nul\x00byte ﻿ ​ 🙂🙂🙂"),
    (26, " ".join(random.Random(1).choices(["über", "the", "x.", "naïve", "世界", "12,5", "don't", "(a)"], k=700))),
    (27, "世界" * 300 + " " + "y" * 500),
    (28, "word  " * 200),
]


def plain(text):
    """(bytes of every token, its id) by either library's plain call."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(FILE_A)
    a.encode_special_tokens = True
    sign = tokens.byte_alphabet()
    model = sentencepiece.SentencePieceProcessor(model_file=FILE_B)

    def both():
        for i in a.encode(" " + text, add_special_tokens=False).ids:
            yield 0, i, bytes(sign[c] for c in a.id_to_token(i))
        for i in model.encode(text):
            piece = model.id_to_piece(i)
            yield 1, i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()

    found = [(k, i, b) for k, i, b in both()]
    own = [[(i, b) for k, i, b in found if k == side] for side in (0, 1)]
    whole = (" " + text).encode()
    return own if text and all(b"".join(b for _, b in x) == whole for x in own) else [[], []]


def brute(rows):
    docs, counts = [], collections.Counter()
    for key, text in rows:
        side = plain(text or "")
        ends = []
        for found in side:
            at, out = 0, {}
            for i, b in found:
                at += len(b)
                out[at] = i
            ends.append(out)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, low = [], 0
        for e in both:
            groups.append("|".join(",".join(str(i) for p, i in x.items() if low < p <= e) for x in ends))
            low = e
        links = [(ends[0][e], ends[1][e]) for e in both]
        counts.update(links)
        text = ";".join(groups)
        docs.append((key, len(side[0]), len(side[1]), len(groups), links, hashlib.sha256(text.encode()).hexdigest() if text else ""))
    most = collections.Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return sorted(
        ((k, a, b, g, len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x), s) for k, a, b, g, x, s in docs),
        key=str,
    )


@pytest.mark.parametrize("size,margin", [(L.RANGE, L.MARGIN), (60, 25), (700, 90)])
def test_against_plain_libraries(spark, docs, size, margin):
    rows = [*TEXTS, *MORE]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    clash = frame.select("*", *(F.lit(1).alias(c) for c in ("block", "doc", "part", "t", "pair")))
    got = L.align_tokens(clash, FILE_A, FILE_B, size=size, margin=margin)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_empty(spark, none):
    assert L.align_tokens(none, FILE_A, FILE_B).collect() == []
    one = spark.createDataFrame([(None, None)], "doc_id long, text string")
    assert [tuple(r) for r in L.align_tokens(one, FILE_A, FILE_B).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")]


cuts = st.lists(st.integers(1, 4), min_size=1, max_size=40)


@settings(max_examples=150, deadline=None)
@given(cuts, cuts, st.lists(st.integers(0, 160), max_size=6), st.integers(1, 4))
def test_composition_is_associative(steps_a, steps_b, edges, fan_in):
    """Fragments of any ranges, composed in any grouping, are the whole's."""
    end_a, end_b = np.cumsum(steps_a), np.cumsum(steps_b)
    total = int(max(end_a[-1], end_b[-1]))
    end_a, end_b = (x if x[-1] == total else np.append(x, total) for x in (end_a, end_b))
    a, b = np.arange(len(end_a)), 100 + np.arange(len(end_b))
    edges = [0, *sorted(e for e in edges if e < total), total]
    parts = []
    for low, high in zip(edges, edges[1:]):
        in_a, in_b = (end_a > low) & (end_a <= high), (end_b > low) & (end_b <= high)
        parts.append(L.fragment(a[in_a], b[in_b], end_a[in_a], end_b[in_b]))
    same = lambda x, y: all(np.array_equal(u, v) for u, v in zip(x, y, strict=True))
    whole = L.fragment(a, b, end_a, end_b)
    assert same(L.compose(parts), whole)
    while len(parts) > 1:
        parts = [L.compose(parts[i : i + fan_in + 1]) for i in range(0, len(parts), fan_in + 1)]
    assert same(parts[0], whole)
    assert same(L.compose([L.EMPTY, whole, L.EMPTY]), whole)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="ab é▁\n\t.", max_size=300), st.integers(5, 40))
def test_ranges_tile_the_text(text, size):
    data = (" " + text).encode()
    end = 0
    for first, low, high, stretch in L.ranges(text, size, 8):
        assert low == end and high >= low and first <= low
        assert data[first:].startswith(stretch.encode()) and first + len(stretch.encode()) >= high
        end = high
    assert end == len(data)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab. é世\n\t'▁\x00<|>A1", max_size=60), min_size=1, max_size=8))
def test_encoders_equal_the_libraries(texts):
    import pyarrow as pa

    column = pa.array([" " + t if t else "" for t in texts], pa.string())
    for file in (FILE_A, FILE_B):
        e = tokens.encoder(file, True, True)
        ids, sizes, good = e.encode_checked(column)
        ends = np.cumsum(sizes)
        for t, n, end, fine in zip(texts, sizes, ends, good, strict=True):
            own = ids[end - n : end].tolist()
            if file == FILE_A:
                want = e.tokenizer.encode(" " + t, add_special_tokens=False).ids if t else []
                assert own == want and fine
            elif fine:
                assert own == e.model.encode(t)
            else:
                assert "▁" in t


def test_forgetting_changes_nothing(monkeypatch):
    import pyarrow as pa

    rng = random.Random(3)
    texts = [" " + " ".join(f"w{rng.randrange(300)}" for _ in range(100)) for _ in range(30)]
    small = tokens.Encoder(FILE_A, True, True)
    small.remembered = 150
    for t in texts:
        ids, _, _ = small.encode_checked(pa.array([t, LONG]))
        assert ids.tolist() == [i for x in small._ids([t, LONG]) for i in x]
    assert len(small.number) < 1000
