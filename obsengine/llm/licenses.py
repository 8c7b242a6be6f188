"""Licence scan with a trained paragraph classifier (operator 4).

A multinomial logistic regression over word uni- and bigrams tells the licence
family of a paragraph, or ``unknown``.  It is trained here, on variants of the
templates below (crops, dropped words, ordinary words around them) against
paragraphs of the corpus; a held-out fold calibrates the probabilities by a
temperature.  A prediction counts as confirmed if the paragraph also shares
most word pairs with a template of the predicted family.
"""

from __future__ import annotations

import random
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import raw_texts, with_struct

UNKNOWN = "unknown"
#: Documents of the corpus that the classifier may see as ordinary text.
SAMPLE_DOCS = 300
#: Segments of their paragraphs, and variants of each family's templates.
SAMPLE_PARAGRAPHS, VARIANTS = 1500, 150
#: Longer paragraphs are read in overlapping segments of so many words.
SEGMENT = 48
#: Paragraphs that name a licence are no ordinary text.
NAMED = r"licen[cs]e|copyright|rights reserved"
LEAST_PROBABILITY = 0.5
LEAST_SIMILARITY = 0.6
#: Families from this probability on are held against their whole templates.
OTHER_PROBABILITY = 0.1

# Public licence notices by family.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version.",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "Lesser General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring "
        "rights to this work under CC0.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential.",
    ),
}
# Ordinary sentences with words of licences.
DECOYS = (
    "The driver showed a license to the officer and went on.",
    "Permission was granted by the teacher to leave the room early.",
    "All the rights of the citizens were discussed in public.",
    "The software was released in the general version last year.",
    "The public library is free and open to any person.",
    "He reserved all seats for the work of the foundation.",
    "A copy of the file was distributed under the table.",
    "Commons and lords agreed to the terms in writing.",
)

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 or c in b"\n" else 32
    for c in range(256)
)
HIT = T.StructType(
    [
        T.StructField("family", T.StringType()),
        T.StructField("line", T.LongType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("similarity", T.DoubleType()),
        T.StructField("confirmed", T.BooleanType()),
    ]
)
FIELDS = T.StructType([T.StructField("n_paragraphs", T.LongType()), T.StructField("hits", T.ArrayType(HIT))])


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split()


@dataclass
class Model:
    families: list[str]  # the first is UNKNOWN
    words: dict[bytes, int]  # from 1
    weights: np.ndarray  # of the words, row 0 is zero
    pairs: np.ndarray  # first * len + second, ascending
    pair_weights: np.ndarray
    bias: np.ndarray
    temperature: float
    templates: list[list[frozenset]]  # word pairs of each family's templates

    def numbered(self, words: list[bytes]) -> list[int]:
        get = self.words.get
        return [get(w, 0) for w in words]

    def logits(self, ids: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Of each segment [begin, end) of the numbered words ``ids``."""
        zero = np.zeros((1, len(self.bias)), np.float64)
        total = np.concatenate([zero, np.cumsum(self.weights[ids], axis=0)])
        out = total[end] - total[begin]
        code = ids[:-1] * (len(self.words) + 1) + ids[1:]
        at = np.minimum(np.searchsorted(self.pairs, code), max(len(self.pairs) - 1, 0))
        own = np.where((self.pairs[at] == code)[:, None], self.pair_weights[at], 0.0)
        total = np.concatenate([zero, np.cumsum(own, axis=0)])
        last = np.maximum(end - 1, begin)
        out += total[np.minimum(last, len(own))] - total[np.minimum(begin, len(own))]
        return self.bias + out / np.sqrt(np.maximum(end - begin, 1))[:, None]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)

    def similarity(self, family: int, words: list[bytes]) -> float:
        own = frozenset(zip(words, words[1:], strict=False))
        best = 0.0
        for template in self.templates[family]:
            shared = len(own & template)
            if shared >= 2:
                best = max(best, shared / min(len(own), len(template)))
        return best

    def closest(self, family: int, words: list[bytes]) -> tuple[float, frozenset]:
        """The template of a family of which most is in the words, and its share."""
        own = frozenset(zip(words, words[1:], strict=False))
        return max(((len(own & t) / len(t), t) for t in self.templates[family]), key=lambda x: x[0])

    def rest(self, family: int, words: list[bytes]) -> list[tuple[int, int]]:
        """[begin, end) of the words before and behind the place where the
        closest template of the family is."""
        template = self.closest(family, words)[1]
        own = np.array([p in template for p in zip(words, words[1:], strict=False)], np.int64)
        width = min(len(template), len(own))
        total = np.concatenate([[0], np.cumsum(own)])
        at = int((total[width:] - total[: len(total) - width]).argmax())
        hit = at + np.flatnonzero(own[at : at + width])
        return [(0, int(hit[0])), (int(hit[-1]) + 2, len(words))] if len(hit) else []


def segments(n_words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(paragraph, begin, end) of the segments of paragraphs of so many words."""
    half = SEGMENT // 2
    count = np.where(n_words > SEGMENT, -(-(n_words - SEGMENT) // half) + 1, np.minimum(n_words, 1))
    paragraph = np.repeat(np.arange(len(n_words)), count)
    nth = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    ends = np.cumsum(n_words)
    begin = (ends - n_words)[paragraph] + nth * half
    return paragraph, begin, np.minimum(begin + SEGMENT, ends[paragraph])


def train(ordinary: list[str], seed: int = 7) -> Model:
    """Fit the model on variants of the templates and on ordinary paragraphs."""
    rng = random.Random(seed)
    families = [UNKNOWN, *TEMPLATES]
    fillers = [w for p in ordinary for w in words_of(p)] or [b"and"]
    rows: list[tuple[list[bytes], int]] = []
    for k, family in enumerate(families[1:], 1):
        texts = [words_of(t) for t in TEMPLATES[family]]
        rows += [(t, k) for t in texts for _ in range(4)]
        for _ in range(VARIANTS):
            w = list(rng.choice(texts))
            if len(w) > 12 and rng.random() < 0.5:  # a crop
                a = rng.randrange(len(w) - 10)
                w = w[a : a + rng.randrange(10, 40)]
            w = [x for x in w if rng.random() > 0.06] or w
            front = [rng.choice(fillers) for _ in range(rng.choice((0, 0, 2, 6)))]
            back = [rng.choice(fillers) for _ in range(rng.choice((0, 0, 2, 12)))]
            rows.append((front + w + back, k))
    for p in ordinary[:SAMPLE_PARAGRAPHS]:
        rows.append((words_of(p)[: SEGMENT], 0))
    pool = [w for texts in TEMPLATES.values() for t in texts for w in words_of(t)]
    for d in DECOYS:
        rows += [(words_of(d), 0)] * 10
    for _ in range(4 * VARIANTS):  # licence words in no order, among ordinary ones
        mixed = [rng.choice(pool) for _ in range(rng.randrange(1, 8))]
        mixed += [rng.choice(fillers) for _ in range(rng.randrange(4, 20))]
        rng.shuffle(mixed)
        rows.append((mixed, 0))
    rows = [r for r in rows if r[0]]
    rng.shuffle(rows)
    words = {w: i for i, w in enumerate(sorted(set(pool)), 1)}
    base = len(words) + 1
    seen = {a * base + b for t in TEMPLATES.values() for x in t
            for a, b in zip(*(lambda i: (i, i[1:]))([words[w] for w in words_of(x)]), strict=False)}
    pairs = np.array(sorted(seen), np.int64)
    x = np.zeros((len(rows), base + len(pairs)), np.float64)
    for r, (w, _) in enumerate(rows):
        ids = np.array([words.get(v, 0) for v in w], np.int64)
        np.add.at(x[r], ids[ids > 0], 1.0)
        code = ids[:-1] * base + ids[1:]
        at = np.searchsorted(pairs, code)
        ok = (at < len(pairs)) & (pairs[np.minimum(at, len(pairs) - 1)] == code)
        np.add.at(x[r], base + at[ok], 1.0)
        x[r] /= np.sqrt(len(w))
    y = np.array([k for _, k in rows])
    held = np.arange(len(rows)) % 5 == 0
    target = np.eye(len(families))[y]
    w = np.zeros((x.shape[1], len(families)))
    b = np.zeros(len(families))
    fit, goal = x[~held], target[~held]
    speed_w, speed_b = np.zeros_like(w), np.zeros_like(b)
    for _ in range(400):
        z = fit @ w + b
        z = np.exp(z - z.max(axis=1, keepdims=True))
        off = (z / z.sum(axis=1, keepdims=True) - goal) / len(fit)
        speed_w = 0.9 * speed_w - 4.0 * (fit.T @ off + 1e-5 * w)
        speed_b = 0.9 * speed_b - 4.0 * off.sum(axis=0)
        w, b = w + speed_w, b + speed_b
    templates = [[]] + [
        [frozenset(zip(t, t[1:], strict=False)) for t in map(words_of, TEMPLATES[f])] for f in families[1:]
    ]
    w[0] = 0.0
    model = Model(families, words, w[:base], pairs, w[base:], b, 1.0, templates)
    logits = x[held] @ w + b

    def loss(t: float) -> float:
        model.temperature = t
        return -np.log(np.maximum(model.probabilities(logits)[np.arange(int(held.sum())), y[held]], 1e-12)).mean()

    model.temperature = min((0.25 * 2 ** (k / 4) for k in range(21)), key=loss)
    return model


def scan_texts(model: Model, texts: list[bytes]) -> tuple[list[int], list[list[dict]]]:
    words: list[bytes] = []
    sizes, doc_of, line_of = [], [], []
    n_paragraphs = []
    for d, raw in enumerate(texts):
        n = 0
        for i, line in enumerate(raw.translate(_FOLD).split(b"\n")):
            own = line.split()
            if own:
                words += own
                sizes.append(len(own))
                doc_of.append(d)
                line_of.append(i)
                n += 1
        n_paragraphs.append(n)
    hits: list[list[dict]] = [[] for _ in texts]
    if not words:
        return n_paragraphs, hits
    size = np.array(sizes, np.int64)
    paragraph, begin, end = segments(size)
    starts = np.cumsum(size) - size
    # a segment without any word pair of a template is unknown
    ids = np.array(model.numbered(words), np.int64)
    base = len(model.words) + 1
    paired = np.zeros(base * base, bool)
    paired[model.pairs] = True
    pairs = np.concatenate([[0], np.cumsum(paired[ids[:-1] * base + ids[1:]])])
    some = np.flatnonzero(pairs[np.maximum(end - 1, begin)] > pairs[begin])
    if not len(some):
        return n_paragraphs, hits
    paragraph, begin, end = paragraph[some], begin[some], end[some]
    length = end - begin
    first = np.cumsum(length) - length
    own_ids = ids[np.arange(int(length.sum())) + np.repeat(begin - first, length)]
    p = model.probabilities(model.logits(own_ids, first, first + length))
    best = p.argmax(axis=1)
    last: dict[tuple, list[int]] = {}  # of a document, line and family: place in hits, first word

    def found(at: int, k: int, first_word: int, probability: float, similarity: float) -> None:
        hit = {
            "family": model.families[k],
            "line": line_of[at],
            "first_word": first_word,
            "probability": probability,
            "similarity": similarity,
            "confirmed": similarity >= LEAST_SIMILARITY,
        }
        # overlapping segments of a paragraph count once, by the most similar
        own, key = hits[doc_of[at]], (at, k)
        if key in last and abs(first_word - last[key][1]) < SEGMENT:
            i = last[key][0]
            own[i] = max(own[i], hit, key=lambda h: (h["similarity"], h["probability"]))
            last[key][1] = max(last[key][1], first_word)
        else:
            last[key] = [len(own), first_word]
            own.append(hit)

    def others(at: int, k: int, start: int, own: list[bytes]) -> None:
        """Whole templates of other families around the place of family k."""
        for i, j in model.rest(k, own):
            if j - i < 3:
                continue
            part = own[i:j]
            q = model.probabilities(
                model.logits(np.array(model.numbered(part), np.int64), np.array([0]), np.array([j - i]))
            )[0]
            for other in np.flatnonzero(q >= OTHER_PROBABILITY).tolist():
                share = model.closest(other, part)[0] if other and other != k else 0.0
                if share >= LEAST_SIMILARITY:
                    found(at, other, start + i, float(q[other]), share)
                    others(at, other, start + i, part)
                    break

    for s in np.flatnonzero((p[:, 1:] >= OTHER_PROBABILITY).any(axis=1)):
        at, own = int(paragraph[s]), words[begin[s] : end[s]]
        start, k = int(begin[s] - starts[at]), int(best[s])
        sure = False
        if k and p[s, k] >= LEAST_PROBABILITY:
            similarity = model.similarity(k, own)
            found(at, k, start, float(p[s, k]), similarity)
            sure = similarity >= LEAST_SIMILARITY
        if not sure:  # several families may share the probability
            for k in sorted((np.flatnonzero(p[s, 1:] >= OTHER_PROBABILITY) + 1).tolist(), key=lambda k: -p[s, k]):
                share = model.closest(k, own)[0]
                if share >= LEAST_SIMILARITY:
                    found(at, k, start, float(p[s, k]), share)
                    sure = True
                    break
        if sure:
            others(at, k, start, own)
    return n_paragraphs, [sorted(h, key=lambda x: (x["line"], x["first_word"])) for h in hits]


def fit_on(docs: DataFrame, text: str = "text", key: str = "doc_id") -> Model:
    """Train against a bounded sample: of the SAMPLE_DOCS documents with the
    smallest key hash, the SAMPLE_PARAGRAPHS segments of SEGMENT words with the
    smallest hash, without paragraphs that name a licence.  The ids are chosen
    first; the segments come from the whole texts of the chosen documents,
    however long, and at most SAMPLE_PARAGRAPHS of them reach the driver."""
    hashed = docs.select(F.xxhash64(F.col(key).cast("string")).alias("h"), F.col(text).alias("t")).where("t IS NOT NULL")
    chosen = [r["h"] for r in hashed.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).collect()]
    line = F.explode(F.split("t", "\n")).alias("line")
    lines = hashed.where(F.col("h").isin(chosen)).select("h", line)
    words = F.filter(F.split("line", r"\s+"), lambda w: w != "")
    lines = lines.where(~F.lower("line").rlike(NAMED)).select("h", words.alias("w")).where(F.size("w") > 0)
    begins = F.explode(F.sequence(F.lit(0), F.size("w") - 1, F.lit(SEGMENT))).alias("i")
    parts = lines.select("h", "w", begins).select("h", F.array_join(F.slice("w", F.col("i") + 1, SEGMENT), " ").alias("p"))
    rows = parts.distinct().orderBy(F.xxhash64("h", "p"), "p").limit(SAMPLE_PARAGRAPHS).collect()
    return train([r["p"] for r in rows])


def scan_licenses(docs: DataFrame, model: Model | None = None, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column ``licenses``: number of paragraphs (lines
    with words) and the licence hits of each whole text by line; returns the
    frame and the column's name.

    Without a model one is trained on a bounded sample of ``docs``.  NULL and
    empty texts have no paragraph; repeated rows have equal hits; an empty
    table gives no rows; extra columns are kept, and a column already called
    ``licenses`` gets an underscore beside it.
    """
    model = model or fit_on(docs, text)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a fixed size: the templates' n-grams

    def make():
        def work(part: pa.RecordBatch):
            return list(scan_texts(sent.value, raw_texts(part.column(part.schema.names.index(text)))))

        return work

    return with_struct(docs, "licenses", FIELDS, text, make)


def license_report(docs: DataFrame) -> DataFrame:
    """One row a document: paragraphs, confirmed families and all hits."""
    found, name = scan_licenses(docs.select("doc_id", "text"))
    hits = F.col(f"{name}.hits")
    sure = F.filter(hits, lambda h: h["confirmed"])
    return found.select(
        "doc_id",
        F.col(f"{name}.n_paragraphs"),
        F.size(hits).cast("long").alias("n_hits"),
        F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda h: h["family"]))), ",").alias("families"),
        hits.alias("hits"),
    )
