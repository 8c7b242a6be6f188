"""Near-duplicate detection with ProbMinHash (operator 8).

A document is the multiset of its shingles of five words, the weight of a
shingle is how often it occurs.  The probability Jaccard of two documents is
the chance that independent exponential races with these weights have the same
winner; with equal weights it is the plain Jaccard similarity.  ProbMinHash
draws for each shingle the arrivals of a Poisson process whose rate is its
weight, deals each arrival to one of the registers, and stops a shingle's
arrivals as soon as they are later than all registers of the document.

Documents with equal words collapse first.  Bands of registers give the
candidates; a bucket's members are verified against one leader.  Buckets whose
members aren't all connected by then are compared in full: small ones by pairs,
larger ones by pairs of blocks, whose members are counted against each other
inside a task that returns a spanning forest of the links.  No link that would
join two groups is lost, and no pairs of a large group are ever rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, mix, raw_texts, slices, staged, word_hashes
from .tokens import release

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 6
#: Buckets up to this size are compared by pairs, larger ones in blocks.
SMALL = 32
#: Members of a block; a task holds two blocks.
BLOCK = 512

#: Bytes of text worked at once: a task's arrays take a multiple of it.
SLICE_BYTES = 1 << 20

_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[bytes], size: int = SHINGLE):
    """(documents, shingles, weights) of all distinct shingles, by document;
    (number of words, 128-bit hash of the words) of each document.  A text of
    fewer words than ``size`` has one shingle of all its words."""
    import xxhash

    words, counts = word_hashes(texts)
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(texts)), counts)
    copies = [
        xxhash.xxh3_128_digest(words[e - n : e].tobytes()) if n else None
        for e, n in zip(ends.tolist(), counts.tolist(), strict=True)
    ]
    at = np.arange(len(words))
    value = words.copy()
    for k in range(1, size):
        inside = at + k < ends[doc]
        following = words[np.minimum(at + k, max(len(words) - 1, 0))]
        value = np.where(inside, mix(value * _STEP + following), value)
    first = at == (ends - counts)[doc]
    real = (at + size <= ends[doc]) | first
    doc, value = doc[real], value[real]
    # equal shingles of a document meet under one key
    key = mix(value + _STEP * (doc.astype(np.uint64) + np.uint64(1)))
    _, where, weights = np.unique(key, return_index=True, return_counts=True)
    by = np.argsort(doc[where], kind="stable")
    where = where[by]
    return doc[where], value[where], weights[by], counts, copies


def signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The shingle that wins each register of each document."""
    arrival = np.full(n_docs * registers, np.inf)
    winner = np.zeros(n_docs * registers, np.uint64)
    live = np.arange(len(doc))
    time = np.zeros(len(doc))
    state = mix(value + _STEP)
    while len(live):
        state = mix(state + _STEP)
        uniform = ((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53
        time = time - np.log(uniform) / weight[live]
        own = doc[live]
        place = own * registers + (mix(state ^ _STEP) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(time < arrival[place])
        early = early[np.argsort(-time[early], kind="stable")]  # the earliest is written last
        arrival[place[early]] = time[early]
        won = early[arrival[place[early]] == time[early]]
        winner[place[won]] = value[live[won]]
        docs, which = np.unique(own, return_inverse=True)
        latest = arrival.reshape(n_docs, registers)[docs].max(axis=1)
        on = time < latest[which]  # later arrivals can't win any more
        live, time, state = live[on], time[on], state[on]
    return winner.reshape(n_docs, registers)


def band_keys(winner: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.zeros((len(winner), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(winner), b + 1, np.uint64)
        for r in range(rows):
            key = mix(key * _STEP + winner[:, b * rows + r])
        out[:, b] = key
    return out.view(np.int64)


def probability_jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """J_P of two weighted sets given by ascending distinct keys."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    wa, wb = wa.astype(np.float64), wb.astype(np.float64)
    x, y = wa[i], wb[j]
    ratio = y / x
    only_a, only_b = wa.sum() - x.sum(), wb.sum() - y.sum()
    levels, which = np.unique(ratio, return_inverse=True)
    sum_x = np.cumsum(np.bincount(which, x, len(levels))) + only_a  # ratio at most this level
    own_y = np.bincount(which, y, len(levels))
    sum_y = own_y.sum() - np.cumsum(own_y) + only_b  # ratio above it
    return float((y / (ratio * sum_x[which] + sum_y[which])).sum())


def connected(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the links (a, b): alternating large and
    small stars until nothing changes; the label is the smallest node."""
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = staged(large, "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = staged(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    )


def _weighted(keys: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    k = np.frombuffer(keys, np.uint64)
    return k, np.frombuffer(weights, "<u4") if weights else np.ones(len(k))


def _forest(threshold: float):
    """Links between the members of two blocks that join different groups,
    without those that others imply."""

    def run(table: pa.Table) -> pa.Table:
        copies, groups = table.column("copy").to_pylist(), table.column("group").to_pylist()
        keys, weights = table.column("keys").to_pylist(), table.column("weights").to_pylist()
        left = np.asarray(table.column("left"))
        same_block = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        sizes = np.array([len(k) // 8 for k in keys], np.int64)
        _, which = np.unique(np.concatenate([np.frombuffer(k, np.uint64) for k in keys]), return_inverse=True)
        row = np.repeat(np.arange(len(keys)), sizes)
        plain = np.array([not w for w in weights])
        own = np.concatenate([_weighted(k, w)[1] for k, w in zip(keys, weights, strict=True)])
        total = np.bincount(row, own, len(keys))
        # a shingle that one member alone has is shared with nobody
        common = np.bincount(which) > 1
        kept = common[which]
        row, own, which = row[kept], own[kept], (np.cumsum(common) - 1)[which[kept]]
        # share[a, b]: the part of a's weight on shingles that b has too, some
        # shingles at a time
        share = np.zeros((len(keys), len(keys)), np.float32)
        order = np.argsort(which, kind="stable")
        which, row, own = which[order], row[order], own[order]
        for start in range(0, int(common.sum()), 4096):
            a, b = np.searchsorted(which, (start, start + 4096))
            at = row[a:b], which[a:b] - start
            here, part = np.zeros((2, len(keys), 4096), np.float32)
            here[at] = 1.0
            part[at] = own[a:b] / total[row[a:b]]
            share += part @ here.T
        # J_P is at most the sum of the lesser normalised weights, so at most
        # the lesser share; with equal weights it is known but for rounding
        shared = share * sizes[:, None]
        plainly = shared / np.maximum(sizes[:, None] + sizes[None, :] - shared, 0.5)
        likely = np.where(plain[:, None] & plain[None, :], plainly, np.minimum(share, share.T))
        maybe = likely >= threshold - 1e-4
        number = {g: n for n, g in enumerate(dict.fromkeys(groups))}
        group = np.array([number[g] for g in groups])
        maybe &= group[:, None] != group[None, :]
        maybe &= np.triu(np.ones_like(maybe), 1) if same_block else left[:, None] & ~left[None, :]
        parent = list(range(len(number)))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        for x, y in zip(*np.nonzero(maybe), strict=True):
            gx, gy = root(group[x]), root(group[y])
            if gx != gy and probability_jaccard(
                *_weighted(keys[x], weights[x]), *_weighted(keys[y], weights[y])
            ) >= threshold - 1e-12:
                parent[gx] = gy
                found.append((copies[x], copies[y]))
        cols = list(zip(*found, strict=True)) or [(), ()]
        return pa.table([pa.array(c, pa.binary()) for c in cols], names=["a", "b"])

    return run


def near_duplicates(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
    size: int = SHINGLE,
) -> DataFrame:
    """One row a row of ``docs`` (doc_id, text): doc_id, text_hash, class_id
    (the smallest doc_id of its group of near duplicates) and representative
    (true in one (doc_id, text_hash) of each group).

    Texts with equal words are of one group, even if they differ in white
    space or letter case (A-Z).  NULL and empty texts are alone, each its own
    group.  Rows without doc_id take part and come first in their order.
    Repeated rows share their group.  An empty table gives no row; other
    columns are not read.
    """
    src = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text"), F.xxhash64("text").alias("text_hash")
    )
    registers = bands * rows

    def sign(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = raw_texts(part.column(1))
                doc, value, weight, counts, copies = shingles(texts, size)
                keys = band_keys(signatures(doc, value, weight, len(texts), registers), bands, rows)
                offsets = pa.array(np.arange(0, len(texts) * bands + 1, bands, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(copies, pa.binary()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))],
                    ["doc_id", "text_hash", "copy", "bands"],
                )
        release()

    schema = "doc_id long, text_hash long, copy binary, bands array<long>"
    signed = staged(src.mapInArrow(sign, schema), "signatures")

    one = F.struct("doc_id", "text_hash")
    texts = signed.where("copy IS NOT NULL").groupBy("copy").agg(
        F.min(one).alias("at"), F.first("bands").alias("bands")
    )
    entries = texts.select("copy", F.explode("bands").alias("bucket"))
    leaders = entries.groupBy("bucket").agg(F.min("copy").alias("leader"), F.count("*").alias("n"))
    members = staged(entries.join(leaders.where("n > 1").drop("n"), "bucket"), "buckets")

    wanted = members.select("copy").distinct().join(texts.select("copy", "at.*"), "copy")
    wanted = wanted.select(F.col("copy").alias("wanted"), F.col("doc_id").alias("w_doc"), F.col("text_hash").alias("w_hash"))
    found = src.join(wanted, F.col("doc_id").eqNullSafe(F.col("w_doc")) & (F.col("text_hash") == F.col("w_hash")))

    def sets_of(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                texts = raw_texts(part.column(1))
                doc, value, weight, _, copies = shingles(texts, size)
                cut = np.searchsorted(doc, np.arange(len(texts) + 1))
                keys, weights = [], []
                for a, b in zip(cut, cut[1:], strict=False):
                    by = np.argsort(value[a:b])
                    keys.append(value[a:b][by].tobytes())
                    weights.append(weight[a:b][by].astype("<u4").tobytes() if (weight[a:b] > 1).any() else b"")
                mine = np.array([c == w for c, w in zip(copies, part.column(0).to_pylist(), strict=True)], bool)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(keys, pa.binary()), pa.array(weights, pa.binary())],
                    ["copy", "keys", "weights"],
                ).filter(pa.array(mine))
        release()

    sets = found.select("wanted", "text").mapInArrow(sets_of, "copy binary, keys binary, weights binary")
    sets = staged(sets.dropDuplicates(["copy"]), "shingles")

    def verified(pairs: DataFrame) -> DataFrame:
        def check(batches):
            for batch in batches:
                a, ak, aw, b, bk, bw = (batch.column(i).to_pylist() for i in range(6))
                sim = [
                    probability_jaccard(*_weighted(k, w), *_weighted(x, y))
                    for k, w, x, y in zip(ak, aw, bk, bw, strict=True)
                ]
                yield pa.RecordBatch.from_pydict(
                    {"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "similarity": pa.array(sim, pa.float64())}
                )

        left = sets.select(F.col("copy").alias("a"), F.col("keys").alias("ak"), F.col("weights").alias("aw"))
        right = sets.select(F.col("copy").alias("b"), F.col("keys").alias("bk"), F.col("weights").alias("bw"))
        rows = pairs.join(left, "a").join(right, "b").select("a", "ak", "aw", "b", "bk", "bw")
        return staged(rows.mapInArrow(check, "a binary, b binary, similarity double"), "verified")

    linked = F.col("similarity") >= threshold - 1e-12
    pairs = members.where("copy <> leader").select(F.col("leader").alias("a"), F.col("copy").alias("b"))
    links = verified(pairs.distinct()).where(linked).select("a", "b")
    labels = staged(connected(links), "labels")

    # buckets that still hold several groups
    here = members.select("bucket", "copy").join(
        labels.select(F.col("node").alias("copy"), F.col("label").alias("group")), "copy", "left"
    )
    here = here.withColumn("group", F.coalesce("group", "copy"))
    groups = here.groupBy("bucket", "group").agg(F.count("*").alias("n"))
    mixed = groups.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "group")).alias("top"), F.count("*").alias("groups")
    )
    mixed = mixed.where("groups > 1").select("bucket", "n", F.col("top.group").alias("top"))
    here = staged(here.join(mixed, "bucket"), "mixed")
    small, large = here.where(F.col("n") <= SMALL), here.where(F.col("n") > SMALL)
    # small: of two members of different groups one is outside the largest group
    rest = small.where("group <> top").select("bucket", F.col("copy").alias("a"), F.col("group").alias("ga"))
    others = small.select("bucket", F.col("copy").alias("b"), F.col("group").alias("gb"))
    pairs = rest.join(others, "bucket").where("ga <> gb")
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    more = verified(pairs).where(linked).select("a", "b")
    # large: blocks of members, each pair of blocks in a task of its own
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("copy"), blocks).cast("int")
    dealt = large.select("bucket", "copy", "group", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    dealt = dealt.select(
        "bucket", "copy", "group", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") <= F.col("other")).alias("left"),
    )
    found = dealt.join(sets, "copy").groupBy("bucket", "i", "j").applyInArrow(_forest(threshold), "a binary, b binary")
    labels = staged(connected(links.unionByName(more).unionByName(staged(found.distinct(), "forest"))), "labels")

    grouped = signed.select("doc_id", "text_hash", "copy").join(
        labels.select(F.col("node").alias("copy"), "label"), "copy", "left"
    )
    # texts without words are groups of their own
    alone = F.struct(F.col("doc_id"), F.col("text_hash"))
    grouped = grouped.withColumn("label", F.coalesce("label", "copy"))
    worded = grouped.where("label IS NOT NULL")
    first = worded.groupBy("label").agg(F.min(alone).alias("first"))
    out = worded.join(first, "label")
    cols = ["doc_id", "text_hash", F.col("first.doc_id").alias("class_id"), alone.eqNullSafe(F.col("first")).alias("representative")]
    empty = grouped.where("label IS NULL").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(True).alias("representative")
    )
    return out.select(*cols).unionByName(empty)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each group of near duplicates, with its own columns.
    Repeated rows of one (doc_id, text) count once."""
    k, h, own = (free_name(docs.columns, c) for c in ("_k", "_h", "_h_own"))
    keep = near_duplicates(docs.select("doc_id", "text"), threshold).where("representative")
    keep = keep.select(F.col("doc_id").alias(k), F.col("text_hash").alias(h)).distinct()
    mine = docs.withColumn(own, F.xxhash64("text"))
    on = F.col("doc_id").cast("long").eqNullSafe(F.col(k)) & (F.col(own) == F.col(h))
    return mine.join(keep, on, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
