"""Collocations by sorting suffix pointers (operator 11).

A suffix is a pointer to a word and the words behind it up to the end of its
piece.  Texts are gathered to blocks of one language; in a block a multikey
quicksort partitions pointers three ways by their first word, the partition of
equal words by the second, and so on to the greatest depth.  The size of an
equal partition is the count of its phrase in the block.

Counts of blocks are routed to buckets by a hash of their words, and a bucket
adds them up.  That happens for single words, then for leading word pairs,
before anything deeper is sorted: a block gets back which of its words and
pairs reach the least count, pointers end at the first pair that doesn't, and
partitions of infrequent leads are abandoned unsorted.  A phrase however
frequent has one count a block, and the number of buckets grows with the
number of counts, so a bucket's size does not grow with the input.  Counts
travel packed: sorted, as differences, compressed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import mix, raw_texts, slices, staged, word_hashes

LONGEST = 5
LEAST = 100
TOP = 2000
#: A longer phrase with so many percent of a phrase's count replaces it.
REPLACES_PERCENT = 100
#: The score counts thousandths.
SCALE = 1000
#: Texts of one language are sorted in blocks of about so many bytes.
BLOCK_BYTES = 16 << 20
#: Counts that one bucket adds up, about.
BUCKET_ROWS = 1_000_000
#: Blocks that one task may number.
BLOCK_BITS = 24

# The ASCII bytes that end a piece, and those that end a word.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"

_FOLD = bytes(
    10 if b in PIECE_ENDS else 32 if b in WORD_ENDS else b + 32 if 65 <= b <= 90 else b for b in range(256)
)

BLOCKS = "block long, lang string, n_words long, n_rows long, codes binary, words binary, counts binary"
CODED = "block long, lang string, n_rows long, gids binary, codes binary, pairs binary"
#: Counts of a block that go to one bucket, and where they came from in it.
CELLS = "lang string, bucket long, block long, depth int, rows binary, counts binary, places binary"
#: What a bucket finds: frequent phrases (``ids``, ``f``, a single word's own
#: ``word``), and for each block which of its rows they are.
FOUND = "lang string, word string, ids array<long>, f long, block long, places binary, gids binary"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def pack(columns: list[np.ndarray]) -> bytes:
    """Columns of integers, compressed: the first as differences, all by the
    bytes of equal weight."""
    out = []
    for k, x in enumerate(columns):
        x = np.diff(x.astype("<i8"), prepend=0) if k == 0 else x.astype("<i8")
        out.append(np.ascontiguousarray(x.view(np.uint8).reshape(-1, 8).T).tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes, columns: int) -> np.ndarray:
    """The packed columns, as rows of a matrix."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    found = np.ascontiguousarray(raw.reshape(columns, 8, -1).transpose(0, 2, 1)).view("<i8")[:, :, 0].astype(np.int64)
    found[0] = np.cumsum(found[0])
    return found


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(data)


def _codes(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


def cut_words(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts in order, and for each the number of its piece."""
    data = np.frombuffer(b"\n".join(texts).translate(_FOLD) + b"\n", np.uint8)
    apart = (data == 10) | (data == 32)
    edge = np.flatnonzero(np.diff(apart, prepend=True))
    begin, end = edge[::2], edge[1::2]
    piece = np.cumsum(data == 10, dtype=np.int32)[begin]
    offsets = np.concatenate([[0], np.cumsum(end - begin)])
    large = len(data) >= 1 << 31
    words = pa.Array.from_buffers(
        pa.large_string() if large else pa.string(), len(begin),
        [None, pa.py_buffer(offsets.astype(np.int64 if large else np.int32)), pa.py_buffer(data[~apart])],
    )
    return words, piece


def apart(codes: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """The codes with a -1 wherever a new piece begins."""
    new = np.zeros(len(codes), np.int64)
    new[1:] = np.cumsum(piece[1:] != piece[:-1])
    out = np.full(len(codes) + (int(new[-1]) if len(new) else 0), -1, np.int32)
    out[np.arange(len(codes)) + new] = codes
    return out


def multikey_quicksort(
    words: np.ndarray, at: np.ndarray, length: np.ndarray, depth: int
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Three-way partitions of the pointers ``at`` into ``words``, each of
    which reaches over ``length`` (one or more) words, to ``depth`` words.

    Yields (depth, a pointer of each equal partition, the partitions' sizes);
    each distinct phrase of a depth is in exactly one partition.  All
    partitions of a round are split together.
    """
    size = np.array([len(at)] if len(at) else [], np.int64)
    level = np.zeros(len(size), np.int64)
    while len(at):
        start = np.cumsum(size) - size
        of = np.repeat(np.arange(len(size)), size)
        key = words[at + level[of]]
        a, b, c = key[start], key[start + size // 2], key[start + size - 1]
        pivot = np.maximum(np.minimum(a, b), np.minimum(np.maximum(a, b), c))[of]
        less, more = key < pivot, key > pivot
        same = ~(less | more)
        equal = np.add.reduceat(same, start, dtype=np.int64)
        first = np.flatnonzero(same)[np.cumsum(equal) - equal]
        for d in range(depth):
            there = level == d
            if there.any():
                yield d + 1, at[first[there]], equal[there]
        same &= length > level[of] + 1
        same &= (level + 1 < depth)[of]
        parts = [(m, np.add.reduceat(m, start, dtype=np.int64), up) for m, up in ((less, 0), (same, 1), (more, 0))]
        level = np.concatenate([(level + up)[n > 0] for _, n, up in parts])
        size = np.concatenate([n[n > 0] for _, n, _ in parts])
        at, length = (np.concatenate([x[m] for m, _, _ in parts]) for x in (at, length))


def _reach(linked: np.ndarray, depth: int) -> np.ndarray:
    """Words that a pointer at each place reaches, if ``linked`` says whether
    the next word belongs to it."""
    n = len(linked)
    reach, on = np.ones(n, np.int64), linked.copy()
    for k in range(min(depth - 1, n)):
        on[: n - k] &= linked[k:]
        on[n - k :] = False
        reach += on
    return reach


def word_blocks(docs: DataFrame, text: str, lang: str, block_bytes: int) -> DataFrame:
    """The texts' words as numbers of a block's own dictionary, written."""
    src = docs.select(
        F.coalesce(F.col(text), F.lit("")).alias("t"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("l")
    )

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        held: dict[str, list[bytes]] = {}
        size = count = 0

        def block(name: str, texts: list[bytes]) -> pa.RecordBatch:
            nonlocal count
            words, piece = cut_words(texts)
            coded = words.dictionary_encode()
            codes = np.asarray(coded.indices)
            n = np.bincount(codes, minlength=len(coded.dictionary))
            count += 1
            own = b"\n".join(coded.dictionary.cast(pa.binary()).to_pylist())
            row = (
                (task << BLOCK_BITS) + count - 1, name, len(codes), len(n),
                _squeeze(apart(codes, piece).astype("<i4").tobytes()), _squeeze(own), pack([n]),
            )
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], _names(BLOCKS))

        for batch in batches:
            for part in slices(batch, "t"):
                for name, t in zip(part.column(1).to_pylist(), raw_texts(part.column(0)), strict=True):
                    held.setdefault(name, []).append(t)
                    size += len(t) + 1
                    if size >= block_bytes:
                        for name_, texts in held.items():
                            yield block(name_, texts)
                        held, size = {}, 0
        for name, texts in held.items():
            yield block(name, texts)

    return staged(src.mapInArrow(run, BLOCKS), "word-blocks")


def _bucket_cells(
    row: tuple, hashes: np.ndarray, buckets: int, depth: int, columns: list[np.ndarray], counts: np.ndarray
) -> Iterator[tuple]:
    """A block's counts by bucket, as rows of CELLS."""
    lang, block = row
    to = (mix(hashes) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    edges = np.searchsorted(to[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(edges)):
        at = order[edges[k] : edges[k + 1]]
        rows = pack([c[at] for c in columns]) if columns else b""
        yield lang, int(k), block, depth, rows, pack([counts[at]]), pack([at])


def _hash_rows(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = mix(out ^ c.astype(np.uint64)) + np.uint64(len(columns))
    return out


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    fields = [(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")]
    cols = zip(*rows, strict=True) if rows else [[] for _ in fields]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, fields, strict=True)], [n for n, _ in fields])


def _word_cells(buckets: int):
    """Every block's distinct words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if not r["n_rows"]:
                    continue
                data = zstandard.ZstdDecompressor().decompress(r["words"])
                words, hashes = data.split(b"\n"), word_hashes([data])[0]
                (counts,) = unpack(r["counts"], 1)
                rows = []
                for cell in _bucket_cells((r["lang"], r["block"]), hashes, buckets, 1, [], counts):
                    (at,) = unpack(cell[6], 1)
                    own = _squeeze(b"\n".join([words[j] for j in at.tolist()]))
                    rows.append((*cell[:4], own, *cell[5:]))
                yield _batch(rows, CELLS)

    return run


def _pair_cells(buckets: int):
    """Every block's distinct pairs of frequent words by bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for i in range(batch.num_rows):
                r = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                if r["n_rows"]:
                    g1, g2, n = unpack(r["pairs"], 3)
                    cells = _bucket_cells((r["lang"], r["block"]), _hash_rows([g1, g2]), buckets, 2, [g1, g2], n)
                    yield _batch(list(cells), CELLS)

    return run


def _cells_of(table: pa.Table, depth: int) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """A bucket's cells of one depth, the number of rows before each, and all counts."""
    cells = [r for r in table.to_pylist() if r["depth"] == depth]
    counts = [unpack(r["counts"], 1)[0] for r in cells]
    edges = np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int64)
    return cells, edges, np.concatenate([np.zeros(0, np.int64), *counts])


def _totals(of: np.ndarray, size: int, counts: np.ndarray) -> np.ndarray:
    """Exact sums of the counts of equal numbers below ``size``."""
    out = np.zeros(size, np.int64)
    np.add.at(out, of, counts)
    return out


def _frequent_words(least: int, buckets: int):
    """A bucket's words that reach the least count in their language.  A word's
    id is its place in the bucket by count, times the buckets, and the bucket."""

    def run(key, table):
        lang, bucket = (k.as_py() for k in key)
        cells, edges, counts = _cells_of(table, 1)
        data = [zstandard.ZstdDecompressor().decompress(r["rows"]).split(b"\n") for r in cells]
        coded = pa.array([w for d in data for w in d], pa.binary()).dictionary_encode()
        of = np.asarray(coded.indices)
        total = _totals(of, len(coded.dictionary), counts)
        names = coded.dictionary.to_pylist()
        good = np.flatnonzero(total >= least).tolist()
        good.sort(key=lambda i: (-total[i], names[i]))
        gid = np.full(len(names), -1, np.int64)
        gid[good] = np.arange(len(good)) * buckets + bucket
        rows = [(lang, names[i].decode(), [int(gid[i])], int(total[i]), None, None, None) for i in good]
        for r, a, b in zip(cells, edges, edges[1:], strict=False):
            own = gid[of[a:b]]
            known = own >= 0
            if known.any():
                places = unpack(r["places"], 1)[0][known]
                rows.append((lang, None, None, None, r["block"], pack([places]), pack([own[known]])))
        return pa.Table.from_batches([_batch(rows, FOUND)])

    return run


def _frequent_rows(least: int, depths: range, tell_blocks: bool):
    """A bucket's phrases of the given depths that reach the least count."""

    def run(key, table):
        lang, _ = (k.as_py() for k in key)
        rows = []
        for d in depths:
            cells, edges, counts = _cells_of(table, d)
            if not cells:
                continue
            ids = np.concatenate([unpack(r["rows"], d) for r in cells], axis=1)
            order = np.lexsort(ids[::-1])
            ids = ids[:, order]
            new = np.append(True, (ids[:, 1:] != ids[:, :-1]).any(axis=0))
            start = np.flatnonzero(new)
            total = np.add.reduceat(counts[order], start)
            good = total >= least
            phrases, f = ids[:, start[good]].T.tolist(), total[good].tolist()
            rows += [(lang, None, p, n, None, None, None) for p, n in zip(phrases, f, strict=True)]
            if tell_blocks:
                known = np.zeros(len(order), bool)
                known[order] = np.repeat(good, np.diff(np.append(start, len(order))))
                for r, a, b in zip(cells, edges, edges[1:], strict=False):
                    if known[a:b].any():
                        places = unpack(r["places"], 1)[0][known[a:b]]
                        rows.append((lang, None, None, None, r["block"], pack([places]), None))
        return pa.Table.from_batches([_batch(rows, FOUND)])

    return run


def _recode(blocks: pa.Table, known: pa.Table) -> pa.Table:
    """A block in numbers of its frequent words, and its counts of word pairs."""
    if not blocks.num_rows or not known.num_rows:
        return pa.Table.from_batches([_batch([], CODED)])
    cells = known.to_pylist()
    local = np.concatenate([unpack(r["places"], 1)[0] for r in cells])
    gids = np.concatenate([unpack(r["gids"], 1)[0] for r in cells])
    order = np.argsort(gids)
    local, gids = local[order], gids[order]
    own = _codes(blocks.column("codes")[0].as_py())
    to = np.full(max(int(own.max(initial=-1)), int(local.max())) + 2, -1, np.int32)
    to[local] = np.arange(len(gids), dtype=np.int32)
    codes = to[own]  # the last place of ``to`` is -1, and so is to[-1]
    # words between infrequent ones begin no phrase
    good = np.concatenate([[False], codes >= 0, [False]])
    stays = good[1:-1] & (good[:-2] | good[2:])
    keep = stays | np.concatenate([[False], stays[:-1]])
    codes = np.where(stays, codes, -1)[keep].astype(np.int32)
    linked = np.append((codes[:-1] >= 0) & (codes[1:] >= 0), False) if len(codes) else np.zeros(0, bool)
    at = np.flatnonzero(linked)
    pairs = [np.zeros((3, 0), np.int64)]
    for depth, pointer, size in multikey_quicksort(codes, at, np.full(len(at), 2), 2):
        if depth == 2:
            pairs.append(np.array([codes[pointer], codes[pointer + 1], size]))
    a, b, n = np.concatenate(pairs, axis=1)
    order = np.lexsort((b, a))  # codes are in the order of ids
    a, b, n = a[order], b[order], n[order]
    row = (
        blocks.column("block")[0].as_py(), blocks.column("lang")[0].as_py(), len(n),
        pack([gids]), _squeeze(codes.astype("<i4").tobytes()), pack([gids[a], gids[b], n]),
    )
    return pa.Table.from_batches([_batch([row], CODED)])


def _deeper(depth: int, buckets: int):
    """Counts by bucket of a block's phrases of three to ``depth`` words, all
    of whose pairs are frequent."""

    def run(blocks: pa.Table, frequent: pa.Table) -> pa.Table:
        if not blocks.num_rows or not frequent.num_rows:
            return pa.Table.from_batches([_batch([], CELLS)])
        (gids,) = unpack(blocks.column("gids")[0].as_py(), 1)
        codes = _codes(blocks.column("codes")[0].as_py())
        places = np.concatenate([unpack(r, 1)[0] for r in frequent.column("places").to_pylist()])
        g1, g2, _ = unpack(blocks.column("pairs")[0].as_py(), 3)[:, np.sort(places)]
        wanted = np.searchsorted(gids, g1) * len(gids) + np.searchsorted(gids, g2)
        pair = codes[:-1].astype(np.int64) * len(gids) + codes[1:]
        place = np.minimum(np.searchsorted(wanted, pair), len(wanted) - 1)
        linked = np.append((codes[:-1] >= 0) & (codes[1:] >= 0) & (wanted[place] == pair), False)
        reach = _reach(linked, depth)
        at = np.flatnonzero(reach >= 3)
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for d, pointer, size in multikey_quicksort(codes, at, reach[at], depth):
            if d >= 3:
                found.setdefault(d, []).append((pointer, size))
        head = blocks.column("lang")[0].as_py(), blocks.column("block")[0].as_py()
        rows = []
        for d, parts in found.items():
            pointer, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            words = codes[pointer[:, None] + np.arange(d)]
            order = np.lexsort(words.T[::-1])
            columns = list(gids[words[order]].T)
            rows += _bucket_cells(head, _hash_rows(columns), buckets, d, columns, size[order])
        return pa.Table.from_batches([_batch(rows, CELLS)])

    return run


def _buckets(rows: int | None) -> int:
    return max(1, -(-(rows or 0) // BUCKET_ROWS))


def count_phrases(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang",
    block_bytes: int = BLOCK_BYTES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(phrases, vocabulary, sizes): every phrase of one to ``longest`` words
    that occurs ``least`` times or more in its language, as (lang, ids, f);
    the frequent words as (lang, gid, word); each language's number of words
    as (lang, n).  An id stands for one word of a language.

    NULL texts are empty, a NULL language is ``und``; repeated rows count as
    often as they occur; an empty table gives empty tables; other columns are
    not read, so their names can't clash.
    """
    blocks = word_blocks(docs, text, lang, block_bytes)
    sizes = staged(blocks.groupBy("lang").agg(F.sum("n_words").alias("n")), "language-sizes")
    buckets = _buckets(blocks.agg(F.sum("n_rows")).first()[0])
    cells = blocks.select("block", "lang", "n_rows", "words", "counts").mapInArrow(_word_cells(buckets), CELLS)
    words = cells.groupBy("lang", "bucket").applyInArrow(_frequent_words(least, buckets), FOUND)
    words = staged(words, "frequent-words")
    known = words.where("block IS NOT NULL").select(F.col("block").alias("of"), "places", "gids")
    coded = blocks.select("block", "lang", "codes").groupBy("block").cogroup(known.groupBy("of"))
    coded = staged(coded.applyInArrow(_recode, CODED), "coded-blocks")

    buckets = _buckets(coded.agg(F.sum("n_rows")).first()[0])
    cells = coded.select("block", "lang", "n_rows", "pairs").mapInArrow(_pair_cells(buckets), CELLS)
    pairs = cells.groupBy("lang", "bucket").applyInArrow(_frequent_rows(least, range(2, 3), True), FOUND)
    pairs = staged(pairs, "frequent-pairs")
    known = pairs.where("block IS NOT NULL").select(F.col("block").alias("of"), "places")
    # a frequent pair's occurrences lead at most so many longer phrases
    buckets = _buckets((longest - 2) * (pairs.agg(F.sum("f")).first()[0] or 0))
    cells = coded.select("block", "lang", "gids", "codes", "pairs").groupBy("block").cogroup(known.groupBy("of"))
    cells = cells.applyInArrow(_deeper(longest, buckets), CELLS)
    deep = cells.groupBy("lang", "bucket").applyInArrow(_frequent_rows(least, range(3, longest + 1), False), FOUND)

    phrases = words.unionByName(pairs).unionByName(deep).where("ids IS NOT NULL").select("lang", "ids", "f")
    vocabulary = words.where("word IS NOT NULL").select("lang", F.col("ids")[0].alias("gid"), "word")
    return staged(phrases.where(F.size("ids") <= longest), "phrases"), vocabulary, sizes


def collocations(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP, text: str = "text",
    lang: str = "lang", block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Each language's ``top`` collocations: lang, rank, phrase, a, l, r, n,
    score, by score and count descending and the phrase's bytes ascending.

    A candidate is a phrase of two words or more with a count ``a`` of at
    least ``least``; its score is the least floor(1000 a n / (l r)) over the
    ways to cut it in two (the first of equal ones), and it is dropped if a
    longer phrase around it is as frequent.  Defined as in ``count_phrases``
    for NULLs, repeated rows, empty tables and other columns.
    """
    phrases, vocabulary, sizes = count_phrases(docs, least, longest, text, lang, block_bytes)
    found = phrases.where(F.size("ids") >= 2).withColumnRenamed("f", "a")
    d = F.size("ids")

    # a phrase around it is as frequent only if one with one more word is
    around = found.where(d > 2).select(
        "lang", F.explode(F.array(F.slice("ids", 1, d - 1), F.slice("ids", 2, d - 1))).alias("ids"), F.col("a").alias("b")
    )
    around = around.groupBy("lang", "ids").agg(F.max("b").alias("b"))
    kept = found.join(around, ["lang", "ids"], "left").where(
        F.col("b").isNull() | (100 * F.col("b") < REPLACES_PERCENT * F.col("a"))
    )

    cuts = kept.select("lang", "ids", "a", F.explode(F.sequence(F.lit(1), d - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.slice("ids", 1, F.col("k"))).withColumn(
        "right", F.slice("ids", F.col("k") + 1, d - F.col("k"))
    )
    first = phrases.select("lang", F.col("ids").alias("left"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("ids").alias("right"), F.col("f").alias("r"))
    cuts = cuts.join(first, ["lang", "left"]).join(rest, ["lang", "right"]).join(sizes, "lang")
    exact = lambda c: f"CAST({c} AS DECIMAL(18, 0))"
    score = F.expr(f"CAST({SCALE} * {exact('a')} AS DECIMAL(20, 0)) * {exact('n')} div ({exact('l')} * {exact('r')})")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "ids", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "ids", "a", "cut.l", "cut.r", "n", "cut.score")

    ahead = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    near = scored.withColumn("place", F.rank().over(ahead)).where(F.col("place") <= top).drop("place")
    near = staged(near, "collocations")
    spelled = near.select("lang", "ids", F.posexplode("ids").alias("i", "gid")).join(vocabulary, ["lang", "gid"])
    spelled = spelled.groupBy("lang", "ids").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("i", "word"))), lambda w: w["word"]), " ").alias("phrase")
    )
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    out = near.join(spelled, ["lang", "ids"]).withColumn("rank", F.row_number().over(last).cast("long")).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


# DuckDB SQL for ``collocations`` with its defaults.
ORACLE = f"""
WITH piece AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), cut AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM piece
), size AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM cut GROUP BY lang
), f AS (
    SELECT lang, d, p, CAST(count(*) AS BIGINT) AS f
    FROM (
        SELECT lang, d, array_to_string(w[i:i + d - 1], ' ') AS p
        FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut WHERE len(w) > 0), range(1, {LONGEST + 1}) AS r(d)
        WHERE i + d - 1 <= len(w)
    )
    GROUP BY lang, d, p HAVING count(*) >= {LEAST}
), longer AS (
    SELECT lang, f AS b, string_split(p, ' ') AS w, d FROM f WHERE d > 2
), gone AS (
    SELECT lang, p, max(b) AS b FROM (
        SELECT lang, b, array_to_string(w[1:d - 1], ' ') AS p FROM longer
        UNION ALL SELECT lang, b, array_to_string(w[2:d], ' ') AS p FROM longer
    ) GROUP BY lang, p
), kept AS (
    SELECT f.lang, f.p, f.d, f.f AS a, string_split(f.p, ' ') AS w
    FROM f LEFT JOIN gone USING (lang, p)
    WHERE f.d > 1 AND (b IS NULL OR 100 * b < {REPLACES_PERCENT} * f.f)
), cuts AS (
    SELECT lang, p, d, a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:d], ' ') AS rp
    FROM kept, range(1, {LONGEST}) AS c(k) WHERE k < d
), scored AS (
    SELECT cuts.lang, cuts.p, a, k, x.f AS l, y.f AS r, n,
           CAST(({SCALE}::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
    FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.p = lp JOIN f AS y ON y.lang = cuts.lang AND y.p = rp
    JOIN size ON size.lang = cuts.lang
), best AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank, p AS phrase, a, l, r, n, score
FROM best QUALIFY rank <= {TOP}
"""
