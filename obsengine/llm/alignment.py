"""Alignment of two tokenizers' tokens (operator 13).

Two files cut the same bytes into tokens; byte offsets at which a token of
both ends cut the text into groups.  A byte range of a text gives a fragment:
the tokens up to its first common end (an open prefix), the groups closed
inside, and the tokens behind its last common end (an open suffix).  Two
neighbouring fragments compose to one: the left suffix and the right prefix
are a group.  That is associative, so the ranges of a very long text are
tokenized by different Spark tasks and composed in rounds, some neighbours at
a time; other texts are one range.

The last tokens of a group are a link.  How often a pair of ids is linked in
the whole corpus is added up over blocks of documents, and each block gets
back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged
from .tokens import encoder, release

#: Texts of more bytes are cut to ranges of about so many characters.
RANGE = 1 << 15
#: Around the edge of a range a place where both files surely cut is sought.
MARGIN = 1 << 11
#: Texts of about so many bytes are aligned at once.
SLICE_BYTES = 1 << 20
#: Neighbouring fragments that one task composes in a round.
FAN_IN = 16

# A single space between two other characters: no token reaches over its start.
_SAFE = re.compile(r"(?<=[^\s▁]) (?=[^\s▁])")
_ID_BITS = 32

FRAGMENT = (
    "doc long, doc_id long, part long, good boolean, closed boolean, prefix_a array<int>, prefix_b array<int>, "
    "groups_a array<int>, sizes_a array<int>, groups_b array<int>, sizes_b array<int>, suffix_a array<int>, suffix_b array<int>"
)
RANGES = "doc long, doc_id long, part long, first long, low long, high long, stretch string"
BLOCK = (
    "block string, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
    "groups_sha256 array<string>, links binary, pairs array<struct<pair:long,n:long>>"
)
RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Fragment(NamedTuple):
    """A range's tokens.  ``closed``: it has a common end; else all its tokens
    are in the prefix.  Groups follow one another, with their sizes."""

    good: bool
    closed: bool
    prefix_a: np.ndarray
    prefix_b: np.ndarray
    groups_a: np.ndarray
    sizes_a: np.ndarray
    groups_b: np.ndarray
    sizes_b: np.ndarray
    suffix_a: np.ndarray
    suffix_b: np.ndarray


_NONE = np.zeros(0, np.int32)
EMPTY = Fragment(True, False, *[_NONE] * 8)


def common_ends(end_a: np.ndarray, end_b: np.ndarray, first: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which tokens of either file end where one of the other does; all ends
    lie in (first, first + size]."""
    mark_a, mark_b = np.zeros(size + 1, bool), np.zeros(size + 1, bool)
    mark_a[end_a - first] = True
    mark_b[end_b - first] = True
    return mark_b[end_a - first], mark_a[end_b - first]


def fragment(a: np.ndarray, b: np.ndarray, end_a: np.ndarray, end_b: np.ndarray, good: bool = True) -> Fragment:
    """The fragment of tokens in order, given by their ids and ends."""
    if not len(a) and not len(b):
        return EMPTY._replace(good=good)
    first = min(int(x[0]) for x in (end_a, end_b) if len(x)) - 1
    last = max(int(x[-1]) for x in (end_a, end_b) if len(x))
    both_a, both_b = common_ends(end_a, end_b, first, last - first)
    cut_a, cut_b = np.flatnonzero(both_a) + 1, np.flatnonzero(both_b) + 1
    a, b = a.astype(np.int32), b.astype(np.int32)
    if not len(cut_a):
        return EMPTY._replace(good=good, prefix_a=a, prefix_b=b)
    return Fragment(
        good, True, a[: cut_a[0]], b[: cut_b[0]],
        a[cut_a[0] : cut_a[-1]], np.diff(cut_a).astype(np.int32),
        b[cut_b[0] : cut_b[-1]], np.diff(cut_b).astype(np.int32),
        a[cut_a[-1] :], b[cut_b[-1] :],
    )


def compose(parts: list[Fragment]) -> Fragment:
    """Neighbouring fragments as one; associative, EMPTY changes nothing."""
    good = all(p.good for p in parts)
    prefix: list[list[np.ndarray]] = [[], []]
    tail: list[list[np.ndarray]] = [[], []]  # open behind the last common end
    groups: list[list[np.ndarray]] = [[], []]
    sizes: list[list[np.ndarray]] = [[], []]
    closed = False
    for p in parts:
        own = ((p.prefix_a, p.groups_a, p.sizes_a, p.suffix_a), (p.prefix_b, p.groups_b, p.sizes_b, p.suffix_b))
        for k, (head, middle, size, suffix) in enumerate(own):
            if not closed:
                prefix[k].append(head)
            else:
                tail[k].append(head)
                if p.closed:  # what was open is a group now
                    groups[k] += tail[k]
                    sizes[k].append(np.array([sum(map(len, tail[k]))], np.int32))
                    tail[k] = []
            if p.closed:
                groups[k].append(middle)
                sizes[k].append(size)
                tail[k] = [suffix]
        closed = closed or p.closed
    join = lambda x: np.concatenate([_NONE, *x])
    return Fragment(
        good, closed, join(prefix[0]), join(prefix[1]), join(groups[0]), join(sizes[0]), join(groups[1]),
        join(sizes[1]), join(tail[0]), join(tail[1]),
    )


def ranges(text: str, size: int = RANGE, margin: int = MARGIN) -> Iterator[tuple[int, int, int, str]]:
    """Cut " " + text at about every ``size`` characters: (first, low, high,
    stretch) says that the tokens which end in the byte range (low, high] are
    those of ``stretch``, whose first byte is number ``first``.

    An edge may lie inside a token; the stretch reaches to safe places on both
    sides.  Where there is none within ``margin``, there is no edge.
    """
    text = " " + text
    edges = []  # (safe place before the edge, edge, safe place behind it)
    for at in range(size, len(text), size):
        before = None
        for found in _SAFE.finditer(text, max(at - margin, 1), at + 1):
            before = found.start()
        after = _SAFE.search(text, at, at + margin)
        if before is not None and after is not None:
            edges.append((before, at, after.start()))
    bytes_at = {0: 0}
    place = total = 0
    for p in sorted({p for e in edges for p in e} | {len(text)}):
        total += len(text[place:p].encode())
        place = p
        bytes_at[p] = total
    begin, low = 0, 0
    for before, at, after in [*edges, (len(text), len(text), len(text))]:
        yield bytes_at[begin], bytes_at[low], bytes_at[at], text[begin:after]
        begin, low = before, at


def _digits() -> np.ndarray:
    """Rows of decimal digits and one of three signs behind, zeros after."""
    ids = np.arange(1 << 16)
    rows = np.zeros((3, 1 << 16, 6), np.uint8)
    width = 1 + sum((ids >= 10**k).astype(int) for k in range(1, 5))
    for k in range(5):
        own = width > k
        rows[:, own, k] = 48 + ids[own] // 10 ** (width[own] - 1 - k) % 10
    for kind, sign in enumerate(b",|;"):
        rows[kind, ids, width] = sign
    return rows.reshape(-1, 6)


_DIGITS: list[np.ndarray] = []


def spelled(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups' text, ``a1,a2|b1;...`` with a sign behind every id, and the
    bytes of it up to each group's end.  The n-th group ends before the tokens
    cut_a[n] and cut_b[n]; ids are below 65,536."""
    if not _DIGITS:
        _DIGITS.append(_digits())
    if not len(cut_a):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    n_a, n_b = np.diff(cut_a, prepend=0), np.diff(cut_b, prepend=0)
    code = np.zeros(len(a) + len(b), np.int32)
    of_a, of_b = np.repeat(np.arange(len(n_a)), n_a), np.repeat(np.arange(len(n_b)), n_b)
    place_a = np.arange(len(a)) + (cut_b - n_b)[of_a]
    place_b = np.arange(len(b)) + cut_a[of_b]
    code[place_a] = a
    code[place_b] = b
    code[place_a[cut_a - 1]] += 1 << 16
    code[place_b[cut_b - 1]] += 2 << 16
    rows = _DIGITS[0][code]
    filled = rows != 0
    ends = np.cumsum(filled.sum(axis=1, dtype=np.int8), dtype=np.int64)[cut_a + cut_b - 1]
    return rows[filled], ends


def block_row(
    block: str, keys: list, n_a: np.ndarray, n_b: np.ndarray, a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray
) -> tuple:
    """A row of BLOCK: documents with so many tokens each, one after another."""
    groups_to = np.searchsorted(cut_a, np.cumsum(n_a), side="right")
    n_groups = np.diff(groups_to, prepend=0)
    text, ends = spelled(a, b, cut_a, cut_b)
    stop = np.concatenate([[0], ends])[groups_to].tolist()
    raw = memoryview(text.tobytes())
    shas, begin = [], 0
    for end in stop:
        shas.append(hashlib.sha256(raw[begin : end - 1]).hexdigest() if end > begin else "")
        begin = end
    pair = (a[cut_a - 1].astype(np.int64) << _ID_BITS) | b[cut_b - 1]
    pairs, of, n = np.unique(pair, return_inverse=True, return_counts=True)
    found = pa.StructArray.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
    return (block, keys, n_a, n_b, n_groups, shas, zstandard.ZstdCompressor(level=1).compress(of.astype("<i4").tobytes()), pa.ListArray.from_arrays([0, len(n)], found))


_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def _arrow(schema: str) -> pa.Schema:
    """One of the schemas above for Arrow; Spark's own parser runs on the driver only."""

    def kind(text: str) -> pa.DataType:
        if text.startswith("array<"):
            return pa.list_(kind(text[6:-1]))
        if text.startswith("struct<"):
            return pa.struct([(n, kind(k)) for n, k in (f.split(":") for f in text[7:-1].split(","))])
        return _KINDS[text]

    return pa.schema([(n, kind(k)) for n, k in (c.split(" ") for c in schema.split(", "))])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = _arrow(schema)
    cols = [
        c[0].cast(f.type) if isinstance(c[0], pa.Array) else pa.array(c, f.type)
        for c, f in zip(zip(*rows, strict=True), fields, strict=True)
    ]
    return pa.RecordBatch.from_arrays(cols, schema=fields)


def _table(rows: list[tuple], schema: str) -> pa.Table:
    if rows:
        return pa.Table.from_batches([_batch(rows, schema)])
    return _arrow(schema).empty_table()


def _fragment_row(head: tuple, f: Fragment) -> tuple:
    return (*head, *f)


def _fragments(table: pa.Table | pa.RecordBatch) -> list[Fragment]:
    """The fragments of rows with the columns of FRAGMENT."""
    cols = [table.column(table.schema.names.index(c)) for c in Fragment._fields]
    cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
    out = []
    for i in range(table.num_rows):
        lists = [np.asarray(c[i].values) for c in cols[2:]]
        out.append(Fragment(cols[0][i].as_py(), cols[1][i].as_py(), *lists))
    return out


def aligned_blocks(docs: DataFrame, file_a: str, file_b: str, text: str, key: str, size: int, margin: int) -> DataFrame:
    """Blocks of aligned documents (columns of BLOCK), written."""
    src = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    long = F.octet_length("t") > 2 * size

    def encoders():
        return encoder(file_a, True, True), encoder(file_b, True, True)

    def short_blocks(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        first, second = encoders()
        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part in slices(batch, "t", SLICE_BYTES):
                t = pa.array([" " + x if x else "" for x in part.column(1).to_pylist()], pa.string())
                a, n_a, good_a = first.encode_checked(t)
                b, n_b, good_b = second.encode_checked(t)
                good = good_a & good_b
                if not good.all():
                    a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
                    n_a, n_b = np.where(good, n_a, 0), np.where(good, n_b, 0)
                end_a, end_b = np.cumsum(first.length_of[a]), np.cumsum(second.length_of[b])
                both_a, both_b = common_ends(end_a, end_b, 0, int(end_a[-1]) if len(end_a) else 0)
                cut_a, cut_b = np.flatnonzero(both_a) + 1, np.flatnonzero(both_b) + 1
                yield _batch([block_row(f"{task}-{n}", part.column(0).to_pylist(), n_a, n_b, a, b, cut_a, cut_b)], BLOCK)
                n += 1
        release()

    def cut(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        doc = TaskContext.get().partitionId() << 33
        for batch in batches:
            for i in range(batch.num_rows):
                k, t = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = [(doc, k, n, *r) for n, r in enumerate(ranges(t, size, margin))]
                yield _batch(rows, RANGES)
                doc += 1

    def align(batches: Iterator[pa.RecordBatch]):
        first, second = encoders()
        for batch in batches:
            for part in slices(batch, "stretch", SLICE_BYTES):
                rows = []
                col = {c: part.column(i) for i, c in enumerate(part.schema.names)}
                found = [e.encode_checked(col["stretch"]) for e in (first, second)]
                cuts = [np.concatenate([[0], np.cumsum(n)]) for _, n, _ in found]
                for i in range(part.num_rows):
                    begin, low, high = (col[c][i].as_py() for c in ("first", "low", "high"))
                    ids, ends = [], []
                    for (flat, _, _), edge, e in zip(found, cuts, (first, second), strict=True):
                        own = flat[edge[i] : edge[i + 1]]
                        end = begin + np.cumsum(e.length_of[own])
                        inside = (end > low) & (end <= high)
                        ids.append(own[inside])
                        ends.append(end[inside])
                    good = bool(found[0][2][i] and found[1][2][i])
                    head = tuple(col[c][i].as_py() for c in ("doc", "doc_id", "part"))
                    rows.append(_fragment_row(head, fragment(*ids, *ends, good)))
                yield _batch(rows, FRAGMENT)
        release()

    def merge(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        head = tuple(table.column(c)[0].as_py() for c in ("doc", "doc_id"))
        return _table([_fragment_row((*head, table.column("group")[0].as_py()), compose(_fragments(table)))], FRAGMENT)

    def long_blocks(batches: Iterator[pa.RecordBatch]):
        """A whole text's prefix is its first group, and its suffix is empty."""
        from pyspark import TaskContext

        task, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            keys = batch.column(batch.schema.names.index("doc_id")).to_pylist()
            for k, f in zip(keys, _fragments(batch), strict=True):
                a, b = np.concatenate([f.prefix_a, f.groups_a]), np.concatenate([f.prefix_b, f.groups_b])
                cut_a, cut_b = (
                    np.cumsum(np.concatenate([[len(p)], s]).astype(np.int64))
                    for p, s in ((f.prefix_a, f.sizes_a), (f.prefix_b, f.sizes_b))
                )
                if not f.good:
                    a, b, cut_a, cut_b = _NONE, _NONE, _NONE.astype(np.int64), _NONE.astype(np.int64)
                n_a, n_b = np.array([len(a)]), np.array([len(b)])
                yield _batch([block_row(f"long-{task}-{n}", [k], n_a, n_b, a, b, cut_a, cut_b)], BLOCK)
                n += 1

    short = src.where(~long).mapInArrow(short_blocks, BLOCK)
    # the ranges are written once, so a document's number is the same in every attempt
    spread = staged(src.where(long).mapInArrow(cut, RANGES), "text-ranges")
    parts = staged(spread.repartition("doc", "part").mapInArrow(align, FRAGMENT), "fragments")
    last = parts.agg(F.max("part")).first()[0] or 0
    while last:
        grouped = parts.withColumn("group", F.expr(f"part div {FAN_IN}")).groupBy("doc", "group")
        parts = staged(grouped.applyInArrow(merge, FRAGMENT), "fragments")
        last //= FAN_IN
    return staged(short.unionByName(parts.mapInArrow(long_blocks, BLOCK)), "aligned-blocks")


def link_counts(blocks: DataFrame) -> DataFrame:
    """(pair, f, best): how often each pair of ids is linked in all blocks, and
    whether no other pair with its second id is linked more often."""
    totals = blocks.select(F.inline("pairs")).groupBy("pair").agg(F.sum("n").alias("f"))
    totals = staged(totals.withColumn("b", F.col("pair").bitwiseAND((1 << _ID_BITS) - 1)), "links")
    most = totals.groupBy("b").agg(F.max("f").alias("most"))
    return totals.join(most, "b").select("pair", "f", (F.col("f") == F.col("most")).alias("best"))


def align_tokens(
    docs: DataFrame, file_a: str, file_b: str, text: str = "text", key: str = "doc_id", size: int = RANGE, margin: int = MARGIN
) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.

    ``file_a`` is a byte-level file of the tokenizers library and ``file_b`` a
    sentencepiece file, both read as plain text.  NULL and empty texts, and
    those whose tokens' bytes are not a space and the text, have no tokens:
    zeros and the digest ''.  A NULL key stays NULL; repeated rows count as
    often as they occur; an empty table gives no row; other columns are not
    read, so their names can't clash.
    """
    blocks = aligned_blocks(docs, file_a, file_b, text, key, size, margin)
    own = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("i", "p"))
    own = own.select("of", "i", F.col("p.pair").alias("pair"))
    counts = own.join(link_counts(blocks), "pair").select("of", "i", "f", "best")

    def finish(block: pa.Table, found: pa.Table) -> pa.Table:
        if not block.num_rows:
            return _table([], RESULT)
        keys, n_a, n_b, n_groups, shas = (
            block.column(c)[0].as_py() for c in ("doc_ids", "n_a", "n_b", "n_groups", "groups_sha256")
        )
        at, f, best = (np.asarray(found.column(c).combine_chunks()) for c in ("i", "f", "best"))
        count, is_best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        count[at], is_best[at] = f, best
        link = np.frombuffer(zstandard.ZstdDecompressor().decompress(block.column("links")[0].as_py()), "<i4")
        ends = np.cumsum(n_groups)
        sums = [np.diff(np.concatenate([[0], np.cumsum(x[link])])[ends], prepend=0).tolist() for x in (is_best, count)]
        return _table(list(zip(keys, n_a, n_b, n_groups, n_groups, *sums, shas, strict=True)), RESULT)

    return blocks.drop("pairs").groupBy("block").cogroup(counts.groupBy("of")).applyInArrow(finish, RESULT)
