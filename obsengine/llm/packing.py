"""Bounded-space online packing of documents into fixed windows (operator 10).

Each partition packs its documents as they come: whole windows are cut off a
long document first, and what is left goes to the fullest open window that
still has room for it (best fit).  A partition holds a fixed number of open
windows; when none fits and no more may be opened, the fullest is emitted.  The windows
that are open at a partition's end are merged in rounds over groups of
partitions, as whole windows by the same rule, until one group is left.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, staged
from .tokens import TOKEN_SLICE_BYTES, encoder, release, trim

CAPACITY = 2048
#: Open windows of a partition.
OPEN = 128
#: Partitions whose leftovers meet in one task of a merging round.
FAN_IN = 64
#: Windows that a partition may number.
WINDOW_BITS = 36

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "part long, window long, offset long, leftover long"
)
#: ``leftover`` is NULL in a piece; a row with it tells the fill of a window
#: that was open when its partition ended, and has no document.


class OpenWindows:
    """A fixed number of open windows, best fit, the fullest emitted first."""

    def __init__(self, capacity: int, open_windows: int):
        self.capacity, self.most = capacity, open_windows
        self.fills: list[tuple[int, int]] = []  # (fill, window), ascending
        self.next = 0
        self.emitted: set[int] = set()

    def new(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, size: int) -> tuple[int, int]:
        """The window and the offset of an item of at most the capacity."""
        at = bisect_left(self.fills, (self.capacity - size + 1, -1)) - 1
        if at >= 0:
            fill, window = self.fills.pop(at)
        else:
            if len(self.fills) >= self.most:
                self.emitted.add(self.fills.pop()[1])
            fill, window = 0, self.new()
        if fill + size == self.capacity:
            self.emitted.add(window)
        else:
            insort(self.fills, (fill + size, window))
        return window, fill


def cut_pieces(sizes: Iterable[int], windows: OpenWindows) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) for documents of the given sizes."""
    for doc, n in enumerate(sizes):
        start = 0
        while n - start >= windows.capacity:
            window = windows.new()
            windows.emitted.add(window)
            yield doc, start, windows.capacity, window, 0
            start += windows.capacity
        if start < n:
            yield doc, start, n - start, *windows.place(n - start)


def pack_documents(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 1,
    spaced: bool = False,
    capacity: int = CAPACITY,
    open_windows: int = OPEN,
    keep_ids: bool = True,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``keep_ids``, the piece's ids.

    A NULL or empty text is its end id alone; a NULL key stays NULL; repeated
    rows are packed as often as they occur; an empty table gives no piece;
    other columns are not read, so their names can't clash.  No row of text
    moves between tasks.
    """
    src = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        tokens = encoder(tokenizer, spaced)
        windows = OpenWindows(capacity, open_windows)
        part_id = TaskContext.get().partitionId()
        names = [c.split()[0] for c in schema.split(", ")]

        def rows_of(cols: dict, n: int) -> pa.RecordBatch:
            cols["part"] = np.full(n, part_id, np.int64)
            own = [cols.get(c, [None] * n) for c in names]
            own = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, (_, t) in zip(own, types, strict=True)]
            return pa.RecordBatch.from_arrays(own, names)

        types = [(c, pa.list_(pa.int32()) if c == "ids" else pa.int64()) for c in names]
        for batch in batches:
            for part in slices(batch, "t", TOKEN_SLICE_BYTES):
                ids, sizes = tokens.encode(part.column(1))
                ends = np.cumsum(sizes + 1)
                whole = np.full(int(ends[-1]), end_id, "<u4")
                inner = np.ones(len(whole), bool)
                inner[ends - 1] = False
                whole[inner] = ids
                raw = memoryview(whole.tobytes())
                doc, start, length, window, offset = (
                    np.array(c, np.int64) for c in zip(*cut_pieces((sizes + 1).tolist(), windows), strict=True)
                )
                begin = (ends - sizes - 1)[doc] + start
                spans = list(zip(begin.tolist(), (begin + length).tolist(), strict=True))
                keys = part.column(0).to_pylist()
                cols = {
                    "doc_id": [keys[d] for d in doc.tolist()],
                    "start": start,
                    "length": length,
                    "ids_crc32": [zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans],
                    "doc_tokens": (sizes + 1)[doc],
                    "window": window,
                    "offset": offset,
                }
                if keep_ids:
                    # a document's pieces follow one another, and so do documents
                    cols["ids"] = pa.ListArray.from_arrays(np.append(begin, len(whole)).astype(np.int32), whole.view(np.int32))
                yield rows_of(cols, len(doc))
                trim()  # a task keeps no more than a slice needs
        open_now = {"window": [w for _, w in windows.fills], "leftover": [f for f, _ in windows.fills]}
        yield rows_of(open_now, len(windows.fills))
        release()

    schema = PIECES + ", ids array<int>" * keep_ids
    written = staged(src.mapInArrow(run, schema), "pieces")
    merged = merge_leftovers(written.where("leftover IS NOT NULL"), capacity, open_windows)
    out = written.where("leftover IS NULL").join(merged, ["part", "window"], "left")
    root_part, root_window = F.coalesce("root_part", "part"), F.coalesce("root_window", "window")
    return out.select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        (root_part * F.lit(1 << WINDOW_BITS) + root_window).alias("sequence_id"),
        (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        *(["ids"] * keep_ids),
    )


def merge_leftovers(left: DataFrame, capacity: int, open_windows: int) -> DataFrame:
    """Where each window that was open at its partition's end goes:
    (part, window) -> (root_part, root_window, base).

    A round packs the leftovers of FAN_IN neighbouring groups; its own open
    windows are the next round's leftovers, so a task never gets more than
    FAN_IN times the open windows of one group.  Emitted windows are final.
    """
    rows = left.select(
        "part", "window", F.col("part").alias("root_part"), F.col("window").alias("root_window"),
        F.lit(0).cast("long").alias("base"), F.col("leftover").alias("fill"), F.col("part").alias("group"), F.lit(True).alias("open"),
    )
    last = left.agg(F.max("part")).first()[0] or 0

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        # the windows of this round are the distinct roots, largest first
        roots = pdf.groupby(["root_part", "root_window"], as_index=False)["fill"].first()
        roots = roots.sort_values(["fill", "root_part", "root_window"], ascending=[False, True, True])
        windows = OpenWindows(capacity, open_windows)
        placed = [windows.place(int(n)) for n in roots["fill"]]
        head: dict[int, tuple] = {}
        total: dict[int, int] = {}
        to = {}
        for (w, offset), p, r, n in zip(placed, roots["root_part"], roots["root_window"], roots["fill"], strict=True):
            head.setdefault(w, (p, r))
            total[w] = total.get(w, 0) + int(n)
            to[(p, r)] = (w, offset)
        of = [to[x] for x in zip(pdf["root_part"], pdf["root_window"], strict=True)]
        out = pdf.copy()
        out["root_part"] = [head[w][0] for w, _ in of]
        out["root_window"] = [head[w][1] for w, _ in of]
        out["base"] = pdf["base"].to_numpy() + np.array([o for _, o in of], np.int64)
        out["fill"] = np.array([total[w] for w, _ in of], np.int64)
        out["open"] = [w not in windows.emitted for w, _ in of]
        return out

    final = []
    while True:
        rows = rows.withColumn("group", F.expr(f"group div {FAN_IN}"))
        rows = staged(rows.groupBy("group").applyInPandas(merge, rows.schema), "leftovers")
        last //= FAN_IN
        final.append(rows.where(~F.col("open")) if last else rows)
        if not last:
            break
        rows = rows.where("open")
    return reduce(DataFrame.unionByName, final).select("part", "window", "root_part", "root_window", "base")


def packing_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    return pack_documents(docs, tokenizer, keep_ids=False)
