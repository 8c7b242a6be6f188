"""Token ids in files of Simple-8b words (operator 2).

Ids are cut into blocks of 128.  A 64-bit word holds a selector in its top
four bits and in the other 60 bits as many ids as fit the selector's width; a
run of one value takes one word, and an id beyond 60 bits is escaped into the
word that follows.  The number of words before each block is stored, so a
reader finds every block at once and unpacks all words of one selector
together.

A file is a Parquet part whose rows are chunks of some thousand documents in
ascending order: the documents' ids and lengths, the words and the block
offsets as little-endian binary columns.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, staged
from .tokens import TOKEN_SLICE_BYTES, encoder, release

BLOCK = 128
#: Selector -> (ids in a word, bits of an id); 0 is a run, 15 an escape.
SHAPES = {
    1: (60, 1), 2: (30, 2), 3: (20, 3), 4: (15, 4), 5: (12, 5), 6: (10, 6), 7: (8, 7),
    8: (7, 8), 9: (6, 10), 10: (5, 12), 11: (4, 15), 12: (3, 20), 13: (2, 30), 14: (1, 60),
}
RUN, ESCAPE = 0, 15
#: A run word: 32 bits of the value under 28 bits of the count.
RUN_VALUE_BITS = 32

FILE_SCHEMA = (
    "shard int, chunk int, shard_start long, n_ids long, "
    "doc_ids array<long>, doc_sizes array<long>, words binary, block_words binary"
)


#: Selectors by width: the n-th holds ids below _BOUNDS[n].
_BOUNDS = np.array([1 << bits for _, bits in SHAPES.values()], np.uint64)
_NARROW = np.searchsorted(_BOUNDS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8) + 1


def _selectors(grid: np.ndarray) -> np.ndarray:
    """The narrowest selector that holds each id."""
    if int(grid.max()) < 1 << 16:
        return _NARROW[grid]
    return (np.searchsorted(_BOUNDS, grid, side="right") + 1).astype(np.int8)


def encode_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, number of words before each block) of an array of ids."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    rows = -(-n // BLOCK)
    flat = np.zeros(rows * BLOCK, np.uint64)
    flat[:n] = ids
    grid = flat.reshape(rows, BLOCK)
    # what lies beyond a block's end fits any selector
    widest = np.zeros((rows, BLOCK + 60), np.int8)
    widest[:, :BLOCK] = own = _selectors(grid)
    spans = {1: widest}  # the widest selector among so many ids from here on
    for count, a, b in ((2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1), (6, 3, 3), (7, 4, 3), (8, 4, 4),
                        (10, 5, 5), (12, 6, 6), (15, 8, 7), (20, 10, 10), (30, 15, 15), (60, 30, 30)):
        spans[count] = spans[a].copy()
        np.maximum(spans[a][:, :-a], spans[b][:, a:], out=spans[count][:, :-a])
    choice = np.full((rows, BLOCK), ESCAPE, np.int8)
    low = max(1, int(own.min())) if n % BLOCK == 0 else 1
    for s in range(14, low - 1, -1):  # the fullest word that fits wins
        np.putmask(choice, spans[SHAPES[s][0]][:, :BLOCK] <= s, np.int8(s))
    counts = np.array([0] + [SHAPES[s][0] for s in range(1, 15)] + [1], np.int16)
    step = counts[choice]
    # runs of one value that fill a word better than the selectors do
    same = np.zeros((rows, BLOCK), bool)
    same[:, 1:] = grid[:, 1:] == grid[:, :-1]
    run = np.ones((rows, BLOCK), np.int16)
    if (same[:, 1:] & same[:, :-1]).any():
        column = np.arange(BLOCK, dtype=np.int16)
        begins = np.where(same, np.int16(BLOCK), column)
        after = np.full((rows, BLOCK), BLOCK, np.int16)
        after[:, :-1] = np.minimum.accumulate(begins[:, ::-1], axis=1)[:, ::-1][:, 1:]
        run = after - column
        better = (run > step) & (grid < np.uint64(1 << RUN_VALUE_BITS))
        choice[better] = RUN
        step = np.where(better, run, step)
    # follow the words of all blocks side by side
    at = np.zeros(rows, np.int64)
    live = np.arange(rows)
    picked_row, picked_at = [], []
    while len(live):
        here = at[live]
        picked_row.append(live)
        picked_at.append(here)
        at[live] = here + step[live, here]
        live = live[at[live] < BLOCK]
        # ids beyond the end of the last block are not written
        if len(live) and live[-1] == rows - 1 and at[rows - 1] + (rows - 1) * BLOCK >= n:
            live = live[:-1]
    row, col = np.concatenate(picked_row), np.concatenate(picked_at)
    order = np.argsort(row * BLOCK + col, kind="stable")
    row, col = row[order], col[order]
    chosen = choice[row, col]
    size = np.where(chosen == ESCAPE, 2, 1)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    flat = np.concatenate([flat, np.zeros(60, np.uint64)])
    for s in np.unique(chosen):
        of = np.flatnonzero(chosen == s)
        r, c = row[of], col[of]
        if s == ESCAPE:
            words[place[of]] = np.uint64(ESCAPE) << np.uint64(60)
            words[place[of] + 1] = grid[r, c]
            continue
        if s == RUN:
            words[place[of]] = (run[r, c].astype(np.uint64) << np.uint64(RUN_VALUE_BITS)) | grid[r, c]
            continue
        count, bits = SHAPES[s]
        value = np.full(len(of), int(s) << 60, np.uint64)
        for k in range(count):
            ids_there = flat[r * BLOCK + c + k]
            if count > 1 and k:
                ids_there = np.where(c + k < BLOCK, ids_there, np.uint64(0))
            value |= ids_there << np.uint64(k * bits)
        words[place[of]] = value
    before = np.searchsorted(row, np.arange(rows))
    return words, place[before].astype(np.uint32)


def decode_ids(words: np.ndarray, block_words: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids (uint64) of an encoded array."""
    if not n:
        return np.zeros(0, np.uint64)
    rows = len(block_words)
    selector = (words >> np.uint64(60)).astype(np.int8)
    # a raw word behind an escape is no word of its own
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == ESCAPE):
        if not raw[i]:
            raw[i + 1] = True
    counts = np.array([0] + [SHAPES[s][0] for s in range(1, 15)] + [1], np.int64)
    size = counts[selector]
    payload = words & np.uint64((1 << 60) - 1)
    runs = (selector == RUN) & ~raw
    size[runs] = (payload[runs] >> np.uint64(RUN_VALUE_BITS)).astype(np.int64)
    size[raw] = 0
    block = np.searchsorted(block_words, np.arange(len(words)), side="right") - 1
    before = np.cumsum(size) - size
    first = before - before[block_words.astype(np.int64)][block] + block * BLOCK
    out = np.zeros(rows * BLOCK + 60, np.uint64)
    for s in np.unique(selector[~raw]):
        of = np.flatnonzero((selector == s) & ~raw)
        if s == ESCAPE:
            out[first[of]] = words[of + 1]
        elif s == RUN:
            reps = size[of]
            at = np.repeat(first[of] - (np.cumsum(reps) - reps), reps) + np.arange(int(reps.sum()))
            out[at] = np.repeat(payload[of] & np.uint64((1 << RUN_VALUE_BITS) - 1), reps)
        else:
            count, bits = SHAPES[s]
            mask = np.uint64((1 << bits) - 1)
            for k in range(count):
                at = first[of] + k
                own = at < (block[of] + 1) * BLOCK
                out[at[own]] = (payload[of][own] >> np.uint64(k * bits)) & mask
    return out[:n]


def write_token_ids(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 2,
    spaced: bool = True,
    name: str = "token-ids",
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Encode every whole text, append ``end_id`` to each document, write the
    files in ascending order of ``key`` and return them, read back.

    NULL texts are empty (the end id alone); documents without a key come
    first; rows with equal keys follow in the order of their texts' hash;
    equal rows are written as often as they occur; an empty table gives no
    chunk.  Other columns are not read, so their names can't clash.
    """
    src = docs.select(F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    tie = F.xxhash64("t").alias("h")
    src = src.select("k", "t", tie)
    src = src.repartitionByRange(F.col("k").asc_nulls_first(), F.col("h")).sortWithinPartitions(
        F.col("k").asc_nulls_first(), "h"
    )

    def run(batches: Iterator[pa.RecordBatch]):
        from pyspark import TaskContext

        tokens = encoder(tokenizer, spaced)
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in slices(batch, "t", TOKEN_SLICE_BYTES):
                ids, sizes = tokens.encode(part.column(1))
                ends = np.cumsum(sizes + 1)
                whole = np.full(int(ends[-1]), end_id, np.uint32)
                inner = np.ones(len(whole), bool)
                inner[ends - 1] = False
                whole[inner] = ids
                words, before = encode_ids(whole)
                yield pa.RecordBatch.from_pydict(
                    {
                        "shard": pa.array([shard], pa.int32()),
                        "chunk": pa.array([chunk], pa.int32()),
                        "shard_start": [start],
                        "n_ids": [len(whole)],
                        "doc_ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                        "doc_sizes": pa.array([(sizes + 1).tolist()], pa.list_(pa.int64())),
                        "words": [words.astype("<u8").tobytes()],
                        "block_words": [before.astype("<u4").tobytes()],
                    }
                )
                chunk += 1
                start += len(whole)
        release(forget=False)

    return staged(src.mapInArrow(run, FILE_SCHEMA), name)


def read_token_ids(files: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row a document from the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 and, if asked for, the ids."""
    schema = "doc_id long, shard int, own_start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                get = {c: batch.column(i)[row] for i, c in enumerate(batch.schema.names)}
                words = np.frombuffer(get["words"].as_buffer(), "<u8")
                before = np.frombuffer(get["block_words"].as_buffer(), "<u4")
                ids = decode_ids(words, before, get["n_ids"].as_py()).astype("<u4")
                sizes = np.asarray(get["doc_sizes"].values)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                cols = [
                    get["doc_ids"].values,
                    pa.array(np.full(len(sizes), get["shard"].as_py(), np.int32)),
                    pa.array(starts + get["shard_start"].as_py()),
                    pa.array(sizes),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "shard", "own_start", "n_tokens", "ids_crc32"]
                if with_ids:
                    cols.append(pa.ListArray.from_arrays(np.append(starts, ends[-1]), ids.astype(np.int64)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    docs = files.mapInArrow(run, schema)
    # one row a shard, so the running sum is over a few numbers
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    earlier = F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = shards.select("shard", F.coalesce(earlier, F.lit(0)).alias("before"))
    keep = ["doc_id", (F.col("own_start") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"]
    return docs.join(shards, "shard").select(*keep, *(["ids"] * with_ids))


def token_id_digest(docs: DataFrame, tokenizer: str) -> DataFrame:
    return read_token_ids(write_token_ids(docs, tokenizer))


