"""Helpers shared by the operators: batches of texts, staged tables, names."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from obsengine.session import checkpoint_dir

#: Rows of one Arrow batch are worked in slices of about so many bytes of text.
SLICE_BYTES = 8 << 20


def free_name(taken: list[str], name: str) -> str:
    """``name``, or ``name`` with underscores behind it where a column has it."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared checkpoint folder and read it
    back: lineage is cut at files that every executor sees."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of a column; NULL is the empty text."""
    return ["" if t is None else t for t in column.to_pylist()]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part has at most about ``limit`` bytes of text
    (one longer text is a part of its own)."""
    sizes = np.asarray(
        pc.binary_length(batch.column(batch.schema.names.index(text))).fill_null(0)
    ).astype(np.int64)
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if total and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < batch.num_rows:
        yield batch.slice(start)


def with_struct(
    df: DataFrame,
    name: str,
    fields: T.StructType,
    text: str,
    make: Callable[[], Callable[[pa.RecordBatch], list]],
    limit: int = SLICE_BYTES,
    done: Callable[[], None] | None = None,
) -> tuple[DataFrame, str]:
    """``df`` with one more struct column computed from whole rows.

    ``make`` runs once a task and returns a function from a slice (of about
    ``limit`` bytes of text) to the struct's columns; ``done`` runs at the
    task's end.  Returns the frame and the new column's name, which
    differs from ``name`` only where ``df`` has that name already.
    """
    name = free_name(df.columns, name)
    schema = T.StructType([*df.schema.fields, T.StructField(name, fields, False)])
    target = to_arrow_schema(fields)

    def run(batches):
        work = make()
        for batch in batches:
            for part in slices(batch, text, limit):
                cols = [pa.array(c, f.type) for c, f in zip(work(part), target, strict=True)]
                made = pa.StructArray.from_arrays(cols, fields=list(target))
                yield pa.RecordBatch.from_arrays([*part.columns, made], [*part.schema.names, name])
        if done is not None:
            done()

    return df.mapInArrow(run, schema), name


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser over uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def sha256_of(column) -> F.Column:
    return F.sha2(F.encode(column, "utf-8"), 256)


#: Texts are hashed in groups of about so many bytes.
HASH_BYTES = 2 << 20
# an odd base: its powers have inverses modulo 2**64
_BASE = 0x9E3779B97F4A7C15
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FOLDED = _BYTES.copy()
_FOLDED[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i for i below a power of two of at least ``n``."""
    size = 1 << max(n - 1, 1).bit_length()
    if size not in _POWERS:
        both = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            x = np.full(size, base, np.uint64)
            x[0] = 1
            both.append(np.multiply.accumulate(x))
        if size > HASH_BYTES * 2:
            return both[0], both[1]
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size]


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (runs without ASCII white space, A-Z folded)
    of the texts one after another, and each text's number of words."""
    hashes, counts = [], []
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) < HASH_BYTES):
            size += len(texts[end]) + 1
            end += 1
        data = np.frombuffer(b"\n".join(texts[at:end]) + b"\n", np.uint8)
        space = _SPACE[data]
        edge = np.flatnonzero(np.diff(space, prepend=True))
        begin, stop = edge[::2], edge[1::2]
        power, inverse = _powers(len(data))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_FOLDED[data] * power[: len(data)])])
        own = (total[stop] - total[begin]) * inverse[begin]
        hashes.append(mix(own + (stop - begin).astype(np.uint64)))
        ends = np.cumsum([len(t) + 1 for t in texts[at:end]])
        counts.append(np.bincount(np.searchsorted(ends, begin, side="right"), minlength=end - at))
        at = end
    if not texts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(counts)


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 of a column's texts; NULL is the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]
