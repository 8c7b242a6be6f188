"""Quality rules with compression bands (operator 6).

Base rules count words, symbols, repeated lines and repeated word windows.
The method's verdict compresses the whole document and the chunks that cover
it with zstandard: natural text has a ratio inside a band that depends on the length.
Above the band a text is repetitive, below it is incompressible.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_of, with_struct
from .tokens import release

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Bytes of text whose words are held at once.
SLICE_BYTES = 1 << 20


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio (bytes over compressed bytes) by length in bytes:
    (least length, lowest ratio, lowest ratio of wide text, highest ratio),
    ascending.  Chunks of ``chunk_bytes`` have their own limits in the same
    order; a document is rejected if more than ``chunk_share`` of its bytes
    are in chunks outside their limits.  The chunks cover the whole text: what
    is left behind the full ones is a chunk with the limits of its length, or,
    below ``least_rest`` bytes, is judged by a full chunk that ends with the
    text.  A text shorter than a chunk is one chunk.

    The lowest ratio lies between what random words reach at the band's upper
    end and what prose (licences, manuals and messages in 11 languages) has at
    its lower end; prose was measured from 256 bytes on.  Random base64
    separates from prose at each of these lengths, random letters from 1,792 and random hex digits from 5,120; below those
    lengths they compress like prose and are kept.  Text with more than
    ``wide_share`` bytes beyond ASCII compresses less, as Chinese does, and
    has a lower limit.
    """

    by_length: tuple = (
        (0, 0.0, 0.0, 2.4),
        (128, 1.0, 0.9, 2.7),
        (256, 1.18, 0.9, 2.7),
        (384, 1.24, 0.9, 2.7),
        (512, 1.28, 1.0, 3.0),
        (768, 1.34, 1.15, 3.0),
        (1024, 1.38, 1.15, 3.0),
        (1792, 1.67, 1.15, 3.0),
        (2048, 1.7, 1.3, 3.4),
        (3072, 1.76, 1.3, 3.4),
        (4096, 1.78, 1.3, 3.4),
        (5120, 1.97, 1.3, 3.4),
        (8192, 2.05, 1.4, 3.8),
        (32768, 2.05, 1.5, 4.2),
    )
    level: int = 3
    chunk_bytes: int = 4096
    chunk_limits: tuple = (1.78, 1.2, 4.0)
    chunk_share: float = 0.25
    least_rest: int = 1024
    wide_share: float = 0.25


FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_bad_chunks", T.LongType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def repeat_words(ids: np.ndarray, doc: np.ndarray, n_docs: int, window: int = WINDOW) -> np.ndarray:
    """Words of each document inside a window of words found twice or more in
    it.  ``ids`` numbers the words, ``doc`` ascends."""
    n = len(ids) - window + 1
    if n < 2:
        return np.zeros(n_docs, np.int64)
    code = ids[:n]
    bits = int(ids.max()).bit_length()
    used = bits
    for k in range(1, window):
        if used + bits > 63:  # number what there is so far anew
            code = np.unique(code, return_inverse=True)[1]
            used = int(code.max()).bit_length()
        code = (code << bits) | ids[k : k + n]
        used += bits
    start = np.flatnonzero(doc[:n] == doc[window - 1 :])
    code, of = code[start], doc[start]
    order = np.argsort(code, kind="stable")  # equal windows of a document are neighbours
    c, d = code[order], of[order]
    same = (c[1:] == c[:-1]) & (d[1:] == d[:-1])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    hit = np.zeros(len(ids), bool)
    at = start[order[twice]]
    for k in range(window):
        hit[at + k] = True
    return np.bincount(doc[hit], minlength=n_docs)


def quality_rules(docs: DataFrame, bands: Bands = Bands(), text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column ``quality``: counts, ratio and verdict
    (``kept``) of each whole text; returns the frame and the column's name.

    No row is dropped here.  A NULL or empty text has no words and fails the
    base rules; repeated rows get equal verdicts; an empty table gives no
    rows; a column already called ``quality`` stays and the new one gets an
    underscore.
    """
    import zstandard

    least = [b[0] for b in bands.by_length]
    symbols_of = SYMBOLS.encode()
    # white space, and the bytes of UTF-8 that don't begin a character
    no_char = b" \t\n\x0b\f\r" + bytes(range(0x80, 0xC0))
    ascii_bytes = bytes(range(0x80))

    def make():
        z = zstandard.ZstdCompressor(level=bands.level, write_content_size=False)

        def ratio(b: bytes) -> float:
            return len(b) / len(z.compress(b)) if b else 0.0

        def inside(b: bytes, r: float, limits: tuple) -> bool:
            low, wide_low, high = limits
            if not b.isascii() and len(b.translate(None, ascii_bytes)) > bands.wide_share * len(b):
                low = wide_low
            return low <= r <= high

        def limits_at(n: int) -> tuple:
            return bands.by_length[int(np.searchsorted(least, n, side="right")) - 1][1:]

        def chunks_of(raw: bytes, whole: float) -> tuple[int, int, int]:
            """Number of chunks, of bad ones, and bytes in bad ones."""
            n, size = len(raw), bands.chunk_bytes
            if n < size:
                bad = n > 0 and not inside(raw, whole, limits_at(n))
                return int(n > 0), int(bad), n * bad
            spans = [(i, i + size, size, bands.chunk_limits) for i in range(0, n - size + 1, size)]
            rest = n % size
            if rest >= bands.least_rest:
                spans.append((n - rest, n, rest, limits_at(rest)))
            elif rest:
                spans.append((n - size, n, rest, bands.chunk_limits))
            bad = [own for i, j, own, limits in spans if not inside(raw[i:j], ratio(raw[i:j]), limits)]
            return len(spans), len(bad), sum(bad)

        def work(part):
            texts = texts_of(part.column(part.schema.names.index(text)))
            names: defaultdict[bytes, int] = defaultdict()
            names.default_factory = names.__len__  # a new word gets the next number
            words, n_words, rows = [], [], []
            for t in texts:
                raw = t.encode("utf-8", "surrogatepass")
                own = raw.split()  # ASCII white space, as bytes
                words += map(names.__getitem__, own)
                n_words.append(len(own))
                lines = [x for x in raw.split(b"\n") if x.strip()]
                whole = ratio(raw)
                n_chunks, bad, bad_bytes = chunks_of(raw, whole)
                natural = inside(raw, whole, limits_at(len(raw))) and bad_bytes <= bands.chunk_share * len(raw)
                rows.append(
                    (len(raw.translate(None, no_char)), len(raw) - len(raw.translate(None, symbols_of)),
                     len(lines) - len(set(lines)), whole, n_chunks, bad, natural)
                )
            n = np.array(n_words, np.int64)
            doc = np.repeat(np.arange(len(texts)), n)
            repeated = repeat_words(np.array(words, np.int64), doc, len(texts))
            chars, symbols, dups, whole, chunks, bad, natural = (list(c) for c in zip(*rows, strict=True))
            failed = (n < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n)
            kept = ~failed & np.array(natural, bool)
            return [n, chars, symbols, dups, repeated, whole, chunks, bad, failed, kept]

        return work

    return with_struct(docs, "quality", FIELDS, text, make, limit=SLICE_BYTES, done=release)


def quality_digest(docs: DataFrame) -> DataFrame:
    found, name = quality_rules(docs.select("doc_id", "text"))
    first = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    order = [*first, *(f.name for f in FIELDS if f.name not in first)]
    return found.select("doc_id", *[F.col(f"{name}.{c}") for c in order])


def keep_quality(docs: DataFrame, bands: Bands = Bands()) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    found, name = quality_rules(docs, bands)
    return found.where(F.col(f"{name}.kept")).drop(name)
