"""Benchmark decontamination with one Aho-Corasick automaton (operator 5).

Questions and answers of the benchmark are normalised (A-Z lower-cased, words
of letters and digits joined by single spaces) and cut into windows of words;
all windows are the patterns of one automaton, and each text is scanned once.
Matches are mapped back from the normalised text to code points of the
original.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import texts_of, with_struct

WINDOW = 10
#: Normalised text of the benchmark in one automaton, in bytes.  A larger
#: benchmark becomes several automata, each of which scans all texts.
AUTOMATON_BYTES = 4 << 20

# Fixed value: a word is a run of these characters, after lower-casing.
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)

HIT = T.StructType(
    [
        T.StructField("item_id", T.StringType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("last_word", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)
FIELDS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("hits", T.ArrayType(HIT)),
    ]
)


def normalised(text: str) -> tuple[bytes, int]:
    """The words joined and framed by single spaces, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    return (b" " + b" ".join(words) + b" " if words else b"", len(words))


def windows(text: str, size: int) -> list[bytes]:
    words = text.encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not words:
        return []
    return [b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))]


def blocks_of(items: list[tuple], size: int, limit: int) -> list[dict]:
    """Patterns (window -> item ids) in blocks of bounded size."""
    out: list[dict] = []
    total = limit
    for item, text in items:
        name = "null" if item is None else str(item)
        for w in windows(text or "", size):
            if total >= limit:
                out.append({})
                total = 0
            own = out[-1].setdefault(w.decode("latin-1"), [])
            if name not in own:
                own.append(name)
                total += len(w)
    return out


_BUILT: dict[str, object] = {}


def automaton(patterns: dict):
    """The automaton of a block, built once in a Python worker."""
    import ahocorasick

    key = hashlib.sha256(repr(sorted(patterns.items())).encode()).hexdigest()
    if key not in _BUILT:
        a = ahocorasick.Automaton()
        for w, ids in patterns.items():
            a.add_word(w, (w.count(" ") - 1, ids))
        a.make_automaton()
        _BUILT.clear()
        _BUILT[key] = a
    return _BUILT[key]


def find_hits(text: str, automata: list):
    """(words, words hit, items, hits) of one text."""
    norm, n = normalised(text)
    if not n:
        return 0, 0, [], []
    found = [(end, *value) for a in automata for end, value in a.iter(norm.decode("latin-1"))]
    if not found:
        return n, 0, [], []
    spaces = np.flatnonzero(np.frombuffer(norm, np.uint8) == 32)
    last = np.searchsorted(spaces, [f[0] for f in found]) - 1  # the word before the closing space
    first = last - np.array([f[1] for f in found]) + 1
    delta = np.zeros(n + 1, np.int64)
    np.add.at(delta, first, 1)
    np.add.at(delta, last + 1, -1)
    n_hit = int((np.cumsum(delta[:-1]) > 0).sum())
    items = sorted({i for f in found for i in f[2]})
    lower = text.translate({c: c + 32 for c in range(65, 91)})
    places = [m.span() for m in WORD.finditer(lower)]
    hits = [
        {"item_id": i, "first_word": a, "last_word": b, "start": places[a][0], "end": places[b][1]}
        for f, a, b in zip(found, first.tolist(), last.tolist(), strict=True)
        for i in f[2]
    ]
    hits.sort(key=lambda h: (h["first_word"], h["last_word"], h["item_id"]))
    return n, n_hit, items, hits


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    text: str = "text",
    automaton_bytes: int = AUTOMATON_BYTES,
) -> tuple[DataFrame, str]:
    """``docs`` with a struct column ``leaks``: words, words hit, items and
    hits (word numbers and code points, end exclusive) of each whole text;
    returns the frame and the column's name.

    The benchmark (item_id, text) is a stated query set that reaches every
    task in blocks of ``automaton_bytes``; each further block is one more scan
    of the same rows, so its size bounds a task's memory, not the result.
    NULL and empty texts have no words and no hits; items without words have
    no window; an item without id is named ``null``; repeated rows and items
    count alike; an empty benchmark hits nothing; extra columns are kept and a
    column already called ``leaks`` gets an underscore beside it.
    """
    items = benchmark.select(F.col("item_id").cast("string"), "text").distinct()
    rows = sorted(((r[0], r[1]) for r in items.toLocalIterator()), key=lambda r: (r[0] or "", r[1] or ""))
    blocks = blocks_of(rows, window, automaton_bytes)
    sent = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks]

    def make():
        automata = []
        for b in sent:
            a = automaton(b.value) if len(sent) == 1 else _fresh(b.value)
            automata.append(a)

        def work(part):
            texts = texts_of(part.column(part.schema.names.index(text)))
            return [list(c) for c in zip(*(find_hits(t, automata) for t in texts), strict=True)]

        return work

    return with_struct(docs, "leaks", FIELDS, text, make)


def _fresh(patterns: dict):
    _BUILT.clear()
    return automaton(patterns)


def leaks_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found, name = decontaminate(docs.select("doc_id", "text"), benchmark)
    n_hit = F.col(f"{name}.n_hit")
    items = F.col(f"{name}.items")
    return found.select(
        "doc_id",
        F.col(f"{name}.n_words"),
        n_hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join(items, ","), "utf-8"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any benchmark window, with their own columns."""
    found, name = decontaminate(docs, benchmark)
    return found.where(F.col(f"{name}.n_hit") == 0).drop(name)
