"""Language-model scoring with a weighted backoff automaton (operator 3).

The model is an n-gram model with hierarchical Dirichlet smoothing:

    p(w | h) = (c(h w) + mass * p(w | h')) / (c(h) + mass)

where h' is h without its first word and the lowest order is
(c(w) + 0.5) / (N + 0.5 (V + 1)).  Written as an automaton, each context seen
in training is a state; an arc for each n-gram seen holds its log-probability,
and the failure arc to the shorter context holds mass / (c(h) + mass).  A text
is read once from left to right: the state is carried, and log-probabilities
of arcs and failure arcs are added up.

No task ever holds the model.  Texts are dealt to blocks; a block asks for the
counts of its own n-grams alone, which are summed over all blocks by n-gram
key, and builds the part of the automaton that its texts can reach.  That part
gives the same path and the same score as the whole one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, raw_texts, staged, word_hashes

ORDER = 2
#: Dirichlet mass of each backoff step.
MASS = 2000.0
#: Bytes of text of a block, on average.
BLOCK_BYTES = 12 << 20
HELD_OUT = 1  # the remainder of crc32(doc_id) by 5 that isn't trained on
BUCKET_BITS = 20

# keys of the marks, which no word's hash is likely to have
_END, _BEGIN = (mix(np.array([x], np.uint64))[0] for x in (0xE0D, 0xBE61))

REQUEST = "block int, level int, bucket int, keys binary, counts binary"
ANSWER = "block int, level int, bucket int, counts binary, n_types long, n_tokens long"
SCORE = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


class Grams:
    """The n-grams of a block's texts, each text between a start and an end mark.

    ``keys[m]`` are the 64-bit keys of the m-grams that end at each place,
    where ``has[m]`` says so.
    """

    def __init__(self, texts: list[bytes], order: int):
        words, counts = word_hashes(texts)
        self.order = order
        self.sizes = counts + 2
        self.first = np.cumsum(self.sizes) - self.sizes
        self.doc = np.repeat(np.arange(len(texts)), self.sizes)
        key = np.empty(len(self.doc), np.uint64)
        inner = np.ones(len(key), bool)
        inner[self.first] = inner[self.first + self.sizes - 1] = False
        key[inner] = words
        key[self.first] = _BEGIN
        key[self.first + self.sizes - 1] = _END
        depth = np.arange(len(key)) - self.first[self.doc]  # words before, the mark too
        self.keys, self.has = [None, key], [None, np.ones(len(key), bool)]
        for m in range(2, order + 1):
            before = np.concatenate([key[:1], self.keys[m - 1][:-1]])
            self.keys.append(mix(before * np.uint64(0x9E3779B97F4A7C15) + key + np.uint64(m)))
            self.has.append(depth >= m - 1)

    def number(self) -> None:
        """Number the distinct m-grams from 1 in the order of their keys:
        ``ids[m]`` at each place (0: none), ``prefix[m]`` and ``suffix[m]`` the
        numbers of an m-gram's (m-1)-grams."""
        self.ids, self.prefix, self.suffix, self.distinct = [None], [None], [None], [None]
        for m in range(1, self.order + 1):
            where = np.flatnonzero(self.has[m])
            keys, which = np.unique(self.keys[m][where], return_inverse=True)
            ids = np.zeros(len(self.doc), np.int64)
            ids[where] = which + 1
            at = np.zeros(len(keys) + 1, np.int64)
            at[which + 1] = where  # some place of each
            self.distinct.append(len(keys))
            self.ids.append(ids)
            none = m == 1
            for parts, back in ((self.prefix, 1), (self.suffix, 0)):
                own = np.zeros(len(at), np.int64) if none else self.ids[m - 1][at - back]
                own[0] = 0
                parts.append(own)
        self.begin = int(self.ids[1][self.first[0]]) if len(self.first) else 0

    def counted(self, m: int, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct m-gram keys, ascending, and how often each is in training texts."""
        keys = np.unique(self.keys[m][self.has[m]])
        trained, times = np.unique(self.keys[m][self.has[m] & train[self.doc]], return_counts=True)
        counts = np.zeros(len(keys), "<u4")
        counts[np.searchsorted(keys, trained)] = times
        return keys, counts


def _packed(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, so that planes of zeros compress."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()


def _unpacked(raw, kind: str) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _requests(blocks_bits: int, order: int):
    def run(table: pa.Table) -> pa.Table:
        grams = Grams(raw_texts(table.column("text")), order)
        train = ~np.asarray(table.column("held_out"))
        block = table.column("block")[0].as_py()
        rows = []
        for m in range(1, order + 1):
            keys, counts = grams.counted(m, train)
            bucket = (keys >> np.uint64(64 - blocks_bits)).astype(np.int64)
            cut = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys))
            for a, b in zip(cut, cut[1:], strict=False):
                rows.append((block, m, int(bucket[a]), _packed(np.diff(keys[a:b].astype("<u8"), prepend=np.uint64(0))), _packed(counts[a:b])))
        cols = list(zip(*rows, strict=True))
        types = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table(
            [pa.array(c, t) for c, t in zip(cols, types, strict=True)],
            names=["block", "level", "bucket", "keys", "counts"],
        )

    return run


def _totals(table: pa.Table) -> pa.Table:
    """Sum a bucket's counts by key and answer each block in its own order."""
    keys = [np.cumsum(_unpacked(x, "<u8")) for x in table.column("keys").to_pylist()]
    counts = [_unpacked(x, "<u4") for x in table.column("counts").to_pylist()]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(which, np.concatenate(counts), len(distinct)).astype("<u8")  # exact below 2**53
    own = total[which]
    cut = np.cumsum([0] + [len(k) for k in keys])
    words = (total > 0) & (distinct != _BEGIN)  # the start mark is no token
    first = np.arange(len(keys)) == 0
    return pa.table(
        {
            "block": table.column("block"),
            "level": table.column("level"),
            "bucket": table.column("bucket"),
            "counts": pa.array([_packed(own[a:b]) for a, b in zip(cut, cut[1:], strict=False)], pa.binary()),
            "n_types": np.where(first, int(words.sum()), 0),
            "n_tokens": np.where(first, int(total[words].sum()), 0),
        }
    )


class Automaton:
    """States are the contexts that were seen in training: state (m, g) is the
    m-gram g, state (0, 0) the empty context.  An n-gram that was seen is an
    arc from its prefix; every state but the empty one has a failure arc to
    its suffix.  The texts' n-grams are numbered, so the arc that a state has
    for the next word is found by the number of the n-gram ending there."""

    def __init__(self, grams: Grams, counts: list, n_tokens: int, n_types: int, mass: float):
        self.grams, self.order = grams, grams.order
        p = (counts[1] + 0.5) / (n_tokens + 0.5 * (n_types + 1))
        self.unigram = np.log10(p)
        self.arc = [None, self.unigram]  # log-probability of each n-gram
        self.seen = [np.ones(1, bool)] + [c > 0 for c in counts[1:]]
        self.fail = [np.zeros(1)] + [np.log10(mass / (c + mass)) for c in counts[1:-1]]
        for m in range(2, self.order + 1):
            p = (counts[m] + mass * p[grams.suffix[m]]) / (counts[m - 1][grams.prefix[m]] + mass)
            self.arc.append(np.log10(p))

    def score(self) -> np.ndarray:
        """Log-probability of each text.  All texts are read side by side, one
        word a step; each carries the length of its context."""
        grams = self.grams
        by = np.argsort(-grams.sizes, kind="stable")  # texts that still have words come first
        sizes, first = grams.sizes[by], grams.first[by]
        total = np.zeros(len(by))
        # the start mark is a state if some text was trained on
        context = np.full(len(by), int(self.order > 1 and self.seen[1][grams.begin]), np.int64)
        n = len(by)
        for step in range(1, int(sizes[0]) if n else 0):
            n = int(np.searchsorted(-sizes[:n], -step))  # texts with more words than ``step``
            self._read(first[:n] + step, context[:n], total[:n])
        out = np.zeros(len(by))
        out[by] = total
        return out

    def _read(self, at: np.ndarray, context: np.ndarray, total: np.ndarray) -> None:
        """Read the word at each place: add what the path costs, move the states."""
        ids = self.grams.ids
        for m in range(self.order, 1, -1):  # m - 1 words of context
            who = np.flatnonzero(context == m - 1)
            if not len(who):
                continue
            gram = ids[m][at[who]]
            hit = self.seen[m][gram]
            taken, failing = who[hit], who[~hit]
            total[taken] += self.arc[m][gram[hit]]
            context[taken] = -m  # done with this word
            total[failing] += self.fail[m - 1][ids[m - 1][at[failing] - 1]]
            context[failing] = m - 2
        who = np.flatnonzero(context == 0)
        total[who] += self.arc[1][ids[1][at[who]]]
        context[who] = -1
        # the n-gram that was read, cut to its longest suffix that is a state
        np.minimum(-context, self.order - 1, out=context)
        for m in range(self.order - 1, 0, -1):
            who = np.flatnonzero(context == m)
            context[who[~self.seen[m][ids[m][at[who]]]]] = m - 1


def score_texts(docs: DataFrame, order: int = ORDER, mass: float = MASS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Train on the documents whose crc32(doc_id as text) mod 5 isn't 1 and
    score every whole text (doc_id, text): doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score.

    A NULL or empty text is the end token alone; a NULL id counts as the empty
    text's crc32, 0, and trains; repeated rows train and are scored each;
    an empty table gives no row; other columns are not read.  Rows with the
    same id and text share a block.
    """
    n_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = int(n_bytes // block_bytes) + 1
    bits = min(BUCKET_BITS, max(4, (n_blocks * 4 - 1).bit_length()))
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    src = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (crc % 5 == HELD_OUT).alias("held_out"),
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_blocks)).cast("int").alias("block"),
    )
    asked = src.groupBy("block").applyInArrow(_requests(bits, order), REQUEST)
    answers = staged(asked.groupBy("level", "bucket").applyInArrow(_totals, ANSWER), "counts")
    sums = answers.where("level = 1").agg(F.sum("n_types"), F.sum("n_tokens")).first()
    n_types, n_tokens = sums[0] or 0, sums[1] or 0

    def score(texts: pa.Table, counts: pa.Table) -> pa.Table:
        grams = Grams(raw_texts(texts.column("text")), order)
        grams.number()
        totals: list = [None]
        rows = sorted(
            zip(*(counts.column(c).to_pylist() for c in ("level", "bucket", "counts")), strict=True),
            key=lambda r: (r[0], r[1]),
        )
        for m in range(1, order + 1):
            total = np.zeros(grams.distinct[m] + 1, np.int64)
            own = [_unpacked(r[2], "<u8") for r in rows if r[0] == m]
            total[1:] = np.concatenate(own) if own else 0
            totals.append(total)
        automaton = Automaton(grams, totals, n_tokens, n_types, mass)
        scores = automaton.score()
        token = np.ones(len(grams.doc), bool)
        token[grams.first] = False  # the start mark
        own = grams.ids[1][token]
        n = len(grams.sizes)
        base = np.bincount(grams.doc[token], automaton.unigram[own], n)
        known = np.bincount(grams.doc[token], totals[1][own] > 0, n).astype(np.int64)
        cols = [texts.column("doc_id"), texts.column("held_out"), grams.sizes - 1, known, base, scores]
        return pa.table(cols, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    scored = src.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(score, SCORE)
    return scored.withColumn("train_tokens", F.lit(n_tokens).cast("long"))
