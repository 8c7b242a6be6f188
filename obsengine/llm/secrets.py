"""Secret scan through a trigram inverted index (operator 1).

Each rule is a regular expression.  From its syntax tree a Boolean trigram
query is derived: every match must hold all trigrams of at least one string
of each literal run.  Texts are taken in segments of some megabytes; a segment
gets an inverted index (trigram -> positions of the texts that hold it) over
the trigrams that some rule mentions, the rule's postings are intersected and
united, and only the candidates are verified with the expression itself.  A
rule without a mandatory trigram (the hexadecimal one) scans every text.

The index of a segment lives beside its texts in one task: postings of the
whole corpus would have to be shuffled back to the texts they came from, and
no text moves here at all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sha256_of, texts_of, with_struct

try:
    from re import _parser as tree
except ImportError:  # older interpreters
    import sre_parse as tree

#: Literal runs with more spellings than this give no query.
MAX_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # characters that the group must have
    ignore_case: bool = False

    @property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.ignore_case else 0))


# The three base kinds, then public key formats.
RULES = (
    Rule(
        "assign",
        r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2, 12, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18),
    # [0-9a-f]+ of 16 characters and more: a run is taken whole or not at all
    Rule("hex", r"[0-9a-f]{16,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[0-9A-Za-z]{36,255}"),
    Rule("slack", r"xox[abprs]-[0-9A-Za-z-]{10,255}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[0-9A-Za-z_-]{8,}\.eyJ[0-9A-Za-z_-]{8,}\.[0-9A-Za-z_-]{8,}"),
)
BASE_KINDS = ("assign", "access", "hex")


def _trigrams(s: str) -> frozenset:
    b = s.lower().encode()
    return frozenset(b[i : i + 3] for i in range(len(b) - 2))


def _spellings(node) -> set[str] | None:
    """All strings that a node can match, if they are few; else None."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg).lower()} if arg < 128 else None
    if op == "IN":
        if any(str(o) != "LITERAL" or a >= 128 for o, a in arg):
            return None
        return {chr(a).lower() for _, a in arg} if len(arg) <= 8 else None
    if op == "SUBPATTERN":
        return _sequence(arg[-1])
    if op == "BRANCH":
        parts = [_sequence(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in ("MAX_REPEAT", "MIN_REPEAT") and arg[1] == 1:
        inner = _sequence(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _sequence(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        s = _spellings(node)
        if s is None or len(out) * len(s) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in s}
    return out


def _clause(strings: set[str]) -> frozenset | None:
    """OR over strings of the AND of their trigrams; None: always true."""
    sets = {_trigrams(s) for s in strings}
    if frozenset() in sets:
        return None
    return frozenset(a for a in sets if not any(b < a for b in sets))


def trigram_query(pattern: str) -> list[frozenset]:
    """The Boolean query of an expression: a conjunction of clauses, each a
    disjunction of trigram sets.  Empty: the expression has no mandatory
    trigram and needs a full scan."""
    found: list[frozenset] = []

    def flush(run: set[str]) -> None:
        if (c := _clause(run)) is not None and c not in found:
            found.append(c)

    def walk(nodes) -> None:
        run = {""}
        for node in nodes:
            s = _spellings(node)
            if s is not None and len(run) * len(s) <= MAX_STRINGS:
                run = {a + b for a in run for b in s}
                continue
            flush(run)
            run = {""}
            op, arg = str(node[0]), node[1]
            if s is not None:
                run = s
            elif op == "SUBPATTERN":
                walk(arg[-1])
            elif op in ("MAX_REPEAT", "MIN_REPEAT") and arg[0] >= 1:
                walk(arg[2])
            elif op == "BRANCH":
                # a clause holds if each branch has one: take the first of each
                parts = [trigram_query_of(x) for x in arg[1]]
                if all(parts):
                    found.append(frozenset().union(*(p[0] for p in parts)))
        flush(run)

    def trigram_query_of(nodes) -> list[frozenset]:
        nonlocal found
        kept, found = found, []
        walk(nodes)
        kept, found = found, kept
        return kept

    walk(tree.parse(pattern))
    return found


class SegmentIndex:
    """Inverted index of one segment over a fixed set of trigrams."""

    def __init__(self, trigrams: list[bytes]):
        self.codes = {t: i for i, t in enumerate(trigrams)}
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        used = sorted({b for t in trigrams for b in t})
        self.classes = np.zeros(256, np.int32)  # 0: in no trigram
        for i, b in enumerate(used):
            self.classes[lower == b] = i + 1
        self.width = len(used) + 1
        self.table = np.full(self.width**3, -1, np.int16)
        for t, i in self.codes.items():
            a, b, c = (int(self.classes[x]) for x in t)
            self.table[(a * self.width + b) * self.width + c] = i

    def build(self, texts: list[bytes]) -> dict[bytes, np.ndarray]:
        """Sorted positions of the texts that hold each trigram."""
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        if len(data) < 3:
            return {}
        ends = np.cumsum([len(t) + 1 for t in texts])
        c = self.classes[data]
        hits = self.table[(c[:-2] * self.width + c[1:-1]) * self.width + c[2:]]
        at = np.flatnonzero(hits >= 0)
        text = np.searchsorted(ends, at, side="right")
        inside = at + 2 < ends[text] - 1  # not across the joint of two texts
        pairs = np.unique(hits[at[inside]].astype(np.int64) * len(texts) + text[inside])
        code, text = np.divmod(pairs, len(texts))
        cut = np.searchsorted(code, np.arange(len(self.codes) + 1))
        return {t: text[cut[i] : cut[i + 1]] for t, i in self.codes.items()}

    @staticmethod
    def candidates(query: list[frozenset], postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
        none = np.zeros(0, np.int64)
        out = np.arange(n)
        for clause in query:
            union = none
            for grams in clause:
                lists = sorted((postings.get(t, none) for t in grams), key=len)
                both = lists[0]
                for p in lists[1:]:
                    if not len(both):
                        break
                    both = np.intersect1d(both, p, assume_unique=True)
                union = np.union1d(union, both)
            out = np.intersect1d(out, union, assume_unique=True)
        return out


SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
    ]
)


def scan_secrets(docs: DataFrame, rules=RULES, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column ``secrets`` whose field ``spans`` lists the
    secrets of the whole text by start, then by the rules' order (start and end
    in code points, end exclusive); returns the frame and the column's name.

    Every row is kept with all its columns.  NULL and empty texts have no
    spans; repeated rows are scanned alike; an empty table gives no rows.  A
    column that is already called ``secrets`` stays, the new one then gets an
    underscore.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    grams = sorted({t for q in queries for clause in q for s in clause for t in s})

    def make():
        regexes = [r.regex for r in rules]
        index = SegmentIndex(grams)

        def work(part):
            texts = texts_of(part.column(part.schema.names.index(text)))
            postings = index.build([t.encode("utf-8", "surrogatepass") for t in texts])
            spans: list[list] = [[] for _ in texts]
            for k, rule in enumerate(rules):
                who = index.candidates(queries[k], postings, len(texts)) if queries[k] else range(len(texts))
                find, group, least = regexes[k].finditer, rule.group, rule.least
                for i in who:
                    for m in find(texts[i]):
                        if m.end(group) - m.start(group) >= least:
                            spans[i].append((m.start(), k, m.end()))
            return [[[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in sorted(x)] for x in spans]]

        return work

    return with_struct(docs, "secrets", T.StructType([T.StructField("spans", T.ArrayType(SPAN))]), text, make)


def span_text(spans) -> F.Column:
    """kind:start:end of each span, joined by commas."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.concat_ws(",", F.transform(spans, one))


def secrets_digest(docs: DataFrame) -> DataFrame:
    """One row a document: counts of the base kinds, the digest of their spans
    and all spans as text."""
    found, name = scan_secrets(docs.select("doc_id", "text"))
    spans = F.col(f"{name}.spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        sha256_of(span_text(base)).alias("base_sha256"),
        span_text(spans).alias("spans"),
    )
