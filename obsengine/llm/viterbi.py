"""Token counts without tokens: count-only Viterbi (operator 7).

The vocabulary is a unigram model, pieces with scores.  An Aho-Corasick
automaton lists the pieces that end at each character, and dynamic
programming carries the best score and the number of pieces of its path; no
path is kept.  Ties go as in the exact tokenizer (``models.Unigram`` of the
tokenizers library): of equal scores the piece that begins first stays.  A
character without a piece costs the lowest score less ten; runs of such
characters fuse and fall back to their UTF-8 bytes.

A space becomes the mark that begins a word, and no piece crosses a mark, so
words are independent and each distinct word of a batch is counted once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import with_struct

MARK = "▁"
# Fixed value of the exact tokenizer.
UNKNOWN_PENALTY = 10.0
#: Words that a worker remembers before it starts afresh.
REMEMBERED = 500_000

FIELDS = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("n_bytes", T.LongType())])


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())]


def exact_tokenizer(pieces: list[tuple[str, float]], unk_id: int = 0):
    """The tokenizer whose ids are counted, for comparison."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(pieces, unk_id=unk_id, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="always", split=True)
    t.encode_special_tokens = True
    return t


class Counter:
    def __init__(self, pieces: list[tuple[str, float]], unk_id: int = 0):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.pieces = dict(pieces)  # as in the tokenizer, a later piece with the same text stands
        self.unk = pieces[unk_id][0]
        for piece, score in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.known: dict[str, tuple[int, int]] = {}

    def count(self, word: str) -> tuple[int, int]:
        """(tokens, tokens that are bytes) of one word."""
        n = len(word)
        score = [0.0] + [-np.inf] * n  # the best up to each character
        tokens, raw = [0] * (n + 1), [0] * (n + 1)
        run = [-1] * (n + 1)  # where the unknown characters begin that end here

        def unknown(begin: int, end: int, value: float) -> None:
            c = score[begin] + value
            if c > score[end]:
                score[end] = c
                run[end] = at = run[begin] if run[begin] >= 0 else begin
                text = word[at:end]  # a fused run that is no piece falls back to bytes
                width = 0 if text in self.pieces else len(text.encode())
                tokens[end], raw[end] = tokens[at] + (width or 1), raw[at] + width

        at, single = 0, False
        # matches come by their end, of one end the longest first
        for end, (size, value) in self.automaton.iter(word):
            while at < end:
                if not single:
                    unknown(at, at + 1, self.unknown)
                single = False
                at += 1
            if size == 1:
                single = True
            begin, end = end + 1 - size, end + 1
            if size == len(self.unk) and word[begin:end] == self.unk:
                unknown(begin, end, value)
                continue
            c = score[begin] + value
            if c > score[end]:
                score[end], tokens[end], raw[end], run[end] = c, tokens[begin] + 1, raw[begin], -1
        while at < n:
            if not single:
                unknown(at, at + 1, self.unknown)
            single = False
            at += 1
        return tokens[n], raw[n]

    def totals(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        coded = words.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        for w in distinct:
            if w not in self.known:
                self.known[w] = self.count(w)
        both = np.array([self.known[w] for w in distinct], np.int64).reshape(-1, 2)
        return both[np.asarray(coded.indices)].T


_COUNTERS: dict[str, Counter] = {}


def _counter(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(vocabulary(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, path: str, text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with a struct column ``tokens`` (n_tokens, n_bytes: tokens that
    are single bytes) of each whole text; returns the frame and the column's
    name.

    NULL and empty texts have no tokens; repeated rows count alike; an empty
    table gives no rows; all columns are kept, and a column already called
    ``tokens`` gets an underscore beside it.
    """

    def make():
        counter = _counter(path)

        def work(part):
            texts = part.column(part.schema.names.index(text)).fill_null("")
            # the mark begins each word: " a b" and "a b" differ in an empty word
            marked = pc.replace_substring(texts, " ", MARK)
            fronted = pc.if_else(pc.starts_with(marked, MARK), marked, pc.binary_join_element_wise(MARK, marked, ""))
            marked = pc.if_else(pc.equal(texts, ""), "", fronted)
            words = pc.split_pattern(marked, MARK)
            counts = np.asarray(pc.list_value_length(words)).astype(np.int64)
            flat = pc.list_flatten(words)
            first = np.zeros(len(flat), bool)
            first[np.cumsum(counts) - counts] = True  # what is before the first mark is empty
            flat = pc.binary_join_element_wise(MARK, flat, "")
            tokens, raw = counter.totals(flat)
            tokens, raw = np.where(first, 0, tokens), np.where(first, 0, raw)
            row = np.repeat(np.arange(len(counts)), counts)
            return [np.bincount(row, x, len(counts)).astype(np.int64) for x in (tokens, raw)]

        return work

    return with_struct(docs, "tokens", FIELDS, text, make)


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    found, name = count_tokens(docs.select("doc_id", "text"), path)
    return found.select("doc_id", F.col(f"{name}.*"))
