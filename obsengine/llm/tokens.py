"""Whole texts to token ids with a tokenizer file, one distinct word at a time.

The tokenizers used here cut a text at each single space between two other
characters before anything else, so a text's ids are the ids of its pieces
between such spaces, one after another.  Pieces repeat, so each Python worker
keeps the ids of the pieces it has met; the library encodes new pieces many at
a time, joined so that they don't touch.  Texts in which white space touches
white space, and texts that hold an added token's string, are encoded whole.
"""

from __future__ import annotations

import ctypes
import gc
import json
import os
from collections import defaultdict
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces that a worker remembers, and their characters; beyond either, those
#: met only once are forgotten.
REMEMBERED = 400_000
REMEMBERED_CHARS = 16 << 20
#: Text that is encoded at once.
TOKEN_SLICE_BYTES = 2 << 20
#: New pieces that are encoded as one text, and those encoded at once.
JOINED = 512
LEARNT = 1 << 15

# Fixed value: white space as the files know it, besides space and line feed
# (a superset is harmless), and white space that touches a space.
_WHOLE = (
    r"[\t\x0b\x0c\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    r"|  | \n|\n |\n\n\n|\n\n\z"
)
#: Signs that are cut off behind a letter.
SIGNS = ".,;:!?\"'()[]{}<>#*$%&|~^+=/@"
#: Marks a piece that no space precedes.
HEAD = "\x1f"
#: A word that parts pieces where a file drops white space.
BETWEEN = "\x00"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level files: printable
    Latin-1 characters stand for themselves, the others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of a file of the tokenizers library.

    ``spaced``: a piece that follows a space is encoded with that space
    (byte-level files); else the file drops white space.  ``literal``: the
    strings of added tokens are ordinary text, and the bytes of ids are
    checked; else they get their own ids, as in the library's plain call.
    """

    remembered = REMEMBERED

    def __init__(self, path: str, spaced: bool, literal: bool = False):
        self.spaced = spaced
        self._open(path, literal)
        self.forget()

    def _open(self, path: str, literal: bool) -> None:
        # a task has one core, and each thread of the library keeps memory of its own
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = json.loads(self.tokenizer.to_str())["added_tokens"]
        self.added = [] if literal else [t["content"] for t in added]
        self.checks = literal  # the bytes of ids are compared
        if self.spaced:
            alphabet = byte_alphabet()
            self.bytes_of = [b""] * self.tokenizer.get_vocab_size(with_added_tokens=True)
            for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
                self.bytes_of[i] = bytes(alphabet.get(c, 0) for c in token)
            self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        else:
            (self.between,) = self._ids([BETWEEN])[0]

    def forget(self) -> None:
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__  # a new piece gets the next number
        self.flat = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 14, np.int64)  # of a piece's ids in flat
        self.size = np.zeros(1 << 14, np.int32)
        self.good = np.zeros(1 << 14, bool)  # the ids' bytes are the piece's
        self.uses = np.zeros(1 << 14, np.int8)  # slices that had the piece, 2 for more
        self.filled = self.chars = 0

    def _keep_used(self) -> None:
        """Forget the pieces that one slice alone has had."""
        n = len(self.number)
        stay = np.flatnonzero(self.uses[:n] > 1)
        if len(stay) > self.remembered // 2:
            stay = stay[:0]
        names = list(self.number)
        names = [names[i] for i in stay.tolist()]
        begin, size, good = self.begin[stay], self.size[stay], self.good[stay]
        flat = self.flat[_ranges(begin, size)]
        self.forget()
        if sum(map(len, names)) > REMEMBERED_CHARS // 2:
            return
        self.number.update(zip(names, range(len(names)), strict=True))
        self._room(len(names))
        self._place(np.arange(len(names)), flat, size, good)
        self.chars = sum(map(len, names))

    def _room(self, n: int) -> None:
        while n > len(self.begin):
            for name in ("begin", "size", "good", "uses"):
                x = getattr(self, name)
                setattr(self, name, np.concatenate([x, np.zeros_like(x)]))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fits(self, ids: list[int], text: str) -> bool:
        """The ids' bytes are the text's."""
        return b"".join([self.bytes_of[i] for i in ids]) == text.encode()

    def _pieces(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Lists of pieces, and which texts must be encoded whole."""
        whole = pc.match_substring_regex(texts, _WHOLE) if self.spaced else pa.array(np.zeros(len(texts), bool))
        for string in self.added:
            whole = pc.or_(whole, pc.match_substring(texts, string, ignore_case=True))
        rest = pc.if_else(whole, "", texts)
        if self.spaced:
            rest = pc.replace_substring(rest, "\n", " \n " + HEAD)
            rest = pc.binary_join_element_wise(HEAD, rest, "")
        else:
            rest = pc.replace_substring(rest, "\n", " ")
        return pc.split_pattern(rest, " "), np.flatnonzero(np.asarray(whole))

    def _place(self, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray, good: np.ndarray) -> None:
        """Remember the ids of the pieces with the numbers ``at``."""
        while self.filled + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.filled : self.filled + len(ids)] = ids
        self.size[at], self.good[at] = sizes, good
        self.begin[at] = self.filled + np.cumsum(sizes, dtype=np.int64) - sizes
        self.filled += len(ids)

    def _alone(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after another, and how many each has."""
        ids = self._ids(texts.to_numpy(zero_copy_only=False).tolist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes

    def _many(self, texts: pa.Array, behind: str) -> tuple[np.ndarray, np.ndarray]:
        """As ``_alone``, with ``behind`` after each text to hold them apart;
        many texts are encoded as one."""
        if behind:
            texts = pc.binary_join_element_wise(texts, "", behind)
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        cuts = [*range(0, len(texts), JOINED), len(texts)]
        raw = memoryview(data)
        joined = [str(raw[ends[i] : ends[j]], "utf-8") for i, j in zip(cuts, cuts[1:])]
        ids = np.concatenate([np.zeros(0, np.uint32), *(np.array(i, np.uint32) for i in self._ids(joined))])
        if self.spaced:
            # a token ends where each text does, for its bytes are told
            reached = np.cumsum(self.length_of[ids])
            stop = ends[1:] - ends[0] - len(behind)
            to = np.minimum(np.searchsorted(reached, stop), len(reached) - 1)
            told = reached[-1] == ends[-1] - ends[0] and (reached[to] == stop).all()
            begin, end = np.concatenate([[0], to[:-1] + 1 + len(behind)]), to + 1
        else:
            end = np.flatnonzero(ids == self.between)
            told = len(end) == len(texts)
            begin = np.concatenate([[0], end[:-1] + 1])
        if not told:
            return self._alone(pc.utf8_slice_codeunits(texts, 0, -len(behind)) if behind else texts)
        return ids[_ranges(begin, end - begin)], end - begin

    def _learn_split(self, new: pa.Array, known: int) -> None:
        """Find the ids of new pieces, which are numbered from ``known`` on.
        Signs behind a letter are a piece of their own, as the files cut there
        as well; so "word," and "word;" need "word" only once."""
        numbers = known + np.arange(len(new))
        core = pc.utf8_rtrim(new, characters=SIGNS)
        split = pc.and_(pc.less(pc.binary_length(core), pc.binary_length(new)), pc.match_substring_regex(core, r"\p{L}\z"))
        cut = np.asarray(split)
        if not cut.any():
            return self._learn(new, numbers)
        cores = core.filter(split).to_numpy(zero_copy_only=False)
        before = HEAD if self.spaced else ""
        pieces = new.filter(split).to_numpy(zero_copy_only=False)
        marks = [before + p[len(c) :] for p, c in zip(pieces, cores, strict=True)]
        start = len(self.number)
        at_core, at_mark = (np.fromiter(map(self.number.__getitem__, x), np.int64, len(x)) for x in (cores, marks))
        both = np.concatenate([at_core, at_mark])
        more, where = np.unique(both, return_index=True)
        more, where = more[more >= start], where[more >= start]
        names = np.concatenate([cores, np.array(marks, object)])[where]
        rest = pa.concat_arrays([new.filter(pc.invert(split)), pa.array(names, pa.string())])
        self._learn(rest, np.concatenate([numbers[~cut], more]))
        ids = np.column_stack([at_core, at_mark]).ravel()
        self._place(
            numbers[cut], self.flat[_ranges(self.begin[ids], self.size[ids])], self.size[at_core] + self.size[at_mark],
            self.good[at_core] & self.good[at_mark],
        )

    def _learn(self, new: pa.Array, numbers: np.ndarray) -> None:
        """Find the ids of new pieces with the given numbers."""
        self._room(len(self.number))
        filled = pc.greater(pc.binary_length(new), 0)
        if self.spaced:
            head, line = pc.starts_with(new, HEAD), pc.equal(new, "\n")
            spaced = pc.binary_join_element_wise(" ", new, "")
            texts = pc.if_else(head, pc.utf8_slice_codeunits(new, 1), pc.if_else(line, new, spaced))
            follows = pc.and_(filled, pc.invert(pc.or_(head, line)))
            first = pc.and_(head, pc.greater(pc.binary_length(texts), 0))
            kinds = [(follows, ""), (first, "\n"), (pc.invert(pc.or_(follows, first)), None)]
        else:
            texts = new
            apart = pc.and_(filled, pc.invert(pc.match_substring(new, BETWEEN)))
            kinds = [(apart, f" {BETWEEN} "), (pc.invert(apart), None)]
        for mask, behind in kinds:
            at = np.flatnonzero(np.asarray(mask))
            if not len(at):
                continue
            own = texts.filter(mask)
            for i in range(0, len(at), LEARNT):
                part = own.slice(i, LEARNT)
                flat, sizes = self._alone(part) if behind is None else self._many(part, behind)
                good = np.ones(len(part), bool)
                if self.checks:
                    data = b"".join([self.bytes_of[x] for x in flat.tolist()])
                    if data != b"".join(part.cast(pa.binary()).to_numpy(zero_copy_only=False)):
                        parts = np.split(flat, np.cumsum(sizes)[:-1])
                        good = np.array([self._fits(x.tolist(), t) for x, t in zip(parts, part.to_pylist(), strict=True)], bool)
                self._place(numbers[at[i : i + LEARNT]], flat, sizes, good)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts (no NULL) one after another (uint32), and for
        each text the number of its ids."""
        ids, sizes, _ = self.encode_checked(texts)
        return ids, sizes

    def encode_checked(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As ``encode``, and for each text whether its ids' bytes are its own
        (where the file tells ids' bytes)."""
        if len(self.number) > self.remembered or self.chars > REMEMBERED_CHARS:
            self._keep_used()
        known = len(self.number)
        pieces, whole = self._pieces(texts)
        counts = np.asarray(pc.list_value_length(pieces)).astype(np.int64)
        coded = pc.list_flatten(pieces).dictionary_encode()  # each distinct piece is looked up once
        distinct = coded.dictionary
        at = np.fromiter(map(self.number.__getitem__, distinct.to_numpy(zero_copy_only=False)), np.int64, len(distinct))
        if len(self.number) > known:
            new = distinct.filter(pa.array(at >= known))
            self._learn_split(new, known)
            self.chars += pc.sum(pc.binary_length(new)).as_py()
        self.uses[at] = np.minimum(self.uses[at] + 1, 2)
        at = at[np.asarray(coded.indices)]
        size = self.size[at]
        flat = self.flat[_ranges(self.begin[at], size)]
        edges = np.concatenate([[0], np.cumsum(counts)])
        ends = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[edges]
        bad = np.concatenate([[0], np.cumsum(~self.good[at])])[edges]
        good = np.diff(bad) == 0
        if not len(whole):
            return flat, np.diff(ends), good
        strings = texts.take(pa.array(whole)).to_pylist()
        own = dict(zip(whole.tolist(), self._ids(strings), strict=True))
        if self.checks:
            for i, s in zip(whole.tolist(), strings, strict=True):
                good[i] = self._fits(own[i], s)
        parts = [
            np.array(own[i], np.uint32) if i in own else flat[ends[i] : ends[i + 1]] for i in range(len(texts))
        ]
        return np.concatenate(parts), np.array([len(p) for p in parts], np.int64), good


class PieceEncoder(Encoder):
    """Ids of a sentencepiece file, of texts as they are: the space that the
    library adds in front of a text is taken as the text's own first space.

    No piece of such a file has a space behind another character, so words
    are encoded apart; it is checked when the file is opened.
    """

    remembered = REMEMBERED // 2  # new pieces cost less

    def __init__(self, path: str):
        super().__init__(path, True, True)

    def _open(self, path: str, literal: bool) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.vocab_size())]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in names):
            raise ValueError(f"{path}: a piece has white space behind another character")
        self.bytes_of = [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(names)
        ]
        self.length_of = np.array([len(b) for b in self.bytes_of], np.int64)
        self.added, self.checks = [], True

    def _ids(self, texts: list[str]) -> list[list[int]]:
        # behind a line feed a text is encoded without a space in front
        front = [t[:1] == " " and len(t) > 1 for t in texts]
        ids = self.model.encode([t[1:] if f else "\n" + t for f, t in zip(front, texts, strict=True)], num_threads=1)
        return [i if f else i[2:] for f, i in zip(front, ids, strict=True)]

    def _many(self, texts: pa.Array, behind: str) -> tuple[np.ndarray, np.ndarray]:
        return self._alone(texts)  # the library takes short texts as fast

    def _learn_split(self, new: pa.Array, known: int) -> None:
        self._learn(new, known + np.arange(len(new)))  # these files cut elsewhere


#: Fixed value: sentencepiece's sign for a space.
SPACE = "▁"


def _ranges(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """begin[0], ..., begin[0]+size[0]-1, begin[1], ..."""
    first = np.cumsum(size, dtype=np.int64) - size
    return np.arange(int(size.sum())) + np.repeat(begin - first, size)


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, spaced: bool, literal: bool = False) -> Encoder:
    """The encoder of a file, kept by the Python worker from task to task."""
    key = (path, spaced, literal)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path) if path.endswith(".model") else Encoder(path, spaced, literal)
    return _ENCODERS[key]


def release(forget: bool = True) -> None:
    """At a task's end: forget all pieces and give memory back, since an idle
    Python worker keeps what it holds.  Without ``forget`` the pieces stay for
    the worker's next task."""
    for e in _ENCODERS.values() if forget else ():
        e.forget()
    gc.collect()
    trim()


def trim() -> None:
    """Give back the memory that is free inside this process."""
    pa.default_memory_pool().release_unused()
    malloc_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if malloc_trim is not None:
        malloc_trim(0)
