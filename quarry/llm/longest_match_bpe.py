"""Byte-pair encoding by longest match and backtracking.

The tokens of a rank file are mapped byte by byte to Latin-1 and put into an
Aho-Corasick automaton.  One run over a word finds the longest token starting
at every byte.  The encoder takes that token if it may stand after the one
before, else the next shorter token that begins alike, and steps back over a
position from which nothing fits; every position is given up at most once, so
the work is linear in the word.

Two tokens may stand side by side exactly if merging their bytes in rank order
never joins a piece of the one with a piece of the other.  ``Ranks.fits`` undoes
the merges of both from the last one back and looks at the pieces facing each
other at each step; answers are memoised in a table of fixed size.  The only
sequence of tokens whose neighbours all fit is the one that the merges make.

Edge cases: NULL text is empty and has no tokens; very long texts are split in
slices of ``SLICE`` words; words without an own token cost time in proportion to
their length; repeated rows are encoded one by one; empty tables give no rows;
NULL ids pass; only ``doc_id`` and ``text`` are read, so further columns of any
name do not matter.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice
from operator import methodcaller

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of at most ``LONGEST`` characters (the older half goes when full) and neighbour tests
#: (the least recently used go) that a worker keeps.
WORDS, LONGEST, PAIRS = 1 << 18, 64, 1 << 17
#: Words of one text in memory at a time, and characters or ids read for one batch of results.
SLICE, BATCH = 1 << 18, 1 << 18

MATCHED = methodcaller("group")


class Words(dict):
    """The ids of words met before; a word that is missing is encoded."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        ids = self.encode(word)
        if len(word) <= LONGEST:
            if len(self) >= WORDS:
                for old in list(islice(self, WORDS // 2)):
                    del self[old]
            self[word] = ids
        return ids


class Ranks:
    """A vocabulary whose merge order is its id order, as in files of ranks."""

    def __init__(self, tokens: dict[bytes, int]):
        self.tokens = tokens
        self.size = max(tokens.values()) + 1
        self.labels = [b""] * self.size
        for label, i in tokens.items():
            self.labels[i] = label
        #: The two tokens that a token is merged from (None: a byte, or out of reach of the merges).
        self.halves: list[tuple[int, int] | None] = [None] * self.size
        self.merged: dict[tuple[int, int], int] = {}
        reachable = []
        for label, i in sorted(tokens.items(), key=lambda t: t[1]):
            if len(label) == 1 or self._find_halves(label, i):
                reachable.append((label, i))
        #: The longest shorter token with which a token begins.
        self.shorter = [None] * self.size
        known = dict(reachable)
        self.automaton = ahocorasick.Automaton()
        for label, i in reachable:
            self.automaton.add_word(label.decode("latin-1"), (len(label), i))
            self.shorter[i] = next((known[label[:n]] for n in range(len(label) - 1, 0, -1) if label[:n] in known), None)
        self.automaton.make_automaton()
        self.fits = lru_cache(PAIRS)(self._fits)
        self.words = Words(self._word)

    def _find_halves(self, label: bytes, i: int) -> bool:
        for cut in range(1, len(label)):
            a, b = self.tokens.get(label[:cut], i), self.tokens.get(label[cut:], i)
            if a < i and b < i and self._fits(a, b):
                self.halves[i], self.merged[a, b] = (a, b), i
                return True
        return False

    def _fits(self, left: int, right: int) -> bool:
        """Whether ``right`` may follow ``left``: no merge before both are whole joins their facing pieces."""
        halves, merged = self.halves, self.merged
        made_left = left if halves[left] else -1
        made_right = right if halves[right] else -1
        before = self.size  # merges of this rank or later come after the state looked at
        while True:
            joined = merged.get((left, right))
            if joined is not None and joined < before:
                return False
            if made_left < 0 and made_right < 0:
                return True
            # The later of both merges is undone; of equal ones, the left happens first.
            if made_left > made_right:
                before, left = made_left, halves[left][1]
                made_left = left if halves[left] else -1
            else:
                before, right = made_right + 1, halves[right][0]
                made_right = right if halves[right] else -1

    def _word(self, word: str) -> bytes:
        """The ids of one word, without splitting it, as 32-bit numbers."""
        raw = word.encode()
        whole = self.tokens.get(raw)
        return array("i", (whole,) if whole is not None else self.encode(raw)).tobytes()

    def encode(self, raw: bytes) -> list[int]:
        n, fits, shorter, labels = len(raw), self.fits, self.shorter, self.labels
        longest = [0] * n
        for end, (length, i) in self.automaton.iter(raw.decode("latin-1")):
            longest[end + 1 - length] = i  # ends ascend, so the longest is written last
        path: list[int] = []
        given_up = bytearray(n + 1)
        at, token = 0, longest[0] if n else None
        while at < n:
            while token is not None:
                end = at + len(labels[token])
                if not given_up[end] and (not path or fits(path[-1], token)):
                    break
                token = shorter[token]
            if token is None:
                given_up[at] = 1
                token = path.pop()
                at -= len(labels[token])
                token = shorter[token]
            else:
                path.append(token)
                at = end
                token = longest[at] if at < n else None
        return path


class Encoder:
    """Texts to ids and back; ``pattern`` splits a text into words that are encoded one by one."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = Ranks({base64.b64decode(label): int(rank) for label, rank in map(bytes.split, f)})
        self.split = regex.compile(pattern)
        self.decimals = list(map(str, range(self.ranks.size)))

    def encode(self, text: str) -> array:
        word = self.ranks.words.__getitem__
        if len(text) <= SLICE:
            return array("i", b"".join(map(word, self.split.findall(text))))
        found, ids = self.split.finditer(text), array("i")
        while part := b"".join(map(word, map(MATCHED, islice(found, SLICE)))):
            ids.frombytes(part)
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.ranks.labels.__getitem__, ids))

    def written(self, ids) -> str:
        """The ids as decimal numbers, joined by one space."""
        return " ".join(map(self.decimals.__getitem__, ids))


_MADE: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of one rank file (the last one used stays, with its bounded tables)."""
    if (path, pattern) not in _MADE:
        _MADE.clear()
        _MADE[path, pattern] = Encoder(path, pattern)
    return _MADE[path, pattern]


def _rows(path: str, pattern: str, column: str, row, fields: list[pa.Field]):
    """A function on Arrow batches: ``row(encoder, value)`` of each value of ``column``, in small batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            rows, n = [], 0
            for doc, value in zip(batch["doc_id"], batch[column]):
                rows.append((doc.as_py(), *row(own, value)))
                n += len(value) if column == "ids" and value.is_valid else len(value.as_py() or "")
                if n >= BATCH:
                    yield _batch(rows, fields)
                    rows, n = [], 0
            if rows:
                yield _batch(rows, fields)

    return run


def _batch(rows: list[tuple], fields: list[pa.Field]) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=pa.schema(fields))


DOC = pa.field("doc_id", pa.int64())
IDS = pa.field("ids", pa.list_(pa.int32()))


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) per row; ``path`` must name the rank file on every executor."""
    run = _rows(path, pattern, "text", lambda own, text: (own.encode(text.as_py() or ""),), [DOC, IDS])
    return _plain(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, decoded): the bytes of the ids of each row; NULL ids are none."""
    run = _rows(path, pattern, "ids", lambda own, ids: (own.decode(ids.as_py() or ()),), [DOC, pa.field("decoded", pa.binary())])
    return tokens.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def _digests(own: Encoder, text) -> tuple[int, str, str]:
    ids = own.encode(text.as_py() or "")
    return (len(ids), hashlib.sha256(own.written(ids).encode()).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest())


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row, of encoding and decoding in one pass."""
    fields = [DOC, pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _plain(docs).mapInArrow(_rows(path, pattern, "text", _digests, fields),
                                   "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
