"""Byte-pair encoding by a tokenization automaton.

States are tokens read last, arcs are tokens, and a path spells the correct
encoding of its bytes exactly if all its arcs exist.  The automaton starts with
one state and an arc for every byte.  The gadget of merge (a, b) -> c

* takes the arc b away from the state of a,
* gives an arc c to every state that still has the arc a, and
* gives the state of c the arcs that the state of b had.

Since every arc labelled x leads to the state of x, ``arc(x, y)`` follows these
gadgets back from the later of both tokens, and the arcs met are kept in a
bounded table; the other billions of a 50,000-token vocabulary are never made.
Encoding a pre-split word walks the arcs longest label first and marks dead
positions (each prefix has one correct path, so a position is tried once).
Decoding joins arc labels.

Edge cases: NULL text is empty and has no tokens; the file's added tokens are
matched in the text before splitting; very long words cost time in proportion
to length times longest label; repeated rows are encoded one by one; empty
tables give no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_WORDS = 1 << 18
# The code points with the Unicode property White_Space.
SPACES = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Runs of text that no word of the splitting pattern crosses, each kept as one entry.
CHUNK = re.compile(f"\\x20?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
MOST_ARCS = 1 << 21


def byte_symbols() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Automaton:
    def __init__(self, merges: list[tuple[bytes, bytes]], ids: dict[bytes, int]):
        self.ids, self.labels = ids, {i: t for t, i in ids.items()}
        self.rank, self.made = {}, {}
        self.arcs: dict[tuple[int, int], bool] = {}
        for r, (a, b) in enumerate(merges):
            pair, c = (ids[a], ids[b]), ids[a + b]
            # A pair without an arc can never be read, so its gadget changes nothing.
            if self.arc(*pair, r - 1):
                self.rank[pair], self.made[c] = r, (r, *pair)
        self.arcs.clear()
        self.reachable = {t: i for t, i in ids.items() if len(t) == 1 or i in self.made}
        self.longest: dict[bytes, int] = {}
        for t in self.reachable:
            self.longest[t[:3]] = max(self.longest.get(t[:3], 2), len(t))

    def arc(self, x: int, y: int, after: int | None = None) -> bool:
        """Whether the state of ``x`` has arc ``y`` after that merge (None: after all)."""
        rank, made = self.rank, self.made
        after = len(rank) + len(self.ids) if after is None else after
        while True:
            r = rank.get((x, y))
            if r is not None and r <= after:
                return False
            mx, my = made.get(x), made.get(y)
            if mx is None and my is None:
                return True
            if my is None or (mx is not None and mx[0] >= my[0]):
                # The state of x began as that of its right part, just before the merge.
                x, after = mx[2], mx[0] - 1
                if my is not None and mx[0] == my[0]:
                    y = my[1]
            else:
                # Arc y was given where the arc of its left part remained.
                y, after = my[1], my[0]

    def encode(self, word: bytes) -> list[int]:
        whole = self.reachable.get(word)
        if whole is not None:
            return [whole]
        n, arcs, reachable, longest = len(word), self.arcs, self.reachable, self.longest
        path: list[int] = []
        ends, dead = [0], set()
        length = min(longest.get(word[:3], 2), n)
        while True:
            at = ends[-1]
            step = False
            while length > 0:
                t = reachable.get(word[at:at + length])
                if t is not None and at + length not in dead:
                    if path:
                        pair = (path[-1], t)
                        fits = arcs.get(pair)
                        if fits is None:
                            if len(arcs) >= MOST_ARCS:
                                arcs.clear()
                            fits = arcs[pair] = self.arc(*pair)
                    else:
                        fits = True
                    if fits:
                        step = True
                        break
                length -= 1
            if step:
                path.append(t)
                at += length
                if at == n:
                    return path
                ends.append(at)
                length = min(longest.get(word[at:at + 3], 2), n - at)
            else:
                dead.add(ends.pop())
                length = len(self.labels[path.pop()]) - 1


class Encoder:
    """Texts to ids and back, with the pre-splitting of a byte-level tokenizer file."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol = byte_symbols()

        def raw(t: str) -> bytes:
            return bytes(symbol[c] for c in t)

        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.automaton = Automaton([(raw(a), raw(b)) for a, b in merges], ids)
        self.added, self.words, self.chunks, self.packed = added, {}, {}, {}
        self.labels = dict(self.automaton.labels) | {i: t.encode() for t, i in added.items()}
        self.split = regex.compile(pattern)
        self.specials = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None

    def _words(self, chunk: str) -> list[int]:
        out, words = [], self.words
        for word in self.split.findall(chunk):
            found = words.get(word)
            if found is None:
                found = self.automaton.encode(word.encode())
                if len(word) <= 64:
                    if len(words) >= MOST_WORDS:
                        words.clear()
                    words[word] = found
            out += found
        return out

    def _plain(self, text: str) -> Iterator[list[int]]:
        chunks = self.chunks
        for chunk in CHUNK.findall(text):
            found = chunks.get(chunk)
            if found is None:
                found = self._words(chunk)
                if len(chunk) <= 64:
                    if len(chunks) >= MOST_WORDS:
                        chunks.clear()
                    chunks[chunk] = found
            yield found

    def _parts(self, text: str) -> Iterator[tuple[str, int | None]]:
        """Plain texts, and the added token after each (None at the end)."""
        done = 0
        for m in self.specials.finditer(text) if self.specials else ():
            yield text[done:m.start()], self.added[m.group()]
            done = m.end()
        yield text[done:] if done else text, None

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for plain, special in self._parts(text):
            for ids in self._plain(plain):
                out += ids
            if special is not None:
                out.append(special)
        return out

    def encode_packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        out, packed = [], self.packed
        for plain, special in self._parts(text):
            for chunk in CHUNK.findall(plain):
                found = packed.get(chunk)
                if found is None:
                    ids = self._words(chunk)
                    found = struct.pack(f"<{len(ids)}I", *ids)
                    if len(chunk) <= 64:
                        if len(packed) >= MOST_WORDS:
                            packed.clear()
                        packed[chunk] = found
                out.append(found)
            if special is not None:
                out.append(struct.pack("<I", special))
        return b"".join(out)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.labels.__getitem__, ids)).decode("utf-8", "replace")


_MADE: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """The worker's encoder of a tokenizer file, compiled once per process."""
    if (path, pattern) not in _MADE:
        _MADE[path, pattern] = Encoder(path, pattern)
    return _MADE[path, pattern]


def _encode(path: str, pattern: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = []
                for text in part["text"].to_pylist():
                    ids = own.encode(text or "")
                    rows.append((len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                                 hashlib.sha256(own.decode(ids).encode()).hexdigest(), ids if with_ids else None))
                cols = list(zip(*rows))
                arrays = [part["doc_id"], pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    arrays, names = [*arrays, pa.array(cols[3], pa.list_(pa.int32()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def tokenise(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) per row.

    ``path`` must name the tokenizer file on every executor.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return plain.mapInArrow(_encode(path, pattern, with_ids), schema)
