"""Packing along a space-filling curve.

Each document's words are hashed into a vector, projected to ``DIMS``
dimensions by random signs and turned into a Hilbert key.  A narrow table of
keys and token counts - not the tokens - is range-sorted by (key, hash of id,
row); the hash splits copies of one document, which share a key.  The sum of
the counts before a row is its document's place in one stream along the curve,
which is cut every ``LIMIT`` ids: only the last sequence needs padding.  Tokens
are written once, meet their place by row number, which deals them out evenly
however texts crowd on the curve, and are cut where they lie.

Token ids come from the merge ranks in the tokenizer file (the tiktoken library
does the merging; an added token in a text is matched first).

Edge cases: NULL or empty text is the end id alone; very long documents are cut
into many pieces; repeated rows are packed one by one; ties in the key are
ordered by the hash of the id, then by row; NULL ids are packed like any other;
an empty table gives no pieces; only ``doc_id`` and ``text`` are read, so
further columns of any name do not matter.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import byte_symbols
from quarry.llm.textblocks import blocks, mix, words
from quarry.operators.ranking import sums_before
from quarry.sources.worktables import WorkTables

LIMIT = 1024
END_ID = 0
DIMS, BITS = 4, 8


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place along the Hilbert curve of integer points (rows) with ``bits`` bits a dimension."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def project(hashes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Each document's point: the signs of its words averaged by dimension, as cells."""
    total = np.zeros((len(of) - 1, DIMS))
    count = np.maximum(np.diff(of), 1)
    for d in range(DIMS):
        sign = 1.0 - 2.0 * (mix(hashes + np.uint64(d + 1)) >> np.uint64(63)).astype(float)
        sums = np.concatenate([[0.0], np.cumsum(sign)])
        total[:, d] = sums[of[1:]] - sums[of[:-1]]
    # A mean over w words varies by 1 / sqrt(w); words repeat, so the spread is wider.
    scaled = np.tanh(total / np.sqrt(count)[:, None] / 4)
    return np.clip(((scaled + 1) / 2 * (1 << BITS)).astype(np.int64), 0, (1 << BITS) - 1)


class Tokens:
    """The ids of a byte-level tokenizer file, as little-endian numbers of ``kind``."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        symbol, model = byte_symbols(), spec["model"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(symbol[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
        made = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        if any(a >= b for a, b in zip(made, made[1:])):
            raise ValueError("the vocabulary's ids do not follow the order of the merges")
        self.library = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens=added)
        self.kind = np.dtype("<u2" if max([*ranks.values(), *added.values()]) < 1 << 16 else "<u4")

    def encode(self, text: str) -> np.ndarray:
        ids = self.library.encode_to_numpy(text, allowed_special="all")
        return np.append(ids, END_ID).astype(self.kind)


_MADE: dict[tuple[str, str], Tokens] = {}


def tokens(path: str, pattern: str) -> Tokens:
    """The worker's tokenizer (the last file used; of fixed size, it remembers no words)."""
    if (path, pattern) not in _MADE:
        _MADE.clear()
        _MADE[path, pattern] = Tokens(path, pattern)
    return _MADE[path, pattern]


CODED = "doc_id long, key long, width int, n long, ids binary"


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokens(path, pattern)
        width = own.kind.itemsize
        for batch in batches:
            for first, last, raw, at in blocks(batch["text"], 1 << 20):
                part = batch.slice(first, last - first)
                key = hilbert_key(project(*words(raw, at)))
                ids = [own.encode(t.as_py() or "").tobytes() for t in part["text"]]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(key), pa.array([width] * len(ids), pa.int32()),
                     pa.array([len(x) // width for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                    names=["doc_id", "key", "width", "n", "ids"])

    return run


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def _cut(limit: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, width, n, ids, at in zip(*(batch[c] for c in ("doc_id", "width", "n", "ids", "before"))):
                doc, n, at, start = doc.as_py(), n.as_py(), at.as_py(), 0
                ids = np.frombuffer(ids.as_buffer(), f"<u{width.as_py()}")
                while start < n:
                    length = min(limit - at % limit, n - start)
                    piece = ids[start:start + length]
                    rows.append((doc, start, length, zlib.crc32(piece.astype("<u4")), n, at // limit, at % limit,
                                 piece if with_ids else None))
                    start, at = start + length, at + length
            if rows:
                cols = list(zip(*rows))
                names = [c.split()[0] for c in PIECES.split(", ")]
                arrays = [pa.array(c, pa.int64()) for c in cols[:7]]
                if with_ids:
                    arrays, names = [*arrays, pa.array(cols[7], pa.list_(pa.int64()))], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def pack(docs: DataFrame, path: str, pattern: str, limit: int = LIMIT, with_ids: bool = False) -> DataFrame:
    """One row per piece: document, start, length, checksum, sequence, offset[, ids]."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    work = WorkTables(docs.sparkSession, "packing")
    coded = plain.mapInArrow(_encode(path, pattern), CODED).withColumn("row", F.monotonically_increasing_id())
    coded = work.keep(coded, "coded", result=True, compression="zstd")
    narrow = coded.select("row", "key", F.xxhash64("doc_id").alias("h"), "n")
    placed = sums_before(narrow, [], [F.col("key"), F.col("h"), F.col("row")], {"before": "n"}, work)
    both = coded.select("row", "doc_id", "width", "n", "ids").join(placed.select("row", "before"), "row")
    return (both.select("doc_id", "width", "n", "ids", "before")
            .mapInArrow(_cut(limit, with_ids), PIECES + ", ids array<long>" * with_ids))
