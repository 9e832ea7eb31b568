"""Line de-duplication through a sharded minimal perfect hash.

1. Each document's distinct line keys are hashed to 128 bits and aggregated
   (partially before the shuffle) to smallest document, whether a second
   document has it, and the number of documents.
2. The hashes found in two documents or more are dealt to shards.  A task
   builds a shard's minimal perfect hash (levels of bit arrays; a hash alone at
   its place settles there, the others go on to the next level) over the first
   64 bits, and arrays of fingerprints (the other 64 bits), document counts and
   smallest documents in hash order.  Shards are files on shared storage; only
   those named in the written manifest, hence of successful attempts, are read.
3. Documents probe the arrays, block by block: a block's hashes are grouped by
   shard and one shard at a time is in memory.

Edge cases: NULL or empty text is one empty line; rows of equal id are one
document; a NULL id neither counts as a holder nor loses lines; an empty table
gives an empty result.  Other columns are kept by :func:`drop_repeated_lines`.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.shared import filesystem, materialise, work_folder
from quarry.llm.textblocks import mix

SPACES = b" \t\n\x0b\x0c\r"
MIN_POINTS = 10
SHARD_KEYS = 1 << 19
PROBE_BYTES = 32 << 20


def line_keys(text: str | None) -> list[bytes | None]:
    """The key of each line, None for keys under ``MIN_POINTS`` code points."""
    out: list[bytes | None] = []
    for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n"):
        key = line.strip(SPACES).lower()
        long = len(key) >= MIN_POINTS and (len(key) >= 4 * MIN_POINTS or len(key.decode("utf-8", "surrogatepass")) >= MIN_POINTS)
        out.append(key if long else None)
    return out


def _hashes(keys) -> np.ndarray:
    """128-bit hashes as rows of two unsigned 64-bit words."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), dtype=">u8").astype(np.uint64).reshape(-1, 2)


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            hashes, ids = [], []
            for doc, text in zip(part["doc_id"].to_pylist(), part["text"].to_pylist()):
                if doc is not None and (keys := {k for k in line_keys(text) if k is not None}):
                    hashes.append(_hashes(keys))
                    ids.append(np.full(len(keys), doc, np.int64))
            if hashes:
                h = np.concatenate(hashes).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()), pa.array(np.concatenate(ids))],
                    names=["h1", "h2", "doc_id"])


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: key to its place 0 .. n - 1.

    Keys that share all 64 bits end in ``rest``, a sorted list after the levels.
    """

    def __init__(self, keys: np.ndarray, gamma: float = 1.5, levels: int = 40):
        self.sizes, self.bits, self.before = [], [], []
        placed, left = 0, keys
        for level in range(levels):
            if not len(left):
                break
            size = max(64, int(gamma * len(left)))
            at = self._at(left, level, size)
            alone = np.bincount(at, minlength=size) == 1
            self.sizes.append(size)
            self.bits.append(alone)
            self.before.append(placed + np.concatenate([[0], np.cumsum(alone)]))
            placed += int(alone.sum())
            left = left[~alone[at]]
        self.rest = np.unique(left)
        self.placed = placed

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(keys ^ mix(np.full(1, level + 1, np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                % np.uint64(size)).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Places; any place or -1 for keys that were not built in."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                return out
            at = self._at(keys[todo], level, size)
            hit = self.bits[level][at]
            out[todo[hit]] = self.before[level][at[hit]]
            todo = todo[~hit]
        if len(self.rest) and len(todo):
            k = np.searchsorted(self.rest, keys[todo]).clip(0, len(self.rest) - 1)
            same = self.rest[k] == keys[todo]
            out[todo[same]] = self.placed + k[same]
        return out


class Shard:
    """Perfect hash plus fingerprint, count and smallest-document arrays."""

    def __init__(self, h1, h2, n_docs, first):
        self.hash = PerfectHash(h1)
        at = self.hash(h1)
        self.fingerprint, self.n_docs, self.first = (np.zeros(len(h1), t) for t in (np.uint64, np.uint32, np.int64))
        self.fingerprint[at], self.n_docs[at], self.first[at] = h2, n_docs.clip(0, 2 ** 32 - 1), first

    def to_bytes(self) -> bytes:
        buffer = io.BytesIO()
        np.savez(buffer, fingerprint=self.fingerprint, n_docs=self.n_docs, first=self.first, rest=self.hash.rest,
                 sizes=np.array(self.hash.sizes, np.int64),
                 bits=np.packbits(np.concatenate(self.hash.bits)) if self.hash.bits else np.empty(0, np.uint8))
        return buffer.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> Shard:
        data = np.load(io.BytesIO(raw))
        self, h = cls.__new__(cls), PerfectHash(np.empty(0, np.uint64))
        self.fingerprint, self.n_docs, self.first = data["fingerprint"], data["n_docs"], data["first"]
        h.sizes, h.rest = data["sizes"].tolist(), data["rest"]
        bits = np.unpackbits(data["bits"], count=sum(h.sizes)).astype(bool)
        for size in h.sizes:
            one, bits = bits[:size], bits[size:]
            h.bits.append(one)
            h.before.append(h.placed + np.concatenate([[0], np.cumsum(one)]))
            h.placed += int(one.sum())
        self.hash = h
        return self

    def first_documents(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, smallest document) of hashes."""
        at = self.hash(h1)
        found = at >= 0
        found[found] = self.fingerprint[at[found]] == h2[found]
        return found, np.where(found, self.first[np.where(found, at, 0)], 0) if len(self.first) else np.zeros(len(h1), np.int64)


def _build(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        rows = pa.Table.from_batches(held)
        fs, path = filesystem(folder)
        fs.create_dir(path, recursive=True)
        shard = rows["shard"].to_numpy()
        for k in np.unique(shard):
            of = shard == k
            h1, h2, n, first = (rows[c].to_numpy()[of] for c in ("h1", "h2", "n_docs", "first"))
            name = f"shard-{int(k)}-{uuid.uuid4().hex}"
            with fs.open_output_stream(f"{path}/{name}") as out:
                out.write(Shard(h1.view(np.uint64), h2.view(np.uint64), n, first).to_bytes())
            yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([name])], names=["shard", "name"])

    return run


def build_index(docs: DataFrame, shard_keys: int = SHARD_KEYS) -> tuple[str, dict[int, str], int]:
    """Write the shards; (folder, shard names by number, number of shards).

    The names are one per ``shard_keys`` repeated lines.
    """
    spark = docs.sparkSession
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) \
        .mapInArrow(_emit, "h1 long, h2 long, doc_id long")
    repeated = materialise(
        lines.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first"),
                                      F.max("doc_id").alias("_last"))
        .where("first < _last").drop("_last"), "line-hashes")
    n = max(1, -(-repeated.count() // shard_keys))
    folder = work_folder(spark, "line-shards")
    dealt = repeated.withColumn("shard", F.pmod("h1", F.lit(n)).cast("int")).repartition(n, "shard")
    manifest = materialise(dealt.mapInArrow(_build(folder), "shard int, name string"), "line-manifest")
    return folder, {r["shard"]: r["name"] for r in manifest.collect()}, n


def _probe(folder: str, names: dict[int, str], n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)
        last: list = [None, None]

        def shard(k: int) -> Shard:
            if last[0] != k:
                last[:] = [None, None]
                with fs.open_input_stream(f"{path}/{names[k]}") as f:
                    last[:] = [k, Shard.from_bytes(f.read())]
            return last[1]

        def answer(part: pa.RecordBatch) -> pa.RecordBatch:
            texts = part["text"].to_pylist()
            keys = [line_keys(t) for t in texts]
            flat = [(d, i) for d, ks in enumerate(keys) for i, k in enumerate(ks) if k is not None]
            doc = np.array([d for d, _ in flat], np.int64)
            hashes = _hashes([keys[d][i] for d, i in flat])
            of = np.mod(hashes[:, 0].view(np.int64) if len(flat) else np.empty(0, np.int64), n)
            ids = part["doc_id"].to_pylist()
            own = np.array([0 if x is None else x for x in ids], np.int64)
            known = np.array([x is not None for x in ids], bool)
            drop = np.zeros(len(flat), bool)
            for k in np.unique(of):
                if int(k) in names:
                    at = np.flatnonzero(of == k)
                    found, first = shard(int(k)).first_documents(hashes[at, 0], hashes[at, 1])
                    drop[at] = found & (first != own[doc[at]]) & known[doc[at]]
            gone: dict[int, set[int]] = {}
            for j in np.flatnonzero(drop):
                gone.setdefault(flat[j][0], set()).add(flat[j][1])
            kept = [t if d not in gone else "\n".join(
                line for i, line in enumerate(t.split("\n")) if i not in gone[d]) for d, t in enumerate(texts)]
            columns = [part[c] if c != "text" else pa.array([k or "" for k in kept], pa.string())
                       for c in part.schema.names]
            return pa.RecordBatch.from_arrays(
                columns + [pa.array([len(k) for k in keys], pa.int64()),
                           pa.array([len(gone.get(d, ())) for d in range(len(keys))], pa.int64())],
                names=[*part.schema.names, "n_lines", "n_dropped"])

        for batch in batches:
            rows = max(1, min(batch.num_rows, batch.num_rows * PROBE_BYTES // max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, rows):
                yield answer(batch.slice(at, rows))

    return run


def drop_repeated_lines(docs: DataFrame, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """``docs`` with the kept text, ``n_lines`` (before) and ``n_dropped``."""
    folder, names, n = build_index(docs, shard_keys)
    plain = docs.drop("n_lines", "n_dropped")
    plain = plain.withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*(T.StructField(f.name, f.dataType) for f in plain.schema.fields),
                           T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    return plain.mapInArrow(_probe(folder, names, n), schema)


def line_dedup(docs: DataFrame) -> DataFrame:
    """The contract's digest of :func:`drop_repeated_lines`."""
    return drop_repeated_lines(docs.select("doc_id", "text")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


#: DuckDB SQL of the query over ``documents``.
ORACLE = r"""
WITH l AS (
  SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS line
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i FROM documents)),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
m AS (SELECT k.*, r.first IS NOT NULL AND r.first <> doc_id AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
