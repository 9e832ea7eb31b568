"""Exact top-k search by vector-approximation files.

Query blocks are written to shared storage.  Each task keeps one chunk of
candidates and its approximation (one cell of ``CELLS`` per component), reads
the query blocks one after another and, for every query,

1. scans the cells for a lower and an upper bound of each inner product;
2. takes the k-th best lower bound as threshold;
3. reads exact vectors in order of their upper bound until the k-th exact
   score exceeds every bound still unread.

A chunk yields at most k rows per query; a window merges the chunks.  Neither
the queries nor the candidates are ever whole in one task.

Edge cases: vectors that are NULL or hold a NULL or non-finite component take
no part; vectors meet only vectors of their own length; equal scores go to the
smaller id; repeated rows are candidates one by one, but a row of the query's
own id never is; rows with NULL id take no part; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarry.llm.shared import filesystem, work_folder

CELLS = 64
CHUNK = 32768
QUERY_BLOCK = 512


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, v): integer vectors floor(256 x) of the usable rows."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return (vectors.where(F.col(vector).isNotNull() & F.col(id_column).isNotNull() & finite)
            .select(F.col(id_column).cast("long").alias("id"),
                    F.transform(x, lambda c: F.floor(c * 256).cast("long")).alias("v")))


def _by_length(ids: pa.Array, vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix) of each vector length."""
    ids = ids.to_numpy(zero_copy_only=False)
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    starts = vectors.offsets.to_numpy()[:-1] - vectors.offsets.to_numpy()[0]
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield ids[rows], flat[starts[rows][:, None] + np.arange(d)[None, :]]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; in floating point where every sum stays below 2**53."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[-1], 1)
    if top < 2 ** 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


class Approximation:
    """Cells of a chunk: component = base + width * cell + (0 .. width - 1)."""

    def __init__(self, vectors: np.ndarray):
        self.base = int(vectors.min(initial=0))
        self.width = max(1, -(-(int(vectors.max(initial=0)) - self.base + 1) // CELLS))
        self.cells = ((vectors - self.base) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores at the cells' lower corners, and what each query can lose or gain from there."""
        corner = _product(queries, self.cells.astype(np.int64)) * self.width + self.base * queries.sum(1)[:, None]
        rest = self.width - 1
        return corner, np.minimum(queries, 0).sum(1) * rest, np.maximum(queries, 0).sum(1) * rest


def _best(query: np.ndarray, query_id: int, ids: np.ndarray, vectors: np.ndarray, corner: np.ndarray,
          loses: int, gains: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    own = ids == query_id
    able = np.flatnonzero(~own) if own.any() else np.arange(len(ids))
    if len(able) > k:
        c = corner[able]
        threshold = np.partition(c, len(c) - k)[len(c) - k] + loses
        able = able[c + gains >= threshold]
    able = able[np.argsort(-corner[able], kind="stable")]
    read, scores, step = 0, np.empty(0, np.int64), max(4 * k, 32)
    while read < len(able):
        part = able[read:read + step]
        scores = np.concatenate([scores, _product(query[None, :], vectors[part])[0]])
        read += len(part)
        if read < len(able) and len(scores) >= k:
            kth = np.partition(scores, len(scores) - k)[len(scores) - k]
            if kth > corner[able[read]] + gains:
                break
    seen = able[:read]
    top = np.lexsort((ids[seen], -scores))[:k]
    return ids[seen[top]], scores[top]


SCHEMA = "query_id long, vec_id long, score long"


def _search(folder: str, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = filesystem(folder)

        def answer(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            chunk = pa.Table.from_batches(held).combine_chunks()
            parts = [(i, v, Approximation(v)) for i, v in
                     _by_length(chunk["id"].combine_chunks(), chunk["v"].combine_chunks())]
            for info in sorted(fs.get_file_info(pa.fs.FileSelector(path)), key=lambda f: f.path):
                if not info.path.endswith(".parquet"):
                    continue
                for block in pq.ParquetFile(fs.open_input_file(info.path)).iter_batches(QUERY_BLOCK):
                    out: list[list[np.ndarray]] = [[], [], []]
                    for qids, queries in _by_length(block["id"], block["v"]):
                        for ids, vectors, approx in parts:
                            if vectors.shape[1] != queries.shape[1]:
                                continue
                            for at in range(0, len(qids), 64):
                                corner, loses, gains = approx.bounds(queries[at:at + 64])
                                for j in range(len(corner)):
                                    q = at + j
                                    found, scores = _best(queries[q], qids[q], ids, vectors, corner[j],
                                                          int(loses[j]), int(gains[j]), k)
                                    out[0].append(np.full(len(found), qids[q]))
                                    out[1].append(found)
                                    out[2].append(scores)
                    if out[0]:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in out],
                                                         names=["query_id", "vec_id", "score"])

        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                yield from answer(held)
                held, rows = [], 0
        if rows:
            yield from answer(held)

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id",
          vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` highest inner products.

    Repeated query rows are one query.
    """
    spark = vectors.sparkSession
    folder = work_folder(spark, "queries")
    quantised(vectors.where(is_query), id_column, vector).dropDuplicates(["id"]).write.parquet(folder)
    found = quantised(vectors, id_column, vector).mapInArrow(_search(folder, k), SCHEMA)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


#: DuckDB SQL of the query over ``embeddings``.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
