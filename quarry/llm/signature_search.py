"""Ranked lexical search over bit-sliced Bloom signatures, exact.

*Index.*  Documents are taken in blocks of consecutive rows and, within a block,
in groups whose numbers of distinct keys lie within a factor of two.  A key is a
term together with a level: a term that occurs tf times has the levels
0..floor(log2(tf)).  A group is one bit matrix, a row for every Bloom position
and a column for every document, sized by its longest document, so long
documents do not fill up the signatures of short ones.  Blocks are written with
their texts, so nothing is ever joined back.

*Bounds.*  ANDing the rows of a key tells which documents may hold a term at
least that often; the answer errs on one side only.  A document's length and
highest count then bound what the term can add to its score, and the bounds of
an item's terms, weighted, add up to an upper bound for every document.

*Search.*  The ``k`` documents of highest bound are scored exactly first; the
k-th of these scores is a floor under the k-th best of all.  Every document whose
bound reaches that floor is scored exactly from its text; the others are provably
excluded.  Items are searched in blocks of a bounded number of term occurrences.

Edge cases: NULL or empty text has no terms and is never found (nor counted);
items without terms find nothing; rows with one item id are one item with the
terms of all; very long texts fill groups of their own; repeated rows are ranked
one by one, equal scores by ascending id and then in any order; rows without an
id are counted and found like others and come last among equal scores; empty
tables give no rows; only the id and text columns are read, so further columns
of any name do not matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.importance import split as terms
from quarry.llm.textblocks import mix
from quarry.operators.ranking import numbered
from quarry.sources.worktables import WorkTables

K = 50
#: Bloom bits for each key of a group's longest document, and positions of a key.
BITS_PER_KEY, POSITIONS = 12, 4
LEVELS = 8
#: Documents and bytes of text in a block; distinct (item, term) pairs in one block of items.
BLOCK_DOCS, BLOCK_BYTES, BLOCK_TERMS = 512, 4 << 20, 1 << 16

def key_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit number for each term, from its bytes, eight at a time."""
    longest = max(map(len, words), default=0)
    width = max(8, -(-longest // 8) * 8) if longest <= 64 else 64
    if longest > 64:  # the rest of a very long term is folded into eight bytes
        words = [w if len(w) <= 64 else w[:56] + mix(np.array([hash_tail(w[56:])], np.uint64)).tobytes() for w in words]
    table = np.array(words, dtype=f"S{width}").view("<u8").reshape(len(words), width // 8)
    h = np.zeros(len(words), np.uint64)
    for part in table.T:
        # Padding must not change the number, or it would depend on the longest term of the text.
        h = np.where(part == 0, h, mix(h ^ part) * np.uint64(0x9E3779B97F4A7C15))
    return mix(h)


def hash_tail(raw: bytes) -> int:
    h = 0
    for at in range(0, len(raw), 8):
        h = (h * 0x100000001B3 ^ int.from_bytes(raw[at:at + 8], "little")) & 0xFFFFFFFFFFFFFFFF
    return h


def positions(hashes: np.ndarray, level: int, rows: int) -> np.ndarray:
    """The Bloom rows (len x POSITIONS) of terms at a level; ``rows`` is a power of two."""
    h = mix(hashes + np.uint64((level + 1) * 0xD1342543DE82EF95 & 0xFFFFFFFFFFFFFFFF))
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + np.arange(POSITIONS, dtype=np.uint64) * step[:, None]) & np.uint64(rows - 1)).astype(np.int64)


# --- index ---------------------------------------------------------------------------------------------------------

INDEX = ("doc_ids array<long>, lengths array<int>, highest array<int>, texts array<string>, rows int, slices binary, "
         "n_docs long, n_terms long")


def _block(docs: list[tuple[int | None, str]]) -> pa.RecordBatch:
    """The groups of one block of documents that hold at least one term."""
    groups: dict[int, list] = {}
    for doc, text in docs:
        words = terms(text)
        if not words:
            continue
        counts = Counter(words)
        hashes, tf = key_hashes(list(counts)), np.fromiter(counts.values(), np.int64)
        level = np.minimum(np.log2(tf).astype(np.int64), LEVELS - 1)
        n_keys = int((level + 1).sum())
        groups.setdefault(math.ceil(math.log2(n_keys * BITS_PER_KEY)), []).append(
            (doc, text, len(words), int(tf.max()), hashes, level))
    out = []
    for bits, members in groups.items():
        matrix = np.zeros((1 << bits, len(members)), bool)
        for column, (*_, hashes, level) in enumerate(members):
            for at in range(int(level.max()) + 1):
                matrix[positions(hashes[level >= at], at, 1 << bits).ravel(), column] = True
        ids, texts, lengths, highest = ([m[k] for m in members] for k in range(4))
        out.append((ids, lengths, highest, texts, 1 << bits, np.packbits(matrix).tobytes(), len(ids), sum(lengths)))
    names = [c.split()[0] for c in INDEX.split(", ")]
    kinds = [pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string()), pa.int32(),
             pa.binary(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array([g[k] for g in out], kind) for k, kind in enumerate(kinds)], names=names)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        for doc, text in zip(batch["doc_id"], batch["text"]):
            held.append((doc.as_py(), text.as_py() or ""))
            size += len(held[-1][1])
            if len(held) == BLOCK_DOCS or size >= BLOCK_BYTES:
                yield _block(held)
                held, size = [], 0
    if held:
        yield _block(held)


def build_index(docs: DataFrame) -> DataFrame:
    """One row per group of documents: ids, lengths, highest counts, texts and bit slices."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_index, INDEX)


# --- scores --------------------------------------------------------------------------------------------------------

def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def share(tf, m):
    """What a count contributes before weighting (numbers or integer arrays): rises with tf, falls with m."""
    return (1000000000 * tf) // (1000 * tf + 20 * m)


def length_norm(n, n_docs: int, n_terms: int):
    return 100 - 50 + (50 * n * n_docs) // n_terms


class Items:
    """One block of items: its distinct terms with weights, and each item's term numbers."""

    def __init__(self, rows: list[tuple[int, list[bytes]]], df: dict[bytes, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        # Terms that no document holds add nothing.
        self.words = sorted({t for _, own in rows for t in own if t in df})
        self.at = {t: k for k, t in enumerate(self.words)}
        self.weights = np.array([weight(n_docs, df[t]) for t in self.words], np.int64)
        self.numbers = [n for n, _ in rows]
        self.own = [np.array([self.at[t] for t in own if t in df], np.int64) for _, own in rows]
        self.hashes = key_hashes(self.words) if self.words else np.zeros(0, np.uint64)

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        return length_norm(lengths, self.n_docs, self.n_terms)

    def bounds(self, group: dict) -> np.ndarray:
        """Upper bounds (items x documents) of the scores of a group's documents."""
        columns, rows = len(group["lengths"]), group["rows"]
        slices = np.unpackbits(np.frombuffer(group["slices"], np.uint8), count=rows * columns).reshape(rows, columns).astype(bool)
        highest = np.array(group["highest"], np.int64)
        norm = self.norms(np.array(group["lengths"], np.int64))
        may, before = np.ones((len(self.words), columns), bool), np.zeros(columns, np.int64)
        most = np.zeros((len(self.words), columns), np.int64)
        for level in range(LEVELS):
            if highest.max() < 1 << level:
                break
            for place in positions(self.hashes, level, rows).T:
                may &= slices[place]
            cap = highest if level == LEVELS - 1 else np.minimum(highest, (2 << level) - 1)
            now = share(cap, norm)
            # Documents whose highest count is below this level add nothing more: now equals before.
            most += np.where(may, now - before, 0)
            before = now
        most *= self.weights[:, None]
        return np.array([most[own].sum(axis=0) for own in self.own]).reshape(len(self.own), columns)

    def score(self, counts: Counter, length: int, item: int) -> int:
        norm, total = int(self.norms(np.int64(length))), 0
        for t in self.own[item]:
            tf = counts.get(self.words[t])
            if tf:
                total += int(self.weights[t]) * share(tf, norm)
        return total


def _groups(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as Python values, one in memory at a time."""
    for row in range(batch.num_rows):
        yield batch.slice(row, 1).to_pylist()[0]


# --- search --------------------------------------------------------------------------------------------------------

SEEDS = "item int, bound long, block long, place int"


def _seeds(items: Items, k: int):
    """The ``k`` documents of highest bound of each item and task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros((0, 3), np.int64) for _ in items.own]
        for batch in batches:
            for group in _groups(batch):
                for item, bound in enumerate(items.bounds(group)):
                    found = np.flatnonzero(bound > 0)
                    rows = np.column_stack([bound[found], np.full(len(found), group["block"]), found]).astype(np.int64)
                    rows = np.concatenate([best[item], rows])
                    if len(rows) > k:
                        rows = rows[np.argpartition(-rows[:, 0], k - 1)[:k]]
                    best[item] = rows
        numbers = np.repeat(np.arange(len(best)), [len(b) for b in best])
        rows = np.concatenate(best) if best else np.zeros((0, 3), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int32()), pa.array(rows[:, 0]), pa.array(rows[:, 1]),
             pa.array(rows[:, 2].astype(np.int32))], names=["item", "bound", "block", "place"])

    return run


def _score_seeds(items: Items, seeds: dict[int, list[tuple[int, int]]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for block, texts in zip(batch["block"].to_pylist(), batch["texts"]):
                for item, place in seeds.get(block, ()):
                    words = terms(texts[place].as_py())
                    rows.append((item, items.score(Counter(words), len(words), item)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                                  pa.array([r[1] for r in rows], pa.int64())], names=["item", "score"])

    return run


def _survivors(items: Items, floors: np.ndarray, k: int):
    """Exact scores of all documents whose bound reaches the item's floor; the best ``k`` of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in items.own]
        for batch in batches:
            texts = batch["texts"]
            for row, group in enumerate(_groups(batch.drop_columns(["texts"]))):
                bound = items.bounds(group)
                reach = (bound >= floors[:, None]) & (bound > 0)
                for place in np.flatnonzero(reach.any(axis=0)):
                    words = terms(texts[row].values[place].as_py())
                    counts, doc = Counter(words), group["doc_ids"][place]
                    for item in np.flatnonzero(reach[:, place]):
                        score = items.score(counts, len(words), item)
                        if score > 0 and score >= floors[item]:
                            # NULL ids last among equal scores
                            best[item].append((-score, doc is None, doc))
                            if len(best[item]) >= 8 * k:
                                best[item] = nsmallest(k, best[item], key=lambda r: (r[0], r[1], r[2] or 0))
        rows = [(item, doc, -score) for item, own in enumerate(best)
                for score, _, doc in nsmallest(k, own, key=lambda r: (r[0], r[1], r[2] or 0))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["item", "doc_id", "score"])

    return run


def _document_counts(words: set[bytes]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        for batch in batches:
            for texts in batch["texts"]:
                for text in texts:
                    found.update(words.intersection(terms(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())],
                                         names=["term", "n"])

    return run


def _best(rows: DataFrame, key: str, order: list, k: int) -> DataFrame:
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    return ranked.where(F.col("rank") <= k)


def item_blocks(items: DataFrame, work: WorkTables) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """(item_id, distinct terms) of every item, in blocks of about ``BLOCK_TERMS`` terms on the driver."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [sorted(set(terms(t.as_py()))) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(own, pa.list_(pa.binary()))], names=["item_id", "terms"])

    plain = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    pairs = plain.mapInArrow(split, "item_id long, terms array<binary>").select("item_id", F.explode("terms").alias("term"))
    pairs = numbered(pairs.distinct(), [F.col("item_id"), F.col("term")], "n", work, "items", result=False)
    most = pairs.agg(F.max("n")).first()[0] or 0
    held: dict = {}
    for first in range(0, most, BLOCK_TERMS):
        part = pairs.where((F.col("n") > first) & (F.col("n") <= first + BLOCK_TERMS)).orderBy("n").collect()
        for r in part:
            if r["item_id"] not in held and held and sum(map(len, held.values())) >= BLOCK_TERMS:
                yield list(held.items())
                held = {}
            held.setdefault(r["item_id"], []).append(bytes(r["term"]))
    work.drop("items")
    if held:
        yield list(held.items())


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    work = WorkTables(spark, "search")
    index = work.keep(build_index(docs).withColumn("block", F.monotonically_increasing_id()), "index", result=True)
    total = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = total[0] or 0, total[1] or 0
    results = []
    for rows in item_blocks(items, work):
        words = {t for _, own in rows for t in own}
        found = index.select("texts").mapInArrow(_document_counts(words), "term binary, n long")
        df = {bytes(r["term"]): r["n"] for r in found.groupBy("term").agg(F.sum("n").alias("n")).collect()}
        block = Items(rows, df, n_docs, n_terms)
        slices = index.select("block", "lengths", "highest", "rows", "slices")
        seeds = _best(slices.mapInArrow(_seeds(block, k), SEEDS), "item", [F.col("bound").desc(), "block", "place"], k)
        by_block: dict[int, list] = {}
        for r in seeds.collect():  # at most k an item of the block
            by_block.setdefault(r["block"], []).append((r["item"], r["place"]))
        scores = (index.where(F.col("block").isin(list(by_block))).select("block", "texts")
                  .mapInArrow(_score_seeds(block, by_block), "item int, score long"))
        floors = np.zeros(len(rows), np.int64)
        for r in _best(scores, "item", [F.col("score").desc()], k).where(F.col("rank") == k).collect():
            floors[r["item"]] = r["score"]
        exact = (index.drop("block", "n_docs", "n_terms")
                 .mapInArrow(_survivors(block, floors, k), "item int, doc_id long, score long"))
        best = _best(exact, "item", [F.col("score").desc(), F.col("doc_id").asc_nulls_last()], k)
        ids = spark.createDataFrame([(n, i) for n, (i, _) in enumerate(rows)], "item int, item_id long")
        results.append(best.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionAll(more)
    return out


ORACLE = r"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                    '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term FROM benchmark),
total AS (SELECT count(DISTINCT doc_id) AS n_docs, count(*) AS n_terms FROM t),
norms AS (SELECT doc_id, 100 - 50 + (50 * count(*) * any_value(n_docs)) // any_value(n_terms) AS m
          FROM t CROSS JOIN total GROUP BY doc_id),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t SEMI JOIN q USING (term) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w
      FROM tf CROSS JOIN total GROUP BY term),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
           FROM q JOIN w USING (term) JOIN tf USING (term) JOIN norms USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50
"""
