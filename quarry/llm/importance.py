"""Target-distribution importance resampling over hashed n-grams.

Texts are read as UTF-8 bytes: one 256-byte table lower-cases A-Z and blanks
every separator, ``bytes.split`` gives the words, and the CRC-32 of a longer
n-gram goes on from that of the shorter one (the last checksum is the seed of
the next).  Each task counts its buckets in one ``Counter`` of at most
``BUCKETS`` keys; Spark adds the counters of all tasks.  The gains of the
buckets - a table of fixed size - then weigh every document, and Gumbel noise
from a digest of the id makes a top-k of the scores a draw in proportion to the
weights.  The draw ranks documents over ranges of the score.

Edge cases: NULL or empty text has no words and weight 0; very long texts are
counted ``SLICE`` words at a time; repeated rows count and compete one by one
(equal scores and ids: either order); an empty corpus or an empty target gives
gains from the counts of 0; rows without an id are counted in the corpus, have
no score and are never drawn nor counted among the eligible; only ``doc_id``
and ``text`` are read, so further columns of any name do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from fractions import Fraction
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.ranking import numbered
from quarry.sources.worktables import WorkTables

BUCKETS, ORDER = 10000, 3
LEAST_WORDS, SHARE, SEED = 20, Fraction(5, 100), 42
#: Words of one text in memory as numbers at a time.
SLICE = 1 << 18

#: Byte table: digits, lower-case letters and bytes of other scripts stay, A-Z is lower-cased, the rest is blank.
TABLE = bytes(b if chr(b).isdigit() or 97 <= b < 123 or b >= 128 else b + 32 if 65 <= b < 91 else 32
              for b in range(256))


def split(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


def checksums(words: list[bytes]) -> Iterator[np.ndarray]:
    """CRC-32 of every run of 1 to ``ORDER`` words, joined by one space, in slices."""
    for first in range(0, len(words), SLICE):
        part = words[first:first + SLICE]
        more = [b" " + w for w in words[first + 1:first + SLICE + ORDER - 1]]
        sums = list(map(crc32, part))
        yield np.array(sums, np.int64)
        for k in range(ORDER - 1):
            sums = list(map(crc32, more[k:], sums))
            yield np.array(sums, np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter[int] = Counter()
    for batch in batches:
        for text in batch["text"]:
            for sums in checksums(split(text.as_py())):
                found.update((sums % BUCKETS).tolist())
    yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())],
                                     names=["bucket", "n"])


def bucket_counts(texts: DataFrame) -> DataFrame:
    """(bucket, n) of all n-grams of the column ``text``; at most ``BUCKETS`` rows."""
    plain = texts.select(F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> DataFrame:
    """(bucket, gain) of every bucket: how much likelier the target's n-grams fall there."""
    spark = corpus.sparkSession
    both = (spark.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
            .join(bucket_counts(corpus).withColumnRenamed("n", "s"), "bucket", "left")
            .join(bucket_counts(target).withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    total = both.agg(F.sum("s").cast("double").alias("all_s"), F.sum("t").cast("double").alias("all_t"))
    s, t = F.col("s").cast("double"), F.col("t").cast("double")
    ratio = (t + 1) * (F.col("all_s") + BUCKETS) / ((s + 1) * (F.col("all_t") + BUCKETS))
    return both.crossJoin(F.broadcast(total)).select("bucket", F.floor(1000 * F.log(ratio)).alias("gain"))


def _weigh(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = [], [], []
            for text in batch["text"]:
                words = split(text.as_py())
                n, total = 0, 0
                for sums in checksums(words):
                    n += len(sums)
                    total += int(gain[sums % BUCKETS].sum())
                n_words.append(len(words))
                n_features.append(n)
                weight.append(total)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    return run


def weigh(docs: DataFrame, gain: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_features, weight) per row; ``gain`` has ``BUCKETS`` rows."""
    table = np.zeros(BUCKETS, np.int64)
    for bucket, value in gain.collect():
        table[bucket] = value
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(_weigh(table), "doc_id long, n_words long, n_features long, weight long")


def scored(weighed: DataFrame, seed: int = SEED) -> DataFrame:
    """``weighed`` with ``score``: the weight plus Gumbel noise from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighed.withColumn("score", F.col("weight") + noise)


def resample(docs: DataFrame, target: DataFrame, share: Fraction = SHARE, least_words: int = LEAST_WORDS,
             seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per row; ``rank`` is NULL where not drawn."""
    work = WorkTables(docs.sparkSession, "resample")
    table = work.keep(scored(weigh(docs, gains(docs, target)), seed), "scored", result=True)
    # The row number tells repeated rows apart, so that ranges can cut them.
    table = table.withColumn("_row", F.monotonically_increasing_id())
    eligible = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    ranked = numbered(table.where(eligible), [F.col("score").desc(), F.col("doc_id"), F.col("_row")], "rank", work)
    drawn = share.numerator * table.where(eligible).count() // share.denominator
    rank = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    others = table.where(~F.coalesce(eligible, F.lit(False))).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, rank).unionAll(others)


#: The contract's result, checksums included, as DuckDB SQL (table views ``documents`` and ``benchmark``).
ORACLE = r"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS crc FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
hex AS (SELECT map_from_entries(list((printf('%02X', i), i))) AS byte FROM range(256) AS r(i)),
texts AS (SELECT 'd' AS part, doc_id AS id, coalesce(text, '') AS text FROM documents
          UNION ALL SELECT 'b', item_id, coalesce(text, '') FROM benchmark),
words AS (SELECT part, id, regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM texts),
grams AS (SELECT part, id, unnest(list_concat(list_concat(w,
            list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])),
            list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS g FROM words),
sums AS (
  SELECT g, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(g)), '..'), lambda x: byte[x])),
                lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM grams) CROSS JOIN crc_table CROSS JOIN hex),
hits AS (SELECT part, id, bucket FROM grams JOIN sums USING (g)),
counts AS (SELECT b AS bucket, count(*) FILTER (WHERE part = 'd') AS s, count(*) FILTER (WHERE part = 'b') AS t
           FROM range(10000) AS r(b) LEFT JOIN hits ON bucket = b GROUP BY ALL),
gains AS (SELECT bucket, CAST(floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ())::DOUBLE + 10000)
                   / ((s + 1)::DOUBLE * ((sum(t) OVER ())::DOUBLE + 10000)))) AS BIGINT) AS gain FROM counts),
weights AS (SELECT id, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
            FROM hits JOIN gains USING (bucket) WHERE part = 'd' GROUP BY id),
scores AS (
  SELECT d.id AS doc_id, len(d.w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || left(sha256('42:' || d.id), 8))::BIGINT + 0.5::DOUBLE)
                                                         / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM words AS d LEFT JOIN weights USING (id) WHERE part = 'd'),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
          FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranks USING (doc_id)
"""
