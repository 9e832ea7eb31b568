"""The corpus pipeline: from raw documents to packed training sequences.

Quality classifier (rejected documents go), line de-duplication (repeated lines
go), n-gram Jaccard join (one document of each group stays), secret scan
(secrets are masked), packing.  Each stage is written as Parquet and read again
as the next one's input; all but the last return the columns of ``documents``.

Rows are treated one by one whatever their ids: rows without an id pass like
others and are near copies like others (a row with an id stays before one
without); of repeated rows one stays; rows of one id and different texts stay
apart.  A NULL text is an empty one, which no join links and packing gives the
end id; very long texts are read whole; a score equal to the threshold passes;
empty tables give empty results.  Further columns go through unchanged whatever
their names, except that ``n_chars`` follows a changed text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import factorisation_machine, jaccard_join, line_dedup, packing, secret_scan
from quarry.llm.shared import materialise, table, unwrapped, wrapped

TOKENIZER = "byte_bpe_50k.json"


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the threshold."""
    labels = table(spark, sf_dir, "labels")
    model = factorisation_machine.train(docs, labels, ~factorisation_machine.held_out())
    scored = factorisation_machine.score(wrapped(docs, "doc_id", "text", "n_chars"), model)
    return unwrapped(scored.where(F.col("score") >= factorisation_machine.THRESHOLD), docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines stay in their first document only; ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(wrapped(docs, "doc_id", "text"))
    return unwrapped(kept, docs.columns, text=F.col("text"), n_chars=F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates, that with the smallest id."""
    return jaccard_join.one_of_each(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become the name of their kind; ``n_chars`` follows the text."""
    masked = secret_scan.redact(wrapped(docs, "doc_id", "text"))
    return unwrapped(masked, docs.columns, text=F.col("text"), n_chars=F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of at most 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


STAGES = [("quality classifier", classify), ("line dedup", drop_lines), ("n-gram Jaccard join", drop_near_copies),
          ("secret scans", mask_secrets), ("packing", pack)]

#: SQL can express neither the learned classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
