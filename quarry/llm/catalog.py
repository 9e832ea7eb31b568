"""The registered queries ``opN_<name>``, over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, factorisation_machine, importance, jaccard_join, line_dedup, longest_match_bpe, packing,
                        quality_rules, secret_scan, signature_search, url_filters, vector_search, warc)
from quarry.llm.shared import table

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filters.url_filter(url_filters.page_captures(pages), url_filters.page_changes(pages))


def op2_top_k_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation_machine.quality_classifier(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.tokenise(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), public_tokenizers.PATTERN)


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_longest_match_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return longest_match_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                        public_tokenizers.PATTERN)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filters": op1_url_filters,
    "op2_top_k_search": op2_top_k_search,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_warc": op4_warc,
    "op5_line_dedup": op5_line_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_bpe": op7_bpe,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality_rules": op10_quality_rules,
    "op11_longest_match_bpe": op11_longest_match_bpe,
    "op12_ranked_search": op12_ranked_search,
    "op13_importance_resampling": op13_importance_resampling,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_filters": url_filters.ORACLE,
    "op2_top_k_search": vector_search.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op9_jaccard_join": jaccard_join.ORACLE,
    "op12_ranked_search": signature_search.ORACLE,
    "op13_importance_resampling": importance.ORACLE,
}
