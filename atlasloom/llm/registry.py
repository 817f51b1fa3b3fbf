"""Queries of the corpus operators, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, jaccard, licenses, line_dedup, oracles, packing, pieces, quality, token_files, topk, url_filters
from .common import table, workspace

BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures have no fetch time of their own: page_id gives each a day of 2024."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    fetched = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 366).cast("int"))
    found = url_filters.apply_lists(pages.withColumn("fetched", fetched), url_filters.sample_history(pages))
    return found.withColumns({f"{s}_since": F.col(f"{s}_since").cast("string") for s in url_filters.SCOPES})


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE, "byte", with_ids=False)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), PIECES)


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.link_calls(*chat.exchanges(table(spark, sf_dir, "conversations")), chat.REPLY).drop("answers")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{workspace(spark)}/files"
    token_files.write_files(table(spark, sf_dir, "documents"), folder, WORD_BPE, "word")
    return token_files.read_files(spark, folder)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


def op9_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_packing": op2_packing,
    "op3_url_filters": op3_url_filters,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_line_dedup": op5_line_dedup,
    "op6_token_files": op6_token_files,
    "op7_chat_formatting": op7_chat_formatting,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_topk_search": op9_topk_search,
    "op10_quality_rules": op10_quality_rules,
}

ORACLES: dict[str, str] = {
    "op1_license_scan": oracles.LICENCES,
    "op3_url_filters": oracles.URL_FILTERS,
    "op5_line_dedup": oracles.LINE_DEDUP,
    "op7_chat_formatting": oracles.CHAT,
    "op9_topk_search": oracles.TOP_K,
    "op10_quality_rules": oracles.QUALITY,
}
