"""The corpus pipeline: quality rules, line dedup, n-gram Jaccard join, packing.

Every stage takes what its predecessor kept, as Parquet that was written and read again, and all but the
last return the columns of documents. The Jaccard join keeps, of each group of near copies, the document
with the smallest id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atlasloom.llm import jaccard, line_dedup, packing, quality
from atlasloom.llm.common import materialize, table, workspace
from atlasloom.llm.registry import BYTE_BPE


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BYTE_BPE, "byte")


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("jaccard_join", jaccard_stage),
    ("packing", packing_stage),
]

#: A tokenizer is not expressible in SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), workspace(spark)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
