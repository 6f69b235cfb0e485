"""Cleaning of a corpus in stages; each takes and, but for the last, returns documents.

Quality rules drop bad documents, line dedup drops repeated lines (and documents with nothing left), near
dedup keeps one document of each group, decontamination drops documents that hold a benchmark item, and
the last stage encodes what is left and checks that the ids decode to the same text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from maskloom.llm.bpe import bpe_round_trip
from maskloom.llm.common import table
from maskloom.llm.leaks import without_leaks
from maskloom.llm.lines import without_repeated_lines
from maskloom.llm.near import one_of_each_group
from maskloom.llm.queries import tokenizer_path
from maskloom.llm.rules import good_documents
from maskloom.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return good_documents(docs, table(spark, sf_dir, "labels").where("quality = 1"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_repeated_lines(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe_round_trip(docs, tokenizer=tokenizer_path(),
                          outputs=("n_tokens", "ids", "ids_sha256", "decoded_sha256"))


STAGES = [
    ("quality_rules", quality), ("line_dedup", lines), ("near_dedup", near), ("decontamination", decontaminate),
    ("bpe", encode),
]
#: SQL has neither the perplexity model nor the tokenizer; tests hold the stages against plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
