"""A corpus pipeline of five stages, each by an operator of ``almanack.llm``.

quality rules, near-duplicates, benchmark decontamination, personal data, packing. A stage gets
the documents that its predecessor kept; what it decides is done to them. All but the last
return the columns of ``documents``. Empty tables go through; nulls, ties and repeated rows
are treated as the operators state.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from almanack.llm.decontaminate import decontaminate
from almanack.llm.packing import pack_documents
from almanack.llm.parity import keep_one_each
from almanack.llm.pii import redact
from almanack.llm.repetition import keep_unrepetitive
from almanack.llm.storage import shared_folder, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules reject go."""
    return keep_unrepetitive(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id stays."""
    return keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of context windows with their ids, a row each."""
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, tokenizer, end_id=1, with_ids=True, forget=True, lot_ids=1 << 19)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("personal data", personal_data),
    ("packing", packing),
]

#: SQL has no tokenizers; ``tests/llm`` compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and reread."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
