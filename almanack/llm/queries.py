"""Each operator of this folder as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .cotraining import classify_quality
from .decontaminate import contaminated
from .fill_in_middle import fill_in_middle, restored_digests
from .licenses import scan_licences
from .oracles import ORACLES
from .packing import pack_documents
from .parity import jaccard_components
from .pii import find_personal_data
from .repetition import repetition_rules
from .secrets import find_secrets
from .spelling import spelling_variants
from .storage import shared_folder
from .token_files import token_digests, write_token_files
from .url_reputation import Rule, judge_urls
from .warc import read_warc, write_warc

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = f"{shared_folder(spark, 'op1')}/ids"
    write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return token_digests(spark, folder)


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=1)


@_query
def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repetition_rules(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("dup_ngram_shares", "dup_line_share")


@_query
def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_personal_data(_table(spark, sf_dir, "documents"))


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(_table(spark, sf_dir, "documents"))


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark, 'op8')}/warc"
    write_warc(_table(spark, sf_dir, "pages"), folder)
    return read_warc(spark, folder).drop("url", "record_id")


@_query
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"))


@_query
def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(_table(spark, sf_dir, "documents"))


@_query
def op3_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


#: The rules of the query's contract.
URL_RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


@_query
def op11_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "labels"), URL_RULES)


@_query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_digests(fill_in_middle(_table(spark, sf_dir, "documents")))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))
