"""A training-text pipeline: five stages, each an operator applied to all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lamina.llm import langid, queries, secrets, simhash, templates
from lamina.llm.common import stash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified, which a NULL ``lang`` becomes; NULL texts and texts without a letter go."""
    return langid.keep_identified(docs, queries.profiles_of(docs), lang="lang").select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: the one with the least id."""
    return simhash.drop_near_copies(docs, shingle=3, distance=2).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.drop_contaminated(docs, benchmark).select(*COLUMNS)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secrets.redact_secrets(docs).select(*COLUMNS)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Counts and digests of every document's token ids and of the text decoded from them."""
    return queries.round_trip(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("redact", redact),
    ("tokenize", tokenize),
]

# Language profiles, fingerprints, templates and merges cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is stored as Parquet and read again by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name)
    return docs
