"""From raw documents to packed token sequences, one stored table per stage.

Each stage reads all that the one before it kept, and its decisions take effect:
a document whose language is undetermined or unsure goes; of each group of near
copies the one with the smallest id stays; a document with a benchmark passage
goes; secrets are replaced by a mark; what is left is packed. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickstrata.llm import decontaminate, jaccard, language, packing, secrets
from clickstrata.sources import stage

LEAST_SCORE = 0.5


def _restored(found: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' columns from a struct of the others and the text beside it."""
    return found.select(*[F.col("text") if c == "text" else F.col("carried")[c].alias(c) for c in columns])


def _others(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c != "text"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language, whose posterior is at least ``LEAST_SCORE``."""
    found = language.identify(docs, carry=_others(docs))
    return _restored(found.where((F.col("lang_pred") != language.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.find_passages(docs, benchmark, carry=_others(docs))
    return _restored(found.where(F.size("hits") == 0), docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the packed sequences."""
    return packing.pack(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("packing", pack),
]

# Sums over segmentations and greedy retrieval are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
