"""From raw documents to packed training sequences, in five stages.

Each stage is ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from copyaudit.llm.byte_cnn import fit, keep_good
from copyaudit.llm.common import table, written
from copyaudit.llm.line_dedup import drop_repeated_lines
from copyaudit.llm.mixing import mix_documents
from copyaudit.llm.packing import pack_documents
from copyaudit.llm.simhash import keep_first


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network, trained on the labels of ``sf_dir``, scores as good."""
    return keep_good(docs, fit(docs, table(spark, sf_dir, "labels")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier line exactly or within the edit bound."""
    return drop_repeated_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links."""
    return keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents chosen to meet the target weights; a document chosen in two epochs is two rows."""
    return mix_documents(docs, details=False)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, each with its place in a sequence."""
    return pack_documents(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

# The classifier and the tokenizer cannot be written in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
