"""Corpus pipeline over the documents table: filter, two deduplications, secret removal, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read
again as the next stage's documents. All stages but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import dedup, packing, quality, secret_scan, simhash
from rivulet.llm.common import written
from rivulet.llm.queries import CAPACITY, GOOD_FROM, byte_bpe, labelled
from rivulet.sources.tables import table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores as good; it learns outside the test fold."""
    model = quality.fit(labelled(spark, sf_dir, docs, "quality"))
    return quality.keep_good(docs, model, GOOD_FROM)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate group the document with the smallest id."""
    return simhash.keep_first(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a training sequence."""
    return packing.pack(docs, byte_bpe(), CAPACITY)


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: The first stage is a trained classifier, which SQL cannot express; tests compare with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
