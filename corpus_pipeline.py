"""A training corpus from ``documents``: five stages, each over all rows of the one before.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which :func:`run` writes
as Parquet into the shared checkpoint folder and rereads as the next stage's ``docs``.
All but the last return the columns of ``documents``.  Nulls, empty and very long texts,
repeated rows, empty tables and extra columns are handled by the operators (see there).

``ORACLE_SQL`` is None: FTRL training, signature joins and gradient steps have no SQL
form.  ``tests/llm/test_pipeline_stages.py`` holds its stages against plain versions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from glossa.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from glossa.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose language is not recognised."""
    return language_id.accept(docs)


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the document with the largest id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by word shingles, keep the one with the least id."""
    return ngram_join.keep_one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that the languages meet their target weights."""
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole texts, with their count."""
    return bpe.encode(docs, ["doc_id", "lang", "source"]).selectExpr(
        "doc_id", "lang", "source", "cast(size(ids) as bigint) as n_tokens", "ids")


STAGES = [("language", language), ("exact dedup", copies), ("n-gram join", near_copies),
          ("mixing", mixture), ("tokens", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs


ORACLE_SQL = None
