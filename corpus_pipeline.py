"""Corpus pipeline: quality rules, quality classifier, near-duplicates,
personal data, packing -- each stage one operator of ``chainyard.llm``.

A stage takes (spark, docs, sf_dir) and returns a frame; it is written as
Parquet and reread as the next stage's ``docs``.  All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chainyard.llm.common import prepared, stored, table
from chainyard.llm.packing_bm25 import pack_documents
from chainyard.llm.pii_surrogates import replace_pii, secret
from chainyard.llm.quality_knn import classifier_filter
from chainyard.llm.quality_rules_mcd import quality_filter
from chainyard.llm.queries import PII_KEY, tokenizer
from chainyard.llm.simhash_gph import keep_one


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no multivariate outliers."""
    prepared(spark)
    return quality_filter(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be of good quality.  The model learns from the
    labelled rows of the whole ``documents`` table, rejected ones included."""
    prepared(spark)
    whole = table(spark, sf_dir, "documents")
    return classifier_filter(docs, whole, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, that of smallest id."""
    prepared(spark)
    return keep_one(docs, size=4, max_bits=4)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data and secrets."""
    prepared(spark)
    return replace_pii(docs, secret(PII_KEY))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2,048 tokens, with their ids."""
    prepared(spark)
    return pack_documents(docs, tokenizer("word_bpe_49k.json"), end_id=1, window=2048)


STAGES = [
    ("quality rules", quality_rules),
    ("quality classifier", quality_classifier),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("packing", packing),
]

#: SQL cannot express the stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to ``documents``."""
    docs = table(prepared(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
