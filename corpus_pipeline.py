"""Corpus pipeline: stages that take and give documents, each one operator of broadsheet.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from broadsheet.llm import exact_dedup, mixing, ngram_join, sentencepiece_bpe, toxicity
from broadsheet.llm.common import documents, table
from broadsheet.session import materialise


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that compression distance does not take for toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.keep_distinct(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar texts, the document with the smallest id (shingles of five words, Jaccard 0.8)."""
    return ngram_join.keep_representatives(docs, ngram_join.Spec(width=5, num=80, den=100))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources drawn to their target weights; a document may come twice."""
    return mixing.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, as digests, with those of the decoded text."""
    return sentencepiece_bpe.token_digests(docs)


STAGES = [
    ("toxicity", clean), ("exact dedup", exact), ("n-gram Jaccard join", near), ("source mixing", mixed), ("SentencePiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: Compression lengths and token ids cannot be had in SQL.
ORACLE_SQL = None
