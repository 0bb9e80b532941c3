"""The training-data pipeline: toxic documents go, near-copies go, the rest is mixed and encoded."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelwright.llm import bpe, mixing, simhash, toxicity
from panelwright.llm.common import table, written

#: Shares of tokens that the mix aims at; no document leaves, so the scarcer domain is repeated.
TARGETS = {"good": 0.85, "poor": 0.15}


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labels outside the held-out fold."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) link at two bits or fewer: that of the least id."""
    return simhash.keep_one(docs, words=3, max_distance=2)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated by their fitted rates, each at least once."""
    labels = table(spark, sf_dir, "labels").filter("toxic = 0")
    return mixing.repeated(docs, mixing.quality_domains(labels), TARGETS, least=1.0)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's number of tokens, and digests of its ids and of the text decoded from them."""
    return bpe.round_trip(docs)


STAGES = [("toxicity", without_toxic), ("near_duplicates", without_copies), ("mixing", mixed), ("encoding", encoded)]

#: Learnt scores, near copies and merges have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = written(docs)
    return docs
