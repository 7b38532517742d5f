"""A corpus from raw documents to token ids in four stages, each an operator of lodestar.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestar.llm import bpe, mixing, quality, queries, simhash
from lodestar.sources.shared import materialise


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from the labelled ones among those it is given.

    Null and empty texts and null n_chars are scored like others, repeated and null keys are rows like others, very long texts
    are scored whole; without labels all score 0.5 and go; an empty table gives no rows; all columns are kept."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.fit(docs, labels))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more, candidates from SimHashes.

    Null and empty texts are copies of each other, null keys go after others, repeated rows are copies, very long texts
    count whole; an empty table gives no rows; all columns are kept."""
    return simhash.keep_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights, documents repeated or left out.

    A null source is one of its own, the last; texts without words take no words; repeated rows share their class's copies; null
    keys are allowed; very long texts are units like others; an empty table gives no rows; all columns are kept."""
    return mixing.mixed(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded texts, for each row of the mix.

    Null texts count as empty (no tokens); null and repeated keys are rows like others; very long texts are encoded whole; an
    empty table gives no rows; other columns go."""
    return bpe.round_trip(docs, queries.vocabulary())


STAGES = [("quality classifier", classify), ("near-duplicates", deduplicate), ("mixing", mix), ("tokens", tokenize)]

#: The classifier and the draws of the mix have no SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
