"""A training-data pipeline over ``documents``: quality classifier, line dedup, SimHash
near-dedup, substring dedup, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet into
the shared folder and read again as the next stage's docs. All but the last return the
columns of documents; the last returns the pieces of the packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bramble.llm import line_dedup, packing, quality_classifier, simhash, substring_dedup
from bramble.llm.shared import table, write_shared


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled rows of docs."""
    return quality_classifier.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the lines that they share with an earlier document."""
    return line_dedup.keep_new_lines(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (4-word shingles, 4 bits)."""
    return simhash.drop_near_duplicates(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the words of 50-word windows that an earlier document has."""
    return substring_dedup.remove_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of documents in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", classify_quality),
    ("line_dedup", drop_shared_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_passages),
    ("packing", pack),
]

# Fingerprints, patience diffs, learned scores and token ids are beyond SQL; the stages are
# tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_shared(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
