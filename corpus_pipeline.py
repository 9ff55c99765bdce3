"""From raw documents to a training mixture: five stages over the whole table.

Each stage takes (spark, docs, sf_dir), works on all that the one before it
kept and returns a DataFrame; ``run`` writes each to Parquet in the shared
folder and reads it again for the next.  All but the last return the columns
of ``documents``; the mixture adds ``copy``.

Nulls, empty and very long texts, ties, repeated rows and further columns are
handled as the operators say.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kontor.llm import decontaminate, mixing, quality, repeats, simhash_dedup
from kontor.llm.common import read, stored


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.without_rejected(docs, read(spark, sf_dir, "labels"), threshold=0.3)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id."""
    return simhash_dedup.keep_one_of_each(docs, words_per_shingle=4, max_bits=4)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur again are cut out; every document stays."""
    return repeats.without_repeats(docs, depth=200)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in benchmark windows go."""
    return decontaminate.without_contaminated(docs, read(spark, sf_dir, "benchmark"), width=13)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at tempered weights, each document as often as drawn, shuffled."""
    return mixing.replicate(docs, temper=0.5, epochs=1.0, seed="mix-1")


STAGES = [
    ("quality", classified),
    ("simhash_dedup", deduplicated),
    ("suffix_dedup", without_passages),
    ("decontamination", decontaminated),
    ("mixing", mixed),
]

ORACLE_SQL = None  # SQL can't express a learned classifier; tests/llm compares with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
