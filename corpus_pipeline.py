"""The corpus pipeline: documents in, an encoded mix out.

Each stage is one of the numbered operators applied to what its predecessor
kept; all but the last return the columns of ``documents``. A stage's result
is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lanekit.llm import bpe, mixing, quality, simhash, substring
from lanekit.llm.common import stage, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or the estimated rules go."""
    return quality.keep_good(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return simhash.one_per_group(docs, shingle=3, max_bits=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated windows of 20 words go from the texts; all documents stay."""
    return substring.drop_repeats(docs, window=20)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the source weights take them."""
    return mixing.mixed(docs)


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, digested as in the operator's
    query; the round trip through the decoder is part of it."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("bpe", bpe_encode),
]

#: SQL can express neither the estimation of the rules, XXH64 with a seed nor
#: the tokenizer; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        rows = stage(apply(spark, rows, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return rows
