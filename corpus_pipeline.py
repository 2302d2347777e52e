"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Toxic documents go, one document of each near-duplicate group stays, long repeated passages are cut out of
texts, sources are brought to their weights, and what is left is packed into token sequences.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, packing, simhash, suffixes, toxicity
from millrace.llm.common import documents, stored

#: Words from which on a passage that occurs twice is removed: over 50.
PASSAGE = 51
#: Share of the tokens that the mix reads, each document once at most, and the weights it aims at.
PERCENT = 90
WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2}}


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return toxicity.keep_clean(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash links: three-word shingles, at most 2 of 64 bits differ."""
    return simhash.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of over 50 words that occur twice."""
    return suffixes.cut_passages(docs, PASSAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix reads."""
    return mixing.keep_mixed(docs, PERCENT, weights=WEIGHTS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; a row per piece of a document."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxic),
    ("simhash_near_dedup", near_copies),
    ("suffix_dedup", passages),
    ("hierarchical_mixing", mix),
    ("best_fit_packing", pack),
]

#: A trained network, SimHash and byte-pair encoding are beyond SQL; tests compare the stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
