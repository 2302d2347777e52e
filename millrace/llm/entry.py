"""The registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import chat, hnsw, langid, ledger, mih, mixing, packing, planes, ranking, simhash, suffixes, toxicity, trie
from millrace.llm.common import documents


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens; a row per piece."""
    return packing.pack_documents(documents(spark, sf_dir))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of all documents without strings of 400 bytes that occur twice."""
    return suffixes.repeat_digest(documents(spark, sf_dir))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    return toxicity.toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_token_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written to plane files and digested from them."""
    return planes.token_digest(documents(spark, sf_dir))


def op5_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return mih.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op6_hierarchical_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix of as many tokens as there are reads of all documents, at most two epochs of each source."""
    return mixing.mixture(documents(spark, sf_dir))


def op7_tool_call_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All tool calls and results of the conversations."""
    return chat.tool_messages(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under SimHash links."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    return langid.identify(documents(spark, sf_dir))


def op10_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector."""
    return hnsw.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the prefix tree of all conversations."""
    return trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets in every document."""
    return ledger.secret_digest(documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return ranking.ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_best_fit_packing, op2_suffix_dedup, op3_toxicity, op4_token_planes, op5_multi_index_hashing, op6_hierarchical_mixing, op7_tool_call_linking, op8_simhash_near_dedup, op9_language_id, op10_hnsw_near_dedup, op11_prefix_trie, op12_secret_ledger, op13_ranked_search)
}
SQL: dict[str, str] = {"op6_hierarchical_mixing": mixing.mixture_sql(), "op7_tool_call_linking": chat.LINK_SQL, "op11_prefix_trie": trie.TRIE_SQL, "op12_secret_ledger": ledger.secrets_sql(), "op13_ranked_search": ranking.RANKING_SQL}
