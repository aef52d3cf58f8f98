"""From raw documents to training shards: reject, merge copies, decontaminate, mix, shard.

Every stage takes all documents its predecessor kept and returns the columns of
documents; the last one adds `shard` and `slot`. Rows are judged by their own
text, so null ids and repeated ids pass through with a defined result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import bradley_terry, hilbert, mixing, positional_index, setsketch
from tradewind.llm.common import id_remainder
from tradewind.llm.queries import SHARDS, table
from tradewind.session import stage_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier accepts."""
    ranking = bradley_terry.learn_quality(docs, table(spark, sf_dir, "labels"), id_remainder(4) != 2)
    return bradley_terry.accept_documents(docs, ranking)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return setsketch.keep_one(docs, width=5, percent=80)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which less than a twentieth is benchmark text."""
    return positional_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents repeated to the sources' target weights, shuffled."""
    return mixing.poisson_mix(docs).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot along the Hilbert curve."""
    return hilbert.hilbert_shards(docs, hilbert.document_dims(), SHARDS, ties=[F.col("doc_id"), F.xxhash64("text")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("shard", shard),
]

# the learned classifier and the sketches have no SQL form; tests compare with brute force
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
