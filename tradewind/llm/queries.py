"""The registered queries of this subpackage, over whole tables, and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import (
    bradley_terry, chat_format, hilbert, merkle, mixing, oracles, orc_tokens, positional_index, prefix_trie, quality_rules, setsketch, suffix_dedup,
    token_counts, toxicity,
)
from tradewind.llm.common import id_remainder
from tradewind.session import scratch_path

SHARDS = 24
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    judged = quality_rules.judge_quality(table(spark, sf_dir, "documents"), trusted)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def op3_noisy_channel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(3) == 1
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op4_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.poisson_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", "text")


def op5_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "orc-tokens")
    tokenizer = Path(public_tokenizers.path("word_bpe_49k.json")).read_text(encoding="utf-8")
    orc_tokens.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer, END_ID)
    return orc_tokens.token_layout(spark, path)


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[v.alias(f"dim_{k}") for k, v in hilbert.document_dims().items()],
    )
    dims = {k: F.col(f"dim_{k}") for k in hilbert.document_dims()}
    placed = hilbert.hilbert_shards(rows, dims, SHARDS, ties=[F.col("doc_id"), F.col("text_crc32")])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), id_remainder(4) == 2
    ranking = bradley_terry.learn_quality(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = bradley_terry.score_quality(docs, ranking)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op10_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    proved = merkle.document_manifest(table(spark, sf_dir, "documents"), tampered=id_remainder(7) == 0)
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", "verified")


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(1).select(
        F.lit(-1).cast(rows.schema["conv_id"].dataType).alias("conv_id"),
        F.to_json(F.struct(F.lit(said).alias("prompt"), F.lit(said).alias("completion"))).alias("record"),
    )
    records = chat_format.as_records(rows, ["turn", "role", "text"]).unionByName(extra)
    path = scratch_path(spark, "formatted")
    chat_format.write_formatted(chat_format.canonical_turns(records), path)
    return chat_format.read_back(chat_format.read_formatted(spark, path))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    owner = F.col("conv_id") - F.pmod(F.col("conv_id"), F.lit(100))
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    rebuilt, convs = prefix_trie.replace_heads(prefix_trie.numbered_turns(rows), owner, heads, most=5)
    return prefix_trie.trie_nodes(rebuilt, convs)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_quality_rules, op3_noisy_channel_toxicity, op4_poisson_mix, op5_orc_tokens, op6_setsketch,
        op7_hilbert_shards, op8_bradley_terry, op9_suffix_dedup, op10_positional_index, op11_merkle_manifest, op12_chat_format,
        op13_prefix_trie,
    )
}
ORACLE_SQL: dict[str, str] = {
    "op4_poisson_mix": oracles.MIX, "op6_setsketch": oracles.NEAR, "op7_hilbert_shards": oracles.shards(SHARDS),
    "op9_suffix_dedup": oracles.REPEATS, "op10_positional_index": oracles.CONTAMINATED, "op11_merkle_manifest": oracles.manifest(), "op12_chat_format": oracles.FORMATTED,
    "op13_prefix_trie": oracles.trie(),
}
