"""The operators over the given tables: one registered query each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyloom.llm import bpe, conversations, language, minhash, mixing, packing, phrases, pq, quality, records, secrets, sharding, urls
from tallyloom.session import shared_dir

TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq.near_duplicates(read(spark, sf_dir, "embeddings")).drop("label")


def op2_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Predictions see the id and the text alone; lang only teaches.
    return language.identify(read(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select(
        "row.doc_id", "held_out", "lang_pred", "score", "rejected")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), RULES)


def op9_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return found.select("row.doc_id", of("assign"), of("access"), of("hex"), F.sha2(secrets.listed(base), 256).alias("base_sha256"),
                        secrets.listed(F.col("spans")).alias("spans"))


def op11_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_dir(spark, "records")
    records.write_records(read(spark, sf_dir, "documents"), path, public_tokenizers.path(WORD_TOKENIZER))
    return records.read_records(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads, laid = conversations.repair(read(spark, sf_dir, "conversations"))
    return conversations.hashed(laid, heads)


def op13_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit()}
