"""From raw documents to packed training sequences: each stage calls one operator and passes documents on."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tallyloom.llm import language, minhash, mixing, packing, secrets
from tallyloom.session import materialize

TOKENIZER = "byte_bpe_50k.json"


def _rows(docs: DataFrame) -> DataFrame:
    """The documents as structs, so helper columns cannot clash with theirs; text_hash tells texts apart."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row).select("row", F.col("row.doc_id"), F.xxhash64(F.coalesce(F.col("row.text"), F.lit(""))).alias("text_hash"))


def _with_text(docs: DataFrame, text: Column) -> list[Column]:
    """The columns of ``docs`` from ``row``, with another text and its length."""
    fresh = {"text": text, "n_chars": F.when(text.eqNullSafe(F.col("row.text")), F.col("row.n_chars") if "n_chars" in docs.columns else F.lit(None)).otherwise(F.length(text).cast("long"))}
    return [fresh.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter or far from every language learnt go; the others stay as they are."""
    return language.identify(docs).where(~F.col("rejected")).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the document with the smallest id stays; of
    equal rows one. Documents without words stay."""
    found = minhash.near_duplicates(docs, width=5, percent=80).where("kept").groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    found = materialize(found, "kept")
    kept = _rows(docs).join(found.select(F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")),
                            F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("hash")), "left_semi")
    if not found.where("n > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", "text_hash"])
    return kept.select("row.*")


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span found is replaced by a mark; all documents stay."""
    found = secrets.find_secrets(docs)
    return found.select(*_with_text(docs, secrets.redacted(F.col("row.text"), F.col("spans"))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each whole epoch a document gives to the mix, and one for the words of a part. Documents the budget
    leaves out, and those without words, go. Equal rows are one document with as many copies."""
    plan = (mixing.mix(docs.select("doc_id", "text", "source")).groupBy("doc_id", "source", "text_hash")
            .agg(F.sum("taken").alias("taken"), F.max("size").alias("size"), F.count(F.lit(1)).alias("n")))
    plan = materialize(plan, "plan")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("doc_id").alias("id"), F.col("source").alias("s"), F.xxhash64("text").alias("hash"))
    if not plan.where("n > 1").isEmpty():
        rows = rows.dropDuplicates(["id", "s", "hash"])
    chosen = rows.join(plan.where("taken > 0"), F.col("id").eqNullSafe(F.col("doc_id")) & F.col("s").eqNullSafe(F.col("source")) & (F.col("hash") == F.col("text_hash")))
    copies = chosen.select("row", F.explode(mixing.repeated(F.col("row.text"), F.col("size"), F.col("taken"))).alias("given"))
    return copies.select(*_with_text(docs, F.col("given")))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in windows of 1024 tokens, with their token ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER), with_ids=True)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", hide_secrets),
    ("mix", mix_sources),
    ("pack", pack_windows),
]

# SQL can express neither the language model nor the packing; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
