"""The registered query of each operator; ``checks`` has the SQL where it can state them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import (bpe, checks, decontam, embed_dedup, hard_negatives, html_extract, merkle,
                         minhash, pii, quality, sharding, suffix_dedup, toxicity, urls)
from barloom.session import ship_package

SHARDS = [f"shard-{k:03d}" for k in range(96)]
RULES = [urls.Rule("block", "net", "/"), urls.Rule("allow", "example.net", "/en/"),
         urls.Rule("block", "example.com", "/de/"), urls.Rule("allow", "org", "/fr/")]
PII_KEY = b"a key for trials; a deployment passes its own"
BPE_FILE = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship_package(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, percent=85)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(F.array_join("items", ","), 256)).drop("items")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    decoded = bpe.decode(bpe.encode(docs, BPE_FILE).select("doc_id", "ids"), BPE_FILE)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(quality.learnable())
    scored = quality.score(docs, quality.learn(docs, labels))
    return scored.select("doc_id", (~quality.learnable()).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    texts = html_extract.extract(pages, html_extract.learn(pages))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(toxicity.learnable())
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", (~toxicity.learnable()).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), RULES)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), 100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.col("text")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    columns = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaves = docs.select("doc_id", "source", merkle.leaf(*columns, text).alias("leaf"), F.when(
        tampered & text.contains("\n"), merkle.leaf(*columns, F.replace(text, F.lit("\n"), F.lit(""))))
        .alias("new_leaf"))
    proofs = merkle.manifest(leaves, "source", "doc_id", "leaf", "new_leaf").leaves
    return proofs.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root",
                         F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
                         "folded_root", "verified")


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_sharding, op3_decontamination, op4_bpe, op5_quality, op6_pii, op7_html,
    op8_embedding_dedup, op9_toxicity, op10_url_filter, op11_hard_negatives, op12_suffix_dedup,
    op13_merkle)}
ORACLES = {
    "op1_minhash": checks.OP1_SQL,
    "op2_sharding": checks.op2_sql(SHARDS),
    "op3_decontamination": checks.OP3_SQL,
    "op8_embedding_dedup": checks.OP8_SQL,
    "op10_url_filter": checks.OP10_SQL,
    "op11_hard_negatives": checks.OP11_SQL,
    "op12_suffix_dedup": checks.OP12_SQL,
    "op13_merkle": checks.OP13_SQL,
}
