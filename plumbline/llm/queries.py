"""One registered query for each operator, over its whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import byte_bpe, centroids, exact_dedup, html_layout, language, line_dedup, merkle, neighbours, oracles, packing, quality, shuffle_shards, simhash, suffix_dedup
from plumbline.llm.cluster import fresh

Query = Callable[[SparkSession, str], DataFrame]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and their decoding, as digests."""
    out = byte_bpe.encode_decode(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), offsets=False)
    return out.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the passages of earlier ones."""
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document."""
    out = simhash.near_groups(documents(spark, sf_dir))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every document."""
    return exact_dedup.exact_groups(documents(spark, sf_dir)).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def fold(folds: int):
    """crc32(doc_id as text) mod ``folds``."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def op5_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The visible text of every page as it is laid out."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "html")
    return html_layout.render_pages(pages, keep=["page_id"]).withColumn("n_chars", F.length("text").cast("bigint"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from four of five folds."""
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = quality.learn(docs, labels.where(fold(5) != 0))
    rows = docs.select("doc_id", "text", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"))
    return quality.classify(rows, weights).select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_collision_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector, among all."""
    return neighbours.nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.pmod("vec_id", F.lit(50)) == 0)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two of three folds."""
    docs = documents(spark, sf_dir)
    samples = language.learn(docs.where(fold(3) != 1))
    rows = docs.select("doc_id", "text", F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out"))
    return language.identify(rows, samples).select("doc_id", "held_out", "lang_pred", "score")


def op9_shuffle_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of a shuffled corpus, counts at most one apart."""
    docs = documents(spark, sf_dir)
    shard, slot = fresh(docs.columns, "shard", "slot")
    out = shuffle_shards.shard(docs, 8, into=(shard, slot))
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(shard).alias("shard"),
        F.col(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_pack_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 ids."""
    pieces = packing.pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the lines of earlier ones."""
    out = line_dedup.drop_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op12_hilbert_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cluster of every vector after five rounds from 40 drawn centroids."""
    out = centroids.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    numbers = F.array_join(F.transform("centroid", lambda x: x.cast("string")), ",")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", F.sha2(numbers, 256).alias("centroid_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, witness and root of every document; a third of the texts are tampered with before they are verified."""
    tampered = F.when(fold(3) == 0, F.translate("text", UPPER, UPPER.lower())).otherwise(F.col("text"))
    out = merkle.manifest(documents(spark, sf_dir), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", claimed={"text": tampered})
    shown = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "proof", "folded")}
    return out.select(
        F.col("id").alias("doc_id"), shown["leaf"].alias("leaf"), shown["subroot"].alias("subroot"), shown["root"].alias("root"),
        shown["proof"].alias("proof_sha256"), shown["folded"].alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"),
    )


QUERIES: dict[str, Query] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash": op3_simhash,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_html_layout": op5_html_layout,
    "op6_quality": op6_quality,
    "op7_collision_search": op7_collision_search,
    "op8_language": op8_language,
    "op9_shuffle_shards": op9_shuffle_shards,
    "op10_pack_cut": op10_pack_cut,
    "op11_line_dedup": op11_line_dedup,
    "op12_hilbert_centroids": op12_hilbert_centroids,
    "op13_merkle_manifest": op13_merkle_manifest,
}

#: The SQL each must agree with, where SQL can express it.
ORACLES: dict[str, str] = {
    **oracles.ORACLES,
    "op4_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS points,
                   sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
            FROM documents
        ), g AS (
            SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY text_sha256) AS group_size
            FROM d
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
    """,
}
