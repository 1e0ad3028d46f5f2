"""From documents to packed sequences: five stages, each an operator of ``plumbline.llm``.

Each stage takes (spark, docs, sf_dir), works on all that the stage before kept, and returns documents with the
columns they had; the last returns the pieces of the packed sequences. Between stages the rows are written as
Parquet and read again. Rows are told apart by their place in the stored table, so missing or repeated ids are
documents like others. Columns of any name travel along: what a stage adds for itself gets names that none has.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import exact_dedup, language, packing, simhash, suffix_dedup
from plumbline.llm.cluster import fresh, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told stay: those with a letter. Languages are learned from two of three folds.

    Where no row names its language nothing can be learned; then a letter is all that is asked for.
    """
    samples = language.learn(docs.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1))
    if not samples:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told_c, score_c = fresh(docs.columns, "language", "score")
    told = language.identify(docs, samples, into=(told_c, score_c))
    return told.where(F.col(told_c) != "und").select(*docs.columns)


def _numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with the place of each, and the name of that column."""
    (row,) = fresh(docs.columns, "row")
    return docs.withColumn(row, F.monotonically_increasing_id()), row


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the longest stays, then the smallest id."""
    numbered, row = _numbered(docs)
    kept = exact_dedup.exact_groups(numbered, row=row).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near fingerprints the smallest id stays."""
    numbered, row = _numbered(docs)
    kept = simhash.near_groups(numbered, row=row).where("row = keep_row").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes or more that a document with a smaller id has are cut out; n_chars follows the text.

    A document of which nothing is left goes. One that had no text stays as it is.
    """
    numbered, row = _numbered(docs)
    left = suffix_dedup.remove_repeats(numbered, row=row)
    kept_c, removed_c = fresh(numbered.columns, "kept", "removed")
    left = left.where("n_removed < n_bytes or n_bytes = 0").select(F.col("row").alias(row), F.col("kept_text").alias(kept_c), F.col("n_removed").alias(removed_c))
    joined = numbered.drop("text").join(left, row)
    text = F.when((F.col(removed_c) == 0) & (F.length(kept_c) == 0), F.lit(None)).otherwise(F.col(kept_c))
    values = {"text": text, "n_chars": F.when(F.col(removed_c) > 0, F.length(kept_c)).otherwise(F.col("n_chars")) if "n_chars" in docs.columns else None}
    return joined.select(*(values[c].cast(docs.schema[c].dataType).alias(c) if c in values else c for c in docs.columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack_sequences),
]

#: No stage but the second can be written in SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
