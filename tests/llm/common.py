"""Small tables with the awkward cases, and a reader of results."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("ids", T.StringType()), T.StructField("row", T.StringType())]
)  # the last two clash with names that the operators use


def frame(spark, texts, first=0):
    """Documents with ids from ``first``; a pair (id, text) names its own id."""
    rows = []
    for i, t in enumerate(texts, first):
        doc_id, text = t if isinstance(t, tuple) else (i, t)
        rows.append((doc_id, text, "en" if i % 3 else None, None, None, "x", None))
    return spark.createDataFrame(rows, DOCS).repartition(3, "text")


def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


AWKWARD = [None, "", " ", "\n\t \x0b", "a", "a", "It's 1,234  words\n\nand a long tail " * 400, "It's 1,234  words\n\nand a long tail " * 400, "é" * 3000, "ß ü 中文 😀 ' 's 're", "\x00\x85　 x", "aaaa" * 700]
