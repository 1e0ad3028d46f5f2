"""Composite keys and content hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.text import col

SEPARATOR = "|"


def or_label(c: Column | str, label: str) -> Column:
    return F.coalesce(col(c).cast("string"), F.lit(label))


def joined(*parts: Column | str) -> Column:
    """Key parts with a bar between; one null part makes the key null."""
    out: list[Column] = []
    for part in parts:
        if out:
            out.append(F.lit(SEPARATOR))
        out.append(col(part).cast("string"))
    return F.concat(*out)


def keyed(**parts: str) -> Column:
    """Key of named columns, each with the label that stands in for null (EXP-20)."""
    return joined(*[or_label(name, label) for name, label in parts.items()])


def content_hash(df: DataFrame, columns: list[str]) -> Column:
    """SHA-256 over the columns that exist; native, so no Python per row (EXP-21).

    A part is written as its length, a colon and its text, a missing part as ``-``: no two
    different rows are written alike, which matters because the hash is part of record keys.
    """
    texts = [F.col(c).cast("string") for c in columns if c in df.columns]
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*parts) if parts else F.lit(""), 256)


def lighter(df: DataFrame, key: str, digest: str) -> DataFrame:
    """Rows to be moved: the content hash ``digest`` as its 32 bytes, of which text is 64 characters that don't compress, and without the key
    that ends in it. A frame without the hash stays as it is."""
    return df.withColumn(digest, F.unhex(digest)).drop(key) if digest in df.columns else df


def keyed_again(df: DataFrame, key: str, digest: str, *ahead: Column | str, text: bool = False) -> DataFrame:
    """The key of ``lighter`` rows, made of the parts ``ahead`` of its hash: as text, or as bytes, which are equal where the text is."""
    if digest not in df.columns:
        return df
    if text:
        return df.withColumn(digest, F.lower(F.hex(digest))).withColumn(key, joined(*ahead, digest))
    return df.withColumn(key, F.concat(joined(*ahead, F.lit("")).cast("binary"), F.col(digest))).drop(digest)
