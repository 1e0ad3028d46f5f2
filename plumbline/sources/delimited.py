"""Delimited text: tolerant and strict readers, lineage and physical line numbers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.functions.text import clean_text, header_name, null_tokens, snake_name
from plumbline.operators.unions import union_relaxed
from plumbline.runtime import join_small
from plumbline.sources import records
from plumbline.sources.records import FILE, PLACE, SPLIT

CP1252 = "windows-1252"
UTF8 = "UTF-8"

def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    encoding: str = CP1252,
    strict: bool = True,
    breaks: bool = True,
) -> DataFrame:
    """``;`` file with a header, every column text (SRC-01, SRC-03, SRC-04).

    ``strict`` fails on a broken record: ragged, undecodable, or a quote that is never closed. Otherwise short rows are
    padded, long ones cut, and the line of an open quote is a row by itself; ``records.read_records`` tells which they are.
    Files are read in splits; only those where a quote is open behind a line are put together from their lines, and a
    source that is declared free of line breaks (``breaks=False``) never is.
    Besides the data there are ``_file``, ``_split`` and ``_place_in_split`` for lineage.
    """
    found = records.read_records(spark, paths, columns, encoding, breaks)
    return records.checked(found) if strict else found.drop(records.REASON, records.RAW)


def read_by_layout(
    spark: SparkSession, layouts: dict[tuple[str, ...], list[str]], encoding: str = CP1252, strict: bool = True
) -> DataFrame:
    """Files grouped by header; layouts that drifted meet by name, missing columns are null."""
    frames = [read_delimited(spark, files, list(header), encoding, strict) for header, files in layouts.items()]
    return union_relaxed(frames, allow_missing=True)


def data_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in (FILE, SPLIT, PLACE)]


def with_line_numbers(df: DataFrame, name: str = "linha_arquivo", first: int = 2) -> DataFrame:
    """Record number per file (EXP-28), also for files of many splits; without quoted line breaks it is the line.

    Row ids are consecutive inside a split, so the place in the split is a subtraction. The
    shifts, one row per split, are computed first and joined map-side; the rows themselves are
    neither shuffled nor sorted, or the call fails. Call it on a frame as read.
    """
    splits = df.groupBy(FILE, SPLIT).agg(F.count(F.lit(1)).alias("_size"), F.min(PLACE).alias("_first"))
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_size").over(earlier), F.lit(0))
    offsets = splits.select(
        F.col(FILE).alias("_f"), F.col(SPLIT).alias("_s"), (before - F.col("_first") + first).alias("_shift")
    )
    both = join_small(df, offsets, (F.col(FILE) == F.col("_f")) & (F.col(SPLIT) == F.col("_s")))
    return both.withColumn(name, F.col(PLACE) + F.col("_shift")).drop("_f", "_s", "_shift", SPLIT, PLACE)


def file_name(c: Column | str = FILE) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def period_of(c: Column | str = FILE) -> Column:
    """``202503`` of ``…/202503_Compras.csv`` (SRC-10)."""
    return F.nullif(F.regexp_extract(file_name(c), r"^(\d{6})_", 1), F.lit(""))


def with_period_lineage(df: DataFrame) -> DataFrame:
    """periodo, ano, mes and file of origin (EXP-27)."""
    period = period_of()
    return df.withColumns(
        {
            "periodo_origem": period,
            "ano_origem": F.substring(period, 1, 4).try_cast("int"),
            "mes_origem": F.substring(period, 5, 2).try_cast("tinyint"),
            "arquivo_origem": F.col(FILE),
        }
    ).drop(FILE, SPLIT, PLACE)


def in_periods(df: DataFrame, first: str, last: str) -> DataFrame:
    """Period range on ``yyyyMM`` text (FLT-08)."""
    return df.where(F.col("periodo_origem").between(first, last))


def row_control(raw: DataFrame, transformed: DataFrame, files: DataFrame) -> DataFrame:
    """Input and output rows per file; files without rows stay in the control (SRC-10)."""
    before = raw.groupBy(F.col(FILE).alias("file")).agg(F.count(F.lit(1)).alias("input_rows"))
    after = transformed.groupBy(F.col("arquivo_origem").alias("file")).agg(F.count(F.lit(1)).alias("output_rows"))
    both = files.join(before, "file", "left").join(after, "file", "left")
    return both.select(
        "file",
        period_of("file").alias("period"),
        F.coalesce("input_rows", F.lit(0)).alias("input_rows"),
        F.coalesce("output_rows", F.lit(0)).alias("output_rows"),
    )


def row_control_of(raw: DataFrame, stored: DataFrame, files: DataFrame) -> DataFrame:
    """``row_control`` of a table that carries its file of origin as ``arquivo_origem`` on both sides."""
    return row_control(raw.select(F.col("arquivo_origem").alias(FILE)), stored, files)


def read_mapped(
    spark: SparkSession,
    path: str,
    headers: list[str],
    rule: Callable[[str], str],
    tokens: tuple[str, ...],
    encoding: str = CP1252,
) -> DataFrame:
    """Mandatory headers, several null spellings, renamed by rule (SRC-02, SRC-14)."""
    df = read_delimited(spark, path, encoding=encoding)
    absent = sorted(set(headers) - set(data_columns(df)))
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    named = {h: rule(h) for h in headers}
    rest = [F.col(c) for c in (FILE, SPLIT, PLACE)]
    return df.select(*[null_tokens(F.col(f"`{h}`"), tokens).alias(n) for h, n in named.items()], *rest)


def read_snake_cased(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """UTF-8 file, byte-order mark allowed, snake-cased header, stripped values (SRC-07)."""
    df = read_delimited(spark, paths, encoding=UTF8, strict=False)
    kept = [F.col(c) for c in (FILE, SPLIT, PLACE)]
    return df.select(*[clean_text(F.col(f"`{c}`")).alias(snake_name(c.lstrip("\ufeff"))) for c in data_columns(df)], *kept)


def normalized_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c if c in (FILE, SPLIT, PLACE) else header_name(c) for c in df.columns])
