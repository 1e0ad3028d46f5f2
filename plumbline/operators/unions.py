"""Unions with the three drift policies, and schema backfill."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _wider(frame: DataFrame, a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: text if one is text (landed columns drift to it), else Spark's own common type."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    atomic = (T.ArrayType, T.MapType, T.StructType, T.BinaryType)
    if T.StringType() in (a, b) and not isinstance(a, atomic) and not isinstance(b, atomic):
        return T.StringType()
    both = frame.sparkSession.range(0).select(F.coalesce(F.lit(None).cast(a), F.lit(None).cast(b)).alias("c"))
    return both.schema["c"].dataType


def union_strict(frames: list[DataFrame]) -> DataFrame:
    """Same columns, same types, matched by name (SET-01)."""
    first = {f.name: f.dataType for f in frames[0].schema.fields}
    for frame in frames[1:]:
        if {f.name: f.dataType for f in frame.schema.fields} != first:
            raise ValueError(f"Schemas differ: {frames[0].schema.simpleString()} / {frame.schema.simpleString()}")
    return reduce(DataFrame.unionByName, frames)


def union_relaxed(frames: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Columns meet at their common wider type (SET-02); missing ones may become null (SET-03)."""
    target: dict[str, T.DataType] = {}
    for frame in frames:
        for field in frame.schema.fields:
            try:
                target[field.name] = _wider(frame, target.get(field.name, field.dataType), field.dataType)
            except AnalysisException as error:
                raise TypeError(f"{field.name}: {target[field.name].simpleString()} and {field.dataType.simpleString()} have no common type") from error
    cast = [f.select(*[F.col(c).cast(target[c]).alias(c) if f.schema[c].dataType != target[c] else F.col(c) for c in f.columns]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), cast)


def backfill(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Add the expected columns that a source lacks as typed nulls (EXP-29)."""
    absent = {c: F.lit(None).cast(kind) for c, kind in expected.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df


def existing(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    if old in df.columns and new not in df.columns:
        return df.withColumnRenamed(old, new)
    return df


def void_to_string(df: DataFrame) -> DataFrame:
    """Columns that hold nothing but null have no storable type (SNK-02)."""
    void = {f.name: F.col(f.name).cast("string") for f in df.schema.fields if isinstance(f.dataType, T.NullType)}
    return df.withColumns(void) if void else df
