"""Nested documents: flatten structs, stringify arrays, unnest children."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import snake_name


def _leaves(schema: T.StructType, path: str, prefix: str) -> list[Column]:
    out: list[Column] = []
    for field in schema.fields:
        name = f"{prefix}_{snake_name(field.name)}" if prefix else snake_name(field.name)
        here = f"{path}.`{field.name}`" if path else f"`{field.name}`"
        if isinstance(field.dataType, T.StructType):
            out.extend(_leaves(field.dataType, here, name))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType)):
            out.append(F.to_json(F.col(here)).alias(name))
        else:
            out.append(F.col(here).alias(name))
    return out


def flatten(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``a.b.c`` becomes ``a_b_c``; arrays become JSON text (EXP-31)."""
    kept = [F.col(c) for c in keep]
    schema = T.StructType([f for f in df.schema.fields if f.name not in keep])
    return df.select(*_leaves(schema, "", ""), *kept)


def unnest(df: DataFrame, array: str, carry: dict[str, str]) -> DataFrame:
    """One row per child; ``carry`` copies parent columns down. Empty arrays give no row (EXP-32)."""
    child = df.select(*[F.col(src).alias(dst) for dst, src in carry.items()], F.explode(array).alias("_child"))
    fields = [f for f in child.schema["_child"].dataType.fields if snake_name(f.name) not in carry]
    nested = T.StructType(fields)
    return child.select(*_leaves(nested, "_child", ""), *carry)
