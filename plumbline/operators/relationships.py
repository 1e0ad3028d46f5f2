"""Star relationships: validation and filter propagation from dimension to fact."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.aggregates import rows
from plumbline.operators.checks import orphan_rows
from plumbline.operators.links import Link, counted_keys, described


@dataclass(frozen=True)
class Relationship:
    """Many rows of ``from_table`` point to one row of ``to_table``."""

    name: str
    from_table: str
    from_column: str
    to_table: str
    to_column: str
    allow_orphans: bool = False


def validate(rel: Relationship, fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Key types agree, the one-side is unique, orphans only where allowed (DQ-16)."""
    from_type = fact.schema[rel.from_column].dataType.simpleString()
    to_type = dim.schema[rel.to_column].dataType.simpleString()
    orphans = orphan_rows(fact, dim, rel.from_column, rel.to_column).agg(rows().alias("orphan_rows"))
    keys = dim.where(F.col(rel.to_column).isNotNull()).groupBy(rel.to_column).agg(rows().alias("_n"))
    repeated = keys.agg(F.count_if(F.col("_n") > 1).alias("duplicate_to_key_groups"))
    name = F.lit(rel.name).alias("name")
    both = orphans.select(name, "orphan_rows").join(repeated.select(name, "duplicate_to_key_groups"), "name")
    fine = (F.col("duplicate_to_key_groups") == 0) & ((F.col("orphan_rows") == 0) | F.lit(rel.allow_orphans))
    return both.select(
        "name",
        F.lit(rel.from_table).alias("from_table"),
        F.lit(rel.from_column).alias("from_column"),
        F.lit(rel.to_table).alias("to_table"),
        F.lit(rel.to_column).alias("to_column"),
        F.lit(from_type).alias("from_dtype"),
        F.lit(to_type).alias("to_dtype"),
        "orphan_rows",
        "duplicate_to_key_groups",
        F.lit(rel.allow_orphans).alias("orphans_allowed"),
        (fine & F.lit(from_type == to_type)).alias("approved"),
    )


def validate_all(rels: list[Relationship], tables: dict[str, DataFrame]) -> DataFrame:
    """``validate`` for many relationships (DQ-16): each table is read once, all keys move in one shuffle."""
    found = counted_keys(tables, [Link(r.to_table, r.to_column, r.from_table, r.from_column) for r in rels])
    facts = [
        dict(
            name=r.name, from_table=r.from_table, from_column=r.from_column, to_table=r.to_table, to_column=r.to_column,
            from_dtype=tables[r.from_table].schema[r.from_column].dataType.simpleString(),
            to_dtype=tables[r.to_table].schema[r.to_column].dataType.simpleString(), orphans_allowed=r.allow_orphans,
        )
        for r in rels
    ]
    fine = (F.col("repeated_keys") == 0) & ((F.col("orphan_rows") == 0) | F.col("orphans_allowed"))
    return described(found, facts).select(
        "name", "from_table", "from_column", "to_table", "to_column", "from_dtype", "to_dtype", "orphan_rows",
        F.col("repeated_keys").alias("duplicate_to_key_groups"), "orphans_allowed",
        (fine & (F.col("from_dtype") == F.col("to_dtype"))).alias("approved"),
    )


def propagate(fact: DataFrame, dim: DataFrame, rel: Relationship, attributes: list[str]) -> DataFrame:
    """Bring dimension attributes to the fact; unmatched rows fall to the blank member (MSR-06)."""
    side = dim.select(F.col(rel.to_column).alias("_to"), *attributes)
    return fact.join(side, fact[rel.from_column] == F.col("_to"), "left").drop("_to")
