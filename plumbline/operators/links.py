"""All key questions of a suite at once: every table is read once, both sides of every link meet in one aggregation.

The keys of a table are stacked as (slot, key, asked, known) rows, one per question that the table takes part in, and
counted per task before they move, so a hot key sends one row a task. No anti join, distinct or window is needed:
a key that is asked for and not known is missing, one that is known twice is repeated.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


@dataclass(frozen=True)
class Link:
    """``from_table.from_column`` points to ``to_table.to_column``; without a from side it only asks whether keys are unique."""

    to_table: str
    to_column: str
    from_table: str | None = None
    from_column: str | None = None


def _common(tables: dict[str, DataFrame], link: Link) -> T.DataType:
    """The type in which the keys of both sides are compared: their own, the wider of two numbers or moments, else text."""
    to = tables[link.to_table].schema[link.to_column].dataType
    if link.from_table is None:
        return to
    source = tables[link.from_table].schema[link.from_column].dataType
    if source == to:
        return to
    for kind in (T.NumericType, MOMENTS):
        if isinstance(source, kind) and isinstance(to, kind):
            sides = tables[link.from_table].select(link.from_column).union(tables[link.to_table].select(link.to_column))
            return sides.schema.fields[0].dataType
    return T.StringType()


def _text(column: str, kind: T.DataType) -> Column:
    """A text that is equal exactly where the keys are."""
    c = F.col(column).cast(kind)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        c = c + F.lit(0).cast(kind)  # minus zero is zero
    elif isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)  # an hour that a clock repeats has two moments of one text
    elif isinstance(kind, T.BinaryType):
        return F.hex(c)
    return c.cast("string")


def counted_keys(tables: dict[str, DataFrame], links: list[Link]) -> DataFrame:
    """One row per link, by its place in the list (``slot``), also where its tables are empty.

    ``orphan_rows`` and ``missing_keys`` are the rows and the different keys of the from side that the to side lacks,
    ``repeated_keys`` the keys that the to side has more than once; null keys count for none of them. ``to_rows``,
    ``to_keys`` (null is one) and ``to_nulls`` describe the to side. Keys of two types that aren't both numbers or both
    moments are compared as text. The rows number as many as the links.
    """
    asked: dict[str, list[Column]] = {}
    for slot, link in enumerate(links):
        kind = _common(tables, link)
        sides = [(link.to_table, link.to_column, 0, 1)]
        if link.from_table is not None:
            sides.append((link.from_table, link.from_column, 1, 0))
        for table, column, wants, has in sides:
            row = F.struct(
                F.lit(slot).alias("slot"), _text(column, kind).alias("key"), F.lit(wants).cast("bigint").alias("asked"), F.lit(has).cast("bigint").alias("known")
            )
            asked.setdefault(table, []).append(row)
    stacked = [tables[table].select(F.inline(F.array(*keys))) for table, keys in asked.items()]
    spark = next(iter(tables.values())).sparkSession
    seeds = spark.range(len(links), numPartitions=1).select(F.col("id").cast("int").alias("slot"), F.lit(None).cast("string").alias("key"), F.lit(0).cast("bigint").alias("asked"), F.lit(0).cast("bigint").alias("known"))
    rows = reduce(DataFrame.unionByName, [*stacked, seeds])
    per_key = rows.groupBy("slot", "key").agg(F.sum("asked").alias("asked"), F.sum("known").alias("known"))
    real = F.col("key").isNotNull()
    missing = real & (F.col("asked") > 0) & (F.col("known") == 0)
    return per_key.groupBy("slot").agg(
        F.sum(F.when(missing, F.col("asked")).otherwise(0)).alias("orphan_rows"),
        F.count_if(missing).alias("missing_keys"),
        F.count_if(real & (F.col("known") > 1)).alias("repeated_keys"),
        F.sum("known").alias("to_rows"),
        F.count_if(F.col("known") > 0).alias("to_keys"),
        F.sum(F.when(~real, F.col("known")).otherwise(0)).alias("to_nulls"),
    )


def described(counts: DataFrame, facts: list[dict]) -> DataFrame:
    """Constants per link (the same names for all) beside its counts."""
    rows = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in fact.items()]) for fact in facts])
    return counts.withColumn("_facts", F.get(rows, F.col("slot"))).select("*", "_facts.*").drop("_facts")
