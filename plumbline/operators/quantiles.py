"""Exact medians of groups of any size.

A group's values are counted first, so copies of a value are one row. The different values are dealt to slices by boundaries
from a sketch; sums of the slices tell which of them hold the middle of each group, and only the values of those are sorted.
No task holds a group, whatever its share of the rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.runtime import materialize

SKETCH = 2_000


def exact_median(df: DataFrame, by: list[str], value: str, alias: str, slices: int | None = None) -> DataFrame:
    """One row per group that has a value: its keys and the exact median as double (AGG-09), the mean of the middle two where they are two.

    A null key is a group; null values don't count.
    """
    n = slices or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [f"_k{i}" for i in range(len(by))]
    rows = df.where(F.col(value).isNotNull()).select(*[F.col(c).alias(k) for c, k in zip(by, keys, strict=True)], F.col(value).alias("_v"))
    counts = materialize(rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n")))
    # Some numbers, literals of the plan: every read of it cuts alike.
    found = counts.agg(F.percentile_approx(F.col("_v").cast("double"), [i / n for i in range(1, n)], SKETCH).alias("b")).first()["b"] if n > 1 else None
    bounds = sorted(set(found or []))
    slice_ = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b < F.col("_v").cast("double"))) if bounds else F.lit(0)
    sliced = counts.withColumn("_slice", slice_)

    group = Window.partitionBy(*keys)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_size"))
    upto = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sizes = sizes.withColumns({"_end": F.sum("_size").over(upto), "_all": F.sum("_size").over(group)})
    # Places of the middle values, from 0.
    sizes = sizes.withColumns({"_low": F.expr("(_all - 1) div 2"), "_high": F.expr("_all div 2"), "_from": F.col("_end") - F.col("_size")})
    holds = [(F.col("_from") <= F.col(p)) & (F.col(p) < F.col("_end")) for p in ("_low", "_high")]
    named = sizes.where(holds[0] | holds[1]).select(*[F.col(k).alias(f"{k}_") for k in keys], F.col("_slice").alias("_s"), "_from", "_low", "_high")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys], F.col("_slice") == F.col("_s"))
    middle = sliced.join(named, on)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    middle = middle.withColumn("_to", F.col("_from") + F.sum("_n").over(inside))
    at = [F.max(F.when((F.col("_to") - F.col("_n") <= F.col(p)) & (F.col(p) < F.col("_to")), F.col("_v"))) for p in ("_low", "_high")]
    both = middle.groupBy(*keys).agg(at[0].cast("double").alias("_a"), at[1].cast("double").alias("_b"))
    return both.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], ((F.col("_a") + F.col("_b")) / 2).alias(alias))


def with_median(summary: DataFrame, df: DataFrame, by: list[str], value: str, alias: str, slices: int | None = None) -> DataFrame:
    """``summary``, one row per group of ``df``, with the exact median of each; null where a group has no value."""
    found = exact_median(df, by, value, alias, slices)
    found = found.toDF(*[f"_g{i}" for i in range(len(by))], alias)
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(by)], F.lit(True))
    return summary.join(found, on, "left").select(*summary.columns, alias)
