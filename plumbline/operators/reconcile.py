"""Compare totals of two layers within a tolerance.

Every table contributes one aggregate; the values meet by check name, so no frames are crossed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.aggregates import total

MONEY_TOLERANCE = 0.05


def side(df: DataFrame, values: dict[str, Column], which: str) -> DataFrame:
    """One (check, value) row per aggregate; ``which`` is ``silver`` or ``gold``."""
    return sides(df, {which: values})


def sides(df: DataFrame, values: dict[str, dict[str, Column]]) -> DataFrame:
    """As ``side``, for what both layers take from one table: it is aggregated once."""
    named = {f"{which}_{k}": (k, which, v) for which, checks in values.items() for k, v in checks.items()}
    one = df.agg(*[v.cast("double").alias(name) for name, (_, _, v) in named.items()])
    pairs = [F.struct(F.lit(k).alias("check"), F.lit(which).alias("_side"), F.col(name).alias("_value")) for name, (k, which, _) in named.items()]
    return one.select(F.inline(F.array(*pairs)))


def distinct_rows(df: DataFrame, columns: list[str | Column]) -> DataFrame:
    return df.select(*columns).distinct()


def compare(sides: list[DataFrame], tolerances: dict[str, float] | None = None) -> DataFrame:
    """Equality within tolerance per check (REC-01); a missing total counts as zero."""
    values = reduce(DataFrame.unionByName, sides)
    met = values.groupBy("check").agg(
        F.coalesce(F.max(F.when(F.col("_side") == "silver", F.col("_value"))), F.lit(0.0)).alias("silver_value"),
        F.coalesce(F.max(F.when(F.col("_side") == "gold", F.col("_value"))), F.lit(0.0)).alias("gold_value"),
    )
    allowed = F.lit(0.0)
    for name, tolerance in (tolerances or {}).items():
        allowed = F.when(F.col("check") == name, F.lit(tolerance)).otherwise(allowed)
    # Six decimals: a difference of exactly the tolerance is approved whatever the float noise.
    difference = F.round(F.col("gold_value") - F.col("silver_value"), 6)
    return (
        met.withColumn("difference", difference)
        .withColumn("tolerance", allowed)
        .withColumn("approved", F.abs("difference") <= F.col("tolerance"))
        .withColumn("severity", F.when(F.col("approved"), "info").otherwise("error"))
    )


def by_group(
    silver: DataFrame, gold: DataFrame, key: str, metrics: list[str], dataset: str, tolerance: float = 0.01
) -> DataFrame:
    """Per-key totals of both layers, full outer, one row per key and metric (REC-05, JON-07)."""
    left = silver.groupBy(key).agg(*[total(m).alias(m) for m in metrics])
    right = gold.groupBy(key).agg(*[total(m).alias(f"{m}_gold") for m in metrics])
    both = left.join(right, key, "full")
    rows = [
        F.struct(
            F.lit(m).alias("metrica"),
            F.coalesce(F.col(m), F.lit(0.0)).alias("valor_silver"),
            F.coalesce(F.col(f"{m}_gold"), F.lit(0.0)).alias("valor_gold"),
        )
        for m in metrics
    ]
    long = both.select(key, F.lit(dataset).alias("dataset"), F.inline(F.array(*rows)))
    return long.withColumn("diferenca", F.round(F.col("valor_gold") - F.col("valor_silver"), 2)).withColumn(
        "reconciliado", F.abs("diferenca") <= tolerance
    )
