"""Deduplication and snapshot selection.

None of these gathers a whole group in one task: top-1 windows are cut down per map
task before the shuffle (WindowGroupLimit), and snapshots use a pre-aggregated maximum
per group joined back, where AQE may split a hot group. The exception is a snapshot ``within`` small groups, on request.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _tie_break(df: DataFrame, exclude: set[str]) -> list[Column]:
    """A total order over the rest of the row, so equal keys always keep the same row."""
    rest = [c for c in df.columns if c not in exclude]
    return [F.xxhash64(*rest).asc(), *[F.col(c).asc_nulls_first() for c in rest]] if rest else []


def keep_first(df: DataFrame, key: list[str], order: list[Column], total_order: bool = False) -> DataFrame:
    """One row per key, the first in ``order`` (DDP-01/02/03).

    Unless the caller says that ``order`` is total, the remaining columns break ties.
    """
    ties = [] if total_order else _tie_break(df, set(key))
    if not order and not ties:
        return df.dropDuplicates(key)
    w = Window.partitionBy(*key).orderBy(*order, *ties)
    return df.withColumn("_place", F.row_number().over(w)).where("_place = 1").drop("_place")


def keep_latest(df: DataFrame, key: list[str], period: str = "periodo_origem") -> DataFrame:
    """Latest period wins per key (DDP-01)."""
    return keep_first(df, key, [F.col(period).desc_nulls_last()])


def keep_last_line(df: DataFrame, key: list[str], file: str, line: str) -> DataFrame:
    """Last line in file order wins per key (DDP-02)."""
    return keep_first(df, key, [F.col(file).desc(), F.col(line).desc()], total_order=True)


def latest_snapshot(
    df: DataFrame, group: str, period: str, latest: str, where: Column | None = None, digits: bool = False, within: str | None = None
) -> DataFrame:
    """All rows of each group's latest period (DDP-05), with that period as a column.

    ``where`` limits which rows compete; the others pass through with their own period.
    ``digits`` says that a text period is ``yyyyMM``: it is compared as a number, because a
    maximum of numbers is hash-aggregated while a maximum of text has to be sorted. ``within`` names a column of which
    ``group`` is a part, or ``group`` itself, by which the rows are needed next: they move once, by it, and small groups are compared where they are.
    """
    value = F.col(period).cast("int") if digits else F.col(period)
    if within is not None:
        asked = F.col(group).isNotNull() if where is None else F.col(group).isNotNull() & where
        newest = F.max(F.when(asked, value)).over(Window.partitionBy(*dict.fromkeys([within, group])))
        # The window itself moves rows by its whole group, but not by a part of it.
        both = (df if within == group else df.repartition(within)).withColumn("_newest", newest)
        current = F.col(group).isNotNull() & (value == F.col("_newest"))
        return both.where(current if where is None else ~where | current).drop("_newest").withColumn(latest, F.col(period))
    competing = df if where is None else df.where(where)
    newest = competing.groupBy(F.col(group).alias("_group")).agg(F.max(value).alias("_newest"))
    both = df.join(newest, F.col(group) == F.col("_group"), "left")
    current = value == F.col("_newest")
    kept = both.where(current if where is None else ~where | current)
    # The rows that are left have their group's latest period, or their own.
    return kept.drop("_group", "_newest").withColumn(latest, F.col(period))


def canonical(df: DataFrame, key: str, attributes: list[str], name: str) -> DataFrame:
    """Most frequent attribute set per key; ties go to the lower name, then the other attributes (DDP-04)."""
    counted = df.groupBy(key, *attributes).agg(F.count(F.lit(1)).alias("_times"))
    rest = [F.col(a).asc_nulls_first() for a in attributes if a != name]
    order = [F.col("_times").desc(), F.col(name).asc_nulls_first(), *rest]
    return keep_first(counted, [key], order, total_order=True).drop("_times")


def most_frequent(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mode of a column per key; ties go to the lowest value, a key without values keeps null (AGG-14).

    Values are counted first, so a hot key's different values are never gathered in one task.
    """
    counted = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_times"))
    order = [F.col(value).isNull(), F.col("_times").desc(), F.col(value).asc()]
    return keep_first(counted, by, order, total_order=True).select(*by, value)


def merge_by_priority(frames: list[DataFrame], key: str) -> DataFrame:
    """Rows of the earlier frame win per key (DDP-06)."""
    ranked = [f.withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    merged = ranked[0]
    for frame in ranked[1:]:
        merged = merged.unionByName(frame)
    return keep_first(merged, [key], [F.col("_source").asc()]).drop("_source")
