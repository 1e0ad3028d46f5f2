"""Dense ranks, shares and surrogate numbers that scale.

A window without PARTITION BY sends every row to one task, and a window by year sends a
third of the rows there if one year is hot. So the different values of all measures of an
aggregated frame are dealt to slices by value, numbered inside each slice, shifted by the sizes of
the slices before, and joined back. There is one plan for every size; ranks and numbers are bigint.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.numbers import EXACT, percentage
from plumbline.runtime import join_small, materialize


def _same(left: DataFrame, right: DataFrame, columns: list[str]) -> Column:
    """Null-safe equi-join condition; a null group key is a group too."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in columns])


def _positions(rows: DataFrame, order: list[Column], number: str) -> DataFrame:
    """Number the rows 1..n in ``order`` without gathering them in one task."""
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Written once, so that the slice number of a row can never change.
    sliced = materialize(rows.repartitionByRange(slices, *order).withColumn("_slice", F.spark_partition_id()))
    # One row per slice.
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = F.coalesce(F.sum("_size").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select(F.col("_slice").alias("_s"), before.alias("_before")))
    local = sliced.withColumn("_place", F.row_number().over(Window.partitionBy("_slice").orderBy(*order)))
    both = local.join(offsets, F.col("_slice") == F.col("_s"))
    return both.select(*rows.columns, (F.col("_before") + F.col("_place")).alias(number))


# Sketch entries per measure; slices are uneven by about their inverse.
SKETCH = 2_000


def _stacked(base: DataFrame, values: list[str], by: list[str], keep: list[str]) -> tuple[DataFrame, list[str], list[str]]:
    """One row per value that is there: ``_m`` (which measure), the group, the value in the column of its type; names of group and value columns."""
    types = list(dict.fromkeys(base.schema[v].dataType for v in values))
    groups, names = [f"_k{i}" for i in range(len(by))], [f"_v{i}" for i in range(len(types))]

    def entry(m: int, value: str) -> Column:
        held = [(F.col(value) if base.schema[value].dataType == t else F.lit(None).cast(t)).alias(n) for t, n in zip(types, names, strict=True)]
        return F.struct(F.lit(m).alias("_m"), *held)

    entries = F.array(*[entry(m, v) for m, v in enumerate(values)])
    rows = base.select(*keep, *[F.col(c).alias(g) for c, g in zip(by, groups, strict=True)], F.explode(entries).alias("_e"))
    rows = rows.select(*keep, *groups, "_e.*")
    return rows.where(reduce(lambda a, b: a | b, [F.col(n).isNotNull() for n in names])), groups, names


def _ahead(bounds: list[float], value: Column, equal: bool = False) -> Column:
    """How many of the bounds are greater than a value (or equal to it): a search by halves, not a comparison with each."""
    if not bounds:
        return F.lit(0)
    falling = F.array(*[F.lit(b) for b in sorted(bounds, reverse=True)])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def halved(found: Column, step: Column) -> Column:
        bound = F.get(falling, found + step - 1)
        return F.when(bound >= value if equal else bound > value, found + step).otherwise(found)

    return F.aggregate(steps, F.lit(0), halved)


def _ranks(base: DataFrame, values: list[str], by: list[str]) -> DataFrame:
    """The dense rank of every different value of every measure in its group, all in one numbering.

    Values are dealt to slices by boundaries from a sketch, so neither a measure nor a hot group is one window partition: a
    rank is a place in a slice plus the different values in the slices of the group that are higher.
    """
    slices = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = [i / slices for i in range(1, slices)]
    # Some numbers per measure. They are literals of the plan, so that every read of it cuts alike.
    sketch = base.agg(*[F.percentile_approx(F.col(v).cast("double"), parts, SKETCH).alias(f"b{m}") for m, v in enumerate(values)]).first() if parts else None
    rows, groups, names = _stacked(base, values, by, [])
    different = rows.distinct()
    # Equal values have equal approximations, and greater ones no smaller.
    approx = F.coalesce(*[F.col(n).cast("double") for n in names])
    slice_ = F.lit(0)
    for m in range(len(values)):
        bounds = sorted(set(sketch[f"b{m}"] or [])) if sketch else []
        if bounds:
            slice_ = F.when(F.col("_m") == m, _ahead(bounds, approx)).otherwise(slice_)
    keys = ["_m", *groups]
    sliced = different.withColumn("_slice", slice_)
    local = sliced.withColumn("_place", F.row_number().over(Window.partitionBy(*keys, "_slice").orderBy(*[F.col(n).desc() for n in names])))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(*keys, "_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    both = local.join(offsets, _same(local, offsets, [*keys, "_slice"]))
    return both.select(*[local[c] for c in [*keys, *names]], (F.col("_before") + F.col("_place")).cast("bigint").alias("_rank"))


def _with_rank(df: DataFrame, base: DataFrame, alias: str, value: str, by: list[str]) -> DataFrame:
    """One rank: the rows of ``df`` move once, to the slice of their value, and are numbered there; of ``base`` only a count per slice is joined.

    A value of more than a slice's share of the rows, as the sketch has it, is a slice by itself, and its rows, like those without a value,
    are dealt to many tasks: the first place is all that slice has.
    """
    partitions = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = partitions if by else 4 * partitions
    parts = [i / slices for i in range(1, slices)]
    # Some numbers, literals of the plan, so that every read of it cuts alike.
    found = base.agg(F.percentile_approx(F.col(value).cast("double"), parts, SKETCH)).first()[0] if parts else None
    bounds = sorted(found or [])
    kind = base.schema[value].dataType
    # Values whose approximation is the value: only these may share a place.
    exact = isinstance(kind, (T.DoubleType, T.FloatType, T.IntegerType, T.ShortType, T.ByteType, T.LongType))
    often = sorted({b for a, b in zip(bounds, bounds[1:]) if a == b and exact and not (isinstance(kind, T.LongType) and abs(b) >= 2**53)})
    approx = F.col(value).cast("double")
    slice_ = (_ahead(sorted(set(bounds)), approx) + _ahead(often, approx, equal=True)).alias("_slice")
    dealt = F.col(value).isNull() | approx.isin(often) if often else F.col(value).isNull()
    deal = F.when(dealt, F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(partitions))).otherwise(F.lit(0)).alias("_deal")
    inside = Window.partitionBy(*by, "_slice", "_deal").orderBy(F.col(value).desc())
    local = df.select("*", slice_, deal).withColumn("_place", F.dense_rank().over(inside))
    groups = [f"_k{i}" for i in range(len(by))]
    valued = base.where(F.col(value).isNotNull()).select(*[F.col(c).alias(g) for c, g in zip(by, groups, strict=True)], F.col(value).alias("_v"), slice_)
    sizes = valued.groupBy(*groups, F.col("_slice").alias("_s")).agg(F.count_distinct("_v").alias("_size"))
    earlier = Window.partitionBy(*groups).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    # A row per group and slice.
    offsets = sizes.select(*groups, "_s", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(g)) for c, g in zip(by, groups, strict=True)], F.col("_slice") == F.col("_s"))
    rank = F.when(F.col(value).isNotNull(), F.col("_before") + F.col("_place")).cast("bigint")
    return join_small(local, offsets, on, "left").select(*df.columns, rank.alias(alias))


def _with_ranks(df: DataFrame, base: DataFrame, ranks: dict[str, str], by: list[str]) -> DataFrame:
    """``df`` with the ranks of the values in ``base``, which is stored; ``df`` is ``base``, or, for one rank, has its values.

    For several ranks its rows have a stored number ``_row``, which goes.
    """
    if len(ranks) == 1:
        (alias, value), *_ = ranks.items()
        return _with_rank(df, base, alias, value, by)
    found = _ranks(base, list(ranks.values()), by)
    rows, groups, names = _stacked(df, list(ranks.values()), by, ["_row"])
    joined = rows.join(found, _same(rows, found, ["_m", *groups, *names])).select("_row", rows["_m"].alias("_n"), "_rank")
    wide = joined.groupBy("_row").agg(*[F.max(F.when(F.col("_n") == m, F.col("_rank"))).alias(alias) for m, alias in enumerate(ranks)])
    return df.join(wide, "_row", "left").select(*[c for c in df.columns if c != "_row"], *ranks)


def add_ranks(df: DataFrame, ranks: dict[str, str], by: list[str] | None = None) -> DataFrame:
    """Dense rank, highest first, null unranked (WIN-01/02). ``ranks`` maps new column -> value column.

    The frame is stored once; all ranks come from one numbering of its different values.
    """
    base = materialize(df.withColumn("_row", F.monotonically_increasing_id()) if len(ranks) > 1 else df)
    return _with_ranks(base, base, ranks, by or [])


def add_share(df: DataFrame, value: str, by: list[str], total: str, share: str) -> DataFrame:
    """Group total and each row's share of it in percent (WIN-03).

    The total is pre-aggregated, counted and joined, map-side if it is few rows: a hot group is never one window partition, and rows don't move.
    """
    sums = df.groupBy(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]).agg(
        F.coalesce(F.sum(F.col(value).cast(EXACT)), F.lit(0)).cast("double").alias(total)
    )
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)])
    both = join_small(df, sums, match, "left").select(*df.columns, total)
    return both.withColumn(share, percentage(value, total))


def ranked_summary(
    df: DataFrame,
    keys: list[str],
    metrics: dict[str, Column],
    ranks: dict[str, str],
    derived: dict[str, Column] | None = None,
    by: list[str] | None = None,
) -> DataFrame:
    """groupBy -> aggregates -> ratios -> ranks: the shape most marts share. Without ranks nothing is stored."""
    summary = summarize(df, keys, metrics)
    if derived:
        summary = summary.withColumns(derived)
    return add_ranks(summary, ranks, by) if ranks else summary


def summarize(df: DataFrame, keys: list[str], metrics: dict[str, Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*[metric.alias(name) for name, metric in metrics.items()])


def together(
    df: DataFrame, keys: list[str], differing: dict[str, Column], first: dict[str, Column] | None = None, near: list[str] | None = None,
    moved: bool = False,
) -> DataFrame:
    """The rows of a group in one partition, with a flag per name that is true for one row of each different value in a group.

    Counting flags counts different values (null as one of them) without a copy of the rows per count: rows move once, and a join by
    ``keys`` moves nothing more. ``first`` says which row of a value has the flag. For groups of few rows, of which partial sums would merge
    next to nothing: a group's rows are sorted by one task, on disk if need be. ``near`` names those of the keys by which rows move; if ``df``
    was moved by them before, nothing moves. ``moved`` says that a group's rows are in one partition already.
    """
    rows = df if moved else df.repartition(*(near or keys))
    for name, value in differing.items():
        order = (first or {}).get(name, value)
        rows = rows.withColumn(name, F.row_number().over(Window.partitionBy(*keys, value).orderBy(order)) == 1)
    return rows


def summarize_apart(
    df: DataFrame, keys: list[str], metrics: dict[str, Column], distincts: dict[str, Column]
) -> DataFrame:
    """Summary with its distinct counts aggregated apart and joined on the key.

    Next to ordered picks of text, a distinct count would drag every pick through two more
    sorted phases; apart it is a narrow hash aggregate, and both sides meet already
    partitioned by the key.
    """
    wide, narrow = summarize(df, keys, metrics), summarize(df, keys, distincts)
    narrow = narrow.withColumnsRenamed({k: f"_n_{k}" for k in keys})
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_n_{k}")) for k in keys])
    return wide.join(narrow, match).select(*wide.columns, *distincts)


def _hashed(keys: list[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys])


def count_apart(summary: DataFrame, df: DataFrame, keys: list[str], different: dict[str, str]) -> DataFrame:
    """``summary``, a row per key of ``df``, with the different values (null as one of them) of a column per name, each aggregated apart.

    A distinct count of many values moves a row per value, and several of them copy every row. Here such a row is a value and a hash of its
    key instead of the whole key. The hash may stand for the key as no two keys of the summary share one, which is looked up first; else the keys
    themselves are used, with the same result. Values add up per task before they move, so a hot key is many tasks.
    """
    base = materialize(summary.withColumn("_hash", _hashed(keys)))
    apart = base.groupBy("_hash").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1).isEmpty()
    by = ["_hash"] if apart else keys
    rows, both = df.withColumn("_hash", _hashed(keys)), base
    for i, (name, value) in enumerate(different.items()):
        groups = {k: f"_k{i}_{j}" for j, k in enumerate(by)}
        values = rows.select(*[F.col(k).alias(g) for k, g in groups.items()], F.col(value).alias("_v")).distinct()
        counts = values.groupBy(*groups.values()).agg(F.count(F.lit(1)).alias(name))
        both = both.join(counts, reduce(lambda a, b: a & b, [base[k].eqNullSafe(counts[g]) for k, g in groups.items()]))
    return both.select(*summary.columns, *different)


def concentration(
    df: DataFrame,
    keys: list[str],
    metrics: dict[str, Column],
    value: str,
    by: list[str],
    total: str,
    share: str,
    rank: str,
) -> DataFrame:
    """Pair summary with each pair's share and rank inside its group."""
    base = materialize(summarize(df, keys, metrics))
    return _with_ranks(add_share(base, value, by, total, share), base, {rank: value}, by)


def positions(df: DataFrame, number: str, order: list[Column]) -> DataFrame:
    """The rows with their place 1..n in any total order (SRT-01/02), without one task that sorts them all."""
    return _positions(df, order, number)


def number_rows(df: DataFrame, number: str, order: list[str], start: int = 1) -> DataFrame:
    """Surrogate number over a total order of distinct rows (WIN-04)."""
    numbered = _positions(df, [F.col(c).asc_nulls_first() for c in order], number)
    return numbered.withColumn(number, F.col(number) + (start - 1)).select(number, *df.columns)


def _running_before(sizes: DataFrame, order: str, size: str) -> DataFrame:
    """``_before``: the sum of ``size`` over the rows ahead in ``order``; only slice totals meet in one task."""
    slices = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = materialize(sizes.repartitionByRange(slices, F.col(order).asc_nulls_first()).withColumn("_slice", F.spark_partition_id()))
    totals = sliced.groupBy(F.col("_slice").alias("_s")).agg(F.sum(size).alias("_total"))
    # One row per shuffle partition.
    ahead = F.coalesce(F.sum("_total").over(Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    inside = Window.partitionBy("_slice").orderBy(F.col(order).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    both = local.join(totals.select("_s", ahead.alias("_ahead")), F.col("_slice") == F.col("_s"))
    return both.select(*sizes.columns, (F.col("_ahead") + F.col("_inside")).alias("_before"))


def number_in_source_order(df: DataFrame, number: str, segment: str, position: str) -> DataFrame:
    """Number rows 1..n where the source order is known: segments (files, partitions) in order,
    consecutive positions inside each.

    Only one row per segment is aggregated and joined back; the rows are not moved.
    """
    sizes = df.groupBy(F.col(segment).alias("_seg")).agg(F.count(F.lit(1)).alias("_size"), F.min(position).alias("_first"))
    shifts = _running_before(sizes, "_seg", "_size").select("_seg", (F.col("_before") - F.col("_first") + 1).alias("_shift"))
    both = join_small(df, shifts, F.col(segment) == F.col("_seg"))
    return both.withColumn(number, F.col(position) + F.col("_shift")).drop("_seg", "_shift")
