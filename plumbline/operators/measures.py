"""Named business measures as aggregate columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.aggregates import n_unique, rows, total
from plumbline.functions.text import col


@dataclass(frozen=True)
class Measure:
    """A measure of one fact table. ``build`` gets the extra filter and returns the aggregate."""

    name: str
    table: str
    build: Callable[[Column | None], Column]

    def where(self, condition: Column, name: str) -> Measure:
        """The same measure over the rows that also pass ``condition`` (MSR-05)."""
        return Measure(name, self.table, lambda extra: self.build(condition if extra is None else condition & extra))


def _only(value: Column, where: Column | None) -> Column:
    return value if where is None else F.when(where, value)


def sum_of(name: str, table: str, column: str) -> Measure:
    return Measure(name, table, lambda where: total(column, where))


def row_count(name: str, table: str) -> Measure:
    return Measure(name, table, lambda where: rows() if where is None else F.count_if(where))


def distinct_count(name: str, table: str, column: str) -> Measure:
    """A blank counts as one value (MSR-03)."""

    def build(where: Column | None) -> Column:
        if where is None:
            return n_unique(column)
        blank = F.coalesce(F.max((where & col(column).isNull()).cast("int")), F.lit(0))
        return F.count_distinct(_only(col(column), where)) + blank

    return Measure(name, table, build)


def divide(name: str, num: Measure, den: Measure) -> Measure:
    """Quotient, zero where the divisor is zero or blank (MSR-04)."""

    def build(where: Column | None) -> Column:
        return F.coalesce(F.try_divide(num.build(where).cast("double"), den.build(where).cast("double")), F.lit(0.0))

    return Measure(name, num.table, build)


def evaluate(star: dict[str, DataFrame], measures: list[Measure], by: list[str] | None = None) -> DataFrame:
    """Evaluate measures, grouped by attributes their fact tables share; one pass per fact table."""
    by = by or []
    per_table: list[DataFrame] = []
    for table in dict.fromkeys(m.table for m in measures):
        aggregates = [m.build(None).alias(m.name) for m in measures if m.table == table]
        per_table.append(star[table].groupBy(*by).agg(*aggregates))
    if by:
        # Null members meet as well: join on a null-proof copy of the keys.
        def keyed(df: DataFrame) -> DataFrame:
            return df.withColumn("_member", F.to_json(F.struct(*by))) if len(per_table) > 1 else df

        def meet(a: DataFrame, b: DataFrame) -> DataFrame:
            other = b.select("_member", *[F.col(c).alias(f"_b_{c}") for c in by], *[c for c in b.columns if c not in (*by, "_member")])
            both = a.join(other, "_member", "full")
            return both.withColumns({c: F.coalesce(F.col(c), F.col(f"_b_{c}")) for c in by}).drop(*[f"_b_{c}" for c in by])

        return reduce(meet, [keyed(t) for t in per_table]).drop("_member")
    one = [t.withColumn("_one", F.lit(1)) for t in per_table]
    return reduce(lambda a, b: a.join(b, "_one"), one).drop("_one")


LEVEL = "nivel"


def evaluate_sets(star: dict[str, DataFrame], measures: list[Measure], sets: list[list[str]]) -> DataFrame:
    """Evaluate measures under several groupings in one pass per fact table (MSR-06); ``[]`` is the total.

    ``nivel`` tells which grouping a row is of: a bit per attribute, first attribute first, set where the row is over all of its
    members. So the blank member (null, bit clear) is never taken for a subtotal (null, bit set).
    """
    attributes = list(dict.fromkeys(a for s in sets for a in s))
    names = [F.col(a) for a in attributes]
    per_table: list[DataFrame] = []
    for table in dict.fromkeys(m.table for m in measures):
        aggregates = [m.build(None).alias(m.name) for m in measures if m.table == table]
        grouped = star[table].groupingSets([[F.col(a) for a in s] for s in sets], *names)
        per_table.append(grouped.agg(F.grouping_id(*names).alias(LEVEL), *aggregates))

    def meet(a: DataFrame, b: DataFrame) -> DataFrame:
        keys = [LEVEL, *attributes]
        other = b.withColumnsRenamed({k: f"_b_{k}" for k in keys})
        on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys])
        both = a.join(other, on, "full")
        # A row that one side lacks has no level there, which no row has.
        mine = F.col(LEVEL).isNotNull()
        filled = {k: F.when(mine, F.col(k)).otherwise(F.col(f"_b_{k}")) for k in keys}
        return both.select(*[c.alias(k) for k, c in filled.items()], *[c for c in both.columns if c not in keys and not c.startswith("_b_")])

    return reduce(meet, per_table)
