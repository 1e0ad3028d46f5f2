"""Aggregates that say what happens to nulls."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.numbers import EXACT
from plumbline.functions.text import col


def rows() -> Column:
    return F.count(F.lit(1))


def n_unique(c: Column | str) -> Column:
    """Distinct values, null counted as one of them (AGG-03)."""
    return F.count_distinct(col(c)) + F.coalesce(F.max(col(c).isNull().cast("int")), F.lit(0))


def n_present(c: Column | str, where: Column | None = None) -> Column:
    """Distinct non-null values, optionally of the rows that pass a filter (AGG-04/05)."""
    return F.count_distinct(col(c) if where is None else F.when(where, col(c)))


def exact_total(c: Column | str, where: Column | None = None) -> Column:
    value = col(c) if where is None else F.when(where, col(c))
    return F.sum(value.cast(EXACT))


def total(c: Column | str, where: Column | None = None) -> Column:
    """Sum; no values is zero (AGG-01/06). Added exactly, handed out as double."""
    return F.coalesce(exact_total(c, where), F.lit(0).cast("decimal(38,8)")).cast("double")


def added_total(c: Column | str) -> Column:
    """The total of exact totals of parts of a group."""
    return F.coalesce(F.sum(col(c)), F.lit(0).cast("decimal(38,8)")).cast("double")


def whole_total(c: Column | str) -> Column:
    return F.coalesce(F.sum(col(c)), F.lit(0)).cast("bigint")


def mean(c: Column | str, digits: int = 2) -> Column:
    """Mean of the non-null values, rounded half up on the exact quotient (AGG-08)."""
    return F.round(F.try_divide(exact_total(c), F.count(col(c))), digits).cast("double")


def count_where(flag: Column | str) -> Column:
    return F.count_if(col(flag))


def null_count(c: Column | str) -> Column:
    return F.count_if(col(c).isNull())


def any_true(c: Column | str) -> Column:
    return F.coalesce(F.bool_or(col(c)), F.lit(False))


def first_by(c: Column | str, order: Column) -> Column:
    """Value of the first row in a total order (AGG-11)."""
    return F.min_by(col(c), order)


def first_present_by(c: Column | str, order: Column) -> Column:
    """First non-null value in a total order."""
    return F.min_by(col(c), F.when(col(c).isNotNull(), order))
