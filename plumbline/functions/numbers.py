"""Locale-aware numbers, safe ratios and tolerance flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import col, strip

# Money adds up in this type: exact, so a total does not depend on how rows were partitioned.
EXACT = "decimal(28,8)"


def _double(text: Column) -> Column:
    """Tolerant cast; words and suffixes that Java reads as numbers (``NaN``, ``1d``) are null."""
    return F.when(~text.rlike("[A-DF-Za-df-z]"), text.try_cast("double"))


def _cast(text: Column, kind: str) -> Column:
    return _double(text) if kind == "double" else text.try_cast(kind)


def brazilian_decimal(c: Column | str, kind: str = "double") -> Column:
    """``1.234,56`` -> 1234.56; anything else -> null (EXP-03a, EXP-03c with a decimal kind)."""
    without_groups = F.replace(strip(c), F.lit("."), F.lit(""))
    return _cast(F.replace(without_groups, F.lit(","), F.lit(".")), kind)


def brazilian_money(c: Column | str) -> Column:
    """As ``brazilian_decimal`` but a missing amount is zero (EXP-03b)."""
    return F.coalesce(brazilian_decimal(c), F.lit(0.0))


def comma_decimal(c: Column | str) -> Column:
    """Only the decimal comma is replaced (EXP-03d)."""
    return _double(F.replace(strip(c), F.lit(","), F.lit(".")))


def plain_double(c: Column | str) -> Column:
    return _double(strip(c))


def whole_number(c: Column | str, kind: str = "bigint") -> Column:
    """Tolerant integer cast: fractions and words are null."""
    return strip(c).try_cast(kind)


def digits_number(c: Column | str) -> Column:
    """Drop everything but digits and minus, then cast (EXP-06)."""
    return F.regexp_replace(col(c).cast("string"), "[^0-9-]", "").try_cast("bigint")


def ratio(num: Column, den: Column) -> Column:
    """num/den where den is positive, else null."""
    return F.when(den > 0, F.try_divide(num, den))


def rounded(c: Column, digits: int) -> Column:
    """Round a double the way float engines do: scale, round half away from zero, scale back."""
    return F.round(c * float(10**digits), 0) / float(10**digits)


def percentage(num: Column | str, den: Column | str, digits: int = 4) -> Column:
    """EXP-18."""
    return rounded(ratio(col(num).cast("double"), col(den).cast("double")) * 100, digits)


def average_per(total: Column | str, count: Column | str, digits: int = 2) -> Column:
    """Total per head, rounded half up on the exact quotient."""
    quotient = ratio(col(total).cast(EXACT), col(count).cast("bigint"))
    return F.round(quotient, digits).cast("double")


def within(c: Column | str, tolerance: float) -> Column:
    return F.abs(col(c)) <= F.lit(tolerance)


def filled_sum(*columns: Column | str) -> Column:
    """Row-wise total that reads null as zero (EXP-34)."""
    total = F.lit(0)
    for c in columns:
        total = total + F.coalesce(col(c), F.lit(0))
    return total
