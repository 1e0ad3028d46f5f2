"""Tolerant dates, date parts and date repair."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from plumbline.functions.text import clean_text, col

# Month and weekday names do not follow the JVM locale.
MONTHS_PT = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
WEEKDAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def brazilian_date(c: Column | str) -> Column:
    """``31/12/2025`` or ``1/2/2025``; impossible days are null (EXP-04)."""
    return F.try_to_date(clean_text(c), "d/M/yyyy")


def iso_datetime(c: Column | str) -> Column:
    """ISO date-time without zone (EXP-05)."""
    text = clean_text(c)
    return F.when(F.length(text) >= 10, text.try_cast("timestamp_ntz"))


def iso_date(c: Column | str) -> Column:
    """ISO date; the two day-first spellings are tried next."""
    text = clean_text(c)
    iso = F.when(F.length(text) >= 10, text.try_cast("date"))
    return F.coalesce(iso, F.try_to_date(text, "d/M/yyyy"), F.try_to_date(text, "d-M-yyyy"))


def day_of(c: Column | str) -> Column:
    return col(c).cast("date")


def year_month(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMM")


def date_key(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyyMMdd").cast("int")


def iso_weekday(c: Column | str) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return F.weekday(col(c)) + 1


def named(index: Column, names: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), index.cast("int"))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(col(end), col(start))


def before(first: Column | str, second: Column | str) -> Column:
    """True only if both dates are there and the first is earlier (EXP-15)."""
    return F.coalesce(col(first) < col(second), F.lit(False))


def repair_date(date: Column | str, year: Column | str, month: Column | str, window: tuple[int, ...]) -> Column:
    """Keep a date inside the window, else rebuild it from the year and what is known (EXP-17)."""
    d = col(date)
    parts = F.format_string(
        "%04d-%02d-%02d",
        col(year).cast("int"),
        F.coalesce(F.month(d), col(month).cast("int")),
        F.coalesce(F.dayofmonth(d), F.lit(1)),
    )
    usable = col(year).isNotNull() & (d.isNotNull() | col(month).isNotNull())
    rebuilt = F.when(usable, parts).try_cast("date")
    return F.when(F.year(d).isin(*window), d).otherwise(rebuilt)


def is_outside(date: Column | str, window: tuple[int, ...]) -> Column:
    return col(date).isNull() | ~F.year(col(date)).isin(*window)
