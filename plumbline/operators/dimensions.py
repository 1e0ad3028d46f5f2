"""Star-schema dimensions and calendars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import dates
from plumbline.functions.text import strip
from plumbline.operators.ranking import number_rows


def with_key(df: DataFrame, columns: list[str], **keys: Column) -> DataFrame:
    """Distinct rows of a fact with derived keys in front (DIM natural keys)."""
    return df.select(*columns).distinct().select(*[key.alias(name) for name, key in keys.items()], *columns)


def labelled(df: DataFrame, column: str, label: str, source: str | None = None) -> DataFrame:
    """Distinct values with null shown as a label."""
    return df.select(F.coalesce(F.col(source or column), F.lit(label)).alias(column)).distinct()


def surrogate(df: DataFrame, number: str, order: list[str]) -> DataFrame:
    """Numbers are given after sorting, so they do not change from run to run."""
    return number_rows(df, number, order)


def valid_keys(df: DataFrame, column: str) -> DataFrame:
    """Rows whose key is neither null nor blank (FLT-02)."""
    return df.where(F.col(column).isNotNull() & (strip(column) != ""))


def _days(bounds: DataFrame) -> DataFrame:
    """One row per day of a one-row (lo, hi) frame; no bounds, no rows."""
    known = bounds.where(F.col("lo").isNotNull() & F.col("hi").isNotNull())
    return known.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("data"))


def _literal_bounds(spark: SparkSession, first: str, last: str) -> DataFrame:
    return spark.range(1).select(F.lit(first).cast("date").alias("lo"), F.lit(last).cast("date").alias("hi"))


def date_bounds(df: DataFrame, *columns: str) -> DataFrame:
    """Smallest and largest date over the columns, in one pass."""
    lows = [F.min(F.col(c).cast("date")) for c in columns]
    highs = [F.max(F.col(c).cast("date")) for c in columns]
    return df.agg(
        (F.least(*lows) if len(lows) > 1 else lows[0]).alias("lo"),
        (F.greatest(*highs) if len(highs) > 1 else highs[0]).alias("hi"),
    )


def calendar(df: DataFrame, *columns: str) -> DataFrame:
    """Dense calendar from the first to the last date that occurs (CAL-01)."""
    return _calendar_parts(_days(date_bounds(df, *columns)))


def _calendar_parts(days: DataFrame) -> DataFrame:
    d = F.col("data")
    return days.select(
        dates.date_key(d).alias("chave_data"),
        d,
        F.year(d).alias("ano"),
        F.month(d).cast("tinyint").alias("mes"),
        dates.named(F.month(d), dates.MONTHS_PT).alias("nome_mes"),
        F.dayofmonth(d).cast("tinyint").alias("dia"),
        F.quarter(d).cast("tinyint").alias("trimestre"),
        dates.year_month(d).alias("periodo"),
    )


def calendar_of_periods(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Every day from the first month to the last (both ``yyyyMM``), with quarter and week parts."""
    bounds = spark.range(1).select(
        F.to_date(F.lit(first), "yyyyMM").alias("lo"), F.last_day(F.to_date(F.lit(last), "yyyyMM")).alias("hi")
    )
    return wide_calendar(_days(bounds))


def wide_calendar(days: DataFrame) -> DataFrame:
    d = F.col("data")
    return days.select(
        dates.date_key(d).alias("chave_data"),
        d,
        F.year(d).alias("ano"),
        F.month(d).cast("tinyint").alias("mes"),
        dates.named(F.month(d), dates.MONTHS_PT).alias("nome_mes"),
        F.dayofmonth(d).cast("tinyint").alias("dia"),
        F.quarter(d).cast("tinyint").alias("trimestre"),
        F.concat(F.quarter(d).cast("string"), F.lit("º trimestre")).alias("nome_trimestre"),
        F.weekofyear(d).cast("tinyint").alias("semana_ano"),
        dates.iso_weekday(d).cast("tinyint").alias("dia_semana_numero"),
        dates.year_month(d).alias("periodo"),
        F.date_format(d, "MM/yyyy").alias("mes_ano"),
        (dates.iso_weekday(d) >= 6).alias("fim_de_semana"),
    )


def fixed_calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """Calendar of fixed bounds with English day and month names."""
    return english_calendar(_days(_literal_bounds(spark, first, last)))


def english_calendar(days: DataFrame) -> DataFrame:
    d = F.col("data")
    return days.select(
        dates.date_key(d).alias("id_tempo"),
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        dates.year_month(d).alias("ano_mes"),
        dates.named(F.month(d), dates.MONTHS_EN).alias("nome_mes"),
        F.concat(F.lit("T"), F.quarter(d).cast("string")).alias("trimestre"),
        dates.iso_weekday(d).alias("dia_semana"),
        dates.named(dates.iso_weekday(d), dates.WEEKDAYS_EN).alias("nome_dia_semana"),
    )


def observed_calendar(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """Only the dates that occur in one of the columns."""
    found: DataFrame | None = None
    for df, column in frames:
        if column not in df.columns:
            continue
        days = df.select(F.col(column).cast("date").alias("data")).where("data is not null").distinct()
        found = days if found is None else found.unionByName(days)
    if found is None:
        raise ValueError("No date column found")
    d = F.col("data")
    return found.distinct().select(
        dates.date_key(d).alias("id_tempo"),
        d,
        F.year(d).alias("ano"),
        F.month(d).cast("tinyint").alias("mes"),
        F.dayofmonth(d).cast("tinyint").alias("dia"),
        F.quarter(d).cast("tinyint").alias("trimestre"),
        dates.iso_weekday(d).cast("tinyint").alias("dia_semana_numero"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        dates.year_month(d).alias("periodo"),
    )
