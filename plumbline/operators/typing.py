"""Config-driven typing of text frames: one projection, no inference."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

Rule = Callable[[str], Column]


def retype(df: DataFrame, rules: dict[Rule, list[str]]) -> DataFrame:
    """Apply a parser to each listed column. A column that a source must have but lacks raises."""
    absent = sorted({c for names in rules.values() for c in names} - set(df.columns))
    if absent:
        raise ValueError(f"Missing columns: {absent}")
    return df.withColumns({c: rule(c) for rule, names in rules.items() for c in names})


def retype_existing(df: DataFrame, rules: dict[Rule, list[str]]) -> DataFrame:
    """As ``retype`` for the columns that exist."""
    found = {c: rule(c) for rule, names in rules.items() for c in names if c in df.columns}
    return df.withColumns(found) if found else df
