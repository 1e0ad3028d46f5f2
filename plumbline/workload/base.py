"""Registry, staging and SQL snippets."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.text import strip
from plumbline.session import apply_settings

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, as its files are. Its schema is read once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def staged(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run a staging SELECT whose tables are written ``{orders}``."""
    used = {name: table(spark, sf_dir, name) for name in TABLES if f"{{{name}}}" in sql}
    return spark.sql(sql, **used)


def plain(sql: str) -> str:
    """The same SELECT with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def canon(df: DataFrame) -> DataFrame:
    """Output types that both engines have: whole numbers as bigint, decimals as double."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint").alias(f.name)
        elif isinstance(f.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double").alias(f.name)
        out.append(c)
    return df.select(*out)


def query(name: str, sql: str | None = None, wide: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query and, where SQL can say it, its oracle. ``wide`` names int columns it passes on."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_settings(spark)
            return canon(fn(spark, sf_dir))

        if name in QUERIES:
            raise ValueError(f"Query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = plain(widen(sql, *wide) if wide else sql)
        return fn

    return register


def as_text(df: DataFrame, pad: bool = True, dirty_date: bool = False) -> DataFrame:
    """A typed frame as a landed file has it: Brazilian numbers and dates, stray blanks around text."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            c = F.translate(F.format_number(c, 2), ",.", ".,")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "d/M/yyyy" if dirty_date else "dd/MM/yyyy")
        elif isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
        elif isinstance(f.dataType, T.StringType) and pad:
            c = F.concat(F.lit("\u00a0"), c, F.lit(" \t"))
        else:
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def with_reader_columns(text: DataFrame, typed: DataFrame, columns: list[str]) -> DataFrame:
    """Columns that a reader adds are clean and typed; take them back from the padded text."""
    return text.withColumns({c: strip(c).cast(typed.schema[c].dataType) for c in columns if c in typed.columns})


# ---------------------------------------------------------------- SQL snippets


def tot(x: str, where: str | None = None) -> str:
    value = f"CASE WHEN {where} THEN {x} END" if where else x
    return f"CAST(coalesce(sum(CAST({value} AS DECIMAL(28,8))), 0) AS DOUBLE)"


def nuni(x: str) -> str:
    return f"(count(DISTINCT {x}) + CASE WHEN count(*) > count({x}) THEN 1 ELSE 0 END)"


def npres(x: str, where: str | None = None) -> str:
    return f"count(DISTINCT CASE WHEN {where} THEN {x} END)" if where else f"count(DISTINCT {x})"


def cnt(where: str) -> str:
    return f"count(CASE WHEN {where} THEN 1 END)"


def pct(num: str, den: str, digits: int = 4) -> str:
    return f"round(CASE WHEN {den} > 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100 END, {digits})"


def _half_up(units: str, n: str, scale: int) -> str:
    """units / n, rounded half up, then divided by ``scale``; all in integers."""
    return (
        f"CASE WHEN {n} > 0 THEN CAST(sign({units}) * ((2 * abs({units}) + {n}) // (2 * {n})) AS DOUBLE) / {scale}.0 END"
    )


def mean(x: str, digits: int = 2) -> str:
    """Mean of values that have at most two decimals."""
    scale = 10**digits
    units = f"(sum(CAST(round({x} * 100) AS HUGEINT)) * {scale})"
    return (
        f"CASE WHEN count({x}) > 0 THEN CAST(sign({units}) * ((2 * abs({units}) + 100 * count({x}))"
        f" // (200 * count({x}))) AS DOUBLE) / {scale}.0 END"
    )


def per(total: str, n: str) -> str:
    """Total per head to two decimals."""
    return _half_up(f"CAST(round({total} * 100) AS HUGEINT)", n, 100)


def rank(value: str, by: str | None = None) -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"CASE WHEN {value} IS NOT NULL THEN dense_rank() OVER ({part}ORDER BY {value} DESC NULLS LAST) END"


def widen(sql: str, *columns: str) -> str:
    """Integer columns of a given table, shown as bigint like every whole number."""
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)
    return f"SELECT * REPLACE ({casts}) FROM ({sql})"


def bigint(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def first(x: str, order: str) -> str:
    """First non-null value of a group in an order."""
    return f"arg_min({x}, CASE WHEN {x} IS NOT NULL THEN {order} END)"


def sha(*columns: str) -> str:
    """Each part by its length and text, null by a sign of its own."""
    parts = (f"coalesce(CAST(length(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"sha256({' || '.join(parts)})"


def has(x: str, *stems: str) -> str:
    return "(" + " OR ".join(f"contains(lower(coalesce({x}, '')), '{s}')" for s in stems) + ")"


def calendar_sql(bounds: str) -> str:
    """Dense calendar over a SELECT of ``lo`` and ``hi``."""
    months = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
    return f"""
    WITH b AS ({bounds}),
    d AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS data FROM b)
    SELECT CAST(strftime(data, '%Y%m%d') AS BIGINT) AS chave_data, data, year(data) AS ano, month(data) AS mes,
      {months}[month(data)] AS nome_mes, day(data) AS dia, quarter(data) AS trimestre, strftime(data, '%Y%m') AS periodo
    FROM d"""
