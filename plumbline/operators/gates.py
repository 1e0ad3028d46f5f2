"""Approval gates between layers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """The upstream layer was not approved."""


def approval(checks: DataFrame, flag: str = "approved", only_errors: bool = False) -> DataFrame:
    """One row: number of checks, failed, warnings, and the verdict (DQ-14).

    ``only_errors`` ignores failures of warning severity.
    """
    failed = ~F.coalesce(F.col(flag), F.lit(False))
    if only_errors:
        failed = failed & (F.col("severity") == "error")
    return checks.agg(
        F.count(F.lit(1)).alias("check_count"),
        F.count_if(failed).alias("failed_count"),
        F.count_if(F.col("severity") == "warning").alias("warning_count"),
        F.coalesce(F.bool_and(~failed), F.lit(True)).alias("approved"),
    )


def require_approved(checks: DataFrame, name: str, flag: str = "approved", only_errors: bool = False) -> None:
    """Refuse to go on unless every check passed (PIP-04)."""
    verdict = approval(checks, flag, only_errors).first()
    if not verdict["approved"]:
        raise GateError(f"{name}: {verdict['failed_count']} of {verdict['check_count']} checks failed")


def landing_approval(inventory: DataFrame) -> DataFrame:
    """All files are there and none is empty (PIP-06)."""
    return inventory.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("file_size_bytes"), F.lit(0)).alias("total_bytes"),
        F.coalesce(F.bool_and(F.col("file_size_bytes") > 0), F.lit(False)).alias("approved"),
    )


def quarantine(df: DataFrame, rules: dict) -> tuple[DataFrame, DataFrame]:
    """Split into accepted rows and rejected rows with the names of the broken rules (SNK-07)."""
    broken = [F.when(F.coalesce(rule, F.lit(False)), F.lit(name)) for name, rule in rules.items()]
    marked = df.withColumn("motivos_rejeicao", F.array_compact(F.array(*broken)))
    accepted = marked.where(F.size("motivos_rejeicao") == 0).drop("motivos_rejeicao")
    return accepted, marked.where(F.size("motivos_rejeicao") > 0)
