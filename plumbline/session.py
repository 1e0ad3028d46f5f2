"""Session settings the recipes rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when the split costs the operator above one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Spark 4 narrows the charset list of the text readers; landed files are windows-1252.
    "spark.sql.legacy.javaCharsets": "true",
    # The JVM does not compile methods over 8000 bytes. A projection of many columns fused into
    # one larger method would run interpreted; above the limit Spark splits it instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "plumbline", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session. ``master`` is given in tests only; a cluster sets its own."""
    # Checkpoints go when nothing refers to them any more; the setting holds for a whole application.
    builder = SparkSession.builder.appName(app_name).config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
