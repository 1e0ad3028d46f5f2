"""Each landed file is processed exactly once (PIP-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def landed_rows(spark: SparkSession, folder: str, columns: list[str], encoding: str = "UTF-8", glob: str = "*.csv") -> DataFrame:
    """File stream over a landing folder, all columns text, file of origin kept."""
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.readStream.schema(schema)
        .option("sep", ";")
        .option("header", True)
        .option("encoding", encoding)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .csv(folder)
        .select("*", F.col("_metadata.file_path").alias("arquivo_origem"))
    )


def land_once(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] | None = None) -> int:
    """Process what has not been landed yet, then stop. Returns the number of new rows.

    The checkpoint remembers the files, so a second run with nothing new writes nothing.
    A new checkpoint folder is the way to force a reload.
    """
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.trigger(availableNow=True).start(target)
    query.awaitTermination()
    return sum(p["numInputRows"] for p in query.recentProgress)
