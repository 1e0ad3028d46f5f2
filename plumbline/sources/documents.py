"""JSON sources: paged arrays and nested documents.

A JSON document is read by one task from its start to its end, which bounds the size of a landed document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_pages(spark: SparkSession, folder: str, columns: list[str]) -> DataFrame:
    """``pagina_*.json``, each a list of records, values as text (SRC-05)."""
    heads = spark.read.option("wholetext", True).text(f"{folder}/pagina_*.json")
    not_list = heads.where(~F.substring(F.ltrim("value"), 1, 1).eqNullSafe("[")).select(F.col("_metadata.file_path").alias("f"))
    bad = not_list.first()
    if bad is not None:
        raise TypeError(f"Not a list: {bad['f']}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).option("multiLine", True).json(f"{folder}/pagina_*.json")
    df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_place"))
    if df.isEmpty():
        raise ValueError(f"No records in {folder}")
    return df


def read_nested(spark: SparkSession, path: str, at: str | None = None, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON document; ``at`` is the dotted path of the record array (SRC-06).

    ``_file`` says which document a record comes from; its records keep their order.
    """
    reader = spark.read.option("multiLine", True)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.json(path)
    file = F.col("_metadata.file_path").alias("_file")
    if at is None:
        return df.select("*", file)
    return df.select(F.explode(at).alias("_record"), file).select("_record.*", "_file")
