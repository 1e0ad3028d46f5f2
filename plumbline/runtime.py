"""Materialisation and size checks shared by the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a side that holds a few numbers per file or split: about 64 MB when broadcast. More are not broadcast.
MAP_SIDE_ROWS = 500_000


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder of the session; only a local master without one gets a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
        shared = tempfile.mkdtemp(prefix="plumbline-checkpoint-")
    context.setCheckpointDir(shared)


def _columnar(kind: T.DataType) -> bool:
    """Whether Parquet has a type for these values."""
    if isinstance(kind, T.StructType):
        return bool(kind.fields) and all(_columnar(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _columnar(kind.elementType)
    if isinstance(kind, T.MapType):
        return _columnar(kind.keyType) and _columnar(kind.valueType)
    return not isinstance(kind, (T.NullType, T.CalendarIntervalType))


def materialize(df: DataFrame) -> DataFrame:
    """Compute once, write to the shared checkpoint folder and cut the lineage.

    Rankings and surrogate keys read their input more than once; stored rows are the same for all reads, also after
    an executor is lost. They are compressed columns, of which a reader takes those it needs; only a frame that Parquet
    has no type for is a plain checkpoint. Which partition a stored row is read in is open. The folder goes with the application.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    if not _columnar(df.schema):
        return df.checkpoint(eager=True)
    context = spark.sparkContext
    path = f"{context.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    # Columns are stored by their place: names may be repeated or hold any character.
    placed = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    # What was shuffled on the way isn't needed once the rows are written.
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        placed.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, before)
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(placed.schema).parquet(path).toDF(*df.columns)


def bounded(small: DataFrame) -> DataFrame:
    """A side of a row per file or split, computed once; broadcast by the joins that use it if its rows were counted and are few.

    Beyond ``MAP_SIDE_ROWS`` it stays a partitioned table and the join that uses it moves rows; the result is the same.
    """
    small = materialize(small)
    return F.broadcast(small) if small.count() <= MAP_SIDE_ROWS else small


def join_small(df: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """Join with a side of a row per file or split: map-side where the side is few rows, so that ``df`` is not moved."""
    return df.join(bounded(small), on, how)
