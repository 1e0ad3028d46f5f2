"""What the operators share: shared folders, shipped code, Arrow helpers."""

from __future__ import annotations

import hashlib
import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of rows that one Arrow batch hands to Python; long texts make batches of few rows.
BATCH_BYTES = str(4 << 20)

_shipped: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches and hand the package to the executors once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        blob = io.BytesIO()
        with zipfile.ZipFile(blob, "w", zipfile.ZIP_DEFLATED) as out:
            for folder, _, names in sorted(os.walk(root)):
                for name in sorted(names):
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.writestr(zipfile.ZipInfo(os.path.relpath(path, os.path.dirname(root))), open(path).read())
        digest = hashlib.sha256(blob.getvalue()).hexdigest()[:12]
        path = os.path.join(tempfile.mkdtemp(prefix="plumbline-code-"), f"plumbline_{digest}.zip")
        with open(path, "wb") as f:
            f.write(blob.getvalue())
        context.addPyFile(path)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share. A folder of our own only in local mode, where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share.")
    folder = "file://" + tempfile.mkdtemp(prefix="plumbline-shared-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: later reads survive lost executors and recompute nothing.

    The folder is removed when the application ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    # What was shuffled on the way isn't needed once the rows are written.
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(cleanup)
        else:
            spark.conf.set(cleanup, before)
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def fresh(taken: Iterable[str], *wanted: str) -> list[str]:
    """Names that no column of ``taken`` has, whatever its case: those wanted, with underscores added where needed."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def text_bytes(column: pa.Array) -> tuple[bytes, np.ndarray]:
    """All texts of a string column as one byte string, and the offsets of each; null is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return b"", np.zeros(len(column) + 1, np.int64)
    return data[offsets[0] : offsets[-1]].to_pybytes(), offsets - offsets[0]


def binary_array(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column over one buffer; offsets must stay under 2 GiB, which BATCH_BYTES ensures."""
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int32)), pa.py_buffer(data)])


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, after one another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
