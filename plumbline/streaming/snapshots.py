"""Snapshots that follow a landing: each run merges what is new into the groups that it touches (DDP-01/02/05 over PIP-05).

``land`` appends the rows of new files to a landed table under the run's id; the file sink's log makes them appear once.
``follow`` merges the runs that the state hasn't seen. State rows lie in buckets of their group; a run reads and rewrites
only the buckets that new rows fall into, in a folder of its own, and commits them by one file written last, which
says where each bucket's rows are. A run that fails on the way leaves the state as it was, and the next one merges what it
should have; a run without new rows changes nothing.

The merge has to be one that may be done bit by bit: merge(merge(a) + b) equals merge(a + b), as it holds for every
choice by a total order per key and for all rows of a group's latest period.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators import dedup
from plumbline.sources.tables import new_run_id
from plumbline.streaming.landing import land_once

RUN = "execucao"
BUCKET = "_balde"

# A row per bucket and committed run, and one without a bucket that holds the schema.
STATE_SCHEMA = "run_id string, seen string, bucket int, held_by string, schema string"

Merge = Callable[[DataFrame], DataFrame]


def latest_period(group: str, period: str) -> Merge:
    """All rows of each group's latest period (DDP-05); rows without a group or period are in none."""
    return lambda df: dedup.latest_snapshot(df, group, period, period)


def latest_row(key: list[str], order: list[Column]) -> Merge:
    """One row per key, the first in an order, whose ties the other columns break (DDP-01/02)."""
    return lambda df: dedup.keep_first(df, key, order)


def land(stream: DataFrame, landed: str, checkpoint: str) -> int:
    """Append what has not been landed yet, under the id of this run. Returns the number of new rows."""
    return land_once(stream.withColumn(RUN, F.lit(new_run_id())), landed, checkpoint, [RUN])


def _state(spark: SparkSession, target: str) -> tuple[str, dict[int, str], str] | None:
    """Of the newest committed run: the last landed run it has seen, where each bucket is held, and the schema of the rows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/_state")
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return None
    rows = spark.read.schema(STATE_SCHEMA).json(f"{target}/_state")
    newest = rows.agg(F.max("run_id").alias("r")).first()["r"]
    if newest is None:
        return None
    # As many rows as there are buckets, a parameter.
    found = rows.where(F.col("run_id") == newest).collect()
    head = next(r for r in found if r["bucket"] is None)
    return head["seen"], {r["bucket"]: r["held_by"] for r in found if r["bucket"] is not None}, head["schema"]


def _held(spark: SparkSession, target: str, held: dict[int, str], schema: T.StructType) -> DataFrame:
    """The rows of some buckets."""
    if not held:
        return spark.createDataFrame([], schema)
    paths = [f"{target}/runs/{run}/{BUCKET}={bucket}" for bucket, run in sorted(held.items())]
    return spark.read.schema(schema).parquet(*paths)


def read_snapshot(spark: SparkSession, target: str) -> DataFrame:
    """The rows as the newest committed run left them. Absence raises."""
    state = _state(spark, target)
    if state is None:
        raise FileNotFoundError(f"No run of {target} was committed")
    return _held(spark, target, state[1], T.StructType.fromJson(json.loads(state[2])))


def follow(
    spark: SparkSession, landed: str, target: str, group: list[str], merge: Merge, prepare: Callable[[DataFrame], DataFrame] | None = None, buckets: int = 64
) -> int:
    """Merge the landed runs that the state has not seen. Returns how many buckets were rewritten.

    ``group`` are the columns by which ``merge`` tells rows apart, after ``prepare``. ``buckets`` bounds what the driver
    holds (a name per bucket) and should be such that a bucket is some hundred megabytes; it stays what it was at the first run.
    A hot group makes one bucket large: its rows are written by several tasks.
    """
    state = _state(spark, target)
    rows = spark.read.parquet(landed)
    if state is not None:
        rows = rows.where(F.col(RUN) > state[0])
    seen = rows.agg(F.max(RUN).alias("r")).first()["r"]
    if seen is None:
        return 0
    new = rows.drop(RUN)
    new = prepare(new) if prepare else new
    held = state[1] if state else {}
    bucket = F.pmod(F.xxhash64(*group), F.lit(buckets)).cast("int")
    touched = [r["b"] for r in new.select(bucket.alias("b")).distinct().collect()]
    before = _held(spark, target, {b: held[b] for b in touched if b in held}, new.schema)
    run_id = new_run_id()
    path = f"{target}/runs/{run_id}"
    merged = merge(before.unionByName(new)).select(new.columns).withColumn(BUCKET, bucket)
    merged.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).option("compression", "zstd").parquet(path)
    stored = spark.read.schema(T.StructType([*new.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)
    kept = [r[BUCKET] for r in stored.select(BUCKET).distinct().collect()]
    now = {b: at for b, at in held.items() if b not in touched} | dict.fromkeys(kept, run_id)
    lines = [(run_id, seen, None, None, new.schema.json())] + [(run_id, seen, b, at, None) for b, at in sorted(now.items())]
    spark.createDataFrame(lines, STATE_SCHEMA).coalesce(1).write.mode("append").json(f"{target}/_state")
    return len(kept)
