"""Parquet datasets by name, writers, manifests and publication."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.unions import void_to_string
from plumbline.runtime import materialize
from plumbline.sources import records


def dataset_path(root: str, name: str, run_id: str | None = None) -> str:
    """Where a dataset lies; of a layer run, in a folder of the run's own."""
    return f"{root}/{name}/runs/{run_id}/parquet" if run_id else f"{root}/{name}/parquet"


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def current_path(spark: SparkSession, root: str, name: str) -> str:
    """Where the newest committed run wrote a dataset, or its plain folder if no run did.

    A run counts once its manifest is there, which is written last and as one file: tables of a run that failed are not seen.
    """
    if _exists(spark, f"{root}/_control"):
        rows = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_control/*/").where((F.col("dataset") == name) & F.col("path").isNotNull())
        found = rows.agg(F.max_by("path", "run_id").alias("path")).first()["path"]
        if found:
            return found
    return dataset_path(root, name)


def read_dataset(spark: SparkSession, root: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """A dataset of a layer (SRC-08), optionally some columns (SRC-09). Absence raises."""
    df = spark.read.parquet(current_path(spark, root, name))
    return df.select(*columns) if columns else df


def latest_execution(df: DataFrame, partition: str = "execucao") -> DataFrame:
    """Rows of the newest execution partition (SRC-11).

    The newest id is read from the partition values, then used as a literal, so the scan prunes.
    """
    newest = df.select(F.max(partition).alias("newest")).first()["newest"]
    return df.where(F.col(partition) == newest)


def write_dataset(
    df: DataFrame,
    root: str,
    name: str,
    csv: bool = True,
    order_by: list | None = None,
    partition_by: list[str] | None = None,
    run_id: str | None = None,
) -> dict:
    """Parquet (zstd) and optionally ``;`` CSV; counts are observed while writing (SNK-01/02/04).

    ``order_by`` clusters the files: rows are range-partitioned by the presentation order and
    sorted inside each file, so reading the files in name order gives the sorted table. With ``run_id`` the
    files go to a folder of that run, which readers see once its manifest is written.
    """
    seen = Observation(f"write_{name}")
    out = void_to_string(df)
    if order_by:
        out = out.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    writer = out.observe(seen, F.count(F.lit(1)).alias("record_count")).write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    path = dataset_path(root, name, run_id)
    writer.parquet(path)
    if csv:
        stored = df.sparkSession.read.parquet(path).select(*out.columns)
        stored.write.mode("overwrite").option("sep", ";").option("header", True).csv(path.removesuffix("parquet") + "csv")
    return {
        "dataset": name,
        "record_count": int(seen.get["record_count"]),
        "column_count": len(out.columns),
        "columns": out.columns,
        "path": path,
    }


def rejects_path(root: str, name: str) -> str:
    return f"{root}/{name}/rejected"


def write_accepted(found: DataFrame, root: str, name: str, run_id: str, **how) -> dict:
    """Records without a reason against them as a dataset; the others beside it, with reason, raw text and place (SNK-07).

    The rejected ones of every run are kept, by run. What is stored tells how many there were: ``rejected_count``.
    """
    found = materialize(found)
    stats = write_dataset(records.accepted(found).drop(records.FILE, records.SPLIT, records.PLACE), root, name, **how)
    seen = Observation(f"reject_{name}")
    refused = records.rejected(found).select(F.lit(run_id).alias("run_id"), records.FILE, records.SPLIT, records.PLACE, records.REASON, records.RAW)
    refused.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").parquet(rejects_path(root, name))
    return stats | {"rejected_count": int(seen.get["n"])}


def read_rejects(spark: SparkSession, root: str, name: str, all_runs: bool = False) -> DataFrame:
    """What the newest run rejected, or what all did."""
    found = spark.read.parquet(rejects_path(root, name))
    return found if all_runs else _newest_run(found)


MANIFEST_SCHEMA = (
    "run_id string, subject string, layer string, dataset string, record_count bigint, column_count int, "
    "columns array<string>, path string, approved boolean, notes array<string>, "
    "upstream string, first_period string, last_period string, input_rows bigint, removed_rows bigint"
)
CONTROL_SCHEMA = "dataset string, file string, period string, input_rows bigint, output_rows bigint, run_id string"


def new_run_id() -> str:
    """Run ids sort by the time of the run."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def write_manifest(
    spark: SparkSession, root: str, subject: str, layer: str, outputs: list[dict], approved: bool, notes: list[str] | None = None,
    run_id: str | None = None, upstream: str | None = None, periods: tuple[str, str] | None = None, control: DataFrame | None = None,
) -> DataFrame:
    """Control rows of a run, one per dataset written, added to those of earlier runs (SNK-03).

    ``upstream`` is the run of the layer that was read. ``control`` has the rows in and out per dataset and
    landed file (SRC-10): it is kept beside the manifest and gives its input and removed rows.
    """
    run_id = run_id or new_run_id()
    first, last = periods or (None, None)
    rows = [
        (run_id, subject, layer, o["dataset"], o["record_count"], o["column_count"], o["columns"], o["path"], approved, notes or [], upstream, first, last, None, None)
        for o in outputs
    ]
    manifest = spark.createDataFrame(rows, MANIFEST_SCHEMA)
    if control is not None:
        control.withColumn("run_id", F.lit(run_id)).write.mode("append").json(f"{root}/_control/{layer}_files")
        read = read_file_control(spark, root, layer).groupBy("dataset").agg(F.sum("input_rows").alias("_in"))
        manifest = manifest.join(read, "dataset", "left").select(
            *[c for c in manifest.columns if c not in ("input_rows", "removed_rows")],
            F.col("_in").alias("input_rows"),
            (F.col("_in") - F.col("record_count")).alias("removed_rows"),
        )
    manifest.coalesce(1).write.mode("append").json(f"{root}/_control/{layer}")
    return read_manifest(spark, root, layer)


def _newest_run(df: DataFrame) -> DataFrame:
    newest = df.agg(F.max("run_id").alias("r")).first()["r"]
    return df.where(F.col("run_id") == newest)


def read_manifest(spark: SparkSession, root: str, layer: str, all_runs: bool = False) -> DataFrame:
    """Control rows of the newest run, or of all."""
    found = spark.read.schema(MANIFEST_SCHEMA).json(f"{root}/_control/{layer}")
    return found if all_runs else _newest_run(found)


def read_file_control(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Rows in and out per landed file of the newest run."""
    return _newest_run(spark.read.schema(CONTROL_SCHEMA).json(f"{root}/_control/{layer}_files"))


def sweep(spark: SparkSession, root: str, layer: str, keep: int = 2) -> list[str]:
    """Remove the folders of runs of a layer but for its ``keep`` newest ones and any that has no manifest yet but began later.

    Returns the run ids whose folders went. What failed runs left goes with them.
    """
    runs = read_manifest(spark, root, layer, all_runs=True).select("run_id", "dataset").distinct()
    # A row per run and dataset: some thousand at most.
    known = [(r["run_id"], r["dataset"]) for r in runs.collect()]
    newest = sorted({run for run, _ in known})[-keep:]
    hadoop, gone = spark._jvm.org.apache.hadoop.fs, set()
    for name in sorted({d for _, d in known}):
        place = hadoop.Path(f"{root}/{name}/runs")
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in files.listStatus(place) if files.exists(place) else []:
            run = status.getPath().getName()
            if run not in newest and run < newest[-1]:
                files.delete(status.getPath(), True)
                gone.add(run)
    return sorted(gone)


# What counts as a published mart, and the side folders that are not.
MART_PREFIXES = ("fato_", "ranking_", "resumo_", "relacionamento_", "rel_", "agg_")
SIDE_FOLDERS = ("dimensions", "quality", "reconciliation")


def find_marts(spark: SparkSession, gold_root: str) -> list[str]:
    """Names of publishable datasets under a Gold root (SNK-05); file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.parquet")
        .load(gold_root)
    )
    parts = F.split("path", "/")
    kept = files.select(parts.alias("p")).where(~F.arrays_overlap("p", F.array(*[F.lit(s) for s in SIDE_FOLDERS])))
    # …/<dataset>/parquet/part-0.parquet, or …/<dataset>/runs/<run>/parquet/part-0.parquet
    name = F.when(F.element_at("p", -4) == "runs", F.element_at("p", -5)).otherwise(F.element_at("p", -3))
    names = kept.where(F.size("p") > 5).select(name.alias("dataset")).distinct()
    starts = [F.col("dataset").startswith(prefix) for prefix in MART_PREFIXES]
    chosen = starts[0]
    for s in starts[1:]:
        chosen = chosen | s
    # One row per dataset folder: a few dozen names.
    return sorted(r["dataset"] for r in names.where(chosen).collect())


def published_name(domain: str, dataset: str) -> str:
    return dataset if dataset.startswith(f"{domain}_") else f"{domain}_{dataset}"


CATALOG_SCHEMA = "domain string, category string, dataset string, table string, rows bigint, cols int, path string, ok boolean"


def publish(spark: SparkSession, domain: str, source_root: str, target_root: str, datasets: list[str], category: str, run_id: str | None = None) -> DataFrame:
    """Copy datasets to the published area under their table name; returns catalog rows (SNK-05).

    With ``run_id`` tables go to folders of that run: what is published changes when ``write_catalog`` stores their rows.
    """
    rows = []
    for dataset in datasets:
        table = published_name(domain, dataset)
        stats = write_dataset(read_dataset(spark, source_root, dataset), f"{target_root}/{domain}", table, run_id=run_id)
        rows.append((domain, category, dataset, table, stats["record_count"], stats["column_count"], stats["path"], stats["record_count"] > 0))
    return spark.createDataFrame(rows, CATALOG_SCHEMA)


def write_catalog(catalog: DataFrame, target_root: str, domain: str, run_id: str) -> DataFrame:
    """Commit a publication: its rows are added as one file, and from then on they are the domain's catalog."""
    rows = catalog.select(F.lit(run_id).alias("run_id"), *catalog.columns)
    rows.coalesce(1).write.mode("append").json(f"{target_root}/_catalog/{domain}")
    return read_catalog(catalog.sparkSession, target_root, domain)


def read_catalog(spark: SparkSession, target_root: str, domain: str) -> DataFrame:
    """What is published of a domain: tables and where they lie."""
    return _newest_run(spark.read.schema(f"run_id string, {CATALOG_SCHEMA}").json(f"{target_root}/_catalog/{domain}")).drop("run_id")


def update_catalog(existing: DataFrame, new: DataFrame, domain: str, category: str) -> DataFrame:
    """Replace the rows of one domain and category, keep the others."""
    other = existing.where(~((F.col("domain") == domain) & (F.col("category") == category)))
    return other.unionByName(new)


def renamed_by_plan(catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """Apply a (domain, current, new) rename plan; names not in the plan stay."""
    joined = catalog.join(plan.select("domain", F.col("current").alias("dataset"), "new"), ["domain", "dataset"], "left")
    return joined.withColumn("table", F.coalesce("new", "table")).drop("new").select(*catalog.columns)
