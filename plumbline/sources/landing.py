"""Landing inventory: what arrived, what is it, is it whole (SRC-12, SRC-13)."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.sources.delimited import file_name
from plumbline.sources.records import UNDEFINED_1252

# Line hashes are reduced by this prime, so that their sums by place stay exact in 38 digits.
PRIME = 1_000_000_007

# The entity names that occur in landed file names, accents and case removed.
CONTRACT_ENTITIES = {
    "compras": "contratos",
    "itemcompra": "itens_contrato",
    "termoaditivo": "termos_aditivos",
    "apostilamento": "apostilamentos",
}
TENDER_ENTITIES = {
    "licitacao": "licitacoes",
    "itemlicitacao": "itens_licitacao",
    "participanteslicitacao": "participantes_licitacao",
    "empenhosrelacionados": "empenhos_relacionados",
}


def _folded(c: Column) -> Column:
    plain = F.translate(F.lower(c), "áàâãäéêíóôõúüç", "aaaaaeeiooouuc")
    return F.regexp_replace(plain, "[^a-z0-9]", "")


def _lookup(c: Column, names: dict[str, str]) -> Column:
    pairs = [F.lit(x) for pair in names.items() for x in pair]
    return F.try_element_at(F.create_map(*pairs), c)


def classify(files: DataFrame, entities: dict[str, str]) -> DataFrame:
    """Entity, period and the reason why a file is ignored, from the ``file`` column."""
    name = file_name("file")
    source = F.nullif(F.regexp_extract(name, r"(?i)^\d{6}_(.+)\.csv$", 1), F.lit(""))
    period = F.nullif(F.regexp_extract(name, r"(?i)^(\d{6})_.+\.csv$", 1), F.lit(""))
    out = files.withColumn("source_entity", source).withColumn("periodo", period)
    out = out.withColumn("entity", _lookup(_folded(F.col("source_entity")), entities))
    reason = F.when(F.col("source_entity").isNull(), F.lit("nome_fora_do_padrao")).when(
        F.col("entity").isNull(), F.concat(F.lit("entidade_nao_reconhecida:"), F.col("source_entity"))
    )
    return out.withColumns(
        {
            "ano": F.substring("periodo", 1, 4).try_cast("int"),
            "mes": F.substring("periodo", 5, 2).try_cast("int"),
            "reason": reason,
        }
    )


def _landed(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")


def _path(c: Column) -> Column:
    """The path that an address stands for: ``a%20b`` is ``a b``."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def _files(spark: SparkSession, root: str) -> DataFrame:
    """Every landed file and its size; a file of no bytes is listed, but no reader returns anything of it."""
    names = [unquote(f).replace("file:///", "file:/", 1) for f in _landed(spark).text(root).inputFiles()]
    sizes = _landed(spark).format("binaryFile").load(root).select(_path(F.col("_metadata.file_path")).alias("file"), F.col("length").alias("_size"))
    listed = spark.createDataFrame([(n,) for n in names], "file string").join(sizes, "file", "left")
    return listed.select("file", F.coalesce("_size", F.lit(0)).cast("bigint").alias("file_size_bytes"))


def _line_facts(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Per file: content digest and encoding; and its first line. One splittable scan of raw bytes each."""
    lines = _landed(spark).text(root).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_place"),
    )
    bytes_ = F.decode(F.col("value").cast("binary"), "ISO-8859-1")
    digit = F.pmod(F.xxhash64("value"), F.lit(PRIME)).cast("decimal(38,0)")
    splits = lines.groupBy("file", "_split").agg(
        F.count(F.lit(1)).cast("decimal(38,0)").alias("n"),
        F.sum(digit).alias("plain"),
        F.sum((digit * F.col("_place")).cast("decimal(38,0)")).alias("placed"),
        F.min("_place").cast("decimal(38,0)").alias("first"),
        F.bool_and(F.is_valid_utf8("value")).alias("utf8"),
        F.bool_and(~bytes_.rlike(UNDEFINED_1252)).alias("cp1252"),
    )
    # A line counts by its place in the file, whatever the splits: its split's earlier lines come on top.
    earlier = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")
    places = splits.withColumn("by_place", (F.col("placed") + shift * F.col("plain")).cast("decimal(38,0)"))
    facts = places.groupBy("file").agg(
        F.sha2(F.concat_ws(":", *[F.sum(c).cast("decimal(38,0)").cast("string") for c in ("n", "plain", "by_place")]), 256).alias("content_digest"),
        F.when(F.bool_and("utf8"), "utf-8-sig").when(F.bool_and("cp1252"), "cp1252").otherwise("latin-1").alias("encoding"),
    )
    # Only lines of first splits enter, and one of each leaves its task.
    text = (
        F.when(F.is_valid_utf8("value"), F.col("value"))
        .when(~bytes_.rlike(UNDEFINED_1252), F.decode(F.col("value").cast("binary"), "windows-1252"))
        .otherwise(bytes_)
    )
    heads = lines.where("_split = 0 and length(value) > 0").groupBy("file").agg(F.min_by(text, "_place").alias("_header"))
    return facts.withColumn("file", _path(F.col("file"))), heads.withColumn("file", _path(F.col("file")))


def _records(spark: SparkSession, root: str, breaks: bool) -> DataFrame:
    """The file of each record, headers included; split where the source is declared free of line breaks."""
    read = (
        _landed(spark)
        .schema("c string")
        .option("sep", ";")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", breaks)
        .option("encoding", "ISO-8859-1")
        .csv(root)
    )
    return read.select(F.col("_metadata.file_path").alias("file"))


def inventory(spark: SparkSession, root: str, entities: dict[str, str] | None = None, breaks: bool = True) -> DataFrame:
    """One row per file: size, content digest, encoding, header, layout signature, records.

    The digest stands for the lines, their order and number (not the SHA-256 of the file's bytes), so it
    has one definition for every size. Records are counted by the reader that will read them: a quoted
    line break doesn't end one, so each file passes through one task; only a landing that is declared free
    of them (``breaks=False``, as for ``read_delimited``) is split. The header is one line.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    listed = _files(spark, root)
    facts, heads = _line_facts(spark, root)
    records = _records(spark, root, breaks).groupBy("file").agg(F.count(F.lit(1)).alias("_records")).withColumn("file", _path(F.col("file")))
    header = F.split(F.ltrim(F.regexp_replace("_header", "[\"\ufeff]", "")), ";")
    empty = F.sha2(F.lit("0"), 256)
    out = (
        listed.join(facts, "file", "left")
        .join(records, "file", "left")
        .join(heads, "file", "left")
        .withColumn("content_digest", F.coalesce("content_digest", empty))
        .withColumn("encoding", F.coalesce("encoding", F.lit("utf-8-sig")))
        .withColumn("columns", header)
        .withColumn("record_count", F.greatest(F.coalesce("_records", F.lit(0)) - 1, F.lit(0)))
        .withColumn("column_count", F.when(F.col("columns").isNotNull(), F.size("columns")).otherwise(0))
        .withColumn("layout_signature", F.sha2(F.concat_ws("|", F.coalesce("columns", F.array().cast("array<string>"))), 256))
        .withColumn("empty_file", F.col("record_count") == 0)
        .drop("_records", "_header")
    )
    return classify(out, entities) if entities else out


def totals_by_entity(files: DataFrame) -> DataFrame:
    return files.where("reason is null").groupBy("entity").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("record_count").alias("records"),
        F.count_if("empty_file").alias("empty_files"),
    )


def layouts(files: DataFrame) -> DataFrame:
    """Distinct header layouts and how many files have each."""
    return files.where("reason is null").groupBy("entity", "layout_signature").agg(
        F.first("columns").alias("columns"), F.first("column_count").alias("column_count"), F.count(F.lit(1)).alias("files")
    )


def ignored(files: DataFrame) -> DataFrame:
    return files.where("reason is not null").select("file", "reason")


def period_range(files: DataFrame, outdated_before: str) -> DataFrame:
    """First and last period and whether the source stopped before a given month."""
    return files.where("reason is null").agg(
        F.count_distinct("periodo").alias("period_count"),
        F.min("periodo").alias("first_period"),
        F.max("periodo").alias("last_period"),
        F.coalesce(F.max("periodo") < outdated_before, F.lit(False)).alias("source_outdated"),
    )
