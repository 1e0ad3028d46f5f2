"""Sources, sinks, inventory and incremental landing: the given tables written out, then read back.

Files go to a new folder under the shared checkpoint folder of the session.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.numbers import brazilian_decimal, whole_number
from plumbline.operators import dedup
from plumbline.operators.dimensions import calendar
from plumbline.operators.gates import landing_approval
from plumbline.operators.unions import void_to_string
from plumbline.plans import amendments, runner
from plumbline.runtime import ensure_checkpoint_dir
from plumbline.sources import delimited, documents, records, tables
from plumbline.sources import landing as inventory
from plumbline.sources.tables import new_run_id
from plumbline.streaming import snapshots
from plumbline.streaming.landing import land_once, landed_rows
from plumbline.workload.base import calendar_sql, query, staged, table


def scratch(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/plumbline-{uuid.uuid4().hex}"


def _write_text(df: DataFrame, path: str, encoding: str) -> None:
    df.write.option("sep", ";").option("header", True).option("encoding", encoding).option("quoteAll", True).option("escape", '"').csv(path)


_PEOPLE = """SELECT c_custkey AS codigo, CASE WHEN c_custkey % 5 = 0 THEN 'São "' || c_name || '"' || chr(10) || 'linha dois; fim' ELSE 'São ' || c_name END AS nome, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'Não' END AS situacao, c_acctbal AS valor FROM {customer}"""


def _landed(spark: SparkSession, sf: str, encoding: str) -> str:
    path = scratch(spark)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = staged(spark, sf, _PEOPLE)
    text = rows.select(
        F.col("codigo").cast("string").alias("Código"), F.col("nome").alias("Nome"), F.col("situacao").alias("Situação"),
        F.translate(F.format_number("valor", 2), ",.", ".,").alias("Valor (R$)"),
    )
    _write_text(text, path, encoding)
    return path


def _typed(df: DataFrame) -> DataFrame:
    return df.select(whole_number("codigo").alias("codigo"), "nome", "situacao", brazilian_decimal("valor_r").alias("valor"))


query("src_01_cp1252_delimited", _PEOPLE)(
    lambda s, d: _typed(delimited.normalized_headers(delimited.read_delimited(s, _landed(s, d, delimited.CP1252))))
)
BROKEN = """
    UNION ALL SELECT s_suppkey + 1000000, 'F ' || CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 2 = 1 THEN 'x' END, CASE WHEN s_suppkey % 2 = 1 THEN 1.5 END, 'ragged' FROM {supplier}
    UNION ALL SELECT n_nationkey + 2000000, 'ok', 'x', 1.0, NULL FROM {nation}
    UNION ALL SELECT n_nationkey + 3000000, 'b�', 'x', 1.0, 'undecodable' FROM {nation}
    UNION ALL SELECT n_nationkey + 4000000, 'aberto', NULL, NULL, 'unclosed_quote' FROM {nation}
    UNION ALL SELECT n_nationkey + 5000000, 'fim', 'y', 2.0, NULL FROM {nation}"""


def _broken(spark: SparkSession, sf: str) -> list[str]:
    """The people, rows that are too short or too long, and a file for each nation with a quote that is never closed and a byte that is no UTF-8."""
    path, torn = _landed(spark, sf, delimited.UTF8), scratch(spark)
    lines = staged(
        spark, sf,
        """SELECT 'Código;Nome;Situação;Valor (R$)' AS value UNION ALL
        SELECT CAST(s_suppkey + 1000000 AS STRING) || ';F ' || CAST(s_suppkey AS STRING) || CASE WHEN s_suppkey % 2 = 1 THEN ';x;1,50;sobra' ELSE '' END FROM {supplier}""",
    )
    lines.coalesce(1).write.mode("append").text(path)
    files = table(spark, sf, "nation").select(
        "n_nationkey",
        F.concat(
            F.lit("Código;Nome;Situação;Valor (R$)\n"), F.col("n_nationkey") + 2000000, F.lit(";ok;x;1,00\n"), F.col("n_nationkey") + 3000000, F.lit(";b"),
            F.unhex(F.lit("E9")).cast("string"), F.lit(";x;1,00\n"), F.col("n_nationkey") + 4000000, F.lit(';"aberto\n\n'), F.col("n_nationkey") + 5000000, F.lit(";fim;y;2,00"),
        ).alias("value"),
    )
    files.repartition("n_nationkey").write.partitionBy("n_nationkey").text(torn)
    return [path, f"{torn}/n_nationkey=*"]


@query("src_03_tolerant_utf8_delimited", _PEOPLE.replace(" FROM {customer}", ", CAST(NULL AS VARCHAR) AS motivo FROM {customer}") + BROKEN)
def tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """Every record that was landed, and what is wrong with it: short ones are padded with null, long ones cut, none is lost."""
    found = records.read_records(spark, _broken(spark, sf), encoding=delimited.UTF8)
    typed = delimited.normalized_headers(found.drop(delimited.SPLIT, delimited.PLACE, records.RAW).withColumnRenamed(records.REASON, "motivo"))
    return typed.select(whole_number("codigo").alias("codigo"), "nome", "situacao", brazilian_decimal("valor_r").alias("valor"), "motivo")


@query(
    "snk_07_rejected_records",
    """SELECT motivo, count(*) AS registros, count(DISTINCT codigo) AS distintos FROM (
        SELECT c_custkey AS codigo, CAST(NULL AS VARCHAR) AS nome, CAST(NULL AS VARCHAR) AS situacao, c_acctbal AS valor, CAST(NULL AS VARCHAR) AS motivo FROM {customer}"""
    + BROKEN
    + ") GROUP BY 1",
)
def rejected_records(spark: SparkSession, sf: str) -> DataFrame:
    """Accepted records as a dataset, rejected ones beside it with their reason; read back, they are all that was landed."""
    root = scratch(spark)
    found = records.read_records(spark, _broken(spark, sf), encoding=delimited.UTF8)
    tables.write_accepted(found, root, "pessoas", new_run_id())
    code = F.substring_index(records.RAW, ";", 1)
    stored = tables.read_dataset(spark, root, "pessoas").select(F.lit(None).cast("string").alias("motivo"), F.col("`Código`").alias("codigo"))
    refused = tables.read_rejects(spark, root, "pessoas").select(F.col(records.REASON).alias("motivo"), code.alias("codigo"))
    return stored.unionByName(refused).groupBy("motivo").agg(F.count(F.lit(1)).alias("registros"), F.count_distinct("codigo").alias("distintos"))


@query(
    "src_01_strict_refuses",
    """SELECT 'inteiro' AS caso, count(*) AS lidos FROM {customer} UNION ALL SELECT unnest(['ragged', 'undecodable', 'unclosed_quote']), NULL""",
)
def strict_refuses(spark: SparkSession, sf: str) -> DataFrame:
    """Strict reading of whole files gives all rows; of a landing with a record of one broken kind it fails and names the kind."""
    whole = delimited.read_delimited(spark, _landed(spark, sf, delimited.CP1252))
    out = whole.agg(F.lit("inteiro").alias("caso"), F.count(F.lit(1)).alias("lidos"))
    found = records.read_records(spark, _broken(spark, sf), encoding=delimited.UTF8)
    for kind in (records.RAGGED, records.UNDECODABLE, records.UNCLOSED):
        mine = records.checked(found.where(F.coalesce(F.col(records.REASON), F.lit(kind)) == kind))
        try:
            lidos, caso = mine.count(), kind
        except Exception as error:
            lidos, caso = None, next((k for k in (records.RAGGED, records.UNDECODABLE, records.UNCLOSED) if f"({k})" in str(error)), "?")
        out = out.unionByName(spark.createDataFrame([(caso, lidos)], "caso string, lidos bigint"))
    return out


query("src_07_snake_cased_utf8", _PEOPLE)(lambda s, d: _typed(delimited.read_snake_cased(s, _landed(s, d, delimited.UTF8))))


@query(
    "src_02_14_mapped_history_file",
    """SELECT CAST(2000 + l_linenumber AS VARCHAR) || CAST(l_orderkey AS VARCHAR) AS codigo_emenda, CAST(NULL AS VARCHAR) AS favorecido,
    CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE 'Associação' END AS natureza_juridica, l_extendedprice AS valor FROM {lineitem}""",
)
def mapped_history(spark: SparkSession, sf: str) -> DataFrame:
    """A windows-1252 history file with its mandatory headers and three spellings of no value."""
    headers = amendments.HEADERS["favorecidos"]
    source = staged(
        spark, sf,
        """SELECT CAST(2000 + l_linenumber AS STRING) || CAST(l_orderkey AS STRING) AS codigo, CASE WHEN l_orderkey % 2 = 0 THEN 'S/I' ELSE 'Sem informação' END AS f,
        CASE WHEN l_partkey % 2 = 0 THEN '' ELSE 'Associação' END AS nj, l_extendedprice AS v FROM {lineitem}""",
    )
    filled = {h: F.lit("1") for h in headers} | {
        "Código da Emenda": F.col("codigo"),
        "Favorecido": F.col("f"),
        "Natureza Jurídica": F.col("nj"),
        "Valor Recebido": F.translate(F.format_number("v", 2), ",.", ".,"),
    }
    path = scratch(spark)
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    _write_text(source.select(*[c.alias(h) for h, c in filled.items()]), path, delimited.CP1252)
    read = delimited.read_mapped(spark, path, headers, amendments.column_of, amendments.NULL_TOKENS)
    return read.select("codigo_emenda", "favorecido", "natureza_juridica", brazilian_decimal("valor_recebido").alias("valor"))


@query("exp_28_line_numbers", "SELECT count(*) AS linhas, count(*) AS distintas, 2::BIGINT AS primeira, TRUE AS sem_lacuna FROM {orders}")
def line_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """Physical line numbers over all files of a folder: unique per file, from 2, without gaps."""
    path = scratch(spark)
    _write_text(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), path, delimited.UTF8)
    numbered = delimited.with_line_numbers(delimited.read_delimited(spark, path, encoding=delimited.UTF8))
    per_file = numbered.groupBy(delimited.FILE).agg(
        F.count(F.lit(1)).alias("n"), F.min("linha_arquivo").alias("lo"), F.max("linha_arquivo").alias("hi"), F.count_distinct("linha_arquivo").alias("u")
    )
    return per_file.agg(
        F.sum("n").alias("linhas"), F.sum("u").alias("distintas"), F.min("lo").alias("primeira"), F.bool_and(F.col("hi") - F.col("lo") + 1 == F.col("n")).alias("sem_lacuna")
    )


query("exp_27_source_lineage", "SELECT count(*) AS linhas, TRUE AS com_arquivo FROM {customer}")(
    lambda s, d: delimited.with_period_lineage(delimited.read_delimited(s, _landed(s, d, delimited.UTF8), encoding=delimited.UTF8)).agg(
        F.count(F.lit(1)).alias("linhas"), F.bool_and(F.col("arquivo_origem").endswith(".csv") & F.col("periodo_origem").isNull()).alias("com_arquivo")
    )
)


@query("src_06_nested_document", "SELECT event_id AS id, CAST(props ->> '$.k' AS BIGINT) AS k FROM {events}")
def nested_document(spark: SparkSession, sf: str) -> DataFrame:
    """Events as nested JSON records, read with a schema and drilled to the array."""
    path = scratch(spark)
    record = F.struct("event_id", F.from_json("props", "k int").alias("props"))
    # A document holds a few thousand events and is a file of its own.
    held = table(spark, sf, "events").groupBy(F.expr("event_id div 4000").alias("n")).agg(F.collect_list(record).alias("Evento"))
    held.select("n", F.to_json(F.struct(F.struct("Evento").alias("Lista"))).alias("value")).write.partitionBy("n").text(path)
    schema = "Lista struct<Evento:array<struct<event_id:bigint,props:struct<k:int>>>>"
    record = documents.read_nested(spark, path, "Lista.Evento", schema)
    return record.select(F.col("event_id").alias("id"), F.col("props.k").alias("k"))


@query("src_08_09_dataset_columns", "SELECT c_custkey, c_mktsegment FROM {customer}")
def dataset_columns(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    tables.write_dataset(table(spark, sf, "customer"), root, "clientes", csv=False)
    return tables.read_dataset(spark, root, "clientes", ["c_custkey", "c_mktsegment"])


@query("src_11_latest_execution", "SELECT o_orderkey, o_custkey FROM {orders} WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM {orders})")
def newest_execution(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.concat(F.year("o_orderdate").cast("string"), F.lit("0101T000000Z")).alias("execucao")
    )
    tables.write_dataset(rows, root, "pedidos", csv=False, partition_by=["execucao"])
    return tables.latest_execution(tables.read_dataset(spark, root, "pedidos")).select("o_orderkey", "o_custkey")


@query(
    "src_12_landing_inventory",
    "SELECT count(*) AS registros, 4::BIGINT AS colunas, 1::BIGINT AS layouts, TRUE AS com_hash, TRUE AS aprovado FROM {customer}",
)
def landing_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Records, columns, layouts and digests of everything that was landed."""
    found = inventory.inventory(spark, _landed(spark, sf, delimited.CP1252))
    return found.agg(
        F.sum("record_count").alias("registros"), F.max("column_count").alias("colunas"),
        F.count_distinct("layout_signature").alias("layouts"), F.bool_and(F.length("content_digest") == 64).alias("com_hash"),
        F.bool_and(F.col("file_size_bytes") > 0).alias("aprovado"),
    )


@query(
    "pip_06_bronze_approval",
    """SELECT 'inteiro' AS caso, TRUE AS aprovado, count(*) AS registros FROM {customer} UNION ALL SELECT 'vazio', FALSE, count(*) FROM {supplier}""",
)
def bronze_approval(spark: SparkSession, sf: str) -> DataFrame:
    """A whole landing is approved; one with a file of no bytes is not."""
    out = []
    for case, name in (("inteiro", "customer"), ("vazio", "supplier")):
        path = scratch(spark)
        _write_text(table(spark, sf, name), path, delimited.UTF8)
        if case == "vazio":
            place = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/empty.csv")
            place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place).close()
        found = inventory.inventory(spark, path)
        verdict = landing_approval(found).select(F.lit(case).alias("caso"), F.col("approved").alias("aprovado"))
        out.append(verdict.join(found.agg(F.lit(case).alias("caso"), F.sum("record_count").alias("registros")), "caso"))
    return out[0].unionByName(out[1])


@query(
    "snk_01_write_dataset",
    "SELECT l_returnflag, count(*) AS n FROM {lineitem} GROUP BY 1 UNION ALL SELECT 'total', count(*) FROM {lineitem} UNION ALL SELECT 'csv', count(*) FROM {lineitem}",
)
def write_dataset(spark: SparkSession, sf: str) -> DataFrame:
    """Parquet and CSV of a table, clustered by its presentation order; the observed count is a row too."""
    root = scratch(spark)
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_returnflag", "l_extendedprice")
    stats = tables.write_dataset(rows, root, "itens", order_by=[F.col("l_extendedprice").desc_nulls_last()])
    per_flag = tables.read_dataset(spark, root, "itens").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"))
    observed = spark.range(1).select(F.lit("total").alias("l_returnflag"), F.lit(stats["record_count"]).cast("bigint").alias("n"))
    csv = spark.read.option("sep", ";").option("header", True).csv(f"{root}/itens/csv").agg(F.count(F.lit(1)).alias("n"))
    return per_flag.unionByName(observed).unionByName(csv.select(F.lit("csv").alias("l_returnflag"), "n"))


@query(
    "snk_01_versioned_commit",
    """SELECT 'primeira' AS momento, 'pedidos' AS tabela, count(*) AS n FROM {orders} UNION ALL SELECT 'primeira', 'clientes', count(*) FROM {customer}
    UNION ALL SELECT 'após falha', 'pedidos', count(*) FROM {orders} UNION ALL SELECT 'após falha', 'clientes', count(*) FROM {customer}
    UNION ALL SELECT 'segunda', 'pedidos', count(CASE WHEN o_custkey % 2 = 0 THEN 1 END) FROM {orders} UNION ALL SELECT 'segunda', 'clientes', count(CASE WHEN c_custkey % 2 = 0 THEN 1 END) FROM {customer}""",
)
def versioned_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A layer is what its newest committed run wrote: a run that dies between two tables changes nothing, the next one both."""
    root = scratch(spark)
    whole = {"pedidos": table(spark, sf, "orders"), "clientes": table(spark, sf, "customer")}
    halves = {"pedidos": whole["pedidos"].where("o_custkey % 2 = 0"), "clientes": whole["clientes"].where("c_custkey % 2 = 0")}
    dies = halves | {"clientes": halves["clientes"].withColumn("c_name", F.raise_error(F.lit("lost")).cast("string"))}
    out = None
    for moment, tables_ in (("primeira", whole), ("após falha", dies), ("segunda", halves)):
        try:
            runner.write_layer(tables_, root, "dados", "silver")
        except Exception:
            if moment != "após falha":
                raise
        for name, df in runner.read_layer(spark, root, "silver").items():
            seen = df.agg(F.lit(moment).alias("momento"), F.lit(name).alias("tabela"), F.count(F.lit(1)).alias("n"))
            out = seen if out is None else out.unionByName(seen)
    return out


query("snk_02_void_columns", "SELECT r_regionkey, r_name, CAST(NULL AS VARCHAR) AS vazio FROM {region}", wide=("r_regionkey",))(
    lambda s, d: void_to_string(table(s, d, "region").withColumn("vazio", F.lit(None)))
)


@query(
    "snk_03_manifest",
    """SELECT 'nation' AS dataset, count(*) AS record_count, 3::BIGINT AS column_count, TRUE AS approved, CAST(NULL AS BIGINT) AS input_rows, CAST(NULL AS BIGINT) AS removed_rows,
    '202501' AS first_period FROM {nation}
    UNION ALL SELECT 'pedidos', count(DISTINCT o_custkey), 3, TRUE, count(*), count(*) - count(DISTINCT o_custkey), '202501' FROM {orders}""",
)
def manifest(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    raw = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("dir/20250"), F.col("o_custkey") % 3 + 1, F.lit("_Pedidos.csv")).alias("arquivo_origem"))
    latest = dedup.keep_first(raw, ["o_custkey"], [F.col("o_orderkey").desc()])
    outputs = [tables.write_dataset(table(spark, sf, "nation"), root, "nation", csv=False), tables.write_dataset(latest, root, "pedidos", csv=False)]
    files = raw.select(F.col("arquivo_origem").alias("file")).distinct()
    control = delimited.row_control_of(raw, latest, files).withColumn("dataset", F.lit("pedidos"))
    # An earlier run is kept beside the one that counts.
    tables.write_manifest(spark, root, "dados", "silver", outputs[:1], approved=False)
    tables.write_manifest(spark, root, "dados", "silver", outputs, approved=True, periods=("202501", "202503"), control=control)
    columns = ["dataset", "record_count", "column_count", "approved", "input_rows", "removed_rows", "first_period"]
    return tables.read_manifest(spark, root, "silver").select(*columns)


@query("snk_04_partitioned_layout", "SELECT year(o_orderdate) AS ano, month(o_orderdate) AS mes, count(*) AS n FROM {orders} GROUP BY 1, 2")
def partitioned_layout(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch(spark)
    rows = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes"))
    # Rows of one partition value meet before the write, so a value is a few files, not one per task.
    tables.write_dataset(rows.repartition("ano", "mes"), root, "pedidos", csv=False, partition_by=["ano", "mes"])
    return tables.read_dataset(spark, root, "pedidos").groupBy("ano", "mes").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk_05_publish_and_catalog",
    """SELECT 'vendas_fato_pedidos' AS "table", 'gold' AS category, count(*) AS rows, TRUE AS ok FROM {orders}
    UNION ALL SELECT 'vendas_ranking_clientes', 'gold', count(*), TRUE FROM {customer} UNION ALL SELECT 'novo_nome', 'dimension', count(*), TRUE FROM {nation}""",
)
def publish(spark: SparkSession, sf: str) -> DataFrame:
    """Marts chosen by prefix, dimensions published beside them, one renamed by plan."""
    gold, target = scratch(spark), scratch(spark)
    for name, source in (("fato_pedidos", "orders"), ("ranking_clientes", "customer"), ("rascunho", "region")):
        tables.write_dataset(table(spark, sf, source), gold, name, csv=False)
    tables.write_dataset(table(spark, sf, "nation"), f"{gold}/dimensions", "dim_nacao", csv=False)
    catalog = tables.publish(spark, "vendas", gold, target, tables.find_marts(spark, gold), "gold")
    dims = tables.publish(spark, "vendas", f"{gold}/dimensions", target, ["dim_nacao"], "dimension")
    full = tables.update_catalog(tables.update_catalog(catalog, dims, "vendas", "dimension"), dims, "vendas", "dimension")
    plan = spark.createDataFrame([("vendas", "dim_nacao", "novo_nome")], "domain string, current string, new string")
    return tables.renamed_by_plan(full, plan).select("table", "category", "rows", "ok")


@query("pip_05_each_file_lands_once", "SELECT count(*) AS linhas, count(*) AS primeira_vez, 0::BIGINT AS segunda_vez FROM {events}")
def lands_once(spark: SparkSession, sf: str) -> DataFrame:
    """An available-now stream over landed files; the second run finds nothing new."""
    source, target, checkpoint = scratch(spark), scratch(spark), scratch(spark)
    rows = table(spark, sf, "events").select(F.col("event_id").cast("string").alias("id"), "event_type")
    rows.write.option("sep", ";").option("header", True).csv(source)
    first = land_once(landed_rows(spark, source, ["id", "event_type"]), target, checkpoint)
    second = land_once(landed_rows(spark, source, ["id", "event_type"]), target, checkpoint)
    landed = spark.read.parquet(target).agg(F.count_distinct("id").alias("linhas"))
    return landed.select("linhas", F.lit(first).cast("bigint").alias("primeira_vez"), F.lit(second).cast("bigint").alias("segunda_vez"))


_ORDERED = "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y%m') AS periodo FROM {orders}"


def _followed(spark: SparkSession, sf: str, group: list[str], merge: snapshots.Merge) -> DataFrame:
    """Orders land in two sets, newer keys first; each is merged by a run of its own, and a third run finds nothing."""
    source, landed, target, checkpoint = (scratch(spark) for _ in range(4))
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyyMM").alias("periodo"))

    def typed(df: DataFrame) -> DataFrame:
        return df.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"), "periodo")

    for part in (F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 3 == 0, F.lit(False)):
        rows.where(part).write.mode("append").option("sep", ";").option("header", True).csv(source)
        snapshots.land(landed_rows(spark, source, rows.columns), landed, checkpoint)
        snapshots.follow(spark, landed, target, group, merge, typed)
    return snapshots.read_snapshot(spark, target)


query("ddp_05_incremental_snapshot", f"SELECT * FROM ({_ORDERED}) QUALIFY periodo = max(periodo) OVER (PARTITION BY o_custkey)", wide=("o_orderkey", "o_custkey"))(
    lambda s, d: _followed(s, d, ["o_custkey"], snapshots.latest_period("o_custkey", "periodo"))
)
query(
    "ddp_01_incremental_latest",
    f"SELECT * FROM ({_ORDERED}) QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY periodo DESC, o_orderkey DESC) = 1",
    wide=("o_orderkey", "o_custkey"),
)(lambda s, d: _followed(s, d, ["o_custkey"], snapshots.latest_row(["o_custkey"], [F.col("periodo").desc(), F.col("o_orderkey").desc()])))


@query("src_04_text_with_file_and_year", "SELECT o_orderkey, o_orderpriority, year(o_orderdate) AS ano_arquivo_origem, TRUE AS numerada FROM {orders}")
def text_with_file_and_year(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly folders read as text; year and file come from the path, the line from the position."""
    path = scratch(spark)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("ano"))
    rows.repartition("ano").write.partitionBy("ano").option("sep", ";").option("header", True).csv(path)
    read = delimited.read_delimited(spark, f"{path}/ano=*/*.csv", encoding=delimited.UTF8)
    lined = runner.year_lineage(read, r"ano=(\d{4})")
    return lined.select(
        whole_number("o_orderkey").alias("o_orderkey"), "o_orderpriority", "ano_arquivo_origem", (F.col("linha_arquivo") >= 2).alias("numerada")
    )


PAGE_ROWS = 500


@query(
    "src_05_paged_json",
    "SELECT CAST(o_orderkey AS VARCHAR) AS codigo_emenda, CAST(year(o_orderdate) AS VARCHAR) AS ano, o_totalprice AS valor_pago FROM {orders}",
)
def paged_json(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of at most 500 records, each one JSON list and one file; all in one folder, as a folder per page would be made, renamed and listed one by one."""
    path = scratch(spark)
    record = {c: F.lit("x") for c in amendments.PAGE_COLUMNS} | {
        "codigoEmenda": F.col("o_orderkey").cast("string"),
        "ano": F.year("o_orderdate").cast("string"),
        "valorPago": F.translate(F.format_number("o_totalprice", 2), ",.", ".,"),
    }
    page = F.floor(F.col("o_orderkey") / PAGE_ROWS).alias("page")
    pages = table(spark, sf, "orders").groupBy(page).agg(F.to_json(F.collect_list(F.struct(*[c.alias(n) for n, c in record.items()]))).alias("value"))
    pages.select("value").write.option("maxRecordsPerFile", 1).text(f"{path}/pagina_todas.json")
    read = documents.read_pages(spark, path, amendments.PAGE_COLUMNS)
    return amendments.silver_api_pages(read).select("codigo_emenda", "ano", "valor_pago")


@query(
    "src_10_periods_and_row_control",
    """SELECT CAST(year(o_orderdate) AS VARCHAR) || '01' AS period, count(*) AS input_rows, count(CASE WHEN o_orderkey % 5 <> 0 THEN 1 END) AS output_rows
    FROM {orders} WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1""",
)
def periods_and_row_control(spark: SparkSession, sf: str) -> DataFrame:
    """One landed set per period; the period is in the name, rows in and out are counted per set."""
    root = scratch(spark)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("y"))
    years = sorted(r["y"] for r in rows.select("y").distinct().collect())
    paths = [f"{root}/{year}01_Compras.csv" for year in years]
    for year, path in zip(years, paths, strict=True):
        _write_text(rows.where(F.col("y") == year).drop("y"), path, delimited.UTF8)
    read = delimited.read_delimited(spark, paths, encoding=delimited.UTF8)
    # A set is a folder of part files here; its name is the parent of the file.
    raw = read.withColumn(delimited.FILE, F.regexp_replace(delimited.FILE, "/[^/]+$", ""))
    clean = delimited.in_periods(delimited.with_period_lineage(raw), "199601", "200001").where(whole_number("o_orderkey") % 5 != 0)
    sets = raw.select(F.col(delimited.FILE).alias("file")).distinct().where(delimited.period_of("file").between("199601", "200001"))
    return delimited.row_control(raw, clean, sets).select("period", "input_rows", "output_rows")


@query(
    "src_13_encoding_detection",
    "SELECT 'cp1252' AS encoding, count(*) AS registros FROM {customer} UNION ALL SELECT 'utf-8-sig', count(*) FROM {customer}",
)
def encoding_detection(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows landed in two encodings, told apart by their bytes."""
    found = [inventory.inventory(spark, _landed(spark, sf, e)) for e in (delimited.CP1252, delimited.UTF8)]
    return found[0].unionByName(found[1]).groupBy("encoding").agg(F.sum("record_count").alias("registros"))


query(
    "cal_01_calendar",
    calendar_sql("SELECT CAST(min(ts) AS DATE) AS lo, CAST(max(ts) AS DATE) AS hi FROM {events}"),
)(lambda s, d: calendar(table(s, d, "events"), "ts"))
