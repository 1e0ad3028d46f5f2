"""Layer runs: build, write, check, and refuse to go on without approval (PIP-01..04).

Everything is a function of a session and folders; a stage reads what the stage before wrote.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.checks import suite, typed_columns
from plumbline.operators.gates import GateError, approval, landing_approval, require_approved
from plumbline.plans import amendments, chamber, contracts, deputy_expenses, grants, senate, tenders
from plumbline.runtime import materialize
from plumbline.sources import delimited, documents, landing
from plumbline.sources.tables import new_run_id, publish, read_dataset, read_manifest, write_catalog, write_dataset, write_manifest

Tables = dict[str, DataFrame]

# Presentation order of the Gold tables, column -> descending.
PRESENTATION = {
    "ranking_parlamentares": {"ano_emenda": False, "valor_pago": True},
    "ranking_favorecidos": {"ano_emenda": False, "valor_recebido": True},
    "ranking_municipios": {"ano_emenda": False, "valor_pago": True},
    "relacionamento_autor_favorecido": {"ano_emenda": False, "nome_autor_emenda": False, "valor_recebido": True},
    "contratos_atuais_resumo": {"valor_final_total_grupo": True},
    "ranking_contratados": {"valor_final_total": True},
    "relacionamento_orgao_contratado": {"nome_orgao": False, "valor_final_total": True},
    "concorrencia_licitacoes": {"data_resultado_compra": True, "valor_licitacao": True},
    "relacionamento_orgao_fornecedor": {"nome_orgao": False, "valor_itens_vencidos": True},
    "fato_convenios": {"valor_convenio": True},
    "fato_gastos_deputados": {"ano_despesa": False, "mes_despesa": False, "codigo_beneficiario": False, "chave_despesa": False},
    "fato_votacoes": {"data_hora_registro": False, "id_votacao": False},
}


def presentation_order(name: str, df: DataFrame) -> list | None:
    """Sort keys of a table; missing dates and amounts come last (SRT-01/02)."""
    keys = {c: d for c, d in PRESENTATION.get(name, {}).items() if c in df.columns}
    return [F.col(c).desc_nulls_last() if d else F.col(c).asc_nulls_first() for c, d in keys.items()] or None


def write_layer(
    tables: Tables, root: str, subject: str, layer: str, approved: bool = True, notes: list[str] | None = None,
    upstream: str | None = None, periods: tuple[str, str] | None = None, control: Callable[[Tables], DataFrame] | None = None,
) -> DataFrame:
    """Write every table of a layer to folders of this run, then its manifest, which commits them all.

    A run that fails on the way leaves the layer as it was. ``control`` is asked for the rows in and out once the tables
    are stored, and is handed them.
    """
    run_id = new_run_id()
    outputs = [write_dataset(df, root, name, csv=False, order_by=presentation_order(name, df), run_id=run_id) for name, df in tables.items()]
    spark = next(iter(tables.values())).sparkSession
    rows = control({o["dataset"]: spark.read.parquet(o["path"]) for o in outputs}) if control else None
    return write_manifest(spark, root, subject, layer, outputs, approved, notes, run_id=run_id, upstream=upstream, periods=periods, control=rows)


def read_layer(spark: SparkSession, root: str, layer: str) -> Tables:
    """The tables of the newest run that was committed."""
    return {r["dataset"]: spark.read.parquet(r["path"]) for r in read_manifest(spark, root, layer).select("dataset", "path").collect()}


def write_checks(checks: DataFrame, root: str, name: str) -> DataFrame:
    """Store the check rows, then hand out what was stored."""
    write_dataset(checks.coalesce(1), root, name)
    return read_dataset(checks.sparkSession, root, name)


def manifest_state(spark: SparkSession, root: str, layer: str) -> tuple[bool, str, str | None]:
    """Of the newest run of a layer: approved, its id, and the run it was made from."""
    row = read_manifest(spark, root, layer).agg(F.bool_and("approved").alias("ok"), F.max("run_id").alias("run"), F.max("upstream").alias("up")).first()
    return bool(row["ok"]), row["run"], row["up"]


def require_manifest(spark: SparkSession, root: str, layer: str) -> str:
    """The id of the newest run of a layer; refuses one that was not approved."""
    approved, run_id, _ = manifest_state(spark, root, layer)
    if not approved:
        raise GateError(f"{layer} of {root} is not approved")
    return run_id


def require_landing(files: DataFrame) -> None:
    """Bronze gate: refuses a landing with a file of no bytes (PIP-06)."""
    verdict = landing_approval(files).first()
    if not verdict["approved"]:
        raise GateError(f"landing of {verdict['file_count']} files, {verdict['total_bytes']} bytes: a file is empty")


# ---------------------------------------------------------------- silver


def _period_files(
    spark: SparkSession, bronze: str, entities: dict[str, str], builders: dict, first: str, last: str
) -> tuple[Tables, DataFrame]:
    files = landing.classify(landing.inventory(spark, bronze).drop("reason"), entities).where("reason is null")
    files = materialize(files.where(F.col("periodo").between(first, last)))
    require_landing(files)
    # One row per layout, with its files: what a reader has to be told.
    listed = files.where("columns is not null").groupBy("entity", "columns").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    raw: Tables = {}
    for entity in builders:
        layouts = {tuple(row["columns"]): row["files"] for row in listed if row["entity"] == entity}
        if not layouts:
            raise FileNotFoundError(f"No landed file for {entity}")
        read = delimited.read_by_layout(spark, layouts)
        raw[entity] = delimited.with_period_lineage(delimited.normalized_headers(read))
    return raw, files


# The table that holds all rows of an entity, where it has another name.
HISTORY = {"contratos": "contratos_historico"}


def _file_control(files: DataFrame, raw: Tables, stored: Tables) -> DataFrame:
    """Rows in and out per dataset and landed file (SRC-10); files without rows stay."""
    out = None
    for entity, table in raw.items():
        mine = files.where(F.col("entity") == entity).select("file")
        found = delimited.row_control_of(table, stored[entity], mine).withColumn("dataset", F.lit(HISTORY.get(entity, entity)))
        out = found if out is None else out.unionByName(found)
    return out


def _run_silver_periods(spark: SparkSession, bronze: str, silver: str, first: str, last: str, subject: str, entities: dict[str, str], recipe) -> DataFrame:
    raw, files = _period_files(spark, bronze, entities, recipe.SILVER, first, last)
    tables = recipe.silver(raw)

    def control(stored: Tables) -> DataFrame:
        return _file_control(files, raw, {entity: stored[HISTORY.get(entity, entity)].select("arquivo_origem") for entity in raw})

    return write_layer(tables, silver, subject, "silver", periods=(first, last), control=control)


def run_silver_contracts(spark: SparkSession, bronze: str, silver: str, first: str, last: str) -> DataFrame:
    return _run_silver_periods(spark, bronze, silver, first, last, "contratos_federais", landing.CONTRACT_ENTITIES, contracts)


def run_silver_tenders(spark: SparkSession, bronze: str, silver: str, first: str, last: str) -> DataFrame:
    return _run_silver_periods(spark, bronze, silver, first, last, "licitacoes_federais", landing.TENDER_ENTITIES, tenders)


def run_silver_history(spark: SparkSession, files: dict[str, str], silver: str, years: list[int]) -> DataFrame:
    """Amendments, agreements and beneficiaries from the history files."""
    tables = {}
    for entity, build in amendments.SILVER.items():
        read = delimited.read_mapped(spark, files[entity], amendments.HEADERS[entity], amendments.column_of, amendments.NULL_TOKENS)
        tables[entity] = build(amendments.numbered(read), years)
    return write_layer(tables, silver, "historico_emendas", "silver")


def run_silver_api_amendments(spark: SparkSession, pages: str, silver: str) -> DataFrame:
    table = amendments.silver_api_pages(documents.read_pages(spark, pages, amendments.PAGE_COLUMNS))
    return write_layer({"emendas_api": table}, silver, "emendas", "silver")


def year_lineage(read: DataFrame, year: str) -> DataFrame:
    numbered = delimited.with_line_numbers(read)
    found = F.regexp_extract(F.col(delimited.FILE), year, 1).try_cast("int")
    return numbered.withColumns(
        {"ano_arquivo_origem": found, "arquivo_origem": delimited.file_name(delimited.FILE)}
    ).drop(delimited.FILE)


def run_silver_deputy_expenses(spark: SparkSession, bronze: str, silver: str) -> DataFrame:
    read = delimited.read_delimited(spark, f"{bronze}/ano=*/*.csv", encoding=delimited.UTF8, strict=False)
    raw = year_lineage(read, r"ano=(\d{4})")
    return write_layer({"despesas": deputy_expenses.silver_expenses(raw)}, silver, "gastos_deputados", "silver")


def run_silver_chamber(spark: SparkSession, bronze: str, silver: str) -> DataFrame:
    tables, preserved = {}, True
    for dataset in chamber.TYPED:
        read = delimited.read_delimited(spark, f"{bronze}/dataset={dataset}/ano=*/*.csv", encoding=delimited.UTF8)
        raw = year_lineage(read, r"ano=(\d{4})")
        tables[dataset] = chamber.silver_dataset(raw, dataset)
    run_id = new_run_id()
    outputs = [write_dataset(df, silver, name, csv=False, run_id=run_id) for name, df in tables.items()]
    for o in outputs:
        stored = spark.read.parquet(o["path"]).select("chave_registro")
        preserved &= stored.groupBy("chave_registro").count().where("count > 1").isEmpty()
    return write_manifest(spark, silver, "proposicoes_votacoes", "silver", outputs, preserved, run_id=run_id)


def run_silver_senate(spark: SparkSession, bronze: str, silver: str) -> DataFrame:
    senators = documents.read_nested(spark, f"{bronze}/dataset=senadores/senadores_atuais.json", senate.SENATORS_AT)
    bills = documents.read_nested(spark, f"{bronze}/dataset=materias/materias.json", senate.BILLS_AT)
    votings = documents.read_nested(spark, f"{bronze}/dataset=votacoes/votacoes.json")
    order = (delimited.FILE, "_line")

    def lines(path: str) -> DataFrame:
        return delimited.with_line_numbers(delimited.read_snake_cased(spark, path), "_line")

    tables = {
        "senadores": senate.silver_senators(senators),
        "materias": senate.silver_bills(bills),
        "votacoes": senate.silver_votings(votings),
        "votos": senate.silver_votes(votings),
        "ceaps": senate.silver_expenses(lines(f"{bronze}/dataset=ceaps/ano=*/*.csv"), *order),
        "empresas_contratadas": senate.silver_companies(lines(f"{bronze}/dataset=empresas_contratadas/*.csv"), *order),
    }
    return write_layer(tables, silver, "senado_federal", "silver")


# ---------------------------------------------------------------- gold, checks, dimensions

# Domain -> how its Gold tables are built from its Silver tables.
GOLD: dict[str, Callable[[Tables], Tables]] = {
    "contratos": contracts.gold,
    "licitacoes": tenders.gold,
    "convenios": lambda silver: grants.gold(silver["convenios"]),
    "emendas": amendments.gold,
    "gastos_deputados": lambda silver: deputy_expenses.gold(silver["despesas"]),
    "proposicoes_votacoes": chamber.gold,
    "senado_federal": senate.gold,
}

# Suites on Silver, asked before Gold is built.
QUALITY: dict[str, Callable[[Tables], DataFrame]] = {
    "contratos": contracts.quality,
    "licitacoes": tenders.quality,
    "convenios": lambda silver: grants.quality(silver["convenios"]),
    "emendas": amendments.quality,
}
# Domains whose suite needs Gold; it is asked before the dimensions are built.
GOLD_QUALITY = ("proposicoes_votacoes", "senado_federal")

RECONCILIATION: dict[str, Callable[[Tables, Tables], DataFrame]] = {
    "contratos": contracts.reconciliation,
    "licitacoes": tenders.reconciliation,
    "convenios": lambda silver, gold: grants.reconciliation(silver["convenios"], gold),
    "emendas": amendments.reconciliation,
    "gastos_deputados": lambda silver, gold: deputy_expenses.reconciliation(silver["despesas"], gold),
    "proposicoes_votacoes": chamber.reconciliation,
    "senado_federal": senate.quality,
}

# Name of the pass flag where a suite does not call it ``approved``.
FLAGS = {"emendas": "reconciliado", "senado_federal": "passed"}
QUALITY_FLAGS = {"proposicoes_votacoes": "passed", "senado_federal": "passed"}


def run_quality(spark: SparkSession, domain: str, silver: str, years: list[int] | None = None, gold: str | None = None) -> DataFrame:
    """The quality suite of any domain, stored. Chamber and Senate suites also look at Gold."""
    tables = read_layer(spark, silver, "silver")
    if domain in GOLD_QUALITY:
        if gold is None:
            raise ValueError(f"The suite of {domain} looks at Gold: name its folder")
        marts = read_layer(spark, gold, "gold")
        if domain == "senado_federal":
            found = senate.quality(tables, marts)
            # The offending rows themselves, beside the suite that counts them (SNK-06).
            for name, rows in senate.audit_extracts(marts).items():
                write_dataset(rows, f"{gold}/quality", name)
        else:
            approved, run_id, _ = manifest_state(spark, silver, "silver")
            _, _, made_from = manifest_state(spark, gold, "gold")
            found = chamber.quality(marts, approved, made_from == run_id)
        return write_checks(found, f"{gold}/quality", f"validacao_gold_{domain}")
    if domain == "gastos_deputados":
        found = deputy_expenses.quality(tables["despesas"], years or [])
    else:
        found = QUALITY[domain](tables)
    return write_checks(found, f"{silver}/quality", f"validacao_silver_{domain}")


def gate_quality(checks: DataFrame, domain: str) -> None:
    if "severity" not in checks.columns:
        checks = checks.withColumn("severity", F.lit("error"))
    require_approved(checks, f"quality of {domain}", QUALITY_FLAGS.get(domain, "approved"), only_errors=domain in GOLD_QUALITY)


def run_gold(spark: SparkSession, domain: str, silver: str, gold: str, years: list[int] | None = None) -> DataFrame:
    """Refuses unless Silver is approved and its quality suite, which is run here, passes."""
    upstream = require_manifest(spark, silver, "silver")
    if domain not in GOLD_QUALITY:
        gate_quality(run_quality(spark, domain, silver, years), domain)
    return write_layer(GOLD[domain](read_layer(spark, silver, "silver")), gold, domain, "gold", upstream=upstream)


def run_reconciliation(spark: SparkSession, domain: str, silver: str, gold: str) -> DataFrame:
    found = RECONCILIATION[domain](read_layer(spark, silver, "silver"), read_layer(spark, gold, "gold"))
    return write_checks(found, f"{gold}/reconciliation", f"reconciliacao_{domain}")


def gate_reconciliation(checks: DataFrame, domain: str) -> None:
    flag = FLAGS.get(domain, "approved")
    if "severity" not in checks.columns:
        checks = checks.withColumn("severity", F.lit("error"))
    require_approved(checks, f"reconciliation of {domain}", flag, only_errors=domain == "senado_federal")


def run_dimensions(
    spark: SparkSession, domain: str, silver: str, gold: str, checks: DataFrame,
    first: str | None = None, last: str | None = None, as_of_year: int | None = None,
) -> DataFrame:
    """Refuses unless Gold, its reconciliation and, where the suite looks at Gold, its quality are approved."""
    upstream = require_manifest(spark, gold, "gold")
    gate_reconciliation(checks, domain)
    if domain in GOLD_QUALITY:
        gate_quality(run_quality(spark, domain, silver, gold=gold), domain)
    builders: dict[str, Callable[[], Tables]] = {
        "contratos": lambda: contracts.dims(read_dataset(spark, silver, "contratos_atuais"), first, last),
        "licitacoes": lambda: tenders.dims(read_layer(spark, silver, "silver")),
        "convenios": lambda: grants.dims(read_layer(spark, gold, "gold")),
        "emendas": lambda: amendments.dims(read_layer(spark, gold, "gold"), as_of_year),
        "gastos_deputados": lambda: deputy_expenses.dims(read_dataset(spark, gold, "fato_gastos_deputados")),
        "proposicoes_votacoes": lambda: chamber.dims(read_layer(spark, gold, "gold")),
        "senado_federal": lambda: senate.dims(read_layer(spark, gold, "gold")),
    }
    return write_layer(builders[domain](), f"{gold}/dimensions", domain, "dimensions", upstream=upstream)


def run_publish(spark: SparkSession, domain: str, gold: str, target: str, checks: DataFrame) -> DataFrame:
    """Publish marts and dimensions with a catalog; refuses unless both, and the checks, were approved.

    Dimensions that were made from an earlier run of Gold are refused too.
    """
    run_id = require_manifest(spark, gold, "gold")
    require_manifest(spark, f"{gold}/dimensions", "dimensions")
    if manifest_state(spark, f"{gold}/dimensions", "dimensions")[2] != run_id:
        raise GateError(f"dimensions of {domain} are older than its Gold")
    gate_reconciliation(checks, domain)
    tables = read_layer(spark, gold, "gold") | read_layer(spark, f"{gold}/dimensions", "dimensions")
    typed = suite([typed_columns(df, name) for name, df in tables.items()])
    require_approved(typed, f"columns of {domain}")
    if domain == "senado_federal":
        star = write_checks(senate.validate_star(tables), f"{gold}/quality", "validacao_relacionamentos")
        require_approved(star.withColumn("severity", F.lit("error")), "relationships of senado_federal")
    marts = [r["dataset"] for r in read_manifest(spark, gold, "gold").select("dataset").collect()]
    dims = [r["dataset"] for r in read_manifest(spark, f"{gold}/dimensions", "dimensions").select("dataset").collect()]
    publication = new_run_id()
    catalog = publish(spark, domain, gold, target, marts, "gold", publication).unionByName(
        publish(spark, domain, f"{gold}/dimensions", target, dims, "dimension", publication)
    )
    return write_catalog(catalog, target, domain, publication)


__all__ = [name for name in dir() if name.startswith("run_")] + ["approval", "write_layer", "read_layer", "gate_quality", "gate_reconciliation"]
