"""What queries move and store: marts are read for what is asked of them, rows of a group move once."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from plumbline.operators import dedup, ranking
from plumbline.plans import contracts
from plumbline.plans import deputy_expenses as expenses
from plumbline.plans import grants as agreements
from plumbline.sources import documents
from plumbline.workload import catalog, deputy_expenses, grants, senate


def unasked(*_, **__):
    raise AssertionError("nothing is stored or ranked here")


def test_expense_reconciliation_stores_and_ranks_nothing(spark, sf, monkeypatch):
    monkeypatch.setattr(ranking, "materialize", unasked)
    monkeypatch.setattr(deputy_expenses, "materialize", unasked)
    found = catalog.QUERIES["rec_06_expenses"](spark, sf)
    # Distinct counts of the marts aren't computed for their rows and totals.
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    # The given lines hold repeated keys.
    assert {r.check for r in found.collect() if not r.approved} <= {"chaves_despesa_unicas"}


def moved(spark, df):
    """The exchanges of a plan whose sides are too large to be broadcast."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.fixture
def large(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def test_lines_of_a_tender_move_once(spark, sf, large):
    # Participants, items and tenders, one exchange each.
    assert moved(spark, catalog.QUERIES["gld_lc_01_concorrencia_licitacoes"](spark, sf)) == 3


def test_amendments_of_an_agreement_move_once(spark, sf, large):
    # Once for the staging, once for the fact.
    assert moved(spark, catalog.QUERIES["gld_cv_01_fato_convenios"](spark, sf)) == 2


def test_flags_count_different_values(spark):
    rows = "VALUES ('a', 'x', true), ('a', 'x', NULL), ('a', 'x', false), ('a', NULL, true), ('a', NULL, false), (NULL, 'x', false), (NULL, 'y', true)"
    df = spark.sql(f"SELECT * FROM {rows} AS t(k, v, won)").repartition(5)
    flagged = ranking.together(df, ["k"], {"_v": F.col("v")}, {"_v": F.col("won").desc_nulls_last()})
    found = flagged.where("_v").groupBy("k").agg(F.count("*").alias("n"), F.count("v").alias("present"), F.count_if(F.col("won") & F.col("v").isNotNull()).alias("won"))
    assert {r.k: (r.n, r.present, r.won) for r in found.collect()} == {"a": (2, 1, 1), None: (2, 2, 1)}


@pytest.fixture
def stored(monkeypatch):
    """The frames that rankings store."""
    frames, store = [], ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df: frames.append(df) or store(df))
    return frames


@pytest.mark.parametrize("name", ["gld_em_02_ranking_favorecidos", "gld_em_06_relacionamento_autor_favorecido"])
def test_payments_move_once(spark, sf, large, stored, name):
    # For the payments' own rows and for the mart's; no copies per distinct count.
    catalog.QUERIES[name](spark, sf)
    assert moved(spark, stored[0]) == 1 and "Expand" not in stored[0]._jdf.queryExecution().executedPlan().toString()


def test_rows_of_one_rank_move_once(spark, large):
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).alias("g"), (F.col("id") % 100).cast("double").alias("v"))
    found = ranking.add_ranks(df, {"r": "v"}, ["g"])
    assert moved(spark, found) == 1


@pytest.mark.parametrize("kind", ["double", "bigint", "decimal(20,2)", "int"])
def test_one_rank_with_frequent_and_absent_values(spark, kind):
    """Half of the rows share a value, a fifth have none: ranks are those of a window."""
    v = "CASE WHEN id % 2 = 0 THEN 5 WHEN id % 5 = 0 THEN NULL WHEN id % 7 = 0 THEN 6 ELSE id % 41 END"
    df = spark.range(4000).selectExpr("id", "CASE WHEN id % 3 < 2 THEN NULL ELSE id % 6 END AS g", f"CAST({v} AS {kind}) AS v").repartition(6)
    for by in (["g"], []):
        part = "PARTITION BY g " if by else ""
        asked = df.selectExpr("id", "g", "v", f"CASE WHEN v IS NOT NULL THEN CAST(dense_rank() OVER ({part}ORDER BY v DESC NULLS LAST) AS BIGINT) END AS r")
        found = ranking.add_ranks(df, {"r": "v"}, by)
        assert sorted(map(str, found.collect())) == sorted(map(str, asked.collect()))
    assert ranking.add_ranks(df.where("false"), {"r": "v"}, ["g"]).count() == 0


def test_frequent_and_absent_values_are_dealt(spark):
    """No task numbers all rows of a value that half of them have, nor all rows without one."""
    df = spark.range(8000).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 0D WHEN id % 4 = 1 THEN NULL ELSE CAST(id AS DOUBLE) END AS v")
    plan = ranking.add_ranks(df, {"r": "v"})._jdf.queryExecution().optimizedPlan().toString()
    assert "pmod(xxhash64" in plan and "_deal" in plan


def test_lines_of_a_contract_group_move_once(spark, sf, large):
    # Items and terms once each; contracts: newest periods, records, picks and two for a distinct count.
    plan = catalog.QUERIES["gld_ct_02_contratos_atuais_resumo"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2
    assert "chave_logica_item" not in "".join(line for line in plan.split("\n") if "Exchange" in line)


def test_snapshot_within_a_group_keeps_the_same_rows(spark):
    rows = "VALUES ('g', 'a', '202501', true), ('g', 'a', '202502', true), ('g', 'b', '202501', false), ('g', 'b', '202502', true), ('g', NULL, '202503', true), (NULL, 'a', '202501', true), ('h', 'c', NULL, true)"
    df = spark.sql(f"SELECT * FROM {rows} AS t(g, k, p, w)")
    for where in (None, F.col("w")):
        apart = dedup.latest_snapshot(df.where("NOT (k = 'a' AND g IS NULL)"), "k", "p", "latest", where, True)
        close = dedup.latest_snapshot(df.where("NOT (k = 'a' AND g IS NULL)"), "k", "p", "latest", where, True, "g")
        assert sorted(map(str, apart.collect())) == sorted(map(str, close.collect())) and close.columns == apart.columns


def test_yearly_reconciliation_ranks_nothing(spark, sf, monkeypatch):
    monkeypatch.setattr(ranking, "materialize", unasked)
    assert catalog.QUERIES["rec_05_amendments_by_year"](spark, sf).count() > 0


def test_senate_audit_stores_and_ranks_nothing(spark, sf, monkeypatch):
    monkeypatch.setattr(ranking, "materialize", unasked)
    monkeypatch.setattr(senate, "materialize", unasked)
    found = catalog.QUERIES["rec_08_senate_tie_out"](spark, sf)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.count() == 16


def test_agreements_suite_moves_rows_once_and_stores_nothing(spark, sf, large, monkeypatch):
    monkeypatch.setattr(grants, "materialize", unasked)
    found = catalog.QUERIES["dq_10_agreements_suite"](spark, sf)
    # Once for the staging, once for the suite.
    assert moved(spark, found) == 2


def test_agreements_suite_counts_kinds(spark):
    """Repeated pairs and rows count once however often they are repeated; null keys are keys."""
    names = ["numero_convenio", "codigo_emenda", "convenente", "objeto_convenio", "valor_convenio", "data_publicacao_convenio", "ano_emenda"]
    row = ("a", "1", "x", "o", 1.0, None, 2000)
    rows = [row, row, row, ("a", "2", "x", "o", 1.0, None, 2000), ("b", None, "x", None, -1.0, None, 2000), ("b", None, "y", "o", -1.0, None, 2000), (None, "1", "x", "o", 0.0, None, 2000), (None, "1", "x", "o", -0.0, None, 2000)]
    schema = ", ".join(f"{n} {'double' if n.startswith('valor') else 'int' if n.startswith('ano') else 'string'}" for n in names)
    df = spark.createDataFrame(rows, schema).repartition(5)
    found = {r.check: (r.value, r.severity, r.approved) for r in agreements.quality(df).collect()}
    assert found == {
        "dataset_not_empty": (8, "info", True), "codigo_emenda_not_null": (2, "error", False), "numero_convenio_not_null": (2, "error", False),
        "negative_values": (2, "warning", True), "missing_object": (1, "warning", True), "contract_content_consistency": (1, "error", False),
        "multi_emenda_contracts": (1, "warning", True), "emenda_convenio_unique": (3, "error", False), "exact_duplicates": (2, "error", False),
    }
    assert [(r.check, r.value) for r in agreements.quality(df.where("false")).collect() if not r.approved] == [("dataset_not_empty", 0)]


def test_suppliers_lines_are_not_copied_per_count(spark, sf, large, stored):
    found = catalog.QUERIES["gld_gd_05_ranking_fornecedores"](spark, sf)
    # Parties and states alone are counted by copies, of added-up lines; a document moves with a hash of its supplier.
    *_, counted = stored
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "xxhash64" in plan
    unranked = expenses.ranking_suppliers(deputy_expenses.fact(spark, sf), ranked=False)
    assert sorted(map(str, found.drop("posicao_valor_liquido").collect())) == sorted(map(str, unranked.collect()))


@pytest.mark.parametrize("shared", [False, True])
def test_counts_apart_with_null_keys_and_shared_hashes(spark, monkeypatch, shared):
    """Keys that share a hash are told apart, null is a key and a value."""
    if shared:
        monkeypatch.setattr(ranking, "_hashed", lambda keys: F.lit(7).cast("bigint"))
    rows = "VALUES ('a', NULL, 'x', 1), ('a', NULL, 'x', 2), ('a', NULL, NULL, 2), (NULL, 'a', 'y', 3), (NULL, 'a', 'z', 3), (NULL, NULL, NULL, NULL), ('a', 'a', 'x', NULL)"
    df = spark.sql(f"SELECT * FROM {rows} AS t(k, l, v, w)").repartition(5)
    found = ranking.count_apart(ranking.summarize(df, ["k", "l"], {"n": F.count("*")}), df, ["k", "l"], {"nv": "v", "nw": "w"})
    assert {(r.k, r.l): (r.n, r.nv, r.nw) for r in found.collect()} == {("a", None): (3, 2, 2), (None, "a"): (2, 2, 1), (None, None): (1, 1, 1), ("a", "a"): (1, 1, 1)}
    assert found.columns == ["k", "l", "n", "nv", "nw"]


def test_pages_are_files_of_one_folder(spark, sf, monkeypatch):
    """A page is a file of at most 500 records; no folder is made, renamed and listed for each."""
    read, folders = documents.read_pages, []
    monkeypatch.setattr(documents, "read_pages", lambda spark, folder, columns: folders.append(folder) or read(spark, folder, columns))
    found = catalog.QUERIES["src_05_paged_json"](spark, sf).count()
    (folder,) = (Path(f.removeprefix("file:")) for f in folders)
    assert len([p for p in folder.rglob("*") if p.is_dir()]) == 1
    pages = [json.loads(p.read_text()) for p in folder.rglob("part-*")]
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    assert len(pages) == orders.select(F.floor(F.col("o_orderkey") / 500)).distinct().count() > 1
    assert max(map(len, pages)) <= 500 and sum(map(len, pages)) == orders.count() == found


def test_records_items_and_terms_of_a_contract_move_once_with_the_bytes_of_a_hash(spark, sf, large):
    found = catalog.QUERIES["gld_ct_02_contratos_atuais_resumo"](spark, sf)
    assert moved(spark, found) == 3
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        lines = found._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    below = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning" in line]
    assert sum("unhex(" in line for line in lines) == 3
    assert not any(key in line for line in below for key in ("chave_registro_contrato", "chave_item_contrato", "chave_termo_aditivo", "chave_logica_item"))


def contract_rows(spark):
    """Two periods, equal records, items and terms, null numbers, codes, contractors and amounts."""
    # Number, unit, period, contractor, amount.
    records = [("1", "u", "202501", "a", 1.0), ("1", "u", "202502", "a", 2.0), ("1", "u", "202502", "b", 2.0), ("1", "u", "202502", "b", 2.0),
               ("2", "u", "202501", None, None), (None, "u", "202501", "c", 3.0), (None, "u", "202502", "a", 4.0), (None, None, "202501", None, -1.0)]
    # Number, unit, period, code, amount.
    lines = [("1", "u", "202501", "5", 1.0), ("1", "u", "202502", "5", 2.0), ("1", "u", "202502", "5", 2.0), ("1", "u", "202501", "0", 7.0), ("1", "u", "202502", "0", 7.0),
             ("1", "u", "202502", None, 9.0), (None, "u", "202501", "7", 3.0), (None, None, "202501", "7", None), ("9", "u", "202501", "7", 1.0)]
    # Number, unit, number of the term, object.
    amended = [("1", "u", "1", "Prorroga"), ("1", "u", "1", "Prorroga"), ("1", "u", None, "Reajuste"), (None, "u", "SEM_TERMO", None), (None, None, None, None), ("9", "u", "1", None)]
    named = {
        "codigo_orgao_superior": "'s'", "nome_orgao_superior": "'S'", "codigo_orgao": "'o'", "nome_orgao": "'O'", "nome_ug": "upper(codigo_ug)",
        "objeto": "concat('x', codigo_contratado)", "modalidade_compra": "codigo_contratado", "situacao_contrato": "'y'", "nome_contratado": "upper(codigo_contratado)",
        "data_assinatura_contrato": "DATE'2025-01-01'", "data_inicio_vigencia": "CAST(NULL AS DATE)", "data_fim_vigencia": "DATE'2025-12-31'", "valor_inicial_compra": "1D",
    }
    history = spark.createDataFrame(records, "numero_contrato string, codigo_ug string, periodo_origem string, codigo_contratado string, valor_final_compra double").repartition(3)
    items = spark.createDataFrame(lines, "numero_contrato string, codigo_ug string, periodo_origem string, codigo_item_compra string, valor_item double").repartition(3)
    terms = spark.createDataFrame(amended, "numero_contrato string, codigo_ug string, numero_termo_aditivo string, objeto string").repartition(3)
    items = items.selectExpr("*", "'d' AS descricao_item_compra", "'sigiloso' AS descricao_complementar_item_compra", "2D AS quantidade_item")
    terms = terms.withColumn("data_publicacao", F.lit("2025-03-04").cast("date"))
    return contracts.derive_contracts(history.selectExpr("*", *[f"{e} AS {n}" for n, e in named.items()])), contracts.derive_items(items), contracts.derive_terms(terms)


def test_current_records_by_group_are_the_current_records(spark):
    history, _, _ = contract_rows(spark)
    apart, close = contracts.current_contracts(history), contracts.current_contracts(history, by_group=True)
    assert close.columns == apart.columns and close.schema == apart.schema
    assert sorted(map(str, close.collect())) == sorted(map(str, apart.collect())) and close.count() == 6


def test_summary_of_moved_groups(spark):
    history, items, terms = contract_rows(spark)
    close = contracts.contract_summary(contracts.current_contracts(history, by_group=True), contracts.current_items(items, by_group=True), terms, by_group=True)
    apart = contracts.contract_summary(contracts.current_contracts(history), contracts.current_items(items), terms)
    assert close.schema == apart.schema and sorted(map(str, close.collect())) == sorted(map(str, apart.collect()))
    found = {r.chave_grupo_contrato: r for r in close.collect()}
    counts = {
        g: (r.quantidade_registros_atuais, r.quantidade_contratados_grupo, r.quantidade_itens, r.quantidade_itens_codigo_zero, r.valor_total_itens_identificados, r.quantidade_termos_aditivos)
        for g, r in found.items()
    }
    assert counts == {"u|1": (3, 2, 2, 1, 8.0, 2), "u|2": (1, 0, 0, 0, 0.0, 0), "u|SEM_CONTRATO": (1, 1, 1, 0, 6.0, 1), "SEM_UG|SEM_CONTRATO": (1, 0, 1, 0, 0.0, 1)}
    records = history.where("chave_grupo_contrato = 'u|1' AND periodo_origem = '202502'")
    assert found["u|1"].chave_registro_representativo == records.agg(F.min("chave_registro_contrato")).first()[0]


def test_terms_of_a_contract_are_counted_where_they_are(spark, large):
    history, _, terms = contract_rows(spark)
    found = contracts.terms_per_contract(contracts.current_contracts(history, by_group=True), terms)
    plan = found._jdf.queryExecution().executedPlan().toString()
    # Records and terms, one exchange each.
    assert plan.count("Exchange hashpartitioning") == 2
    counts = {r.chave_grupo_contrato: (r.quantidade_termos, r.quantidade_prorrogacoes, r.primeira_publicacao_termo is not None) for r in found.collect()}
    assert counts == {"u|1": (2, 2, True), "u|2": (0, 0, False), "u|SEM_CONTRATO": (1, 0, True), "SEM_UG|SEM_CONTRATO": (1, 0, True)}


def test_contract_reconciliation_is_the_same_without_stored_items(spark, monkeypatch):
    """Sides of items and terms are computed one after the other; only their values are kept."""
    history, items, terms = contract_rows(spark)
    current = contracts.current_contracts(history)
    tables = {"contratos_atuais": current, "itens_contrato": items.join(current.select("chave_grupo_contrato").distinct(), "chave_grupo_contrato", "left_semi"),
              "termos_aditivos": terms.join(current.select("chave_grupo_contrato").distinct(), "chave_grupo_contrato", "left_semi")}
    asked = contracts.reconciliation(tables, contracts.gold(tables)).collect()
    frames, store = [], contracts.materialize
    monkeypatch.setattr(contracts, "materialize", lambda df: frames.append(df.columns) or store(df))
    found = contracts.reconciliation(tables, contracts.gold(tables, stored=False)).collect()
    assert frames == [["check", "_side", "_value"]] * 5
    assert sorted(map(str, found)) == sorted(map(str, asked)) and len(found) == 15 and all(r.approved for r in found)
    assert {r.check: r.silver_value for r in found if r.check in ("termos_aditivos", "itens_identificados_atuais", "itens_codigo_zero")} == {
        "termos_aditivos": 4.0, "itens_identificados_atuais": 4.0, "itens_codigo_zero": 2.0,
    }


def test_marts_of_stored_terms_count_the_keys_that_are_there(spark):
    """A stored key may differ from its parts; it is made anew only of terms that were just derived."""
    history, items, terms = contract_rows(spark)
    current = contracts.current_contracts(history)
    broken = terms.withColumn("chave_termo_aditivo", F.when(F.col("numero_termo_aditivo").isNotNull(), F.lit("k")))
    summary = contracts.contract_summary(current, contracts.current_items(items), broken)
    counts = {"u|1": 1, "u|2": 0, "u|SEM_CONTRATO": 1, "SEM_UG|SEM_CONTRATO": 0}
    assert {r.chave_grupo_contrato: r.quantidade_termos_aditivos for r in summary.collect()} == counts
    assert {r.chave_grupo_contrato: r.quantidade_termos for r in contracts.terms_per_contract(current, broken).collect()} == counts
