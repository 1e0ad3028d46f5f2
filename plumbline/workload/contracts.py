"""Contracts on orders (records), lineitem (items and amendment terms)."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import checks, dimensions
from plumbline.plans import contracts as recipe
from plumbline.runtime import materialize
from plumbline.workload.base import (
    as_text, bigint, calendar_sql, cnt, first, has, mean, npres, nuni, pct, query, rank, sha, staged, tot, with_reader_columns,
)

_QUARTER = "CAST(year({0}) * 100 + quarter({0}) AS STRING)"


def _lineage(date: str, suffix: str) -> str:
    period = _QUARTER.format(date)
    return f"""{period} AS periodo_origem, CAST(year({date}) AS BIGINT) AS ano_origem, CAST(quarter({date}) AS BIGINT) AS mes_origem,
      {period} || '_{suffix}.csv' AS arquivo_origem"""


def _group(key: str) -> str:
    block = f"CAST(floor({key} / 3.0) AS BIGINT)"
    return f"""CASE WHEN {key} % 53 = 0 THEN NULL ELSE 'C' || CAST({block} AS STRING) END AS numero_contrato,
      'U' || CAST({block} % 11 AS STRING) AS codigo_ug, 'UNIDADE ' || CAST({block} % 11 AS STRING) AS nome_ug"""


def _agency(key: str) -> str:
    return f"""CAST({key} % 5 AS STRING) AS codigo_orgao_superior, 'SUPERIOR ' || CAST({key} % 5 AS STRING) AS nome_orgao_superior,
      CAST({key} % 25 AS STRING) AS codigo_orgao, 'ORGAO ' || CAST({key} % 25 AS STRING) AS nome_orgao"""


STAGE_CONTRACTS = f"""
  SELECT {_group("o_orderkey")}, {_agency("o_custkey")},
    CASE WHEN o_orderkey % 29 = 0 THEN 'Objeto sob SIGILO' WHEN o_orderkey % 23 = 0 THEN NULL
      ELSE 'Objeto ' || o_orderpriority END AS objeto,
    o_orderpriority AS fundamento_legal,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderpriority END AS modalidade_compra,
    o_orderstatus AS situacao_contrato,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 8 - 5 AS INT) AS data_assinatura_contrato,
    CAST(o_orderdate AS DATE) AS data_publicacao_dou,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS data_inicio_vigencia,
    CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 - 10 AS INT) AS data_fim_vigencia,
    CASE WHEN o_custkey % 31 = 0 THEN NULL WHEN o_custkey % 37 = 0 THEN '-11' ELSE CAST(o_custkey AS STRING) END AS codigo_contratado,
    CASE WHEN o_custkey % 37 = 0 THEN 'Sigiloso' WHEN o_orderkey % 10 = 0 THEN 'CLIENTE ' || CAST(o_custkey AS STRING) || ' SA'
      ELSE 'CLIENTE ' || CAST(o_custkey AS STRING) END AS nome_contratado,
    CASE WHEN o_orderkey % 47 = 0 THEN CAST(0 AS DOUBLE)
      ELSE CAST(CAST(o_totalprice - (o_orderkey % 7) * 100 AS DECIMAL(18,2)) AS DOUBLE) END AS valor_inicial_compra,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_totalprice END AS valor_final_compra,
    CAST(o_orderkey % 100 AS STRING) AS numero_licitacao, 'U1' AS codigo_ug_licitacao, 'UNIDADE 1' AS nome_ug_licitacao,
    substr(o_orderpriority, 1, 1) AS codigo_modalidade_compra_licitacao, o_orderpriority AS modalidade_compra_licitacao,
    {_lineage("o_orderdate", "Compras")}
  FROM {{orders}}"""

STAGE_ITEMS = f"""
  SELECT {_group("l_orderkey")}, CAST(l_orderkey % 25 AS STRING) AS codigo_orgao, 'ORGAO ' || CAST(l_orderkey % 25 AS STRING) AS nome_orgao,
    CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE CAST(l_partkey % 10 AS STRING) END AS codigo_item_compra,
    CASE WHEN l_linenumber = 3 THEN 'ITEM SIGILOSO ' || l_returnflag ELSE 'ITEM ' || l_returnflag END AS descricao_item_compra,
    CASE WHEN l_linestatus = 'F' THEN NULL ELSE 'COMPLEMENTO' END AS descricao_complementar_item_compra,
    l_quantity AS quantidade_item,
    CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_extendedprice END AS valor_item,
    {_lineage("l_shipdate", "ItemCompra")}
  FROM {{lineitem}}"""

STAGE_TERMS = f"""
  SELECT {_group("l_orderkey")}, {_agency("l_orderkey")},
    CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS numero_termo_aditivo,
    CAST(l_shipdate AS DATE) AS data_publicacao,
    CASE l_partkey % 5 WHEN 0 THEN 'PRORROGA o prazo' WHEN 1 THEN 'Reajuste anual' WHEN 2 THEN 'Acréscimo de itens'
      WHEN 3 THEN 'supressao e revisão' ELSE NULL END AS objeto,
    {_lineage("l_shipdate", "TermoAditivo")}
  FROM {{lineitem}}"""

STAGE_APOSTILLES = f"""
  SELECT {_group("l_orderkey")}, CAST(l_linenumber AS STRING) AS numero_apostilamento, l_extendedprice AS valor_apostilamento,
    {_lineage("l_shipdate", "Apostilamento")}
  FROM {{lineitem}}"""

GROUP_KEY = "coalesce(codigo_ug, 'SEM_UG') || '|' || coalesce(numero_contrato, 'SEM_CONTRATO')"
SILVER_CONTRACTS = f"""
  SELECT *, chave_grupo_contrato || '|' || hash_conteudo_contrato AS chave_registro_contrato FROM (
    SELECT *, {GROUP_KEY} AS chave_grupo_contrato, {sha(*recipe.HASHED_CONTRACT)} AS hash_conteudo_contrato,
      valor_final_compra - valor_inicial_compra AS variacao_valor_contrato,
      {pct("(valor_final_compra - valor_inicial_compra)", "valor_inicial_compra")} AS percentual_variacao_valor,
      datediff('day', data_inicio_vigencia, data_fim_vigencia) AS duracao_vigencia_dias,
      {has("objeto", "sigilo")} OR {has("nome_contratado", "sigil")} OR codigo_contratado IN ('-11', '-3') AS contrato_sigiloso
    FROM ({STAGE_CONTRACTS}))"""
SILVER_ITEMS = f"""
  SELECT *, chave_grupo_contrato || '|' || coalesce(codigo_item_compra, 'SEM_ITEM') || '|' || hash_conteudo_item AS chave_item_contrato FROM (
    SELECT *, {GROUP_KEY} AS chave_grupo_contrato, {sha(*recipe.HASHED_ITEM)} AS hash_conteudo_item,
      quantidade_item * valor_item AS valor_total_item_calculado, codigo_item_compra = '0' AS item_codigo_zero,
      {has("descricao_item_compra", "sigilo")} OR {has("descricao_complementar_item_compra", "sigilo")} AS item_sigiloso
    FROM ({STAGE_ITEMS}))"""
SILVER_TERMS = f"""
  SELECT *, chave_grupo_contrato || '|' || coalesce(numero_termo_aditivo, 'SEM_TERMO') || '|' || hash_conteudo_termo AS chave_termo_aditivo FROM (
    SELECT *, {GROUP_KEY} AS chave_grupo_contrato, {sha(*recipe.HASHED_TERM)} AS hash_conteudo_termo,
      {has("objeto", "prorroga")} AS termo_prorrogacao,
      {has("objeto", "reajuste", "repactua", "revisao", "revisão")} AS termo_reajuste,
      {has("objeto", "acrescimo", "acréscimo", "supressao", "supressão")} AS termo_alteracao_quantitativa
    FROM ({STAGE_TERMS}))"""
CURRENT = f"""
  SELECT *, TRUE AS registro_periodo_atual FROM (
    SELECT *, max(periodo_origem) OVER (PARTITION BY chave_grupo_contrato) AS periodo_mais_recente FROM ({SILVER_CONTRACTS}))
  WHERE periodo_origem = periodo_mais_recente"""
CURRENT_ITEMS = f"""
  SELECT * REPLACE (CASE WHEN item_codigo_zero THEN periodo_origem ELSE periodo_mais_recente_item END AS periodo_mais_recente_item),
    CASE WHEN item_codigo_zero THEN 'registro_fisico_codigo_zero' ELSE 'codigo_item' END AS criterio_selecao_item,
    NOT item_codigo_zero AS item_utilizavel_valor_oficial
  FROM (SELECT *, chave_grupo_contrato || '|' || codigo_item_compra AS chave_logica_item,
      max(periodo_origem) OVER (PARTITION BY chave_grupo_contrato, codigo_item_compra) AS periodo_mais_recente_item
    FROM ({SILVER_ITEMS}) WHERE item_codigo_zero IS NOT NULL)
  WHERE item_codigo_zero OR periodo_origem = periodo_mais_recente_item"""

AGENCY = "codigo_orgao_superior, nome_orgao_superior, codigo_orgao, nome_orgao"


def contracts(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_contracts(staged(spark, sf, STAGE_CONTRACTS))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_items(staged(spark, sf, STAGE_ITEMS))


def terms(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_terms(staged(spark, sf, STAGE_TERMS))


def current(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.current_contracts(contracts(spark, sf))


def silver_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    history = contracts(spark, sf)
    return {
        "contratos_historico": history,
        "contratos_atuais": recipe.current_contracts(history),
        "itens_contrato": items(spark, sf),
        "termos_aditivos": terms(spark, sf),
        "apostilamentos": recipe.silver_apostilles(as_text(staged(spark, sf, STAGE_APOSTILLES))),
    }


LINEAGE = ["periodo_origem", "ano_origem", "mes_origem", "arquivo_origem"]


def _text(spark: SparkSession, sf: str, stage: str) -> DataFrame:
    typed = staged(spark, sf, stage)
    return with_reader_columns(as_text(typed, dirty_date=True), typed, LINEAGE)


query("slv_01_contratos", SILVER_CONTRACTS)(lambda s, d: recipe.silver_contracts(_text(s, d, STAGE_CONTRACTS)))
query("slv_02_itens_contrato", SILVER_ITEMS)(lambda s, d: recipe.silver_items(_text(s, d, STAGE_ITEMS)))
query("slv_03_termos_aditivos", SILVER_TERMS)(lambda s, d: recipe.silver_terms(_text(s, d, STAGE_TERMS)))
_APOSTILLE_NULLS = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}"
    for c in (*AGENCY.split(", "), "descricao_apostilamento", "situacao_apostilamento")
)
query(
    "slv_04_apostilamentos",
    f"""
  SELECT *, chave_grupo_contrato || '|' || coalesce(numero_apostilamento, 'SEM_APOSTILAMENTO') || '|' || hash_conteudo_apostilamento AS chave_apostilamento
  FROM (SELECT *, {GROUP_KEY} AS chave_grupo_contrato, {sha(*recipe.HASHED_APOSTILLE)} AS hash_conteudo_apostilamento
    FROM (SELECT *, {_APOSTILLE_NULLS}, CAST(NULL AS DATE) AS data_de_inclusao FROM ({STAGE_APOSTILLES})))""",
)(lambda s, d: recipe.silver_apostilles(_text(s, d, STAGE_APOSTILLES)))

query("ddp_05_contratos_atuais", CURRENT)(current)
query("gld_ct_08_contratos_atuais_detalhe", CURRENT)(lambda s, d: recipe.current_contracts(contracts(s, d)))
query("gld_ct_01_itens_contrato_atuais", CURRENT_ITEMS)(lambda s, d: recipe.current_items(items(s, d)))

_KEY = "chave_registro_contrato"
_first = partial(first, order=_KEY)
_GROUPS = f"""
    count(*) AS quantidade_registros_atuais, arg_min_null(numero_contrato, {_KEY}) AS numero_contrato,
    {_first("codigo_orgao")} AS codigo_orgao, {_first("nome_orgao")} AS nome_orgao, {_first("codigo_ug")} AS codigo_ug,
    {_first("nome_ug")} AS nome_ug, {_first("codigo_contratado")} AS codigo_contratado_representativo,
    {_first("nome_contratado")} AS nome_contratado_representativo, {tot("valor_inicial_compra")} AS valor_inicial_total_grupo,
    {tot("valor_final_compra")} AS valor_final_total_grupo, {tot("variacao_valor_contrato")} AS variacao_total_grupo"""
_TERMS = f"""{cnt("termo_prorrogacao")} AS quantidade_prorrogacoes, {cnt("termo_reajuste")} AS quantidade_reajustes,
    {cnt("termo_alteracao_quantitativa")} AS quantidade_alteracoes_quantitativas"""


@query(
    "gld_ct_02_contratos_atuais_resumo",
    f"""
  WITH c AS ({CURRENT}), i AS ({CURRENT_ITEMS}), t AS ({SILVER_TERMS}),
  g AS (SELECT chave_grupo_contrato, {_GROUPS}, min({_KEY}) AS chave_registro_representativo,
      {_first("codigo_orgao_superior")} AS codigo_orgao_superior, {_first("nome_orgao_superior")} AS nome_orgao_superior,
      {npres("codigo_contratado")} AS quantidade_contratados_grupo, {_first("objeto")} AS objeto_representativo,
      {_first("modalidade_compra")} AS modalidade_compra, {_first("situacao_contrato")} AS situacao_contrato,
      min(data_assinatura_contrato) AS primeira_data_assinatura, max(data_assinatura_contrato) AS ultima_data_assinatura,
      min(data_inicio_vigencia) AS primeiro_inicio_vigencia, max(data_fim_vigencia) AS ultimo_fim_vigencia,
      coalesce(bool_or(contrato_sigiloso), FALSE) AS possui_contrato_sigiloso, max(periodo_origem) AS periodo_origem
    FROM c GROUP BY chave_grupo_contrato),
  gi AS (SELECT chave_grupo_contrato, {npres("chave_item_contrato")} AS a,
      {npres("chave_item_contrato", "item_utilizavel_valor_oficial")} AS b, {npres("chave_item_contrato", "item_codigo_zero")} AS z,
      {tot("valor_total_item_calculado", "item_utilizavel_valor_oficial")} AS vb,
      {tot("valor_total_item_calculado", "item_codigo_zero")} AS vz, {cnt("item_sigiloso")} AS s
    FROM i GROUP BY chave_grupo_contrato),
  gt AS (SELECT chave_grupo_contrato, {npres("chave_termo_aditivo")} AS n, {_TERMS} FROM t GROUP BY chave_grupo_contrato)
  SELECT g.*, quantidade_registros_atuais > 1 AS grupo_com_multiplos_registros,
    {pct("variacao_total_grupo", "valor_inicial_total_grupo")} AS percentual_variacao_grupo,
    coalesce(a, 0) AS quantidade_itens, coalesce(b, 0) AS quantidade_itens_identificados, coalesce(z, 0) AS quantidade_itens_codigo_zero,
    coalesce(vb, 0.0) AS valor_total_itens_identificados, coalesce(vz, 0.0) AS valor_total_itens_codigo_zero,
    coalesce(s, 0) AS quantidade_itens_sigilosos, coalesce(n, 0) AS quantidade_termos_aditivos,
    coalesce(quantidade_prorrogacoes, 0) AS quantidade_prorrogacoes, coalesce(quantidade_reajustes, 0) AS quantidade_reajustes,
    coalesce(quantidade_alteracoes_quantitativas, 0) AS quantidade_alteracoes_quantitativas,
    coalesce(vb, 0.0) + coalesce(vz, 0.0) AS valor_total_itens_informativo,
    valor_final_total_grupo > valor_inicial_total_grupo AS grupo_com_acrescimo,
    valor_final_total_grupo < valor_inicial_total_grupo AS grupo_com_reducao,
    coalesce(n, 0) > 0 AS possui_termo_aditivo, coalesce(s, 0) > 0 AS possui_item_sigiloso
  FROM g LEFT JOIN gi USING (chave_grupo_contrato) LEFT JOIN gt USING (chave_grupo_contrato)""",
)
def contract_summary(spark: SparkSession, sf: str) -> DataFrame:
    found = recipe.current_contracts(contracts(spark, sf), by_group=True)
    return recipe.contract_summary(found, recipe.current_items(items(spark, sf), by_group=True), terms(spark, sf), by_group=True)


_AMOUNTS = f"""{tot("valor_inicial_compra")} AS valor_inicial_total, {tot("valor_final_compra")} AS valor_final_total,
    {tot("variacao_valor_contrato")} AS variacao_total, {mean("valor_final_compra")} AS valor_medio_contrato,
    max(valor_final_compra) AS maior_valor_contrato, {cnt("contrato_sigiloso")} AS quantidade_contratos_sigilosos"""

query(
    "gld_ct_03_ranking_contratados",
    f"""
  SELECT *, {rank("valor_final_total")} AS posicao_valor_final, {rank("quantidade_contratos")} AS posicao_quantidade_contratos
  FROM (SELECT codigo_contratado, nome_contratado, {nuni("chave_registro_contrato")} AS quantidade_contratos,
      {nuni("chave_grupo_contrato")} AS quantidade_grupos_contrato, {npres("codigo_orgao")} AS quantidade_orgaos,
      {npres("codigo_ug")} AS quantidade_ugs, {_AMOUNTS}
    FROM ({CURRENT}) WHERE codigo_contratado IS NOT NULL GROUP BY 1, 2)""",
)(lambda s, d: recipe.ranking_contractors(current(s, d)))

query(
    "gld_ct_04_ranking_orgaos",
    f"""
  SELECT *, {rank("valor_final_total")} AS posicao_valor_final
  FROM (SELECT {AGENCY}, {nuni("chave_registro_contrato")} AS quantidade_contratos,
      {npres("codigo_contratado")} AS quantidade_contratados, {npres("codigo_ug")} AS quantidade_ugs, {_AMOUNTS}
    FROM ({CURRENT}) GROUP BY {AGENCY})""",
)(lambda s, d: recipe.ranking_agencies(current(s, d)))

query(
    "gld_ct_05_contratos_com_variacao",
    f"""
  SELECT chave_registro_contrato, chave_grupo_contrato, numero_contrato, {AGENCY}, codigo_ug, nome_ug, codigo_contratado,
    nome_contratado, objeto, data_assinatura_contrato, data_inicio_vigencia, data_fim_vigencia, valor_inicial_compra,
    valor_final_compra, variacao_valor_contrato, percentual_variacao_valor, periodo_origem
  FROM ({CURRENT}) WHERE variacao_valor_contrato <> 0""",
)(lambda s, d: recipe.changed_contracts(current(s, d)))

query(
    "gld_ct_06_termos_por_contrato",
    f"""
  WITH g AS (SELECT chave_grupo_contrato, {_GROUPS} FROM ({CURRENT}) GROUP BY chave_grupo_contrato),
  t AS (SELECT chave_grupo_contrato, {npres("chave_termo_aditivo")} AS n, min(data_publicacao) AS primeira_publicacao_termo,
      max(data_publicacao) AS ultima_publicacao_termo, {_TERMS} FROM ({SILVER_TERMS}) GROUP BY 1)
  SELECT g.*, coalesce(n, 0) AS quantidade_termos, primeira_publicacao_termo, ultima_publicacao_termo,
    coalesce(quantidade_prorrogacoes, 0) AS quantidade_prorrogacoes, coalesce(quantidade_reajustes, 0) AS quantidade_reajustes,
    coalesce(quantidade_alteracoes_quantitativas, 0) AS quantidade_alteracoes_quantitativas
  FROM g LEFT JOIN t USING (chave_grupo_contrato)""",
)(lambda s, d: recipe.terms_per_contract(current(s, d), terms(s, d)))

query(
    "gld_ct_07_relacionamento_orgao_contratado",
    f"""
  WITH g AS (SELECT {AGENCY}, codigo_contratado, nome_contratado, {nuni("chave_registro_contrato")} AS quantidade_contratos,
      {tot("valor_final_compra")} AS valor_final_total, {tot("valor_inicial_compra")} AS valor_inicial_total,
      {tot("variacao_valor_contrato")} AS variacao_total
    FROM ({CURRENT}) WHERE codigo_contratado IS NOT NULL GROUP BY ALL),
  s AS (SELECT *, CAST(sum(CAST(valor_final_total AS DECIMAL(28,8))) OVER (PARTITION BY codigo_orgao) AS DOUBLE) AS valor_total_orgao FROM g)
  SELECT *, {pct("valor_final_total", "valor_total_orgao")} AS percentual_concentracao,
    {rank("valor_final_total", "codigo_orgao")} AS posicao_contratado_no_orgao FROM s""",
)(lambda s, d: recipe.agency_contractor(current(s, d)))

# ---------------------------------------------------------------- dimensions

_AGENCY_KEY = "coalesce(codigo_orgao_superior, '') || '|' || coalesce(codigo_orgao, '')"
query("dim_ct_01_orgao", f"SELECT DISTINCT {_AGENCY_KEY} AS chave_orgao, {AGENCY} FROM ({CURRENT})")(
    lambda s, d: recipe.dim_agency(current(s, d))
)
query(
    "dim_ct_02_unidade_gestora",
    f"""SELECT DISTINCT coalesce(codigo_orgao, '') || '|' || coalesce(codigo_ug, '') AS chave_unidade_gestora,
    {_AGENCY_KEY} AS chave_orgao, codigo_orgao_superior, codigo_orgao, codigo_ug, nome_ug FROM ({CURRENT})""",
)(lambda s, d: recipe.dim_unit(current(s, d)))
query(
    "dim_ct_03_contratado",
    f"""SELECT codigo_contratado AS chave_contratado, codigo_contratado, max(nome_contratado) AS nome_contratado,
    {npres("nome_contratado")} AS quantidade_nomes_encontrados, {npres("nome_contratado")} > 1 AS possui_variacao_nome,
    {nuni("chave_registro_contrato")} AS quantidade_contratos, {npres("codigo_orgao")} AS quantidade_orgaos,
    {tot("valor_final_compra")} AS valor_final_total
    FROM ({CURRENT}) WHERE codigo_contratado IS NOT NULL GROUP BY codigo_contratado""",
)(lambda s, d: recipe.dim_contractor(current(s, d)))


def _surrogate_sql(number: str, column: str, label: str, source: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY {column}) AS {number}, {column}
    FROM (SELECT DISTINCT coalesce({column}, '{label}') AS {column} FROM ({source}))"""


query("dim_ct_04_modalidade_compra", _surrogate_sql("codigo_modalidade", "modalidade_compra", "NÃO INFORMADA", CURRENT))(
    lambda s, d: recipe.dim_modality(current(s, d))
)
query("dim_ct_05_situacao_contrato", _surrogate_sql("codigo_situacao", "situacao_contrato", "NÃO INFORMADA", CURRENT))(
    lambda s, d: recipe.dim_status(current(s, d))
)
_WIDE = calendar_sql(
    "SELECT date_trunc('month', min(o_orderdate)) AS lo, last_day(CAST(max(o_orderdate) AS DATE)) AS hi FROM {orders}"
)


@query(
    "dim_ct_06_tempo",
    f"""SELECT * EXCLUDE (semana), semana AS semana_ano, CAST(trimestre AS VARCHAR) || 'º trimestre' AS nome_trimestre,
    isodow(data) AS dia_semana_numero, strftime(data, '%m/%Y') AS mes_ano, isodow(data) >= 6 AS fim_de_semana
    FROM (SELECT *, weekofyear(data) AS semana FROM ({_WIDE}))""",
)
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    """The calendar of the months the orders cover."""
    orders = staged(spark, sf, "SELECT CAST(o_orderdate AS DATE) AS d FROM {orders}")
    bounds = dimensions.date_bounds(orders, "d").select(F.trunc("lo", "month").alias("lo"), F.last_day("hi").alias("hi"))
    return dimensions.wide_calendar(dimensions._days(bounds))


# ---------------------------------------------------------------- audits


def _unique_sql(dataset: str, key: str, source: str) -> str:
    return f"""SELECT 'unique_key' AS "check", '{dataset}' AS dataset, '{key}' AS "key", count(*) AS rows, {nuni(key)} AS distinct_keys,
    count(*) - {nuni(key)} AS duplicates, count(*) - count({key}) AS null_keys,
    CASE WHEN count(*) = {nuni(key)} AND count(*) = count({key}) THEN 'info' ELSE 'error' END AS severity,
    count(*) = {nuni(key)} AND count(*) = count({key}) AS approved, CAST(NULL AS VARCHAR) AS message FROM ({source})"""


@query("dq_01_unique_key", _unique_sql("itens_contrato", "chave_item_contrato", SILVER_ITEMS))
def unique_item_key(spark: SparkSession, sf: str) -> DataFrame:
    return checks.unique_key(items(spark, sf), "itens_contrato", "chave_item_contrato")


_RULES = {
    "signature_after_start": "data_assinatura_contrato > data_inicio_vigencia",
    "end_before_start": "data_fim_vigencia < data_inicio_vigencia",
    "negative_contract_duration": "duracao_vigencia_dias < 0",
}


def rules_sql(dataset: str, source: str, rules: dict[str, str]) -> str:
    """Non-blocking rules, one row each."""
    parts = [
        f"""SELECT '{name}' AS "check", '{dataset}' AS dataset, {cnt(rule)} AS rows,
      CASE WHEN {cnt(rule)} > 0 THEN 'warning' ELSE 'info' END AS severity, TRUE AS approved, CAST(NULL AS VARCHAR) AS message FROM src"""
        for name, rule in rules.items()
    ]
    return f"WITH src AS ({source}) " + " UNION ALL ".join(parts)


query("dq_05_contract_dates", rules_sql("contratos_historico", SILVER_CONTRACTS, _RULES))(
    lambda s, d: recipe.date_checks(contracts(s, d))
)
query(
    "dq_06_snapshot_consistency",
    f"""WITH g AS (SELECT chave_grupo_contrato, count(*) AS n, {cnt("periodo_origem <> periodo_mais_recente")} AS stale FROM ({CURRENT}) GROUP BY 1)
    SELECT 'current_contract_groups' AS "check", 'contratos_atuais' AS dataset, {bigint("sum(n)")} AS rows, count(*) AS distinct_keys,
      {cnt("n > 1")} AS multiple_record_groups, CASE WHEN {cnt("n > 1")} > 0 THEN 'warning' ELSE 'info' END AS severity, TRUE AS approved FROM g
    UNION ALL SELECT 'current_period_consistency', 'contratos_atuais', {bigint("sum(stale)")}, NULL, NULL,
      CASE WHEN sum(stale) > 0 THEN 'error' ELSE 'info' END, sum(stale) = 0 FROM g""",
)(lambda s, d: recipe.snapshot_checks(current(s, d)))
query(
    "dq_07_special_items",
    f"""SELECT 'special_contract_items' AS "check", 'itens_contrato' AS dataset, count(*) AS rows, {cnt("item_codigo_zero")} AS item_code_zero,
    {cnt("item_sigiloso")} AS confidential_items, CASE WHEN {cnt("item_codigo_zero OR item_sigiloso")} > 0 THEN 'warning' ELSE 'info' END AS severity,
    TRUE AS approved FROM ({SILVER_ITEMS})""",
)(lambda s, d: recipe.item_checks(items(s, d)))


def _quality(spark: SparkSession, sf: str) -> DataFrame:
    """No table is stored: hashes enter the key checks alone, which read each table once; the other checks read a few plain columns."""
    return recipe.quality(silver_tables(spark, sf))


_NOTE = "Há valor abaixo de zero."


def _neg(dataset: str, column: str, source: str, blocking: bool) -> str:
    n = cnt(f"{column} < 0")
    level = "error" if blocking else "warning"
    return f"""SELECT 'negative_values' AS c, '{dataset}' AS ds, '{column}' AS sub, {n} AS v,
      CASE WHEN {n} > 0 THEN '{level}' ELSE 'info' END AS sev, {f"{n} = 0" if blocking else "TRUE"} AS ok FROM {source}"""


def _ref(source: str, src_name: str, key: str) -> str:
    n = f"(SELECT count(DISTINCT {key}) FROM {source} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM h WHERE {key} IS NOT NULL))"
    return f"""SELECT 'referential_integrity' AS c, '{src_name}' AS ds, '{key}' AS sub, {n} AS v,
      CASE WHEN {n} > 0 THEN 'error' ELSE 'info' END AS sev, {n} = 0 AS ok"""


def _uni(dataset: str, key: str, source: str) -> str:
    dup = f"count(*) - {nuni(key)}"
    return f"""SELECT 'unique_key' AS c, '{dataset}' AS ds, '{key}' AS sub, {dup} AS v,
      CASE WHEN {dup} = 0 AND count(*) = count({key}) THEN 'info' ELSE 'error' END AS sev,
      {dup} = 0 AND count(*) = count({key}) AS ok FROM {source}"""


_SUITE = [
    _uni("contratos_historico", "chave_registro_contrato", "h"),
    _uni("contratos_atuais", "chave_registro_contrato", "c"),
    _uni("itens_contrato", "chave_item_contrato", "i"),
    _uni("termos_aditivos", "chave_termo_aditivo", "t"),
    _ref("c", "contratos_atuais", "chave_registro_contrato"),
    _ref("i", "itens_contrato", "chave_grupo_contrato"),
    _ref("t", "termos_aditivos", "chave_grupo_contrato"),
    *[_neg("contratos_historico", c, "h", True) for c in ("valor_inicial_compra", "valor_final_compra")],
    *[_neg("itens_contrato", c, "i", False) for c in ("quantidade_item", "valor_item", "valor_total_item_calculado")],
]


@query(
    "dq_14_contracts_suite",
    f"WITH h AS ({SILVER_CONTRACTS}), c AS ({CURRENT}), i AS ({SILVER_ITEMS}), t AS ({SILVER_TERMS}) "
    + "SELECT * FROM ("
    + " UNION ALL ".join(_SUITE)
    + ")",
)
def suite(spark: SparkSession, sf: str) -> DataFrame:
    """The suite without the pure warnings that have their own queries."""
    found = _quality(spark, sf).where(F.col("check").isin("unique_key", "referential_integrity", "negative_values"))
    return found.select(
        F.col("check").alias("c"),
        F.coalesce("dataset", "source_dataset").alias("ds"),
        F.coalesce("key", "column", "source_key").alias("sub"),
        F.coalesce("duplicates", "missing_keys", "negative_rows").alias("v"),
        F.col("severity").alias("sev"),
        F.col("approved").alias("ok"),
    )


_TIES = {
    "contratos_fisicos": "SELECT count(*) FROM c",
    "grupos_contrato": "SELECT count(DISTINCT chave_grupo_contrato) FROM c",
    "grupos_unicos_resumo": "SELECT count(DISTINCT chave_grupo_contrato) FROM c",
    "valor_inicial_contratos": f"SELECT {tot('valor_inicial_compra')} FROM c",
    "valor_final_contratos": f"SELECT {tot('valor_final_compra')} FROM c",
    "variacao_valor_contratos": f"SELECT {tot('variacao_valor_contrato')} FROM c",
    "itens_identificados_atuais": "SELECT count(*) FROM i WHERE NOT item_codigo_zero",
    "itens_codigo_zero": "SELECT count(*) FROM i WHERE item_codigo_zero",
    "valor_itens_identificados": f"SELECT {tot('valor_total_item_calculado', 'NOT item_codigo_zero')} FROM i",
    "valor_itens_codigo_zero": f"SELECT {tot('valor_total_item_calculado', 'item_codigo_zero')} FROM i",
    "termos_aditivos": "SELECT count(DISTINCT chave_termo_aditivo) FROM t",
    "grupos_termos": "SELECT count(DISTINCT chave_grupo_contrato) FROM c",
    "contratados_ranking": "SELECT count(*) FROM (SELECT DISTINCT codigo_contratado, nome_contratado FROM c WHERE codigo_contratado IS NOT NULL)",
    "orgaos_ranking": f"SELECT count(*) FROM (SELECT DISTINCT {AGENCY} FROM c)",
    "relacionamentos_orgao_contratado": f"SELECT count(*) FROM (SELECT DISTINCT {AGENCY}, codigo_contratado, nome_contratado FROM c WHERE codigo_contratado IS NOT NULL)",
}


@query(
    "rec_02_contracts",
    f"WITH c AS ({CURRENT}), i AS ({CURRENT_ITEMS}), t AS ({SILVER_TERMS}) "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST(({sql}) AS DOUBLE) AS silver_value, TRUE AS approved""" for name, sql in _TIES.items()
    ),
)
def reconcile_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Items and terms exist for groups without a contract record too; those are left out, as in a clean source.

    Stored are the columns that keys, marts and checks are made of. Hashes, of which a row's takes more room than the rest of it, are made when
    they are read.
    """
    key = "chave_grupo_contrato"
    unread = ["arquivo_origem", "ano_origem", "mes_origem", "nome_ug_licitacao", "modalidade_compra_licitacao"]
    history = staged(spark, sf, STAGE_CONTRACTS).drop(*unread).withColumn(key, recipe.group_key())
    current = materialize(recipe.current_contracts(history, by_group=True))
    groups = current.select(key).distinct()

    def of_groups(stage: str, columns: list[str]) -> DataFrame:
        typed = staged(spark, sf, stage).select("numero_contrato", "codigo_ug", *columns).withColumn(key, recipe.group_key())
        return materialize(typed.join(groups, key, "left_semi").drop(key))

    tables = {
        "contratos_atuais": recipe.derive_contracts(current),
        "itens_contrato": recipe.derive_items(of_groups(STAGE_ITEMS, [*recipe.HASHED_ITEM, "periodo_origem"])),
        "termos_aditivos": recipe.term_keys_as_bytes(recipe.derive_terms(of_groups(STAGE_TERMS, recipe.HASHED_TERM))),
    }
    return recipe.reconciliation(tables, recipe.gold(tables, stored=False)).select("check", "silver_value", "approved")
