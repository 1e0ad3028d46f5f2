"""Tenders on orders (headers) and lineitem (winning items, participants, commitments)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import checks, dedup
from plumbline.plans import tenders as recipe
from plumbline.runtime import materialize
from plumbline.workload.base import (
    as_text, bigint, calendar_sql, cnt, has, mean, npres, nuni, pct, query, rank, staged, tot, with_reader_columns,
)
from plumbline.workload.contracts import rules_sql

_QUARTER = "CAST(year({0}) * 100 + quarter({0}) AS STRING)"


def _parts(key: str) -> str:
    return f"""CAST({key} AS STRING) AS numero_licitacao, 'U' || CAST({key} % 11 AS STRING) AS codigo_ug,
      'UNIDADE ' || CAST({key} % 11 AS STRING) AS nome_ug,
      CASE WHEN {key} % 59 = 0 THEN NULL ELSE CAST({key} % 5 + 1 AS STRING) END AS codigo_modalidade_compra,
      'MODALIDADE ' || CAST({key} % 5 + 1 AS STRING) AS modalidade_compra, 'P' || CAST({key} AS STRING) AS numero_processo"""


def _agency(key: str) -> str:
    return f"CAST({key} % 25 AS STRING) AS codigo_orgao, 'ORGAO ' || CAST({key} % 25 AS STRING) AS nome_orgao"


STAGE_TENDERS = f"""
  SELECT {_parts("o_orderkey")}, {_agency("o_orderkey")},
    CASE WHEN o_orderkey % 25 = 24 THEN NULL ELSE CAST(o_orderkey % 5 AS STRING) END AS codigo_orgao_superior,
    'SUPERIOR ' || CAST(o_orderkey % 5 AS STRING) AS nome_orgao_superior,
    CASE WHEN o_orderkey % 29 = 0 THEN 'Sob SIGILO' WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'Objeto ' || o_orderpriority END AS objeto,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderstatus END AS situacao_licitacao,
    CASE WHEN o_custkey % 29 = 0 THEN NULL ELSE 'u' || CAST(o_custkey % 27 AS STRING) END AS uf,
    CASE WHEN o_custkey % 33 = 0 THEN NULL ELSE 'cidade ' || CAST(o_custkey % 90 AS STRING) END AS municipio,
    CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 - 3 AS INT) END AS data_resultado_compra,
    CAST(o_orderdate AS DATE) AS data_abertura,
    CASE WHEN o_orderkey % 43 = 0 THEN NULL ELSE o_totalprice END AS valor_licitacao,
    {_QUARTER.format("o_orderdate")} AS periodo_origem
  FROM {{orders}}"""
# Some items and participants name a tender that isn't there.
_ITEM_TENDER = "(CASE WHEN l_linestatus = 'F' THEN l_orderkey ELSE l_orderkey + 700000000 END)"
_PARTICIPANT_TENDER = "(CASE WHEN l_orderkey % 13 <> 0 THEN l_orderkey ELSE l_orderkey + 800000000 END)"
STAGE_ITEMS = f"""
  SELECT {_parts(_ITEM_TENDER)}, {_agency(_ITEM_TENDER)},
    CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE CAST(l_linenumber AS STRING) END AS codigo_item_compra,
    'DESC ' || l_returnflag AS descricao, l_quantity AS quantidade_item,
    CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_extendedprice END AS valor_item,
    CASE WHEN l_suppkey % 17 = 0 THEN '-11' WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS codigo_vencedor,
    CASE WHEN l_suppkey % 17 = 0 THEN 'Sigiloso' ELSE 'FORNECEDOR ' || CAST(l_suppkey AS STRING) END AS nome_vencedor,
    {_QUARTER.format("l_shipdate")} AS periodo_origem
  FROM {{lineitem}}"""
STAGE_PARTICIPANTS = f"""
  SELECT {_parts(_PARTICIPANT_TENDER)}, {_agency(_PARTICIPANT_TENDER)},
    CASE WHEN l_partkey % 61 = 0 THEN NULL WHEN l_linenumber = 7 THEN '0' ELSE CAST(l_linenumber AS STRING) END AS codigo_item_compra,
    'ITEM ' || l_linestatus AS descricao_item_compra,
    CASE WHEN l_partkey % 17 = 0 THEN '-11' WHEN l_partkey % 23 = 0 THEN NULL ELSE CAST(l_partkey % 500 AS STRING) END AS codigo_participante,
    CASE WHEN l_partkey % 17 = 0 THEN 'SIGILOSO' ELSE 'EMPRESA ' || CAST(l_partkey % 500 AS STRING) END AS nome_participante,
    CASE l_returnflag WHEN 'A' THEN 'Sim' WHEN 'R' THEN 'Não' ELSE NULL END AS flag_vencedor,
    {_QUARTER.format("l_shipdate")} AS periodo_origem
  FROM {{lineitem}}"""
STAGE_COMMITMENTS = f"""
  SELECT {_parts("l_orderkey")}, CASE WHEN l_partkey % 61 = 0 THEN NULL ELSE 'E' || CAST(l_partkey AS STRING) END AS codigo_empenho,
    CAST(l_shipdate AS DATE) AS data_emissao_empenho, 'OBS ' || l_returnflag AS observacao_empenho, l_extendedprice AS valor_empenho_r,
    {_QUARTER.format("l_shipdate")} AS periodo_origem
  FROM {{lineitem}}"""

KEY = "coalesce(codigo_ug, 'SEM_UG') || '|' || coalesce(codigo_modalidade_compra, 'SEM_MODALIDADE') || '|' || coalesce(numero_licitacao, 'SEM_NUMERO')"
ITEM_KEY = f"{KEY} || '|' || coalesce(codigo_item_compra, 'SEM_ITEM')"


def _known(code: str) -> str:
    return f"coalesce({code} NOT IN ('-11', '-3', '0'), FALSE)"


SILVER_TENDERS = f"""
  SELECT * REPLACE (upper(uf) AS uf, upper(municipio) AS municipio), {KEY} AS chave_licitacao, {has("objeto", "sigilo")} AS licitacao_sigilosa,
    datediff('day', data_abertura, data_resultado_compra) AS duracao_processo_dias,
    coalesce(data_resultado_compra < data_abertura, FALSE) AS data_processo_inconsistente FROM ({STAGE_TENDERS})"""
SILVER_ITEMS = f"""
  SELECT *, {KEY} AS chave_licitacao, {ITEM_KEY} AS chave_item_licitacao,
    {ITEM_KEY} || '|' || coalesce(codigo_vencedor, 'SEM_VENCEDOR') AS chave_item_vencedor,
    quantidade_item * valor_item AS valor_total_item_calculado, {_known("codigo_vencedor")} AS vencedor_identificado,
    {has("nome_vencedor", "sigil")} AS vencedor_sigiloso FROM ({STAGE_ITEMS})"""
SILVER_PARTICIPANTS = f"""
  SELECT * REPLACE (upper(flag_vencedor) AS flag_vencedor), {KEY} AS chave_licitacao, {ITEM_KEY} AS chave_item_licitacao,
    {ITEM_KEY} || '|' || coalesce(codigo_participante, 'SEM_PARTICIPANTE') AS chave_participacao,
    upper(flag_vencedor) IN ('SIM', 'S', 'YES') AS participante_vencedor, {_known("codigo_participante")} AS participante_identificado,
    {has("nome_participante", "sigil")} AS participante_sigiloso FROM ({STAGE_PARTICIPANTS})"""
SILVER_COMMITMENTS = f"""
  SELECT *, {KEY} AS chave_licitacao, {KEY} || '|' || coalesce(codigo_empenho, 'SEM_EMPENHO') AS chave_empenho_licitacao
  FROM ({STAGE_COMMITMENTS})"""
AGENCY = "codigo_orgao_superior, nome_orgao_superior, codigo_orgao, nome_orgao"


def tenders(spark: SparkSession, sf: str) -> DataFrame:
    typed = staged(spark, sf, STAGE_TENDERS)
    return recipe.derive_tenders(typed.withColumns({c: F.upper(c) for c in ("uf", "municipio")}))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_items(staged(spark, sf, STAGE_ITEMS))


def participants(spark: SparkSession, sf: str) -> DataFrame:
    typed = staged(spark, sf, STAGE_PARTICIPANTS)
    return recipe.derive_participants(typed.withColumn("flag_vencedor", F.upper("flag_vencedor")))


def commitments(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_commitments(staged(spark, sf, STAGE_COMMITMENTS))


def competing(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.competition(tenders(spark, sf), participants(spark, sf), items(spark, sf))


def silver_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "licitacoes": tenders(spark, sf),
        "itens_licitacao": items(spark, sf),
        "participantes_licitacao": participants(spark, sf),
        "empenhos_relacionados": commitments(spark, sf),
    }


def _text(spark: SparkSession, sf: str, stage: str) -> DataFrame:
    typed = staged(spark, sf, stage)
    return with_reader_columns(as_text(typed), typed, ["periodo_origem"])


query("slv_05_licitacoes", SILVER_TENDERS)(lambda s, d: recipe.silver_tenders(_text(s, d, STAGE_TENDERS)))
query("slv_06_itens_licitacao", SILVER_ITEMS)(lambda s, d: recipe.silver_items(_text(s, d, STAGE_ITEMS)))
query("slv_07_participantes_licitacao", SILVER_PARTICIPANTS)(lambda s, d: recipe.silver_participants(_text(s, d, STAGE_PARTICIPANTS)))
query("slv_08_empenhos_relacionados", SILVER_COMMITMENTS)(lambda s, d: recipe.silver_commitments(_text(s, d, STAGE_COMMITMENTS)))

COMPETITION = f"""
  SELECT l.*, coalesce(quantidade_participantes, 0) AS quantidade_participantes, coalesce(quantidade_vencedores, 0) AS quantidade_vencedores,
    coalesce(quantidade_itens_disputados, 0) AS quantidade_itens_disputados,
    coalesce(quantidade_participacoes_sigilosas, 0) AS quantidade_participacoes_sigilosas,
    coalesce(quantidade_itens_resultado, 0) AS quantidade_itens_resultado,
    coalesce(quantidade_fornecedores_vencedores, 0) AS quantidade_fornecedores_vencedores,
    coalesce(valor_itens_vencedores, 0.0) AS valor_itens_vencedores,
    coalesce(quantidade_participantes, 0) <= 1 AS baixa_competitividade, coalesce(quantidade_participantes, 0) = 1 AS participante_unico,
    coalesce(quantidade_participantes, 0) = 0 AS sem_participante_identificado, coalesce(quantidade_vencedores, 0) = 0 AS sem_vencedor_identificado
  FROM ({SILVER_TENDERS}) l
  LEFT JOIN (SELECT chave_licitacao, {npres("codigo_participante")} AS quantidade_participantes,
      {npres("codigo_participante", "participante_vencedor")} AS quantidade_vencedores,
      {npres("codigo_item_compra")} AS quantidade_itens_disputados, {cnt("participante_sigiloso")} AS quantidade_participacoes_sigilosas
    FROM ({SILVER_PARTICIPANTS}) GROUP BY 1) p USING (chave_licitacao)
  LEFT JOIN (SELECT chave_licitacao, {npres("codigo_item_compra")} AS quantidade_itens_resultado,
      {npres("codigo_vencedor", "vencedor_identificado")} AS quantidade_fornecedores_vencedores, {tot("valor_item")} AS valor_itens_vencedores
    FROM ({SILVER_ITEMS}) GROUP BY 1) i USING (chave_licitacao)"""
query("gld_lc_01_concorrencia_licitacoes", COMPETITION)(competing)

_LOW = pct("quantidade_baixa_competitividade", "quantidade_licitacoes")
query(
    "gld_lc_02_ranking_orgaos",
    f"""
  WITH a AS (SELECT {AGENCY}, {nuni("chave_licitacao")} AS quantidade_licitacoes, {npres("codigo_ug")} AS quantidade_ugs,
      {npres("codigo_modalidade_compra")} AS quantidade_modalidades, {tot("valor_licitacao")} AS valor_total_licitado,
      {mean("valor_licitacao")} AS valor_medio_licitacao, max(valor_licitacao) AS maior_valor_licitacao
    FROM ({SILVER_TENDERS}) GROUP BY {AGENCY}),
  b AS (SELECT {AGENCY}, {mean("quantidade_participantes", 4)} AS media_participantes, median(quantidade_participantes) AS mediana_participantes,
      {cnt("baixa_competitividade")} AS quantidade_baixa_competitividade, {cnt("participante_unico")} AS quantidade_participante_unico,
      {cnt("licitacao_sigilosa")} AS quantidade_licitacoes_sigilosas FROM ({COMPETITION}) GROUP BY {AGENCY})
  SELECT a.*, b.* EXCLUDE ({AGENCY}), {_LOW} AS percentual_baixa_competitividade, {rank("valor_total_licitado")} AS posicao_valor_licitado
  FROM a LEFT JOIN b USING ({AGENCY})""",
)(lambda s, d: recipe.ranking_agencies(tenders(s, d), competing(s, d)))
query(
    "gld_lc_03_ranking_fornecedores",
    f"""
  SELECT *, {rank("valor_itens_vencidos")} AS posicao_valor_itens_vencidos, {rank("quantidade_licitacoes_vencidas")} AS posicao_quantidade_licitacoes
  FROM (SELECT codigo_vencedor, nome_vencedor, {nuni("chave_licitacao")} AS quantidade_licitacoes_vencidas,
      {nuni("chave_item_licitacao")} AS quantidade_itens_vencidos, {npres("codigo_orgao")} AS quantidade_orgaos,
      {tot("valor_item")} AS valor_itens_vencidos, {mean("valor_item")} AS valor_medio_item, max(valor_item) AS maior_valor_item
    FROM ({SILVER_ITEMS}) WHERE vencedor_identificado GROUP BY 1, 2)""",
)(lambda s, d: recipe.ranking_suppliers(items(s, d)))
query(
    "gld_lc_04_ranking_modalidades",
    f"""
  WITH a AS (SELECT codigo_modalidade_compra, modalidade_compra, {nuni("chave_licitacao")} AS quantidade_licitacoes,
      {npres("codigo_orgao")} AS quantidade_orgaos, {tot("valor_licitacao")} AS valor_total_licitado,
      {mean("valor_licitacao")} AS valor_medio_licitacao, {cnt("licitacao_sigilosa")} AS quantidade_sigilosas
    FROM ({SILVER_TENDERS}) GROUP BY 1, 2),
  b AS (SELECT codigo_modalidade_compra, modalidade_compra, {mean("quantidade_participantes", 4)} AS media_participantes,
      {cnt("baixa_competitividade")} AS quantidade_baixa_competitividade, {cnt("participante_unico")} AS quantidade_participante_unico
    FROM ({COMPETITION}) GROUP BY 1, 2)
  SELECT a.*, b.* EXCLUDE (codigo_modalidade_compra, modalidade_compra), {_LOW} AS percentual_baixa_competitividade,
    {rank("valor_total_licitado")} AS posicao_valor_licitado
  FROM a LEFT JOIN b USING (codigo_modalidade_compra, modalidade_compra)""",
)(lambda s, d: recipe.ranking_modalities(tenders(s, d), competing(s, d)))
query(
    "gld_lc_05_ranking_uf",
    f"""
  SELECT *, {rank("valor_total_licitado", "uf")} AS posicao_municipio_na_uf
  FROM (SELECT uf, municipio, {nuni("chave_licitacao")} AS quantidade_licitacoes, {npres("codigo_orgao")} AS quantidade_orgaos,
      {tot("valor_licitacao")} AS valor_total_licitado, {mean("valor_licitacao")} AS valor_medio_licitacao
    FROM ({SILVER_TENDERS}) WHERE uf IS NOT NULL GROUP BY 1, 2)""",
)(lambda s, d: recipe.ranking_states(tenders(s, d)))
query(
    "gld_lc_06_relacionamento_orgao_fornecedor",
    f"""
  WITH g AS (SELECT l.codigo_orgao_superior, l.nome_orgao_superior, i.codigo_orgao, i.nome_orgao, codigo_vencedor, nome_vencedor,
      {nuni("i.chave_licitacao")} AS quantidade_licitacoes, {bigint(nuni("chave_item_licitacao"))} AS quantidade_itens,
      {tot("valor_item")} AS valor_itens_vencidos
    FROM ({SILVER_ITEMS}) i LEFT JOIN ({SILVER_TENDERS}) l USING (chave_licitacao) WHERE vencedor_identificado GROUP BY ALL),
  s AS (SELECT *, CAST(sum(CAST(valor_itens_vencidos AS DECIMAL(28,8))) OVER (PARTITION BY codigo_orgao) AS DOUBLE) AS total_itens_vencidos_orgao FROM g)
  SELECT *, {pct("valor_itens_vencidos", "total_itens_vencidos_orgao")} AS percentual_concentracao_fornecedor,
    {rank("valor_itens_vencidos", "codigo_orgao")} AS posicao_fornecedor_no_orgao FROM s""",
)(lambda s, d: recipe.agency_supplier(tenders(s, d), items(s, d)))

# ---------------------------------------------------------------- dimensions

query(
    "dim_lc_01_orgao",
    f"SELECT DISTINCT coalesce(codigo_orgao_superior, '') || '|' || coalesce(codigo_orgao, '') AS chave_orgao, {AGENCY} FROM ({STAGE_TENDERS})",
)(lambda s, d: recipe.dim_agency(tenders(s, d)))
query(
    "dim_lc_02_unidade_gestora",
    f"""SELECT DISTINCT coalesce(codigo_orgao, '') || '|' || coalesce(codigo_ug, '') AS chave_unidade_gestora, codigo_orgao, codigo_ug, nome_ug
    FROM ({STAGE_TENDERS})""",
)(lambda s, d: recipe.dim_unit(tenders(s, d)))
query(
    "dim_lc_03_fornecedor",
    f"SELECT DISTINCT codigo_vencedor AS chave_fornecedor, codigo_vencedor, nome_vencedor FROM ({STAGE_ITEMS})",
)(lambda s, d: recipe.dim_supplier(items(s, d)))
query(
    "dim_lc_04_modalidade",
    f"SELECT DISTINCT codigo_modalidade_compra AS chave_modalidade, codigo_modalidade_compra, modalidade_compra FROM ({STAGE_TENDERS})",
)(lambda s, d: recipe.dim_modality(tenders(s, d)))
query(
    "dim_lc_05_situacao",
    f"""SELECT row_number() OVER (ORDER BY situacao_licitacao) AS chave_situacao, situacao_licitacao
    FROM (SELECT DISTINCT coalesce(situacao_licitacao, 'NÃO INFORMADA') AS situacao_licitacao FROM ({STAGE_TENDERS}))""",
)(lambda s, d: recipe.dim_status(tenders(s, d)))
query(
    "dim_lc_06_localidade",
    f"""SELECT DISTINCT coalesce(uf, 'NÃO INFORMADA') || '|' || coalesce(municipio, 'NÃO INFORMADO') AS chave_localidade,
    coalesce(uf, 'NÃO INFORMADA') AS uf, coalesce(municipio, 'NÃO INFORMADO') AS municipio FROM ({SILVER_TENDERS})""",
)(lambda s, d: recipe.dim_place(tenders(s, d)))
query(
    "dim_lc_07_tempo",
    calendar_sql(
        f"""SELECT least(min(data_abertura), min(data_resultado_compra)) AS lo,
    greatest(max(data_abertura), max(data_resultado_compra)) AS hi FROM ({STAGE_TENDERS})"""
    ),
)(lambda s, d: recipe.dim_time(tenders(s, d)))

# ---------------------------------------------------------------- deduplication and audits

query(
    "ddp_01_latest_period_wins",
    f"""SELECT chave_item_vencedor, periodo_origem, valor_item, codigo_item_compra FROM ({SILVER_ITEMS})
    QUALIFY row_number() OVER (PARTITION BY chave_item_vencedor ORDER BY periodo_origem DESC, valor_item ASC NULLS FIRST, codigo_item_compra ASC NULLS FIRST) = 1""",
)(
    lambda s, d: dedup.keep_first(
        items(s, d).select("chave_item_vencedor", "periodo_origem", "valor_item", "codigo_item_compra"),
        ["chave_item_vencedor"],
        [F.col("periodo_origem").desc(), F.col("valor_item").asc_nulls_first(), F.col("codigo_item_compra").asc_nulls_first()],
        total_order=True,
    )
)
query(
    "ddp_01_removed_count",
    f"""SELECT count(*) - count(DISTINCT chave_item_vencedor) AS removidos, count(DISTINCT chave_item_vencedor) AS mantidos FROM ({SILVER_ITEMS})""",
)(
    lambda s, d: dedup.keep_latest(items(s, d), ["chave_item_vencedor"])
    .agg(F.count(F.lit(1)).alias("mantidos"), F.max(F.lit("x")).alias("_x"))
    .join(items(s, d).agg(F.count(F.lit(1)).alias("_n"), F.max(F.lit("x")).alias("_x")), "_x")
    .select((F.col("_n") - F.col("mantidos")).alias("removidos"), "mantidos")
)

query(
    "dq_02_referential_integrity",
    f"""WITH m AS (SELECT count(*) AS n FROM (SELECT DISTINCT chave_item_licitacao FROM ({SILVER_PARTICIPANTS})
      EXCEPT SELECT chave_item_licitacao FROM ({SILVER_ITEMS})))
    SELECT 'referential_integrity' AS "check", 'participantes_licitacao' AS source_dataset, 'itens_licitacao' AS target_dataset,
      'chave_item_licitacao' AS source_key, 'chave_item_licitacao' AS target_key, n AS missing_keys,
      CASE WHEN n > 0 THEN 'warning' ELSE 'info' END AS severity, TRUE AS approved FROM m""",
)(
    lambda s, d: checks.reference(
        participants(s, d), items(s, d), "participantes_licitacao", "itens_licitacao", "chave_item_licitacao", severity="warning"
    )
)
_NEG = " UNION ALL ".join(
    f"""SELECT 'negative_values' AS "check", 'x' AS dataset, '{c}' AS "column", {cnt(f"{c} < 0")} AS negative_rows,
    CASE WHEN {cnt(f"{c} < 0")} > 0 THEN 'error' ELSE 'info' END AS severity, {cnt(f"{c} < 0")} = 0 AS approved,
    CASE WHEN {cnt(f"{c} < 0")} > 0 THEN 'Há valor abaixo de zero.' END AS message FROM s"""
    for c in ("duracao_processo_dias", "valor_licitacao")
)


@query(
    "dq_04_negative_values",
    f"""WITH s AS ({SILVER_TENDERS}) {_NEG}
    UNION ALL SELECT 'negative_values', 'x', 'ausente', NULL, 'error', FALSE, 'Sem a coluna ausente'""",
)
def negative_values(spark: SparkSession, sf: str) -> DataFrame:
    return checks.negative_values(tenders(spark, sf), "x", ["duracao_processo_dias", "valor_licitacao", "ausente"])


query(
    "dq_05_tender_dates",
    rules_sql(
        "licitacoes",
        SILVER_TENDERS,
        {"result_before_opening": "data_resultado_compra < data_abertura", "negative_process_duration": "duracao_processo_dias < 0"},
    ),
)(lambda s, d: recipe.date_checks(tenders(s, d)))
_NAMELESS = cnt("participante_vencedor AND NOT participante_identificado AND NOT participante_sigiloso")
query(
    "dq_08_winner_without_identification",
    f"""SELECT 'winner_without_identification' AS "check", 'participantes_licitacao' AS dataset,
    {_NAMELESS} AS rows, CASE WHEN {_NAMELESS} > 0 THEN 'error' ELSE 'info' END AS severity, {_NAMELESS} = 0 AS approved,
    CAST(NULL AS VARCHAR) AS message FROM ({SILVER_PARTICIPANTS})""",
)(lambda s, d: recipe.winner_check(participants(s, d)))
query(
    "dq_09_orphan_profile",
    f"""WITH o AS (SELECT * FROM ({SILVER_PARTICIPANTS}) WHERE chave_item_licitacao NOT IN (SELECT chave_item_licitacao FROM ({SILVER_ITEMS})))
    SELECT 'orphan_participants_detail' AS "check", 'participantes_licitacao' AS dataset, count(*) AS rows,
      count(DISTINCT chave_item_licitacao) AS missing_keys, {cnt("participante_vencedor")} AS orphan_winners,
      {cnt("NOT participante_vencedor")} AS orphan_non_winners, {cnt("codigo_item_compra = '0'")} AS item_code_zero,
      {cnt("codigo_participante = '-11'")} AS confidential_participants,
      CASE WHEN count(*) > 0 THEN 'warning' ELSE 'info' END AS severity, TRUE AS approved FROM o""",
)(lambda s, d: recipe.orphan_profile(participants(s, d), items(s, d)))


def _uni(dataset: str, key: str, source: str) -> str:
    fine = f"count(*) = {nuni(key)} AND count(*) = count({key})"
    return f"""SELECT 'unique_key' AS c, '{dataset}' AS ds, '{key}' AS sub, count(*) - {nuni(key)} AS v,
    CASE WHEN {fine} THEN 'info' ELSE 'error' END AS sev, {fine} AS ok FROM {source}"""


def _ref(dataset: str, key: str, source: str, target: str, warn: bool = False) -> str:
    n = f"(SELECT count(*) FROM (SELECT DISTINCT {key} FROM {source} WHERE {key} IS NOT NULL EXCEPT SELECT {key} FROM {target}))"
    return f"""SELECT 'referential_integrity' AS c, '{dataset}' AS ds, '{key}' AS sub, {n} AS v,
    CASE WHEN {n} = 0 THEN 'info' ELSE '{"warning" if warn else "error"}' END AS sev, {"TRUE" if warn else f"{n} = 0"} AS ok"""


def _neg(dataset: str, column: str, source: str) -> str:
    n = cnt(f"{column} < 0")
    return f"""SELECT 'negative_values' AS c, '{dataset}' AS ds, '{column}' AS sub, {n} AS v,
    CASE WHEN {n} > 0 THEN 'error' ELSE 'info' END AS sev, {n} = 0 AS ok FROM {source}"""


_SUITE = [
    _uni("licitacoes", "chave_licitacao", "l"),
    _uni("itens_licitacao", "chave_item_vencedor", "i"),
    _uni("participantes_licitacao", "chave_participacao", "p"),
    _uni("empenhos_relacionados", "chave_empenho_licitacao", "e"),
    _ref("itens_licitacao", "chave_licitacao", "i", "l"),
    _ref("participantes_licitacao", "chave_licitacao", "p", "l"),
    _ref("participantes_licitacao", "chave_item_licitacao", "p", "i", warn=True),
    _ref("empenhos_relacionados", "chave_licitacao", "e", "l"),
    _neg("licitacoes", "valor_licitacao", "l"),
    *[_neg("itens_licitacao", c, "i") for c in ("quantidade_item", "valor_item", "valor_total_item_calculado")],
    _neg("empenhos_relacionados", "valor_empenho_r", "e"),
]


@query(
    "dq_14_tenders_suite",
    f"WITH l AS ({SILVER_TENDERS}), i AS ({SILVER_ITEMS}), p AS ({SILVER_PARTICIPANTS}), e AS ({SILVER_COMMITMENTS}) "
    + " UNION ALL ".join(_SUITE),
)
def suite(spark: SparkSession, sf: str) -> DataFrame:
    # No table is stored: the key checks read each once, the others a few plain columns.
    found = recipe.quality(silver_tables(spark, sf))
    kept = found.where(F.col("check").isin("unique_key", "referential_integrity", "negative_values"))
    return kept.select(
        F.col("check").alias("c"),
        F.coalesce("dataset", "source_dataset").alias("ds"),
        F.coalesce("key", "column", "source_key").alias("sub"),
        F.coalesce("duplicates", "missing_keys", "negative_rows").alias("v"),
        F.col("severity").alias("sev"),
        F.col("approved").alias("ok"),
    )


def _distinct(columns: str, source: str) -> str:
    return f"SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {source})"


_VALUE = f"SELECT {tot('valor_licitacao')} FROM l"
_WON = f"SELECT {tot('valor_item')} FROM w"
_SUPPLIER = "codigo_vencedor, nome_vencedor"
_TIES = {
    **{c: "SELECT count(*) FROM l" for c in (
        "quantidade_licitacoes", "chaves_licitacao_unicas_silver", "chaves_licitacao_unicas_gold",
        "ranking_modalidades_quantidade", "ranking_orgaos_quantidade",
    )},
    **{c: _VALUE for c in ("valor_total_licitacoes", "ranking_modalidades_valor", "ranking_orgaos_valor")},
    "ranking_uf_quantidade": "SELECT count(*) FROM l WHERE uf IS NOT NULL",
    "ranking_uf_valor": _VALUE + " WHERE uf IS NOT NULL",
    "quantidade_itens_fornecedores": _distinct(f"{_SUPPLIER}, chave_item_licitacao", "w"),
    "quantidade_itens_relacionamento": _distinct(f"codigo_orgao, nome_orgao, {_SUPPLIER}, chave_item_licitacao", "w"),
    "valor_itens_fornecedores": _WON,
    "valor_itens_relacionamento": _WON,
    "valor_itens_concorrencia": f"SELECT {tot('valor_item')} FROM i",
    "quantidade_fornecedores": _distinct(_SUPPLIER, "w"),
    "quantidade_modalidades": _distinct("codigo_modalidade_compra, modalidade_compra", "l"),
    "quantidade_orgaos": _distinct(AGENCY, "l"),
    "quantidade_localidades": _distinct("uf, municipio", "l WHERE uf IS NOT NULL"),
    "quantidade_relacionamentos": _distinct(
        f"l.codigo_orgao_superior, l.nome_orgao_superior, w.codigo_orgao, w.nome_orgao, {_SUPPLIER}", "w LEFT JOIN l USING (chave_licitacao)"
    ),
}


# Items of tenders that aren't there are in the Silver total, and in no tender's.
_NO_STRAYS = "NOT EXISTS (SELECT 1 FROM i WHERE chave_licitacao NOT IN (SELECT chave_licitacao FROM l))"


@query(
    "rec_03_tenders",
    f"WITH l AS ({SILVER_TENDERS}), i AS ({SILVER_ITEMS}), w AS (SELECT * FROM i WHERE vencedor_identificado) "
    + " UNION ALL ".join(
        f"""SELECT '{name}' AS "check", CAST(({sql}) AS DOUBLE) AS silver_value, {_NO_STRAYS if name == "valor_itens_concorrencia" else "TRUE"} AS approved"""
        for name, sql in _TIES.items()
    ),
)
def reconcile_tenders(spark: SparkSession, sf: str) -> DataFrame:
    """Stored are the columns that several marts and checks read; participants are read by one."""
    tables = silver_tables(spark, sf)
    read = {
        "licitacoes": ["chave_licitacao", *recipe.AGENCY, *recipe.MODALITY, "codigo_ug", "valor_licitacao", "licitacao_sigilosa", "uf", "municipio"],
        "itens_licitacao": [
            "chave_licitacao", "chave_item_licitacao", "codigo_item_compra", "codigo_orgao", "nome_orgao", "codigo_vencedor", "nome_vencedor",
            "vencedor_identificado", "valor_item",
        ],
    }
    tables |= {name: materialize(tables[name].select(*columns)) for name, columns in read.items()}
    return recipe.reconciliation(tables, recipe.gold(tables)).select("check", "silver_value", "approved")
