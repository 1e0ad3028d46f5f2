"""Deputies' expenses on lineitem: supplier = deputy, part = company, line = document line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans import deputy_expenses as recipe
from plumbline.runtime import materialize
from plumbline.workload.base import calendar_sql, cnt, mean, npres, nuni, per, query, rank, staged, tot

YEARS = [1995, 1996, 1997, 1998, 1999, 2000]
_YEAR = "CAST(year(l_shipdate) AS BIGINT)"
STAGE = f"""
  SELECT CASE WHEN l_suppkey % 10 = 0 THEN 'LIDERANCA ' ELSE 'DEPUTADO ' END || CAST(l_suppkey AS STRING) AS nome_beneficiario,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE 'C' || CAST(l_suppkey AS STRING) END AS cpf,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS ideCadastro,
    CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE CAST(l_suppkey % 600 AS STRING) END AS nuCarteiraParlamentar,
    CASE WHEN l_suppkey % 26 = 0 THEN NULL ELSE 'U' || CAST(l_suppkey % 26 AS STRING) END AS uf,
    CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE 'P' || CAST(l_suppkey % 8 AS STRING) END AS partido,
    'TIPO ' || CAST(l_linenumber AS STRING) AS tipo_despesa, 'ESP' AS especificacao_despesa,
    CASE WHEN l_partkey % 701 = 0 THEN NULL ELSE 'EMPRESA ' || CAST(l_partkey % 700 AS STRING) END AS nome_fornecedor,
    CASE WHEN l_partkey % 14 = 0 THEN NULL ELSE lpad(CAST(l_partkey % 700 AS STRING), 14, '0') END AS documento_fornecedor,
    CAST(l_orderkey AS STRING) AS numero_documento, 'PASSAGEIRO' AS passageiro, 'BSB/GRU' AS trecho,
    '1' AS numero_ressarcimento, 'http://doc/' || CAST(l_orderkey AS STRING) AS url_documento,
    CAST(2023 AS BIGINT) AS numero_legislatura, CAST(57 AS BIGINT) AS codigo_legislatura,
    CASE WHEN l_linenumber = 7 THEN CAST(998 AS BIGINT) ELSE CAST(l_linenumber AS BIGINT) END AS codigo_tipo_despesa,
    CAST(0 AS BIGINT) AS codigo_especificacao_despesa, CAST(l_orderkey % 3 AS BIGINT) AS codigo_tipo_documento,
    {_YEAR} AS ano_despesa, CAST(0 AS BIGINT) AS numero_parcela, l_suppkey AS codigo_beneficiario, l_orderkey AS numero_lote,
    CASE WHEN l_orderkey % 6 = 0 THEN CAST(0 AS BIGINT) ELSE l_orderkey * 8 + l_linenumber END AS codigo_documento,
    l_extendedprice AS valor_documento,
    CASE WHEN l_linenumber = 2 THEN CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS valor_glosa,
    CASE WHEN l_returnflag = 'R' AND l_linenumber > 4 THEN -l_extendedprice
      WHEN l_linenumber = 2 THEN CAST(CAST(l_extendedprice - 10 AS DECIMAL(18,2)) AS DOUBLE) ELSE l_extendedprice END AS valor_liquido,
    CAST(month(l_shipdate) AS BIGINT) AS mes_despesa,
    CASE WHEN l_orderkey % 25 = 0 THEN NULL ELSE l_shipdate + INTERVAL '10' HOUR END AS data_hora_emissao,
    CASE WHEN l_linenumber = 5 THEN l_shipdate + INTERVAL '34' HOUR END AS data_hora_pagamento_restituicao,
    CASE WHEN l_linenumber = 5 THEN CAST(5.25 AS DOUBLE) END AS valor_restituicao,
    {_YEAR} AS ano_arquivo_origem, 'Ano-' || CAST({_YEAR} AS STRING) || '.csv' AS arquivo_origem,
    l_orderkey * 8 + l_linenumber AS linha_arquivo
  FROM {{lineitem}}"""

SILVER = f"""
  SELECT * , CAST(data_hora_emissao AS DATE) AS data_emissao, CAST(data_hora_pagamento_restituicao AS DATE) AS data_pagamento_restituicao,
    CASE WHEN cpf IS NOT NULL OR ideCadastro IS NOT NULL OR nuCarteiraParlamentar IS NOT NULL THEN 'PARLAMENTAR'
      ELSE 'LIDERANCA_OU_ORGAO' END AS tipo_beneficiario,
    CASE WHEN valor_liquido < 0 AND codigo_tipo_despesa IN (998, 999) THEN 'ESTORNO_AEREO' WHEN valor_liquido < 0 THEN 'ESTORNO_OU_AJUSTE'
      ELSE 'DESPESA' END AS tipo_movimento,
    round(valor_documento - valor_glosa - valor_liquido, 2) AS diferenca_financeira,
    abs(round(valor_documento - valor_glosa - valor_liquido, 2)) <= 0.01 AS financeiro_consistente,
    valor_restituicao IS NOT NULL AS possui_restituicao, data_hora_emissao IS NULL AS data_emissao_ausente,
    documento_fornecedor IS NULL AS fornecedor_sem_documento,
    CAST(ano_arquivo_origem AS VARCHAR) || '|' || arquivo_origem || '|' || CAST(linha_arquivo AS VARCHAR) AS chave_despesa,
    CASE WHEN codigo_documento > 0 THEN CAST(ano_arquivo_origem AS VARCHAR) || '|' || CAST(codigo_documento AS VARCHAR)
      ELSE 'SEM_DOCUMENTO|' || CAST(ano_arquivo_origem AS VARCHAR) || '|' || CAST(codigo_beneficiario AS VARCHAR) || '|' || CAST(linha_arquivo AS VARCHAR)
      END AS chave_documento,
    CAST(codigo_beneficiario AS VARCHAR) || '|' || coalesce(nome_beneficiario, '') AS chave_beneficiario,
    coalesce(documento_fornecedor, 'SEM_DOCUMENTO') || '|' || coalesce(nome_fornecedor, 'NÃO INFORMADO') AS chave_fornecedor,
    CAST(ano_despesa AS VARCHAR) || lpad(CAST(mes_despesa AS VARCHAR), 2, '0') AS periodo_despesa
  FROM ({STAGE})"""
FACT = f"""
  SELECT *, round(valor_liquido - coalesce(valor_restituicao, 0), 2) AS valor_liquido_apos_restituicao,
    valor_liquido > 0 AS movimento_positivo, valor_liquido < 0 AS movimento_negativo FROM ({SILVER})"""


def expenses(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.derive_expenses(staged(spark, sf, STAGE))


def fact(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.fact_expenses(expenses(spark, sf))


@query("slv_09_despesas", SILVER)
def silver(spark: SparkSession, sf: str) -> DataFrame:
    """The stage written as the landed file has it: source names, text, decimal comma in refunds."""
    typed = staged(spark, sf, STAGE)
    names = {**recipe.TEXT, **recipe.INTS, **recipe.LONGS, **recipe.AMOUNTS}
    iso = "yyyy-MM-dd'T'HH:mm:ss"
    raw = typed.select(
        *[F.concat(F.lit(" "), F.col(dst).cast("string"), F.lit(" ")).alias(src) for dst, src in names.items()],
        F.col("mes_despesa").cast("string").alias("numMes"),
        F.date_format("data_hora_emissao", iso).alias("datEmissao"),
        F.date_format("data_hora_pagamento_restituicao", iso).alias("datPagamentoRestituicao"),
        F.translate(F.col("valor_restituicao").cast("string"), ".", ",").alias("vlrRestituicao"),
        *recipe.LINEAGE,
    )
    return recipe.silver_expenses(raw)


_SUMS = f"{tot('valor_documento')} AS valor_total_documentos, {tot('valor_glosa')} AS valor_total_glosas, {tot('valor_liquido')} AS valor_total_liquido"
_RESTITUTIONS = f"{tot('valor_restituicao')} AS valor_total_restituicoes"
_LINES = "count(*) AS quantidade_lancamentos"
_REFUNDS = f"{cnt('valor_liquido < 0')} AS quantidade_estornos"
_RANK = f"{rank('valor_total_liquido')} AS posicao_valor_liquido"
_MEMBERS = f"(SELECT * FROM ({FACT}) WHERE tipo_beneficiario = 'PARLAMENTAR')"


def _n(column: str, name: str) -> str:
    return f"{nuni(column)} AS quantidade_{name}"


query("gld_gd_01_fato_gastos_deputados", FACT)(fact)
query(
    "gld_gd_02_ranking_deputados",
    f"""SELECT *, {_RANK}, {rank("quantidade_lancamentos")} AS posicao_quantidade_lancamentos FROM (
    SELECT chave_beneficiario, codigo_beneficiario, nome_beneficiario, partido, uf, {_LINES}, {_n("chave_documento", "documentos")},
      {_n("chave_fornecedor", "fornecedores")}, {_n("codigo_tipo_despesa", "tipos_despesa")}, {_SUMS}, {_RESTITUTIONS},
      {tot("valor_liquido_apos_restituicao")} AS valor_liquido_apos_restituicao, {_REFUNDS},
      {cnt("NOT financeiro_consistente")} AS quantidade_inconsistencias_financeiras
    FROM {_MEMBERS} GROUP BY 1, 2, 3, 4, 5)""",
)(lambda s, d: recipe.ranking_deputies(fact(s, d)))
query(
    "gld_gd_03_ranking_partidos",
    f"""SELECT *, {per("valor_total_liquido", "quantidade_parlamentares")} AS valor_medio_por_parlamentar, {_RANK} FROM (
    SELECT coalesce(partido, 'NÃO INFORMADO') AS partido, {_n("chave_beneficiario", "parlamentares")}, {_LINES},
      {_n("chave_documento", "documentos")}, {_n("chave_fornecedor", "fornecedores")}, {_SUMS}, {_RESTITUTIONS}
    FROM {_MEMBERS} GROUP BY coalesce(partido, 'NÃO INFORMADO'))""",
)(lambda s, d: recipe.ranking_parties(fact(s, d)))
query(
    "gld_gd_04_ranking_ufs",
    f"""SELECT *, {per("valor_total_liquido", "quantidade_parlamentares")} AS valor_medio_por_parlamentar, {_RANK} FROM (
    SELECT coalesce(uf, 'NÃO INFORMADA') AS uf, {_n("chave_beneficiario", "parlamentares")}, {_LINES},
      {_n("chave_fornecedor", "fornecedores")}, {_SUMS} FROM {_MEMBERS} GROUP BY coalesce(uf, 'NÃO INFORMADA'))""",
)(lambda s, d: recipe.ranking_states(fact(s, d)))
query(
    "gld_gd_05_ranking_fornecedores",
    f"""SELECT *, {_RANK} FROM (SELECT chave_fornecedor, documento_fornecedor, nome_fornecedor, {_LINES}, {_n("chave_documento", "documentos")},
      {_n("chave_beneficiario", "beneficiarios")}, {npres("partido")} AS quantidade_partidos, {npres("uf")} AS quantidade_ufs, {_SUMS}, {_REFUNDS}
    FROM ({FACT}) GROUP BY 1, 2, 3)""",
)(lambda s, d: recipe.ranking_suppliers(fact(s, d)))
query(
    "gld_gd_06_ranking_tipos_despesa",
    f"""SELECT *, {_RANK} FROM (SELECT codigo_tipo_despesa, tipo_despesa, {_LINES}, {_n("chave_beneficiario", "beneficiarios")},
      {_n("chave_fornecedor", "fornecedores")}, {_SUMS}, {mean("valor_liquido")} AS valor_medio_lancamento, {_REFUNDS}
    FROM ({FACT}) GROUP BY 1, 2)""",
)(lambda s, d: recipe.ranking_types(fact(s, d)))
query(
    "gld_gd_07_resumo_mensal",
    f"""SELECT ano_despesa, mes_despesa, periodo_despesa, {_LINES}, {_n("chave_documento", "documentos")},
      {_n("chave_beneficiario", "beneficiarios")}, {_n("chave_fornecedor", "fornecedores")}, {_SUMS}, {_RESTITUTIONS}, {_REFUNDS}
    FROM ({FACT}) GROUP BY 1, 2, 3""",
)(lambda s, d: recipe.monthly_summary(fact(s, d)))

# ---------------------------------------------------------------- dimensions

_ACTIVITY = f"{_LINES}, {tot('valor_liquido')} AS valor_total_liquido"
query(
    "dim_gd_01_beneficiario",
    f"""SELECT chave_beneficiario, codigo_beneficiario, nome_beneficiario, tipo_beneficiario, partido, uf, {_ACTIVITY}
    FROM ({FACT}) GROUP BY 1, 2, 3, 4, 5, 6""",
)(lambda s, d: recipe.dim_beneficiary(fact(s, d)))
query(
    "dim_gd_02_fornecedor",
    f"SELECT chave_fornecedor, documento_fornecedor, nome_fornecedor, {_ACTIVITY} FROM ({FACT}) GROUP BY 1, 2, 3",
)(lambda s, d: recipe.dim_supplier(fact(s, d)))
query(
    "dim_gd_03_tipo_despesa",
    f"SELECT DISTINCT CAST(codigo_tipo_despesa AS VARCHAR) AS chave_tipo_despesa, codigo_tipo_despesa, tipo_despesa FROM ({STAGE})",
)(lambda s, d: recipe.dim_type(fact(s, d)))
query(
    "dim_gd_04_partido",
    f"SELECT DISTINCT coalesce(partido, 'NÃO INFORMADO') AS chave_partido, coalesce(partido, 'NÃO INFORMADO') AS partido FROM ({STAGE})",
)(lambda s, d: recipe.dim_party(fact(s, d)))
query("dim_gd_05_uf", f"SELECT DISTINCT coalesce(uf, 'NÃO INFORMADA') AS chave_uf, coalesce(uf, 'NÃO INFORMADA') AS uf FROM ({STAGE})")(
    lambda s, d: recipe.dim_state(fact(s, d))
)
query("dim_gd_06_movimento", f"SELECT DISTINCT tipo_movimento AS chave_movimento, tipo_movimento FROM ({SILVER})")(
    lambda s, d: recipe.dim_movement(fact(s, d))
)
query("dim_gd_07_tempo", calendar_sql(f"SELECT min(data_emissao) AS lo, max(data_emissao) AS hi FROM ({SILVER})"))(
    lambda s, d: recipe.dim_time(fact(s, d))
)

# ---------------------------------------------------------------- audits


def _row(name: str, value: str, kind: str, note: str | None = None, positive: bool = False, source: str = "s") -> str:
    hit = f"{value} = 0" if positive else f"{value} > 0"
    fine = f"NOT ({hit})" if kind == "error" else "TRUE"
    return f"""SELECT '{name}' AS "check", 'despesas' AS dataset, CAST({value} AS BIGINT) AS value,
    CASE WHEN {hit} THEN '{kind}' ELSE 'info' END AS severity, {fine} AS approved, {f"'{note}'" if note else "CAST(NULL AS VARCHAR)"} AS message FROM {source}"""


_ROWS = [
    _row("dataset_not_empty", "count(*)", "error", positive=True),
    _row("expense_key_not_null", "count(*) - count(chave_despesa)", "error"),
    _row("expense_year_valid", cnt(f"ano_despesa NOT IN ({', '.join(map(str, YEARS))})"), "error"),
    _row("expense_month_valid", cnt("mes_despesa NOT BETWEEN 1 AND 12"), "error"),
    _row("movement_type_valid", cnt("tipo_movimento NOT IN ('DESPESA', 'ESTORNO_AEREO', 'ESTORNO_OU_AJUSTE')"), "error"),
    _row("negative_net_rows", cnt("valor_liquido < 0"), "warning", "Há líquidos abaixo de zero; seguem na tabela."),
    _row("negative_outside_airfare", cnt("valor_liquido < 0 AND codigo_tipo_despesa NOT IN (998, 999)"), "warning",
         "Líquido abaixo de zero em subcota que não é 998 nem 999: conferir."),
    _row("institutional_beneficiaries", cnt("tipo_beneficiario = 'LIDERANCA_OU_ORGAO'"), "warning",
         "Nem todo beneficiário é parlamentar."),
    _row("missing_issue_dates", "(count(*) - count(data_emissao))", "warning"),
    _row("missing_supplier_documents", "(count(*) - count(documento_fornecedor))", "warning"),
    _row("financially_inconsistent_rows", cnt("NOT financeiro_consistente"), "warning",
         "Documento menos glosa difere do líquido nestas linhas."),
    _row("expense_key_unique", cnt("n > 1"), "error", source="k"),
    _row("record_count_matches_unique_keys", "sum(n - 1)", "error", source="k"),
]
query(
    "dq_11_expenses_suite",
    f"WITH s AS ({SILVER}), k AS (SELECT chave_despesa, count(*) AS n FROM s GROUP BY 1) " + " UNION ALL ".join(_ROWS),
)(lambda s, d: recipe.quality(materialize(expenses(s, d)), YEARS))

_NET = f"SELECT {tot('valor_liquido')} FROM f"
_TIES = {
    "registros_fato": "SELECT count(*) FROM f",
    "chaves_despesa_unicas": "SELECT count(*) FROM f",
    "valor_documento_fato": f"SELECT {tot('valor_documento')} FROM f",
    "valor_glosa_fato": f"SELECT {tot('valor_glosa')} FROM f",
    **{c: _NET for c in ("valor_liquido_fato", "valor_ranking_fornecedores", "valor_ranking_tipos_despesa", "valor_resumo_mensal")},
    **{c: _NET.replace("FROM f", "FROM m") for c in ("valor_ranking_deputados", "valor_ranking_partidos", "valor_ranking_ufs")},
    "quantidade_deputados": "SELECT count(*) FROM (SELECT DISTINCT chave_beneficiario, partido, uf FROM m)",
    "quantidade_partidos": "SELECT count(DISTINCT coalesce(partido, '')) FROM m",
    "quantidade_ufs": "SELECT count(DISTINCT coalesce(uf, '')) FROM m",
    "quantidade_fornecedores": "SELECT count(DISTINCT chave_fornecedor) FROM f",
    "quantidade_tipos_despesa": "SELECT count(*) FROM (SELECT DISTINCT codigo_tipo_despesa, tipo_despesa FROM f)",
    "quantidade_periodos": "SELECT count(DISTINCT periodo_despesa) FROM f",
    "quantidade_estornos": "SELECT count(*) FROM f WHERE valor_liquido < 0",
}


@query(
    "rec_06_expenses",
    f"WITH f AS ({FACT}), m AS (SELECT * FROM f WHERE tipo_beneficiario = 'PARLAMENTAR') "
    + " UNION ALL ".join(
        f"""SELECT '{n}' AS "check", CAST(({q}) AS DOUBLE) AS silver_value, {"n = u" if n == "chaves_despesa_unicas" else "TRUE"} AS approved
    FROM (SELECT count(*) AS n, count(DISTINCT chave_despesa) AS u FROM f)"""
        for n, q in _TIES.items()
    ),
)
def reconcile_expenses(spark: SparkSession, sf: str) -> DataFrame:
    """Of the marts only rows and totals are read, so neither ranks nor distinct counts are computed and nothing is stored."""
    rows = expenses(spark, sf)
    return recipe.reconciliation(rows, recipe.gold(rows, ranked=False)).select("check", "silver_value", "approved")
