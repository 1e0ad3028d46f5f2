"""Amendments on orders (execution) and lineitem (payments to beneficiaries)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import dedup
from plumbline.plans import amendments as recipe
from plumbline.runtime import materialize
from plumbline.workload.base import as_text, npres, nuni, pct, per, query, rank, staged, tot

YEARS = [1996, 1997, 1998, 1999, 2000]
AS_OF_YEAR = 2000
_MONEY = "CAST(CAST({0} AS DECIMAL(18,2)) AS DOUBLE)"

STAGE_AMENDMENTS = f"""
  SELECT CAST(CAST(year(o_orderdate) AS BIGINT) * 10000 + o_orderkey % 3000 AS STRING) AS codigo_emenda,
    CAST(year(o_orderdate) AS BIGINT) AS ano_emenda, 'TIPO ' || substr(o_orderpriority, 1, 1) AS tipo_emenda,
    CASE WHEN o_custkey % 97 = 0 THEN NULL ELSE CAST(o_custkey % 97 AS STRING) END AS codigo_autor_emenda,
    'AUTOR ' || CAST(o_custkey % 97 AS STRING) || CASE WHEN o_orderkey % 10 = 0 THEN ' JR' ELSE '' END AS nome_autor_emenda,
    CAST(o_orderkey % 3000 AS STRING) AS numero_emenda, 'CIDADE ' || CAST(o_custkey % 50 AS STRING) AS localidade_aplicacao,
    CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE CAST(o_custkey % 200 AS STRING) END AS codigo_municipio_ibge,
    'MUNICIPIO ' || CAST(o_custkey % 200 AS STRING) AS municipio, CAST(o_custkey % 27 AS STRING) AS codigo_uf_ibge,
    CASE WHEN o_custkey % 29 = 0 THEN NULL WHEN o_custkey % 27 = 1 THEN 'Nacional' WHEN o_custkey % 27 = 2 THEN 'Múltiplo'
      ELSE 'uf' || CAST(o_custkey % 27 AS STRING) END AS uf,
    CASE WHEN o_custkey % 53 = 0 THEN NULL ELSE 'REGIAO ' || CAST(o_custkey % 4 AS STRING) END AS regiao,
    substr(o_orderpriority, 1, 1) AS codigo_funcao,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority || ' (EX)' ELSE o_orderpriority END AS nome_funcao,
    CAST(o_orderkey % 6 AS STRING) AS codigo_subfuncao, 'SUB ' || CAST(o_orderkey % 6 AS STRING) AS nome_subfuncao,
    CAST(o_orderkey % 8 AS STRING) AS codigo_programa, 'PROGRAMA ' || CAST(o_orderkey % 8 AS STRING) AS nome_programa,
    CAST(o_orderkey % 12 AS STRING) AS codigo_acao, 'ACAO ' || CAST(o_orderkey % 12 AS STRING) AS nome_acao,
    CAST(o_orderkey % 2 AS STRING) AS codigo_plano_orcamentario, 'PLANO ' || CAST(o_orderkey % 2 AS STRING) AS nome_plano_orcamentario,
    CASE WHEN o_orderkey % 47 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice END AS valor_empenhado,
    {_MONEY.format("o_totalprice - (o_orderkey % 7) * 100")} AS valor_liquidado,
    {_MONEY.format("o_totalprice - (o_orderkey % 10) * 100")} AS valor_pago,
    CAST((o_orderkey % 5) * 50 AS DOUBLE) AS valor_restos_pagar_inscritos,
    CAST((o_orderkey % 3) * 10 AS DOUBLE) AS valor_restos_pagar_cancelados, CAST((o_orderkey % 4) * 25 AS DOUBLE) AS valor_restos_pagar_pagos
  FROM {{orders}}"""
STAGE_PAYMENTS = """
  SELECT CAST(CAST(year(l_shipdate) AS BIGINT) * 10000 + l_orderkey % 3000 AS STRING) AS codigo_emenda,
    CASE WHEN l_partkey % 97 = 0 THEN NULL ELSE CAST(l_partkey % 97 AS STRING) END AS codigo_autor_emenda,
    'AUTOR ' || CAST(l_partkey % 97 AS STRING) AS nome_autor_emenda, CAST(l_orderkey % 3000 AS STRING) AS numero_emenda,
    'TIPO ' || l_returnflag AS tipo_emenda, CAST(year(l_shipdate) AS BIGINT) * 100 + month(l_shipdate) AS ano_mes,
    CASE WHEN l_suppkey % 19 = 0 THEN NULL ELSE CAST(l_suppkey AS STRING) END AS codigo_favorecido,
    'FAVORECIDO ' || CAST(l_suppkey AS STRING) || CASE WHEN l_linenumber = 7 THEN ' LTDA' ELSE '' END AS favorecido,
    'NATUREZA ' || CAST(l_suppkey % 4 AS STRING) AS natureza_juridica, 'PJ' AS tipo_favorecido,
    'U' || CAST(l_suppkey % 27 AS STRING) AS uf_favorecido, 'MUNICIPIO ' || CAST(l_suppkey % 50 AS STRING) AS municipio_favorecido,
    l_extendedprice AS valor_recebido
  FROM {lineitem}"""

_IN_YEARS = f"IN ({', '.join(map(str, YEARS))})"
_SHARES = f"""{pct("valor_liquidado", "valor_empenhado")} AS percentual_liquidado, {pct("valor_pago", "valor_empenhado")} AS percentual_pago"""
BENEFICIARY = ", ".join(recipe.BENEFICIARY)
SILVER_PAYMENTS = f"""
  SELECT codigo_emenda, codigo_autor_emenda, nome_autor_emenda, numero_emenda, tipo_emenda, ano_mes,
    CAST(substr(codigo_emenda, 1, 4) AS BIGINT) AS ano_emenda, ano_mes // 100 AS ano_recebimento, ano_mes % 100 AS mes_recebimento,
    {BENEFICIARY}, {tot("valor_recebido")} AS valor_recebido
  FROM ({STAGE_PAYMENTS}) WHERE CAST(substr(codigo_emenda, 1, 4) AS BIGINT) {_IN_YEARS} GROUP BY ALL"""
SILVER_AMENDMENTS = f"SELECT *, {_SHARES} FROM ({STAGE_AMENDMENTS}) WHERE ano_emenda {_IN_YEARS}"


def amendments(spark: SparkSession, sf: str) -> DataFrame:
    typed = staged(spark, sf, STAGE_AMENDMENTS)
    return typed.where(F.col("ano_emenda").isin(YEARS)).withColumns(recipe.executed_shares())


def _payments_text(spark: SparkSession, sf: str) -> DataFrame:
    return as_text(staged(spark, sf, STAGE_PAYMENTS), pad=False)


def payments(spark: SparkSession, sf: str, near: list[str] | None = None) -> DataFrame:
    return recipe.silver_beneficiaries(_payments_text(spark, sf), YEARS, near)


_GRAIN = "codigo_emenda, codigo_municipio_ibge, codigo_funcao, codigo_subfuncao, codigo_programa, codigo_acao, codigo_plano_orcamentario"


@query(
    "slv_11_emendas_historico",
    f"""SELECT * EXCLUDE (linha), {_SHARES}, {pct("valor_restos_pagar_pagos", "valor_empenhado")} AS percentual_restos_pagos
    FROM (SELECT s.*, o_orderkey AS linha FROM ({STAGE_AMENDMENTS.replace("SELECT ", "SELECT o_orderkey, ", 1)}) s)
    WHERE ano_emenda {_IN_YEARS} QUALIFY row_number() OVER (PARTITION BY {_GRAIN} ORDER BY linha DESC) = 1""".replace(
        "EXCLUDE (linha)", "EXCLUDE (linha, o_orderkey)"
    ),
)
def silver_history(spark: SparkSession, sf: str) -> DataFrame:
    """Text rows in the order of their line numbers; the last of a grain wins (DDP-02)."""
    typed = staged(spark, sf, STAGE_AMENDMENTS.replace("SELECT ", "SELECT o_orderkey AS linha_arquivo, ", 1))
    text = as_text(typed, pad=False).withColumn("arquivo_origem", F.lit("EmendasParlamentares.csv"))
    return recipe.silver_amendments(text.withColumn("linha_arquivo", F.col("linha_arquivo").cast("bigint")), YEARS)


_GRANT_SOURCE = """
  SELECT l_orderkey * 8 + l_linenumber AS linha_arquivo, CAST((1995 + l_suppkey % 5) * 10000 + l_suppkey % 300 AS STRING) AS codigo_emenda,
    CAST(l_orderkey % 4000 AS STRING) AS numero_convenio, 'CONVENENTE ' || CAST(l_orderkey % 120 AS STRING) AS convenente,
    CAST(l_shipdate AS DATE) AS data_publicacao_convenio, l_extendedprice AS valor_convenio
  FROM {lineitem}"""


@query(
    "slv_12_convenios_historico",
    f"""SELECT codigo_emenda, numero_convenio, convenente, data_publicacao_convenio, valor_convenio,
    CAST(substr(codigo_emenda, 1, 4) AS BIGINT) AS ano_emenda FROM ({_GRANT_SOURCE})
    WHERE CAST(substr(codigo_emenda, 1, 4) AS BIGINT) {_IN_YEARS}
    QUALIFY row_number() OVER (PARTITION BY codigo_emenda, numero_convenio ORDER BY linha_arquivo DESC, valor_convenio DESC) = 1""",
)
def silver_grants(spark: SparkSession, sf: str) -> DataFrame:
    typed = staged(spark, sf, _GRANT_SOURCE)
    # Natural duplicates share a line number; the value stands in for the line inside them.
    text = as_text(typed, pad=False).withColumn("arquivo_origem", F.lit("Convenios.csv"))
    line = F.struct(F.col("linha_arquivo").cast("bigint"), F.translate("valor_convenio", ".,", "").cast("bigint"))
    return recipe.silver_grants(text.withColumn("linha_arquivo", line), YEARS)


query("slv_13_favorecidos_historico", SILVER_PAYMENTS)(payments)


@query(
    "slv_14_emendas_api",
    """SELECT codigo_emenda, ano, tipo_emenda, autor, nome_autor, numero_emenda, localidade_gasto, funcao, subfuncao, valor_empenhado,
      valor_liquidado, valor_pago, valor_resto_inscrito, valor_resto_cancelado, valor_resto_pago, municipio, uf,
      round(CASE WHEN valor_empenhado > 0 THEN valor_liquidado / valor_empenhado * 100 END, 4) AS percentual_liquidado,
      round(CASE WHEN valor_empenhado > 0 THEN valor_pago / valor_empenhado * 100 END, 4) AS percentual_pago
    FROM (SELECT CAST(o_custkey AS VARCHAR) AS codigo_emenda, CAST(year(o_orderdate) AS VARCHAR) AS ano, 'T' AS tipo_emenda,
        'A' || CAST(o_custkey % 97 AS VARCHAR) AS autor, 'AUTOR ' || CAST(o_custkey % 97 AS VARCHAR) AS nome_autor,
        CAST(o_orderkey AS VARCHAR) AS numero_emenda,
        CASE WHEN o_orderkey % 4 = 0 THEN 'Nacional' ELSE 'São Tomé ' || CAST(o_custkey % 9 AS VARCHAR) || ' - SP' END AS localidade_gasto,
        'F' AS funcao, 'S' AS subfuncao, o_totalprice AS valor_empenhado,
        CAST(CAST(o_totalprice - (o_orderkey % 7) * 100 AS DECIMAL(18,2)) AS DOUBLE) AS valor_liquidado,
        CAST(CAST(o_totalprice - (o_orderkey % 10) * 100 AS DECIMAL(18,2)) AS DOUBLE) AS valor_pago,
        CAST(NULL AS DOUBLE) AS valor_resto_inscrito, 0.0::DOUBLE AS valor_resto_cancelado, 1234.5::DOUBLE AS valor_resto_pago,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'São Tomé ' || CAST(o_custkey % 9 AS VARCHAR) END AS municipio,
        CASE WHEN o_orderkey % 4 <> 0 THEN 'SP' END AS uf, o_orderkey
      FROM {orders} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)""",
)
def silver_api(spark: SparkSession, sf: str) -> DataFrame:
    pages = staged(
        spark,
        sf,
        """SELECT CAST(o_custkey AS STRING) AS codigoEmenda, CAST(year(o_orderdate) AS STRING) AS ano, 'T' AS tipoEmenda,
        'A' || CAST(o_custkey % 97 AS STRING) AS autor, 'AUTOR ' || CAST(o_custkey % 97 AS STRING) AS nomeAutor,
        CAST(o_orderkey AS STRING) AS numeroEmenda,
        CASE WHEN o_orderkey % 4 = 0 THEN 'Nacional' ELSE 'São Tomé ' || CAST(o_custkey % 9 AS STRING) || ' - SP' END AS localidadeDoGasto,
        'F' AS funcao, 'S' AS subfuncao, translate(format_number(o_totalprice, 2), ',.', '.,') AS valorEmpenhado,
        translate(format_number(o_totalprice - (o_orderkey % 7) * 100, 2), ',.', '.,') AS valorLiquidado,
        translate(format_number(o_totalprice - (o_orderkey % 10) * 100, 2), ',.', '.,') AS valorPago,
        'sem valor' AS valorRestoInscrito, '0,00' AS valorRestoCancelado, '1.234,50' AS valorRestoPago,
        'pagina' AS _file, o_orderkey AS _place FROM {orders}""",
    )
    return recipe.silver_api_pages(pages)


# ---------------------------------------------------------------- gold

AUTHOR = "codigo_autor_emenda, nome_autor_emenda"
_EXECUTED = ", ".join(f"{tot(c)} AS {c}" for c in recipe.EXECUTED)
_ALL_AMOUNTS = ", ".join(f"{tot(c)} AS {c}" for c in (*recipe.EXECUTED, *recipe.LEFTOVERS))
RANK_AUTHORS = f"""
  WITH e AS (SELECT ano_emenda, {AUTHOR}, {nuni("codigo_emenda")} AS quantidade_emendas, {nuni("codigo_municipio_ibge")} AS quantidade_municipios,
      {npres("uf")} AS quantidade_ufs, {npres("nome_funcao")} AS quantidade_funcoes, {_ALL_AMOUNTS} FROM ({SILVER_AMENDMENTS}) GROUP BY 1, 2, 3),
  r AS (SELECT ano_emenda, {AUTHOR}, {npres("codigo_favorecido")} AS f, {tot("valor_recebido")} AS v FROM ({SILVER_PAYMENTS}) GROUP BY 1, 2, 3),
  j AS (SELECT e.*, coalesce(f, 0) AS quantidade_favorecidos, coalesce(v, 0.0) AS valor_recebido_favorecidos, {_SHARES},
      {per("valor_empenhado", "quantidade_emendas")} AS valor_medio_por_emenda FROM e LEFT JOIN r USING (ano_emenda, {AUTHOR}))
  SELECT *, {rank("valor_empenhado", "ano_emenda")} AS posicao_valor_empenhado, {rank("valor_pago", "ano_emenda")} AS posicao_valor_pago,
    {rank("percentual_pago", "ano_emenda")} AS posicao_percentual_pago FROM j"""
RANK_BENEFICIARIES = f"""
  SELECT *, {rank("valor_recebido", "ano_emenda")} AS posicao_valor_recebido FROM (
    SELECT ano_emenda, {BENEFICIARY}, {nuni("codigo_emenda")} AS quantidade_emendas, {npres("codigo_autor_emenda")} AS quantidade_autores,
      {nuni("ano_mes")} AS quantidade_meses_recebimento, {tot("valor_recebido")} AS valor_recebido FROM ({SILVER_PAYMENTS}) GROUP BY ALL)"""


def _places(keys: str, where: str, third: str) -> str:
    return f"""
  SELECT *, {pct("valor_pago", "valor_empenhado")} AS percentual_pago, {rank("valor_pago", "ano_emenda")} AS posicao_valor_pago FROM (
    SELECT ano_emenda, {keys}, {nuni("codigo_emenda")} AS quantidade_emendas, {npres("codigo_autor_emenda")} AS quantidade_autores, {third}, {_EXECUTED}
    FROM (SELECT * REPLACE (upper(uf) AS uf) FROM ({SILVER_AMENDMENTS})) WHERE {where} GROUP BY ALL)"""


RANK_STATES = _places("uf, regiao", "uf IS NOT NULL", f"{npres('codigo_municipio_ibge')} AS quantidade_municipios")
RANK_CITIES = _places(
    "codigo_municipio_ibge, municipio, uf, regiao", "codigo_municipio_ibge IS NOT NULL", f"{npres('nome_funcao')} AS quantidade_funcoes"
)
RANK_FUNCTIONS = _places("codigo_funcao, nome_funcao", "TRUE", f"{npres('codigo_municipio_ibge')} AS quantidade_municipios")
PAIRS = f"""
  WITH g AS (SELECT ano_emenda, {AUTHOR}, {BENEFICIARY}, {nuni("codigo_emenda")} AS quantidade_emendas, {tot("valor_recebido")} AS valor_recebido
    FROM ({SILVER_PAYMENTS}) GROUP BY ALL),
  s AS (SELECT *, CAST(sum(CAST(valor_recebido AS DECIMAL(28,8))) OVER (PARTITION BY ano_emenda, codigo_autor_emenda) AS DOUBLE) AS total_recebido_por_autor FROM g)
  SELECT *, {pct("valor_recebido", "total_recebido_por_autor")} AS percentual_concentracao_autor,
    {rank("valor_recebido", "ano_emenda, codigo_autor_emenda")} AS posicao_favorecido_por_autor FROM s"""

query("gld_em_01_ranking_parlamentares", RANK_AUTHORS)(lambda s, d: recipe.ranking_authors(amendments(s, d), payments(s, d)))
query("gld_em_02_ranking_favorecidos", RANK_BENEFICIARIES)(lambda s, d: recipe.ranking_beneficiaries(payments(s, d, recipe.NEAR_BENEFICIARY)))
query("gld_em_03_ranking_uf", RANK_STATES)(lambda s, d: recipe.ranking_states(amendments(s, d)))
query("gld_em_04_ranking_municipios", RANK_CITIES)(lambda s, d: recipe.ranking_cities(amendments(s, d)))
query("gld_em_05_ranking_funcoes", RANK_FUNCTIONS)(lambda s, d: recipe.ranking_functions(amendments(s, d)))
query("gld_em_06_relacionamento_autor_favorecido", PAIRS)(lambda s, d: recipe.author_beneficiary(payments(s, d, recipe.NEAR_PAIR)))

# ---------------------------------------------------------------- dimensions

query(
    "dim_em_01_ano",
    f"""SELECT DISTINCT ano_emenda, ano_emenda >= {AS_OF_YEAR} AS dados_parciais,
    CASE WHEN ano_emenda >= {AS_OF_YEAR} THEN 'Em andamento' ELSE 'Encerrado' END AS status_exercicio
    FROM (SELECT ano_emenda FROM ({SILVER_AMENDMENTS}) UNION SELECT ano_emenda FROM ({SILVER_PAYMENTS}))""",
)(lambda s, d: recipe.dim_year([amendments(s, d), payments(s, d)], AS_OF_YEAR))


def _canonical_sql(source: str, key: str, attributes: list[str], name: str, counted: bool = True) -> str:
    columns = ", ".join([key, *attributes])
    ties = ", ".join(f"{a} ASC NULLS FIRST" for a in [name, *[a for a in attributes if a != name]])
    count = ", count(*) AS quantidade_registros_origem" if counted else ""
    return f"""
  WITH s AS (SELECT * FROM ({source}) WHERE {key} IS NOT NULL AND trim({key}) <> ''),
  c AS (SELECT {columns}, count(*) AS n FROM s GROUP BY {columns} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {ties}) = 1),
  m AS (SELECT {key}, min(ano_emenda) AS primeiro_ano_emenda, max(ano_emenda) AS ultimo_ano_emenda{count} FROM s GROUP BY 1)
  SELECT c.* EXCLUDE (n), m.* EXCLUDE ({key}) FROM c JOIN m USING ({key})"""


def _author_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """From the keys of both marts: their measures and ranks aren't asked for."""
    authors = amendments(spark, sf).select("ano_emenda", *recipe.AUTHOR).distinct()
    return recipe.dim_author(authors, recipe.pair_keys(payments(spark, sf)))


def _beneficiary_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The keys of the pairs are stored; those of the beneficiaries' ranking are among them."""
    pairs = materialize(recipe.pair_keys(payments(spark, sf)))
    return recipe.dim_beneficiary(pairs.select("ano_emenda", *recipe.BENEFICIARY).distinct(), pairs)


query(
    "dim_em_02_autor",
    _canonical_sql(
        f"SELECT ano_emenda, {AUTHOR} FROM ({RANK_AUTHORS}) UNION ALL SELECT ano_emenda, {AUTHOR} FROM ({PAIRS})",
        "codigo_autor_emenda",
        ["nome_autor_emenda"],
        "nome_autor_emenda",
    ),
)(_author_dimension)
query(
    "dim_em_03_favorecido",
    _canonical_sql(
        f"SELECT ano_emenda, {BENEFICIARY} FROM ({RANK_BENEFICIARIES}) UNION ALL SELECT ano_emenda, {BENEFICIARY} FROM ({PAIRS})",
        "codigo_favorecido",
        recipe.BENEFICIARY[1:],
        "favorecido",
    ),
)(_beneficiary_dimension)
query("dim_em_04_funcao", f"SELECT codigo_funcao, min(nome_funcao) AS nome_funcao FROM ({RANK_FUNCTIONS}) GROUP BY 1")(
    lambda s, d: recipe.dim_function(recipe.ranking_functions(amendments(s, d)))
)
query(
    "dim_em_05_uf",
    f"""WITH s AS (SELECT uf, regiao FROM ({RANK_STATES}) UNION ALL SELECT uf, regiao FROM ({RANK_CITIES})),
    c AS (SELECT uf, regiao, count(*) AS n FROM s WHERE uf IS NOT NULL GROUP BY 1, 2),
    m AS (SELECT uf, regiao FROM c QUALIFY row_number() OVER (PARTITION BY uf ORDER BY regiao IS NULL, n DESC, regiao) = 1)
    SELECT uf, CASE uf WHEN 'MÚLTIPLO' THEN 'Múltiplas regiões' WHEN 'NACIONAL' THEN 'Nacional' ELSE regiao END AS regiao FROM m""",
)(lambda s, d: recipe.dim_state(recipe.ranking_states(amendments(s, d)), recipe.ranking_cities(amendments(s, d))))
query(
    "dim_em_06_municipio",
    _canonical_sql(RANK_CITIES, "codigo_municipio_ibge", ["municipio", "uf", "regiao"], "municipio", counted=False),
)(lambda s, d: recipe.dim_city(recipe.ranking_cities(amendments(s, d))))
query(
    "ddp_04_canonical_author",
    f"""SELECT codigo_autor_emenda, nome_autor_emenda FROM (SELECT {AUTHOR}, count(*) AS n FROM ({STAGE_AMENDMENTS}) GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY codigo_autor_emenda ORDER BY n DESC, nome_autor_emenda) = 1""",
)(
    lambda s, d: dedup.canonical(
        staged(s, d, STAGE_AMENDMENTS).select("codigo_autor_emenda", "nome_autor_emenda"),
        "codigo_autor_emenda",
        ["nome_autor_emenda"],
        "nome_autor_emenda",
    )
)

# ---------------------------------------------------------------- audits

# The authors' ranking lacks one year: its totals don't tie.
_GAP = {"ranking_parlamentares": "ano_emenda % 5 = 3", "ranking_favorecidos": "FALSE"}
_TIES = " UNION ALL ".join(
    f"""SELECT *, round(valor_gold - valor_silver, 2) AS diferenca, abs(round(valor_gold - valor_silver, 2)) <= 0.01 AS reconciliado FROM (
    SELECT ano_emenda, '{mart}' AS dataset, '{m}' AS metrica, {tot(m)} AS valor_silver, CASE WHEN {_GAP[mart]} THEN 0.0 ELSE {tot(m)} END AS valor_gold FROM ({source}) GROUP BY 1)"""
    for mart, source, metrics in (
        ("ranking_parlamentares", SILVER_AMENDMENTS, recipe.EXECUTED),
        ("ranking_favorecidos", SILVER_PAYMENTS, ["valor_recebido"]),
    )
    for m in metrics
)


@query("rec_05_amendments_by_year", _TIES)
def reconcile_amendments(spark: SparkSession, sf: str) -> DataFrame:
    """Of the rankings only the totals of a year are read, not the ranks. Payments are parsed once: stored is what is read of them."""
    paid = materialize(payments(spark, sf).select("ano_emenda", *recipe.AUTHOR, *recipe.BENEFICIARY, "codigo_emenda", "ano_mes", "valor_recebido"))
    tables = {"emendas": amendments(spark, sf), "favorecidos": paid}
    marts = {
        "ranking_parlamentares": recipe.ranking_authors(tables["emendas"], tables["favorecidos"], ranked=False).where(f"NOT ({_GAP['ranking_parlamentares']})"),
        "ranking_favorecidos": recipe.ranking_beneficiaries(tables["favorecidos"], ranked=False),
    }
    return recipe.reconciliation(tables, marts)


