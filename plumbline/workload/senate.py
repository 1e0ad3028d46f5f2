"""Senate documents on supplier (senators), part (bills), orders (votings with votes) and lineitem (expenses)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators import checks, dimensions, measures
from plumbline.operators.measures import evaluate, evaluate_sets
from plumbline.operators.relationships import Relationship, propagate, validate, validate_all
from plumbline.plans import senate as recipe
from plumbline.runtime import materialize
from plumbline.workload import deputy_expenses
from plumbline.workload.base import cnt, nuni, query, rank, sha, staged, table, tot

YEARS = (1998, 1999, 2000)

# ---------------------------------------------------------------- nested documents (Spark only)

DOC_SENATORS = """
  SELECT named_struct('CodigoParlamentar', CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 5000000 ELSE s_suppkey END AS STRING), 'NomeParlamentar', ' SENADOR ' || CAST(s_suppkey AS STRING),
      'NomeCompletoParlamentar', s_name, 'SiglaPartidoParlamentar', CASE WHEN s_suppkey % 8 = 0 THEN '' ELSE 'P' || CAST(s_suppkey % 8 AS STRING) END,
      'UfParlamentar', 'U' || CAST(s_nationkey AS STRING), 'SexoParlamentar', CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END,
      'Telefones', array(CAST(s_suppkey * 3 AS STRING), CAST(s_suppkey * 7 AS STRING))) AS IdentificacaoParlamentar,
    named_struct('CodigoMandato', 'M' || CAST(s_suppkey + 500 AS STRING),
      'PrimeiraLegislaturaDoMandato', named_struct('NumeroLegislatura', '57', 'DataInicio', '2023-02-01', 'DataFim', 'sem data')) AS Mandato
  FROM {supplier}"""
SENATORS = """
  SELECT CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey + 5000000 ELSE s_suppkey END AS identificacao_parlamentar_codigo_parlamentar, 'SENADOR ' || CAST(s_suppkey AS STRING) AS identificacao_parlamentar_nome_parlamentar,
    s_name AS identificacao_parlamentar_nome_completo_parlamentar,
    CASE WHEN s_suppkey % 8 = 0 THEN NULL ELSE 'P' || CAST(s_suppkey % 8 AS STRING) END AS identificacao_parlamentar_sigla_partido_parlamentar,
    'U' || CAST(s_nationkey AS STRING) AS identificacao_parlamentar_uf_parlamentar,
    CASE WHEN s_suppkey % 2 = 0 THEN 'F' ELSE 'M' END AS identificacao_parlamentar_sexo_parlamentar,
    '["' || CAST(s_suppkey * 3 AS STRING) || '","' || CAST(s_suppkey * 7 AS STRING) || '"]' AS identificacao_parlamentar_telefones,
    s_suppkey + 500 AS mandato_codigo_mandato, '57' AS mandato_primeira_legislatura_do_mandato_numero_legislatura,
    CAST('2023-02-01' AS DATE) AS mandato_primeira_legislatura_do_mandato_data_inicio,
    CAST(NULL AS DATE) AS mandato_primeira_legislatura_do_mandato_data_fim
  FROM {supplier}"""
DOC_BILLS = """
  SELECT CAST(p_partkey AS STRING) AS Codigo, CAST(p_partkey % 100 AS STRING) AS Numero, CAST(2000 + p_size AS STRING) AS Ano,
    CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_brand END AS Sigla, 'Descricao ' || p_brand AS DescricaoIdentificacao,
    CAST(p_partkey + 9000 AS STRING) AS IdentificacaoProcesso, 'CCJ' AS SiglaComissao,
    CASE WHEN p_partkey % 23 = 0 THEN '  ' ELSE p_name END AS Ementa, 'AUTOR' AS Autor,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE date_format(DATE'2024-01-01' + CAST(p_partkey % 900 AS INT), 'yyyy-MM-dd') END AS Data,
    'http://materia/' || CAST(p_partkey AS STRING) AS UrlDetalheMateria
  FROM {part}"""
BILLS = """
  SELECT p_partkey AS codigo, p_partkey % 100 AS numero, CAST(2000 + p_size AS BIGINT) AS ano,
    CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE p_brand END AS sigla, 'Descricao ' || p_brand AS descricao_identificacao,
    CAST(p_partkey + 9000 AS STRING) AS identificacao_processo, 'CCJ' AS sigla_comissao,
    CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE p_name END AS ementa, 'AUTOR' AS autor,
    CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST('2024-01-01' AS DATE) + CAST(p_partkey % 900 AS INT) END AS data,
    'http://materia/' || CAST(p_partkey AS STRING) AS url_detalhe_materia
  FROM {part}"""
_VOTE_WORD = """CASE {0} % 6 WHEN 0 THEN 'Sim' WHEN 1 THEN 'Não' WHEN 2 THEN 'Abstenção' WHEN 3 THEN 'Votou' WHEN 4 THEN 'P-NRV' ELSE NULL END"""
_SENATOR = "((o_custkey * 7 + {0}) % 100)"


def _vote(i: int) -> str:
    who = _SENATOR.format(i)
    return f"""named_struct('codigoParlamentar', CAST({who} AS STRING), 'nomeParlamentar', 'SENADOR ' || CAST({who} AS STRING),
      'siglaPartidoParlamentar', CASE WHEN {who} % 8 = 0 THEN CAST(NULL AS STRING) ELSE 'P' || CAST({who} % 8 AS STRING) END,
      'siglaUFParlamentar', 'U' || CAST({who} % 25 AS STRING), 'sexoParlamentar', CASE WHEN {who} % 2 = 0 THEN 'F' ELSE 'M' END,
      'siglaVotoParlamentar', {_VOTE_WORD.format(f"(o_orderkey + {i})")})"""


_RESULT = """CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'APROVADO' END WHEN 'O' THEN 'R'
    ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Retirado' ELSE NULL END END"""
DOC_VOTINGS = f"""
  SELECT o_orderkey AS codigoSessaoVotacao, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2500 END AS codigoMateria,
    date_format(DATE'2024-01-01' + CAST(o_orderkey % 900 AS INT), 'yyyy-MM-dd') AS dataSessao, {_RESULT} AS resultadoVotacao,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 60 END AS totalVotosSim, o_orderkey % 20 AS totalVotosNao,
    o_orderkey % 3 AS totalVotosAbstencao, named_struct('data', '2025-01-02', 'texto', o_orderpriority) AS informeLegislativo,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN array() ELSE array({_vote(0)}, {_vote(1)}, {_vote(2)}) END AS votos
  FROM {{orders}}"""
VOTINGS = f"""
  SELECT o_orderkey AS codigo_sessao_votacao, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2500 END AS codigo_materia,
    CAST('2024-01-01' AS DATE) + CAST(o_orderkey % 900 AS INT) AS data_sessao, {_RESULT} AS resultado_votacao,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 60 END AS total_votos_sim, o_orderkey % 20 AS total_votos_nao,
    o_orderkey % 3 AS total_votos_abstencao, CAST('2025-01-02' AS DATE) AS informe_legislativo_data, o_orderpriority AS informe_legislativo_texto
  FROM {{orders}}"""


def _vote_rows(i: int) -> str:
    who = _SENATOR.format(i)
    return f"""SELECT o_orderkey AS codigo_sessao_votacao, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2500 END AS codigo_materia,
    CAST('2024-01-01' AS DATE) + CAST(o_orderkey % 900 AS INT) AS data_sessao, {who} AS codigo_parlamentar,
    'SENADOR ' || CAST({who} AS STRING) AS nome_parlamentar,
    CASE WHEN {who} % 8 = 0 THEN NULL ELSE 'P' || CAST({who} % 8 AS STRING) END AS sigla_partido_parlamentar,
    'U' || CAST({who} % 25 AS STRING) AS sigla_ufparlamentar, CASE WHEN {who} % 2 = 0 THEN 'F' ELSE 'M' END AS sexo_parlamentar,
    {_VOTE_WORD.format(f"(o_orderkey + {i})")} AS sigla_voto_parlamentar, o_orderkey * 3 + {i} + 1 AS linha_origem
  FROM {{orders}} WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0"""


VOTES = " UNION ALL ".join(_vote_rows(i) for i in range(3))
EXPENSES = """
  SELECT l_orderkey * 8 + l_linenumber AS id, CAST(year(l_shipdate) AS BIGINT) AS ano, CAST(month(l_shipdate) AS BIGINT) AS mes,
    l_suppkey % 100 AS cod_senador, 'SENADOR ' || CAST(l_suppkey % 100 AS STRING) AS nome_senador,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 'TIPO ' || CAST(l_linenumber AS STRING) END AS tipo_despesa,
    CASE WHEN l_partkey % 31 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN lpad(CAST(l_partkey % 900 AS STRING), 11, '0')
      ELSE '12.345.678/' || lpad(CAST(l_partkey % 900 AS STRING), 4, '0') || '-00' END AS cpf_cnpj_fornecedor,
    'EMPRESA ' || CAST(l_partkey % 900 AS STRING) AS nome_fornecedor,
    CASE WHEN l_orderkey % 33 = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS data,
    CASE WHEN l_partkey % 71 = 0 THEN NULL ELSE l_extendedprice END AS valor_reembolsado
  FROM {lineitem}"""


def _drop_audit(df: DataFrame) -> DataFrame:
    return df.drop("chave_registro", "hash_registro", "dataset", "linha_origem")


@query("slv_15_senadores", SENATORS)
def silver_senators(spark: SparkSession, sf: str) -> DataFrame:
    return _drop_audit(recipe.silver_senators(staged(spark, sf, DOC_SENATORS)))


query("slv_16_materias", BILLS)(lambda s, d: _drop_audit(recipe.silver_bills(staged(s, d, DOC_BILLS))))
query("slv_17_votacoes", VOTINGS)(lambda s, d: _drop_audit(recipe.silver_votings(staged(s, d, DOC_VOTINGS))))
query("slv_18_votos", f"SELECT * EXCLUDE (linha_origem) FROM ({VOTES})")(
    lambda s, d: _drop_audit(recipe.silver_votes(staged(s, d, DOC_VOTINGS)))
)


@query("slv_19_ceaps", EXPENSES)
def silver_expenses(spark: SparkSession, sf: str) -> DataFrame:
    """Expense rows as text in Brazilian form; the source order is an arbitrary file position."""
    typed = staged(spark, sf, EXPENSES)
    raw = typed.select(
        *[F.col(c).cast("string").alias(c) for c in typed.columns if c not in ("data", "valor_reembolsado")],
        F.date_format("data", "yyyy-MM-dd").alias("data"),
        F.translate(F.format_number("valor_reembolsado", 2), ",.", ".,").alias("valor_reembolsado"),
        F.monotonically_increasing_id().alias("_line"),
    ).withColumn("_split", F.shiftright("_line", 33))
    return _drop_audit(recipe.silver_expenses(raw, "_split", "_line"))


query(
    "slv_20_empresas",
    """SELECT c_custkey AS codigo, lpad(CAST(c_custkey AS VARCHAR), 14, '0') AS cnpj_cpf, c_name AS nome, c_custkey + 1 AS linha_origem,
    'empresas_contratadas|' || CAST(c_custkey + 1 AS VARCHAR) AS chave_registro, 'empresas_contratadas' AS dataset,
    """ + sha("c_custkey", "lpad(CAST(c_custkey AS VARCHAR), 14, '0')", "c_name") + " AS hash_registro FROM {customer}",
)(
    lambda s, d: recipe.silver_companies(
        staged(
            s, d,
            "SELECT 'n. ' || CAST(c_custkey AS STRING) AS codigo, lpad(CAST(c_custkey AS STRING), 14, '0') AS cnpj_cpf, c_name AS nome, c_custkey AS _line, 1 AS _file FROM {customer}",
        ),
        "_file",
        "_line",
    )
)

# ---------------------------------------------------------------- gold


def _parts(c: str, suffix: str) -> str:
    return f"year({c}) AS ano_{suffix}, month({c}) AS mes_{suffix}, strftime({c}, '%Y%m') AS periodo_{suffix}"


FACT_BILLS = f"""SELECT *, codigo AS id_materia,
  coalesce(sigla, '') || ' ' || coalesce(CAST(numero AS VARCHAR), '') || ' ' || coalesce(CAST(ano AS VARCHAR), '') AS titulo_materia,
  {_parts("data", "apresentacao")}, ementa IS NOT NULL AS possui_ementa FROM ({BILLS})"""
FACT_VOTINGS = f"""SELECT *, codigo_sessao_votacao AS id_votacao, {_parts("data_sessao", "votacao")},
  coalesce(total_votos_sim, 0) + coalesce(total_votos_nao, 0) + coalesce(total_votos_abstencao, 0) AS total_votos_informados,
  CASE WHEN resultado_votacao IN ('A', 'APROVADO', 'APROVADA') THEN 'APROVADA' WHEN resultado_votacao IN ('R', 'REJEITADO', 'REJEITADA') THEN 'REJEITADA'
    ELSE upper(coalesce(resultado_votacao, 'SEM_RESULTADO')) END AS resultado_votacao_normalizado FROM ({VOTINGS})"""
FACT_VOTES = f"""SELECT * RENAME (sigla_ufparlamentar AS sigla_uf_parlamentar),
  CAST(codigo_sessao_votacao AS VARCHAR) || '|' || CAST(codigo_parlamentar AS VARCHAR) || '|' || CAST(linha_origem AS VARCHAR) AS chave_voto,
  {_parts("data_sessao", "voto")},
  CASE WHEN upper(sigla_voto_parlamentar) IN ('SIM', 'S') THEN 'SIM' WHEN upper(sigla_voto_parlamentar) IN ('NAO', 'NÃO', 'N') THEN 'NAO'
    WHEN upper(sigla_voto_parlamentar) LIKE '%ABST%' THEN 'ABSTENCAO' WHEN upper(sigla_voto_parlamentar) LIKE '%VOTOU%' THEN 'VOTOU'
    ELSE upper(coalesce(sigla_voto_parlamentar, 'NAO_INFORMADO')) END AS categoria_voto FROM ({VOTES})"""
_WINDOW = f"({', '.join(map(str, YEARS))})"
FACT_EXPENSES = f"""SELECT *, id AS id_gasto, {_parts("data_referencia", "gasto")},
  regexp_replace(cpf_cnpj_fornecedor, '[^0-9]', '', 'g') AS cpf_cnpj_fornecedor_normalizado, coalesce(valor_reembolsado, 0.0) AS valor_gasto FROM (
  SELECT *, data AS data_documento_original,
    CASE WHEN year(data) IN {_WINDOW} THEN data ELSE TRY_CAST(lpad(CAST(ano AS VARCHAR), 4, '0') || '-' || lpad(CAST(coalesce(month(data), mes) AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(coalesce(day(data), 1) AS VARCHAR), 2, '0') AS DATE) END AS data_referencia,
    data IS NULL OR year(data) NOT IN {_WINDOW} AS data_referencia_ajustada FROM ({EXPENSES}))"""


def bills(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.fact_bills(staged(spark, sf, BILLS))


def votings(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.fact_votings(staged(spark, sf, VOTINGS))


def votes(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.fact_votes(staged(spark, sf, VOTES))


def expenses(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.fact_expenses(staged(spark, sf, EXPENSES), YEARS)


def senators(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, SENATORS)


query("gld_sn_01_fato_materias", FACT_BILLS)(bills)
query("gld_sn_02_fato_votacoes", FACT_VOTINGS)(votings)
query("gld_sn_03_fato_votos", FACT_VOTES)(votes)
query("gld_sn_04_fato_gastos_senadores", FACT_EXPENSES)(expenses)

_SPENT = f"count(*) AS quantidade_despesas, round({tot('valor_gasto')}, 2) AS valor_total"
_SENATORS = f"{nuni('cod_senador')} AS quantidade_senadores"
_SUPPLIERS = f"{nuni('cpf_cnpj_fornecedor_normalizado')} AS quantidade_fornecedores"


def _ranked(keys: str, metrics: str, value: str, source: str) -> str:
    return f"SELECT *, {rank(value)} AS posicao FROM (SELECT {keys}, {metrics} FROM ({source}) GROUP BY ALL)"


query("gld_sn_05_ranking_senadores_gastos", _ranked("cod_senador, nome_senador", f"{_SPENT}, {_SUPPLIERS}", "valor_total", FACT_EXPENSES))(
    lambda s, d: recipe.ranking_senators_spending(expenses(s, d))
)
query(
    "gld_sn_06_ranking_fornecedores_ceaps",
    _ranked("cpf_cnpj_fornecedor_normalizado, nome_fornecedor", f"{_SPENT}, {_SENATORS}", "valor_total", FACT_EXPENSES),
)(lambda s, d: recipe.ranking_suppliers(expenses(s, d)))
query("gld_sn_07_ranking_tipos_despesa_ceaps", _ranked("tipo_despesa", f"{_SPENT}, {_SENATORS}", "valor_total", FACT_EXPENSES))(
    lambda s, d: recipe.ranking_types(expenses(s, d))
)
_COUNTS = ", ".join(
    f"{cnt(f"categoria_voto = '{v}'")} AS {n}" for n, v in {"votos_sim": "SIM", "votos_nao": "NAO", "abstencoes": "ABSTENCAO"}.items()
)
query(
    "gld_sn_08_ranking_senadores_votos",
    _ranked(
        "codigo_parlamentar, nome_parlamentar, sigla_partido_parlamentar, sigla_uf_parlamentar",
        f"count(*) AS quantidade_votos, {nuni('codigo_sessao_votacao')} AS quantidade_votacoes, {_COUNTS}",
        "quantidade_votos",
        FACT_VOTES,
    ),
)(lambda s, d: recipe.ranking_senators_votes(votes(s, d)))
query(
    "gld_sn_09_ranking_partidos_votos",
    _ranked(
        "coalesce(sigla_partido_parlamentar, 'SEM_PARTIDO') AS sigla_partido",
        f"{nuni('codigo_parlamentar')} AS quantidade_senadores, count(*) AS quantidade_votos, {_COUNTS}",
        "quantidade_votos",
        FACT_VOTES,
    ),
)(lambda s, d: recipe.ranking_parties(votes(s, d)))
query(
    "gld_sn_10_resumo_gastos_mensal",
    f"SELECT ano_gasto, mes_gasto, periodo_gasto, {_SPENT}, {_SENATORS}, {_SUPPLIERS} FROM ({FACT_EXPENSES}) GROUP BY 1, 2, 3",
)(lambda s, d: recipe.monthly_spending(expenses(s, d)))
query(
    "gld_sn_11_resumo_atividade_mensal",
    f"""SELECT ano_votacao, mes_votacao, periodo_votacao, count(*) AS quantidade_votacoes,
    {cnt("resultado_votacao_normalizado = 'APROVADA'")} AS quantidade_aprovadas, {cnt("resultado_votacao_normalizado = 'REJEITADA'")} AS quantidade_rejeitadas,
    CAST(sum(total_votos_informados) AS BIGINT) AS total_votos_informados FROM ({FACT_VOTINGS}) GROUP BY 1, 2, 3""",
)(lambda s, d: recipe.monthly_activity(votings(s, d)))
query("gld_sn_12_dim_senadores_base", SENATORS)(senators)
query("gld_sn_13_dim_empresas_base", "SELECT c_custkey AS codigo, c_name AS nome FROM {customer}")(
    lambda s, d: table(s, d, "customer").select(F.col("c_custkey").alias("codigo"), F.col("c_name").alias("nome"))
)

# ---------------------------------------------------------------- dimensions

_I = "identificacao_parlamentar"
DIM_SENATOR = f"""
  WITH u AS (SELECT {_I}_codigo_parlamentar AS codigo_senador, {_I}_nome_parlamentar AS nome_senador, {_I}_nome_completo_parlamentar AS nome_completo,
      {_I}_sigla_partido_parlamentar AS sigla_partido, {_I}_uf_parlamentar AS sigla_uf, {_I}_sexo_parlamentar AS sexo, TRUE AS senador_em_exercicio, 0 AS p FROM ({SENATORS})
    UNION ALL SELECT DISTINCT codigo_parlamentar, nome_parlamentar, CAST(NULL AS VARCHAR), sigla_partido_parlamentar, sigla_uf_parlamentar, sexo_parlamentar, FALSE, 1 FROM ({FACT_VOTES})
    UNION ALL SELECT DISTINCT cod_senador, nome_senador, NULL, NULL, NULL, NULL, FALSE, 2 FROM ({EXPENSES}))
  SELECT codigo_senador AS id_senador, * EXCLUDE (p) REPLACE (coalesce(nome_senador, 'NAO INFORMADO') AS nome_senador,
    coalesce(sigla_partido, 'SEM PARTIDO') AS sigla_partido, coalesce(sigla_uf, 'NI') AS sigla_uf)
  FROM u QUALIFY row_number() OVER (PARTITION BY codigo_senador ORDER BY p) = 1"""


def dim_senator(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.dim_senator(senators(spark, sf), votes(spark, sf), expenses(spark, sf))


query("dim_sn_01_senador", DIM_SENATOR)(dim_senator)
query("ddp_06_priority_merge", f"SELECT id_senador, nome_completo, senador_em_exercicio FROM ({DIM_SENATOR})")(
    lambda s, d: dim_senator(s, d).select("id_senador", "nome_completo", "senador_em_exercicio")
)
query(
    "dim_sn_02_materia",
    f"""SELECT id_materia, codigo, identificacao_processo, descricao_identificacao, sigla, numero, ano, sigla_comissao, ementa, autor, data,
    url_detalhe_materia, titulo_materia FROM ({FACT_BILLS})""",
)(lambda s, d: recipe.dim_bill(bills(s, d)))


def _codes(name: str, number: str, source: str, label: str) -> str:
    return f"""SELECT row_number() OVER (ORDER BY {name}) AS {number}, {name} FROM (SELECT DISTINCT upper(trim(coalesce(c, '{label}'))) AS {name}
    FROM (SELECT {source} AS c FROM ({FACT_VOTES}) UNION ALL SELECT {name} FROM ({DIM_SENATOR})))"""


query("dim_sn_03_partido", _codes("sigla_partido", "id_partido", "sigla_partido_parlamentar", "SEM PARTIDO"))(
    lambda s, d: recipe.dim_party(votes(s, d), dim_senator(s, d))
)
query("dim_sn_04_uf", _codes("sigla_uf", "id_uf", "sigla_uf_parlamentar", "NI"))(
    lambda s, d: recipe.dim_state(votes(s, d), dim_senator(s, d))
)
query(
    "dim_sn_05_tipo_materia",
    f"""SELECT row_number() OVER (ORDER BY sigla_tipo_materia) AS id_tipo_materia, * FROM (SELECT upper(coalesce(sigla, 'NI')) AS sigla_tipo_materia,
    min(descricao_identificacao) AS descricao_tipo_materia FROM ({BILLS}) GROUP BY 1)""",
)(lambda s, d: recipe.dim_bill_type(bills(s, d)))
query(
    "dim_sn_06_tipo_voto",
    f"""SELECT row_number() OVER (ORDER BY categoria_voto, descricao_voto_original NULLS FIRST) AS id_tipo_voto, * FROM (
    SELECT DISTINCT categoria_voto, sigla_voto_parlamentar AS descricao_voto_original FROM ({FACT_VOTES}))""",
)(lambda s, d: recipe.dim_vote_type(votes(s, d)))
query(
    "dim_sn_07_resultado_votacao",
    f"""SELECT row_number() OVER (ORDER BY resultado_normalizado, resultado_original NULLS FIRST) AS id_resultado_votacao, * FROM (
    SELECT DISTINCT resultado_votacao AS resultado_original, resultado_votacao_normalizado AS resultado_normalizado FROM ({FACT_VOTINGS}))""",
)(lambda s, d: recipe.dim_result(votings(s, d)))
query(
    "dim_sn_08_tipo_despesa",
    f"""SELECT row_number() OVER (ORDER BY tipo_despesa) AS id_tipo_despesa, tipo_despesa FROM (
    SELECT DISTINCT coalesce(tipo_despesa, 'NAO INFORMADO') AS tipo_despesa FROM ({EXPENSES}))""",
)(lambda s, d: recipe.dim_expense_type(expenses(s, d)))
query(
    "dim_sn_09_fornecedor",
    f"""SELECT row_number() OVER (ORDER BY nome_fornecedor NULLS FIRST, documento_fornecedor NULLS FIRST) AS id_fornecedor, *,
    CASE length(documento_fornecedor) WHEN 14 THEN 'CNPJ' WHEN 11 THEN 'CPF' ELSE 'OUTRO' END AS tipo_documento FROM (
    SELECT cpf_cnpj_fornecedor_normalizado AS documento_fornecedor, nome_fornecedor, min(cpf_cnpj_fornecedor) AS documento_fornecedor_formatado
    FROM ({FACT_EXPENSES}) GROUP BY 1, 2)""",
)(lambda s, d: recipe.dim_supplier(expenses(s, d)))

_DAYS = f"""SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS data
  FROM (SELECT min(data_sessao) AS lo, max(data_sessao) AS hi FROM ({VOTINGS}))"""


@query(
    "dim_sn_10_tempo",
    f"""SELECT CAST(strftime(data, '%Y%m%d') AS BIGINT) AS id_tempo, data, year(data) AS ano, month(data) AS mes, day(data) AS dia,
    strftime(data, '%Y%m') AS ano_mes, monthname(data) AS nome_mes, 'T' || CAST(quarter(data) AS VARCHAR) AS trimestre, isodow(data) AS dia_semana,
    dayname(data) AS nome_dia_semana FROM ({_DAYS})""",
)
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    """The Senate calendar's columns over the dates of the votings."""
    return dimensions.english_calendar(dimensions._days(dimensions.date_bounds(votings(spark, sf), "data_sessao")))


# ---------------------------------------------------------------- audits and star


def _gold(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """For audits, which read rows and totals of the marts, not the ranks; each reader takes the columns it needs, so nothing is stored."""
    silver = {
        "materias": staged(spark, sf, BILLS),
        "votacoes": staged(spark, sf, VOTINGS),
        "votos": staged(spark, sf, VOTES),
        "ceaps": staged(spark, sf, EXPENSES),
        "senadores": senators(spark, sf),
        "empresas_contratadas": table(spark, sf, "customer"),
    }
    return silver, recipe.gold(silver, ranked=False)


def _tie(name: str, sql: str, severity: str = "error", zero: bool = False) -> str:
    expected = "0.0" if zero else f"({sql})"
    passed = f"({sql}) = 0" if zero else "TRUE"
    return f"""SELECT '{name}' AS "check", '{severity}' AS severity, {passed} AS passed, CAST({expected} AS DOUBLE) AS expected, CAST(({sql}) AS DOUBLE) AS actual"""


def _dup(key: str, source: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"


_TOTAL = f"SELECT round({tot('valor_gasto')}, 2) FROM e"
_CHECKS = [
    *[_tie(f"{n}_silver_gold", f"SELECT count(*) FROM {s}") for n, s in (("materias", "b"), ("votacoes", "v"), ("votos", "o"), ("ceaps", "e"))],
    _tie("duplicidade_id_materia", _dup("id_materia", "b"), zero=True),
    _tie("duplicidade_id_votacao", _dup("id_votacao", "v"), zero=True),
    _tie("duplicidade_chave_voto", _dup("chave_voto", "o"), zero=True),
    _tie("duplicidade_id_gasto", _dup("id_gasto", "e"), zero=True),
    _tie("votos_sem_votacao", "SELECT count(*) FROM o WHERE codigo_sessao_votacao NOT IN (SELECT id_votacao FROM v)", zero=True),
    _tie("votacoes_sem_materia", "SELECT count(*) FROM v WHERE codigo_materia IS NOT NULL AND codigo_materia NOT IN (SELECT id_materia FROM b)",
         "warning", zero=True),
    *[_tie(n, _TOTAL) for n in ("valor_ceaps_silver_gold", "valor_fato_ranking_senadores", "valor_fato_ranking_fornecedores",
                                 "valor_fato_ranking_tipos", "valor_fato_resumo_mensal")],
    _tie("quantidade_votacoes_resumo", "SELECT count(*) FROM v"),
]
_WITH = f"WITH b AS ({FACT_BILLS}), v AS ({FACT_VOTINGS}), o AS ({FACT_VOTES}), e AS ({FACT_EXPENSES}) "


@query("rec_08_senate_tie_out", _WITH + " UNION ALL ".join(_CHECKS))
def quality(spark: SparkSession, sf: str) -> DataFrame:
    return recipe.quality(*_gold(spark, sf)).drop("detail")


query(
    "snk_06_audit_extract",
    _WITH + "SELECT * FROM v WHERE codigo_materia IS NOT NULL AND codigo_materia NOT IN (SELECT id_materia FROM b)",
)(lambda s, d: checks.orphan_rows(votings(s, d), bills(s, d), "codigo_materia", "id_materia"))

_LINKS = [
    ("materia_votacoes", "fato_votacoes", "codigo_materia", "dim_materia", "id_materia", True),
    ("materia_votos", "fato_votos", "codigo_materia", "dim_materia", "id_materia", False),
    ("senador_gastos", "fato_gastos", "cod_senador", "dim_senador", "id_senador", False),
]
_SOURCES = {"fato_votacoes": "v", "fato_votos": "o", "fato_gastos": "e", "dim_materia": "b", "dim_senador": "x"}


def _link_sql(name: str, fact: str, column: str, dim: str, key: str, loose: bool) -> str:
    f, t = _SOURCES[fact], _SOURCES[dim]
    orphans = f"(SELECT count(*) FROM {f} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {t} WHERE {key} IS NOT NULL))"
    repeated = f"(SELECT count(*) FROM (SELECT {key} FROM {t} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"
    return f"""SELECT '{name}' AS name, '{fact}' AS from_table, '{column}' AS from_column, '{dim}' AS to_table, '{key}' AS to_column,
    'bigint' AS from_dtype, 'bigint' AS to_dtype, {orphans} AS orphan_rows, {repeated} AS duplicate_to_key_groups, {loose} AS orphans_allowed,
    {repeated} = 0 AND ({orphans} = 0 OR {loose}) AS approved"""


_DQ_16 = _WITH + f", x AS ({DIM_SENATOR}) " + " UNION ALL ".join(_link_sql(*link) for link in _LINKS)


def _linked(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "fato_votacoes": votings(spark, sf), "fato_votos": votes(spark, sf), "fato_gastos": expenses(spark, sf),
        "dim_materia": recipe.dim_bill(bills(spark, sf)), "dim_senador": dim_senator(spark, sf),
    }


@query("dq_16_relationships", _DQ_16)
def relationships(spark: SparkSession, sf: str) -> DataFrame:
    star = _linked(spark, sf)
    return checks.suite([validate(Relationship(*link), star[link[1]], star[link[3]]) for link in _LINKS])


query("dq_16_stacked_relationships", _DQ_16)(lambda s, d: validate_all([Relationship(*link) for link in _LINKS], _linked(s, d)))


def _star(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "fato_gastos_senadores": expenses(spark, sf), "fato_materias": bills(spark, sf), "fato_votacoes": votings(spark, sf),
        "fato_votos": votes(spark, sf), "fato_gastos_deputados": deputy_expenses.fact(spark, sf),
    }


def _q(name: str, sql: str) -> str:
    return f'{sql} AS "{name}"'


def _div(a: str, b: str) -> str:
    return f"coalesce(CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END, 0.0)"


_SPEND, _VALUE = "count(*)", tot("valor_gasto")
_M_EXPENSES = ", ".join([
    _q("Total Gastos Senado", _VALUE), _q("Quantidade Despesas Senado", _SPEND), _q("Quantidade Senadores com Gastos", nuni("cod_senador")),
    _q("Quantidade Fornecedores Senado", nuni("cpf_cnpj_fornecedor_normalizado")), _q("Ticket Médio Despesa Senado", _div(_VALUE, _SPEND)),
])
_YES = cnt("categoria_voto = 'SIM'")
_M_VOTES = ", ".join([
    _q("Total Votos Senado", "count(*)"), _q("Votos Sim Senado", _YES), _q("Votos Não Senado", cnt("categoria_voto = 'NAO'")),
    _q("Abstenções Senado", cnt("categoria_voto = 'ABSTENCAO'")), _q("Percentual Votos Sim Senado", _div(_YES, "count(*)")),
])
_HELD, _PASSED = nuni("id_votacao"), "count(DISTINCT CASE WHEN resultado_votacao_normalizado = 'APROVADA' THEN id_votacao END)"
_M_VOTINGS = ", ".join([
    _q("Total Votações Senado", _HELD), _q("Votações Aprovadas Senado", _PASSED), _q("Percentual Votações Aprovadas Senado", _div(_PASSED, _HELD)),
])
_NET, _DOCS, _CUT = tot("valor_liquido_apos_restituicao"), tot("valor_documento"), tot("valor_glosa")
_PEOPLE = nuni("codigo_beneficiario")
_M_DEPUTIES = ", ".join([
    _q("Total Gastos Deputados", _NET), _q("Valor Documentos Deputados", _DOCS), _q("Total Líquido Deputados", tot("valor_liquido")),
    _q("Total Glosas Deputados", _CUT), _q("Total Restituições Deputados", tot("valor_restituicao")), _q("Quantidade Despesas Deputados", "count(*)"),
    _q("Quantidade Deputados", _PEOPLE), _q("Quantidade Fornecedores Deputados", nuni("chave_fornecedor")), _q("Quantidade Partidos Deputados", nuni("partido")),
    _q("Ticket Médio Deputados", _div(_NET, "count(*)")), _q("Percentual Glosado Deputados", _div(_CUT, _DOCS)),
    _q("Despesas com Restituição", cnt("possui_restituicao")), _q("Despesas com Glosa", cnt("valor_glosa > 0")), _q("Média por Deputado", _div(_NET, _PEOPLE)),
])


@query(
    "msr_01_05_all_measures",
    _WITH + f""", d AS ({deputy_expenses.FACT})
    SELECT * FROM (SELECT {_M_EXPENSES} FROM e), (SELECT {_q("Total Matérias Senado", nuni("id_materia"))} FROM b), (SELECT {_M_VOTINGS} FROM v),
    (SELECT {_M_VOTES} FROM o), (SELECT {_M_DEPUTIES} FROM d)""",
)
def all_measures(spark: SparkSession, sf: str) -> DataFrame:
    """The 28 measures without a grouping."""
    return evaluate(_star(spark, sf), list(recipe.measure_registry().values()))


@query(
    "msr_06_measures_by_party",
    _WITH + f""", x AS ({DIM_SENATOR}),
    a AS (SELECT sigla_partido, {_M_EXPENSES} FROM e LEFT JOIN x ON e.cod_senador = x.id_senador GROUP BY 1),
    c AS (SELECT x.sigla_partido, {_M_VOTES} FROM o LEFT JOIN x ON o.codigo_parlamentar = x.id_senador GROUP BY 1)
    SELECT coalesce(a.sigla_partido, c.sigla_partido) AS sigla_partido, a.* EXCLUDE (sigla_partido), c.* EXCLUDE (sigla_partido)
    FROM a FULL JOIN c ON a.sigla_partido IS NOT DISTINCT FROM c.sigla_partido""",
)
def measures_by_party(spark: SparkSession, sf: str) -> DataFrame:
    """A dimension attribute reaches two facts through their relationships."""
    dim = materialize(dim_senator(spark, sf))
    links = {
        "fato_gastos_senadores": Relationship("senador_gastos", "fato_gastos_senadores", "cod_senador", "dim_senador", "id_senador"),
        "fato_votos": Relationship("senador_votos", "fato_votos", "codigo_parlamentar", "dim_senador", "id_senador"),
    }
    star = {name: propagate(_star(spark, sf)[name], dim, rel, ["sigla_partido"]) for name, rel in links.items()}
    chosen = [m for m in recipe.measure_registry().values() if m.table in star]
    return evaluate(star, chosen, by=["sigla_partido"])


@query(
    "msr_06_grouping_sets",
    _WITH + f""", x AS ({DIM_SENATOR}),
    a AS (SELECT sigla_partido, sigla_uf, GROUPING_ID(sigla_partido, sigla_uf) AS nivel, {_M_EXPENSES} FROM e LEFT JOIN x ON e.cod_senador = x.id_senador
      GROUP BY GROUPING SETS ((sigla_partido, sigla_uf), (sigla_partido), (sigla_uf), ())),
    c AS (SELECT x.sigla_partido, x.sigla_uf, GROUPING_ID(x.sigla_partido, x.sigla_uf) AS nivel, {_M_VOTES} FROM o LEFT JOIN x ON o.codigo_parlamentar = x.id_senador
      GROUP BY GROUPING SETS ((x.sigla_partido, x.sigla_uf), (x.sigla_partido), (x.sigla_uf), ()))
    SELECT CASE WHEN a.nivel IS NOT NULL THEN a.sigla_partido ELSE c.sigla_partido END AS sigla_partido, CASE WHEN a.nivel IS NOT NULL THEN a.sigla_uf ELSE c.sigla_uf END AS sigla_uf,
      coalesce(a.nivel, c.nivel) AS nivel, a.* EXCLUDE (sigla_partido, sigla_uf, nivel), c.* EXCLUDE (sigla_partido, sigla_uf, nivel)
    FROM a FULL JOIN c ON a.sigla_partido IS NOT DISTINCT FROM c.sigla_partido AND a.sigla_uf IS NOT DISTINCT FROM c.sigla_uf AND a.nivel = c.nivel""",
)
def measures_by_sets(spark: SparkSession, sf: str) -> DataFrame:
    """Two facts by party and state, by each alone and in total, each fact read once."""
    dim = materialize(dim_senator(spark, sf))
    links = {
        "fato_gastos_senadores": Relationship("senador_gastos", "fato_gastos_senadores", "cod_senador", "dim_senador", "id_senador"),
        "fato_votos": Relationship("senador_votos", "fato_votos", "codigo_parlamentar", "dim_senador", "id_senador"),
    }
    attributes = ["sigla_partido", "sigla_uf"]
    star = {name: propagate(_star(spark, sf)[name].drop(*attributes), dim, rel, attributes) for name, rel in links.items()}
    chosen = [m for m in recipe.measure_registry().values() if m.table in star]
    return evaluate_sets(star, chosen, [attributes, *[[a] for a in attributes], []])


query(
    "msr_05_conditional_distinct",
    _WITH + f"""SELECT periodo_votacao, {_PASSED} AS aprovadas, {_HELD} AS realizadas FROM v GROUP BY 1""",
)(
    lambda s, d: evaluate(
        {"v": votings(s, d)},
        [
            measures.distinct_count("realizadas", "v", "id_votacao"),
            measures.distinct_count("x", "v", "id_votacao").where(F.col("resultado_votacao_normalizado") == "APROVADA", "aprovadas"),
        ],
        by=["periodo_votacao"],
    )
)
