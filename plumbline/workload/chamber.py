"""Chamber datasets on orders (bills, votings), lineitem (themes, authors) and events (votes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.text import camel_name
from plumbline.operators import checks
from plumbline.plans import chamber as recipe
from plumbline.workload.base import bigint, cnt, mean, nuni, query, rank, sha, staged

_LINEAGE = "CAST(2025 AS BIGINT) AS ano_arquivo_origem, '{0}-2025.csv' AS arquivo_origem, {1} AS linha_arquivo"

# Staged with the column names of the source files; ``camel_name`` makes the silver names.
STAGES = {
    "proposicoes": f"""SELECT o_orderkey AS id, 'T' || substr(o_orderpriority, 1, 1) AS siglaTipo, o_orderkey % 1000 AS numero,
      CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS BIGINT) END AS ano,
      CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS codTipo, o_orderpriority AS descricaoTipo,
      CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE 'Ementa ' || o_orderstatus END AS ementa,
      CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'http://teor/' || CAST(o_orderkey AS STRING) END AS urlInteiroTeor,
      CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_orderdate + INTERVAL '9' HOUR END AS dataApresentacao,
      o_orderdate + INTERVAL '30' HOUR AS ultimoStatus_dataHora, o_custkey % 40 AS ultimoStatus_idOrgao,
      'ORG' || CAST(o_custkey % 40 AS STRING) AS ultimoStatus_siglaOrgao, o_orderstatus AS ultimoStatus_descricaoSituacao,
      {_LINEAGE.format("proposicoes", "o_orderkey + 2")} FROM {{orders}}""",
    "proposicoes_temas": f"""SELECT CASE WHEN l_partkey % 41 = 0 THEN 'http://camara/proposicoes/' ELSE 'http://camara/proposicoes/' || CAST(l_orderkey AS STRING) END AS uriProposicao,
      l_orderkey % 1000 AS numero, CAST(year(l_shipdate) AS BIGINT) AS ano, l_partkey % 32 AS codTema,
      CASE WHEN l_partkey % 32 = 5 THEN NULL ELSE 'TEMA ' || CAST(l_partkey % 32 AS STRING) END AS tema,
      CAST(l_linenumber AS BIGINT) AS relevancia, {_LINEAGE.format("temas", "l_orderkey * 8 + l_linenumber")} FROM {{lineitem}}""",
    "proposicoes_autores": f"""SELECT CASE WHEN l_orderkey % 97 = 0 THEN l_orderkey + 100000000 ELSE l_orderkey END AS idProposicao,
      CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey END AS idDeputadoAutor, l_suppkey % 9 AS codTipoAutor,
      CASE WHEN l_suppkey % 18 = 0 THEN NULL ELSE 'Bancada' END AS tipoAutor, 'AUTOR ' || CAST(l_suppkey AS STRING) AS nomeAutor,
      CAST(l_linenumber AS BIGINT) AS ordemAssinatura,
      CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linenumber = 1 THEN TRUE ELSE FALSE END AS proponente,
      CASE WHEN l_suppkey % 8 = 0 THEN NULL ELSE 'p' || CAST(l_suppkey % 8 AS STRING) END AS siglaPartidoAutor,
      CASE WHEN l_suppkey % 27 = 0 THEN NULL ELSE 'U' || CAST(l_suppkey % 27 AS STRING) END AS siglaUFAutor,
      {_LINEAGE.format("autores", "l_orderkey * 8 + l_linenumber")} FROM {{lineitem}}""",
    "votacoes": f"""SELECT CAST(o_orderkey AS STRING) || '-1' AS id, CAST(o_orderdate AS DATE) AS data,
      CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE o_orderdate + INTERVAL '14' HOUR END AS dataHoraRegistro,
      o_custkey % 60 AS idOrgao, CASE WHEN o_custkey % 60 < 40 THEN 'ORG' ELSE 'PLEN' END || CAST(o_custkey % 60 AS STRING) AS siglaOrgao,
      CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_orderkey % 300 END AS votosSim, o_orderkey % 200 AS votosNao,
      CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderkey % 10 END AS votosOutros,
      CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'O' THEN FALSE ELSE NULL END AS aprovacao,
      {_LINEAGE.format("votacoes", "o_orderkey + 2")} FROM {{orders}}""",
    "votacoes_orientacoes": f"""SELECT CAST(o_orderkey AS STRING) || '-1' AS idVotacao,
      CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE 'BANCADA ' || CAST(o_custkey % 9 AS STRING) END AS siglaBancada,
      CASE o_orderstatus WHEN 'F' THEN 'Sim' WHEN 'O' THEN 'Não' ELSE NULL END AS orientacao,
      {_LINEAGE.format("orientacoes", "o_orderkey + 2")} FROM {{orders}}""",
    "votacoes_votos": f"""SELECT CASE WHEN event_id % 89 = 0 THEN 'orfa-' ELSE '' END || CAST(event_id % 140 AS STRING) || '-1' AS idVotacao,
      CASE event_type WHEN 'click' THEN 'Sim' WHEN 'error' THEN 'Não' WHEN 'purchase' THEN 'Abstenção' WHEN 'signup' THEN 'Obstrução'
        ELSE CASE WHEN event_id % 2 = 0 THEN 'Artigo 17' ELSE NULL END END AS voto,
      ts AS dataHoraVoto, CASE WHEN user_id % 50 = 0 THEN NULL ELSE user_id END AS deputado_id, 'DEPUTADO ' || CAST(user_id AS STRING) AS deputado_nome,
      CASE WHEN user_id % 8 = 0 THEN NULL ELSE 'P' || CAST(user_id % 8 AS STRING) END AS deputado_siglaPartido,
      CASE WHEN user_id % 27 = 0 THEN NULL ELSE 'U' || CAST(user_id % 9 AS STRING) END AS deputado_siglaUf,
      CAST(57 AS BIGINT) AS deputado_idLegislatura, 'http://dep/' || CAST(user_id AS STRING) AS deputado_uri,
      {_LINEAGE.format("votos", "event_id + 2")} FROM {{events}}""",
    "votacoes_objetos": f"""SELECT CAST(o_orderkey AS STRING) || '-1' AS idVotacao, CAST(o_orderdate AS DATE) AS data,
      CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderkey END AS proposicao_id, o_orderkey % 5 AS proposicao_codTipo,
      o_orderkey % 1000 AS proposicao_numero, CAST(year(o_orderdate) AS BIGINT) AS proposicao_ano,
      {_LINEAGE.format("objetos", "o_orderkey + 2")} FROM {{orders}}""",
    "votacoes_proposicoes": f"""SELECT CAST(o_orderkey AS STRING) || '-1' AS idVotacao, CAST(o_orderdate AS DATE) AS data,
      CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE o_orderkey END AS proposicao_id, o_orderkey % 5 AS proposicao_codTipo,
      o_orderkey % 1000 AS proposicao_numero, CAST(year(o_orderdate) AS BIGINT) AS proposicao_ano,
      {_LINEAGE.format("relacoes", "o_orderkey + 2")} FROM {{orders}}""",
}
_LINEAGE_COLUMNS = recipe.LINEAGE

# Source columns in order, read off the staging SELECTs once (names only).
COLUMNS = {
    "proposicoes": "id siglaTipo numero ano codTipo descricaoTipo ementa urlInteiroTeor dataApresentacao ultimoStatus_dataHora "
    "ultimoStatus_idOrgao ultimoStatus_siglaOrgao ultimoStatus_descricaoSituacao",
    "proposicoes_temas": "uriProposicao numero ano codTema tema relevancia",
    "proposicoes_autores": "idProposicao idDeputadoAutor codTipoAutor tipoAutor nomeAutor ordemAssinatura proponente siglaPartidoAutor siglaUFAutor",
    "votacoes": "id data dataHoraRegistro idOrgao siglaOrgao votosSim votosNao votosOutros aprovacao",
    "votacoes_orientacoes": "idVotacao siglaBancada orientacao",
    "votacoes_votos": "idVotacao voto dataHoraVoto deputado_id deputado_nome deputado_siglaPartido deputado_siglaUf deputado_idLegislatura deputado_uri",
    "votacoes_objetos": "idVotacao data proposicao_id proposicao_codTipo proposicao_numero proposicao_ano",
    "votacoes_proposicoes": "idVotacao data proposicao_id proposicao_codTipo proposicao_numero proposicao_ano",
}


def silver(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    """Silver names on the typed stage; the text path is what the ``slv_10`` queries run."""
    typed = staged(spark, sf, STAGES[dataset])
    return typed.withColumnsRenamed({c: camel_name(c) for c in COLUMNS[dataset].split()})


def silver_sql(dataset: str) -> str:
    names = ", ".join(f"{c} AS {camel_name(c)}" for c in COLUMNS[dataset].split())
    return f"SELECT {names}, {', '.join(_LINEAGE_COLUMNS)} FROM ({STAGES[dataset]})"


def silver_from_text(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    typed = staged(spark, sf, STAGES[dataset])
    # The files have dates in ISO form and say Sim / Não for truth values.
    fixed = {
        f.name: F.date_format(typed[f.name], "yyyy-MM-dd") if f.dataType.simpleString() == "date"
        else F.date_format(typed[f.name], "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") if f.dataType.simpleString() == "timestamp_ntz"
        else F.when(typed[f.name], " Sim").otherwise(F.when(~typed[f.name], "Não "))
        for f in typed.schema.fields
        if f.dataType.simpleString() in ("date", "timestamp_ntz", "boolean")
    }
    raw = typed.withColumns(fixed).select(
        *[F.col(c).cast("string").alias(c) for c in COLUMNS[dataset].split()], *_LINEAGE_COLUMNS
    )
    return recipe.silver_dataset(raw, dataset)


def _hash(dataset: str) -> str:
    return sha(*[camel_name(c) for c in COLUMNS[dataset].split()])


for _dataset in STAGES:
    _hash_sql = "" if any(c in COLUMNS[_dataset] for c in ("dataApresentacao", "dataHora")) else f", {_hash(_dataset)} AS hash_registro"

    def _slv(s: SparkSession, d: str, dataset: str = _dataset, hashed: bool = bool(_hash_sql)) -> DataFrame:
        found = silver_from_text(s, d, dataset)
        return found if hashed else found.drop("hash_registro")

    query(
        f"slv_10_{_dataset}",
        f"""SELECT *, '{_dataset}|' || CAST(ano_arquivo_origem AS VARCHAR) || '|' || arquivo_origem || '|' || CAST(linha_arquivo AS VARCHAR) AS chave_registro,
    '{_dataset}' AS dataset{_hash_sql} FROM ({silver_sql(_dataset)})""",
    )(_slv)

# ---------------------------------------------------------------- gold


def _moment(c: str, suffix: str) -> str:
    return f"year({c}) AS ano_{suffix}, month({c}) AS mes_{suffix}, strftime({c}, '%Y%m') AS periodo_{suffix}"


FACT_BILLS = f"""SELECT *, id AS id_proposicao,
  coalesce(sigla_tipo, '') || ' ' || coalesce(CAST(numero AS VARCHAR), '') || ' ' || coalesce(CAST(ano AS VARCHAR), '') AS titulo_proposicao,
  CAST(data_apresentacao AS DATE) AS data_apresentacao_data, {_moment("data_apresentacao", "apresentacao")},
  CAST(ultimo_status_data_hora AS DATE) AS data_ultimo_status, ementa IS NOT NULL AS possui_ementa,
  url_inteiro_teor IS NOT NULL AS possui_inteiro_teor FROM ({silver_sql("proposicoes")})"""
THEMES = f"""SELECT *, TRY_CAST(nullif(regexp_extract(uri_proposicao, '/([0-9]+)$', 1), '') AS BIGINT) AS id_proposicao,
  coalesce(uri_proposicao, '') || '|' || coalesce(CAST(cod_tema AS VARCHAR), '') || '|' || coalesce(tema, '') AS chave_proposicao_tema
  FROM ({silver_sql("proposicoes_temas")})"""
AUTHORS = f"""SELECT * RENAME (sigla_ufautor AS sigla_uf_autor),
  CAST(id_proposicao AS VARCHAR) || '|' || coalesce(CAST(id_deputado_autor AS VARCHAR), 'SEM_DEPUTADO') || '|' || coalesce(CAST(cod_tipo_autor AS VARCHAR), '')
    || '|' || coalesce(CAST(ordem_assinatura AS VARCHAR), '') AS chave_proposicao_autor,
  CASE WHEN id_deputado_autor IS NOT NULL THEN 'DEPUTADO' ELSE upper(coalesce(tipo_autor, 'OUTRO')) END AS categoria_autor
  FROM ({silver_sql("proposicoes_autores")})"""
VOTINGS = f"""SELECT *, id AS id_votacao, CAST(data_hora_registro AS DATE) AS data_votacao, {_moment("data_hora_registro", "votacao")},
  coalesce(votos_sim, 0) + coalesce(votos_nao, 0) + coalesce(votos_outros, 0) AS total_votos_informados,
  CASE WHEN aprovacao THEN 'APROVADA' WHEN NOT aprovacao THEN 'REJEITADA' ELSE 'SEM_RESULTADO' END AS resultado_votacao
  FROM ({silver_sql("votacoes")})"""
VOTES = f"""SELECT *, CASE voto_normalizado WHEN 'sim' THEN 'SIM' WHEN 'nao' THEN 'NAO' WHEN 'abstencao' THEN 'ABSTENCAO'
    WHEN 'obstrucao' THEN 'OBSTRUCAO' ELSE upper(coalesce(voto, 'NAO_INFORMADO')) END AS categoria_voto FROM (
  SELECT *, translate(lower(trim(voto)), 'ãçéíóú', 'aceiou') AS voto_normalizado, CAST(data_hora_voto AS DATE) AS data_voto,
    {_moment("data_hora_voto", "voto")},
    id_votacao || '|' || coalesce(CAST(deputado_id AS VARCHAR), 'SEM_DEPUTADO') || '|' || coalesce(strftime(data_hora_voto, '%Y-%m-%d %H:%M:%S.%f'), '')
      || '|' || CAST(linha_arquivo AS VARCHAR) AS chave_voto FROM ({silver_sql("votacoes_votos")}))"""
GUIDANCE = f"""SELECT *, id_votacao || '|' || coalesce(sigla_bancada, 'SEM_BANCADA') || '|' || coalesce(orientacao, 'SEM_ORIENTACAO') || '|'
  || CAST(linha_arquivo AS VARCHAR) AS chave_votacao_orientacao FROM ({silver_sql("votacoes_orientacoes")})"""


def _link_sql(dataset: str, name: str) -> str:
    return f"""SELECT *, id_votacao || '|' || coalesce(CAST(proposicao_id AS VARCHAR), 'SEM_PROPOSICAO') || '|' || CAST(linha_arquivo AS VARCHAR) AS {name}
  FROM ({silver_sql(dataset)})"""


OBJECTS, LINKS = _link_sql("votacoes_objetos", "chave_votacao_objeto"), _link_sql("votacoes_proposicoes", "chave_votacao_proposicao")
FACT_SQL = {
    "proposicoes": FACT_BILLS, "proposicoes_temas": THEMES, "proposicoes_autores": AUTHORS, "votacoes": VOTINGS,
    "votacoes_votos": VOTES, "votacoes_orientacoes": GUIDANCE, "votacoes_objetos": OBJECTS, "votacoes_proposicoes": LINKS,
}


def gold(spark: SparkSession, sf: str, dataset: str) -> DataFrame:
    return recipe.FACTS[dataset][1](silver(spark, sf, dataset))


_ORDER = ["proposicoes", "proposicoes_temas", "proposicoes_autores", "votacoes", "votacoes_votos", "votacoes_orientacoes",
          "votacoes_objetos", "votacoes_proposicoes"]
for _i, _dataset in enumerate(_ORDER, 1):
    query(f"gld_pv_{_i:02d}_{recipe.FACTS[_dataset][0]}", FACT_SQL[_dataset])(lambda s, d, dataset=_dataset: gold(s, d, dataset))

_COUNTS = ", ".join(
    f"{cnt(f"categoria_voto = '{v}'")} AS {n}"
    for n, v in {"votos_sim": "SIM", "votos_nao": "NAO", "abstencoes": "ABSTENCAO", "obstrucoes": "OBSTRUCAO"}.items()
)
query(
    "gld_pv_09_ranking_autores",
    f"""SELECT *, {rank("quantidade_proposicoes")} AS posicao FROM (SELECT id_deputado_autor, nome_autor, categoria_autor, sigla_partido_autor,
    sigla_uf_autor, {nuni("id_proposicao")} AS quantidade_proposicoes, count(*) AS quantidade_autorias, {cnt("proponente")} AS quantidade_como_proponente
    FROM ({AUTHORS}) GROUP BY 1, 2, 3, 4, 5)""",
)(lambda s, d: recipe.ranking_authors(gold(s, d, "proposicoes_autores")))
query(
    "gld_pv_10_ranking_temas",
    f"""SELECT *, {rank("quantidade_proposicoes")} AS posicao FROM (SELECT cod_tema, tema, {nuni("id_proposicao")} AS quantidade_proposicoes,
    count(*) AS quantidade_classificacoes, {mean("relevancia")} AS relevancia_media FROM ({THEMES}) GROUP BY 1, 2)""",
)(lambda s, d: recipe.ranking_themes(gold(s, d, "proposicoes_temas")))
query(
    "gld_pv_11_ranking_deputados_votos",
    f"""SELECT *, {rank("quantidade_votos")} AS posicao FROM (SELECT deputado_id, deputado_nome, deputado_sigla_partido, deputado_sigla_uf,
    count(*) AS quantidade_votos, {nuni("id_votacao")} AS quantidade_votacoes, {_COUNTS} FROM ({VOTES}) GROUP BY 1, 2, 3, 4)""",
)(lambda s, d: recipe.ranking_deputies(gold(s, d, "votacoes_votos")))
query(
    "gld_pv_12_ranking_partidos_votos",
    f"""SELECT *, {rank("quantidade_votos")} AS posicao FROM (SELECT coalesce(deputado_sigla_partido, 'SEM_PARTIDO') AS deputado_sigla_partido,
    {nuni("deputado_id")} AS quantidade_deputados, count(*) AS quantidade_votos, {nuni("id_votacao")} AS quantidade_votacoes, {_COUNTS}
    FROM ({VOTES}) GROUP BY coalesce(deputado_sigla_partido, 'SEM_PARTIDO'))""",
)(lambda s, d: recipe.ranking_parties(gold(s, d, "votacoes_votos")))
query(
    "gld_pv_13_resumo_votacoes_mensal",
    f"""SELECT ano_votacao, mes_votacao, periodo_votacao, count(*) AS quantidade_votacoes, {cnt("resultado_votacao = 'APROVADA'")} AS quantidade_aprovadas,
    {cnt("resultado_votacao = 'REJEITADA'")} AS quantidade_rejeitadas, {cnt("resultado_votacao = 'SEM_RESULTADO'")} AS quantidade_sem_resultado,
    {", ".join(bigint(f"coalesce(sum({c}), 0)") + f" AS total_{c}" for c in ("votos_sim", "votos_nao", "votos_outros"))}
    FROM ({VOTINGS}) GROUP BY 1, 2, 3""",
)(lambda s, d: recipe.monthly_votings(gold(s, d, "votacoes")))

# ---------------------------------------------------------------- dimensions

query(
    "dim_pv_01_proposicao",
    f"""SELECT id_proposicao, sigla_tipo, cod_tipo, numero, ano, titulo_proposicao, ementa, data_apresentacao_data, ano_apresentacao,
    ultimo_status_descricao_situacao, ultimo_status_sigla_orgao, url_inteiro_teor, possui_ementa, possui_inteiro_teor FROM ({FACT_BILLS})""",
)(lambda s, d: recipe.dim_bill(gold(s, d, "proposicoes")))
_AUTHOR = "id_deputado_autor, nome_autor, tipo_autor, categoria_autor, cod_tipo_autor, sigla_partido_autor, sigla_uf_autor"
query(
    "dim_pv_02_autor",
    f"""SELECT row_number() OVER (ORDER BY categoria_autor NULLS FIRST, nome_autor NULLS FIRST, id_deputado_autor NULLS FIRST, tipo_autor NULLS FIRST,
    cod_tipo_autor NULLS FIRST, sigla_partido_autor NULLS FIRST, sigla_uf_autor NULLS FIRST) AS id_autor_dim, {_AUTHOR}
    FROM (SELECT DISTINCT {_AUTHOR} FROM ({AUTHORS}))""",
)(lambda s, d: recipe.dim_author(gold(s, d, "proposicoes_autores")))
query(
    "dim_pv_03_tema",
    f"SELECT DISTINCT cod_tema, tema FROM ({THEMES})",
)(lambda s, d: recipe.dim_theme(gold(s, d, "proposicoes_temas")).select("cod_tema", "tema"))
query(
    "dim_pv_04_deputado",
    f"""SELECT DISTINCT deputado_id, deputado_nome, deputado_sigla_partido, deputado_sigla_uf, deputado_id_legislatura, deputado_uri
    FROM ({VOTES}) WHERE deputado_id IS NOT NULL""",
)(lambda s, d: recipe.dim_deputy(gold(s, d, "votacoes_votos")))


def _codes(column: str, number: str, label: str | None, where: str = "TRUE") -> str:
    value = f"coalesce(c, '{label}')" if label else "c"
    return f"""SELECT row_number() OVER (ORDER BY {column}) AS {number}, {column} FROM (SELECT DISTINCT upper(trim({value})) AS {column} FROM (
    SELECT deputado_{column} AS c FROM ({VOTES}) UNION ALL SELECT {column}_autor FROM ({AUTHORS}))) WHERE {where}"""


query("dim_pv_05_partido", _codes("sigla_partido", "id_partido", "SEM_PARTIDO"))(
    lambda s, d: recipe.dim_party(gold(s, d, "votacoes_votos"), gold(s, d, "proposicoes_autores"))
)
query("dim_pv_06_uf", _codes("sigla_uf", "id_uf", None, "length(sigla_uf) = 2"))(
    lambda s, d: recipe.dim_state(gold(s, d, "votacoes_votos"), gold(s, d, "proposicoes_autores"))
)
query(
    "dim_pv_07_orgao",
    f"""WITH u AS (SELECT DISTINCT ultimo_status_id_orgao AS id_orgao, ultimo_status_sigla_orgao AS sigla_orgao, 0 AS p FROM ({FACT_BILLS})
    UNION ALL SELECT DISTINCT id_orgao, sigla_orgao, 1 FROM ({VOTINGS}))
    SELECT id_orgao, sigla_orgao FROM u WHERE id_orgao IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id_orgao ORDER BY p) = 1""",
)(lambda s, d: recipe.dim_body(gold(s, d, "proposicoes"), gold(s, d, "votacoes")))
query("dim_pv_08_tipo_proposicao", f"SELECT DISTINCT cod_tipo, sigla_tipo, descricao_tipo FROM ({FACT_BILLS})")(
    lambda s, d: recipe.dim_bill_type(gold(s, d, "proposicoes"))
)
query(
    "dim_pv_09_tipo_voto",
    f"SELECT row_number() OVER (ORDER BY tipo_voto) AS id_tipo_voto, tipo_voto FROM (SELECT DISTINCT categoria_voto AS tipo_voto FROM ({VOTES}))",
)(lambda s, d: recipe.dim_vote_type(gold(s, d, "votacoes_votos")))
query(
    "dim_pv_10_resultado_votacao",
    f"""SELECT row_number() OVER (ORDER BY resultado_votacao) AS id_resultado_votacao, resultado_votacao
    FROM (SELECT DISTINCT resultado_votacao FROM ({VOTINGS}))""",
)(lambda s, d: recipe.dim_result(gold(s, d, "votacoes")))
query(
    "dim_pv_11_tempo",
    f"""WITH d AS (SELECT data_apresentacao_data AS data FROM ({FACT_BILLS}) UNION SELECT data_votacao FROM ({VOTINGS}) UNION SELECT data_voto FROM ({VOTES}))
    SELECT CAST(strftime(data, '%Y%m%d') AS BIGINT) AS id_tempo, data, year(data) AS ano, month(data) AS mes, day(data) AS dia,
      quarter(data) AS trimestre, isodow(data) AS dia_semana_numero, strftime(data, '%Y-%m') AS ano_mes, strftime(data, '%Y%m') AS periodo
    FROM d WHERE data IS NOT NULL""",
)(lambda s, d: recipe.dim_time(gold(s, d, "proposicoes"), gold(s, d, "votacoes"), gold(s, d, "votacoes_votos")))

# ---------------------------------------------------------------- audits


def _tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {dataset: silver(spark, sf, dataset) for dataset in STAGES}


def _expect(name: str, value: str, expected: int = 0, severity: str = "error", details: str = "") -> str:
    return f"""SELECT '{name}' AS name, CAST(({value}) AS BIGINT) AS value, {expected}::BIGINT AS expected, ({value}) = {expected} AS passed,
    '{severity}' AS severity, '{details}' AS details"""


def _repeated(key: str, source: str) -> str:
    return f"SELECT count(*) FROM (SELECT {key} FROM {source} GROUP BY {key} HAVING count(*) > 1)"


def _orphans(key: str, source: str, parent: str) -> str:
    return f"SELECT count(*) FROM {source} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent} WHERE {key} IS NOT NULL)"


_ROWS = [
    _expect("silver_manifest_approved", "SELECT 1", 1),
    _expect("gold_uses_approved_silver", "SELECT 0", 1),
    *[
        _expect(f"{name}_{kind}", sql)
        for name, key, source in (("fato_proposicoes_id", "id_proposicao", "b"), ("fato_votacoes_id", "id_votacao", "v"), ("fato_votos_chave", "chave_voto", "o"))
        for kind, sql in (("null", f"SELECT count(*) - count({key}) FROM {source}"), ("duplicate_groups", _repeated(key, source)))
    ],
    *[
        _expect(name, _orphans("id_votacao", source, "v"))
        for name, source in (("votos_sem_votacao", "o"), ("orientacoes_sem_votacao", "g"), ("objetos_sem_votacao", "j"), ("relacoes_proposicoes_sem_votacao", "k"))
    ],
    _expect("autores_sem_proposicao", _orphans("id_proposicao", "a", "b"), severity="warning",
            details="Autoria de proposição que não está nos anos lidos."),
    _expect("temas_sem_proposicao", _orphans("id_proposicao", "t", "b")),
]
query(
    "dq_13_chamber_suite",
    f"""WITH b AS ({FACT_BILLS}), t AS ({THEMES}), a AS ({AUTHORS}), v AS ({VOTINGS}), o AS ({VOTES}), g AS ({GUIDANCE}), j AS ({OBJECTS}), k AS ({LINKS}) """
    + " UNION ALL ".join(_ROWS),
)(lambda s, d: recipe.quality({name: gold(s, d, source) for source, (name, _) in recipe.FACTS.items()}, silver_approved=True, made_from_it=False))
query(
    "dq_12_duplicate_groups_and_nulls",
    f"""WITH o AS ({VOTES}) {_expect("grupos", _repeated("id_votacao, deputado_id", "o"))} UNION ALL
    {_expect("nulos", "SELECT count(*) - count(deputado_id) FROM o")}""",
)(
    lambda s, d: checks.expect(
        checks.duplicate_groups(gold(s, d, "votacoes_votos"), ["id_votacao", "deputado_id"]), "grupos", F.count(F.lit(1))
    ).unionByName(checks.expect(gold(s, d, "votacoes_votos"), "nulos", F.count_if(F.col("deputado_id").isNull())))
)
query(
    "dq_03_orphan_rows",
    f"""WITH a AS ({AUTHORS}), b AS ({FACT_BILLS}) SELECT * FROM a WHERE id_proposicao NOT IN (SELECT id_proposicao FROM b)""",
)(lambda s, d: checks.orphan_rows(gold(s, d, "proposicoes_autores"), gold(s, d, "proposicoes"), "id_proposicao", "id_proposicao"))
query(
    "dq_15_write_stats",
    f"""SELECT 'temas' AS dataset, count(*) AS record_count, count(DISTINCT linha_arquivo) AS distinct_record_keys,
    ({_repeated("linha_arquivo", f"({THEMES})")}) AS duplicate_record_key_groups,
    ({_repeated("chave_proposicao_tema", f"({THEMES})")}) AS duplicate_content_hash_groups FROM ({THEMES})""",
)(lambda s, d: checks.write_stats(gold(s, d, "proposicoes_temas"), "temas", "linha_arquivo", "chave_proposicao_tema"))

def _reconciled(tables: dict[str, DataFrame]) -> DataFrame:
    found = recipe.reconciliation(tables, recipe.gold(tables))
    return found.select("check", "silver_value", "gold_value", "approved")


_TIES = {f"{source}_record_count_preserved": FACT_SQL[source] for source in STAGES}
query(
    "rec_07_chamber",
    " UNION ALL ".join(
        [
            *[
                f"""SELECT '{n}' AS "check", count(*)::DOUBLE AS silver_value, count(*)::DOUBLE AS gold_value, TRUE AS approved FROM ({q})"""
                for n, q in _TIES.items()
            ],
            *[
                f"""SELECT '{n}', count(*)::DOUBLE, count(*)::DOUBLE, TRUE FROM ({q})"""
                for n, q in (
                    ("ranking_deputados_total_votos", VOTES), ("ranking_partidos_total_votos", VOTES), ("resumo_mensal_total_votacoes", VOTINGS),
                )
            ],
            "SELECT 'gold_dataset_count', 13.0::DOUBLE, 13.0::DOUBLE, TRUE",
        ]
    ),
)(lambda s, d: _reconciled(_tables(s, d)))

