"""Federal Senate: nested documents to facts, marts, dimensions, audits and measures."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions.dates import is_outside, iso_date, repair_date, year_month
from plumbline.functions.keys import content_hash, joined, or_label
from plumbline.functions.nested import flatten, unnest
from plumbline.functions.numbers import brazilian_decimal, digits_number, filled_sum
from plumbline.functions.text import clean_text, digits_only, document_kind, strip, title_of
from plumbline.operators import checks, dedup, dimensions, measures, ranking, reconcile
from plumbline.operators.measures import Measure
from plumbline.operators.relationships import Relationship, validate_all
from plumbline.operators.typing import retype_existing
from plumbline.operators.unions import rename_if_absent, union_relaxed
from plumbline.sources.delimited import FILE

# Paths of the record arrays, typed columns, and the years a document date may have.
SENATORS_AT = "ListaParlamentarEmExercicio.Parlamentares.Parlamentar"
BILLS_AT = "PesquisaBasicaMateria.Materias.Materia"
TYPED = {
    "senadores": {
        digits_number: [
            "identificacao_parlamentar_codigo_parlamentar", "identificacao_parlamentar_codigo_publico_na_leg_atual",
            "mandato_codigo_mandato", "mandato_numero_legislatura",
        ],
        iso_date: [
            "mandato_primeira_legislatura_do_mandato_data_inicio", "mandato_primeira_legislatura_do_mandato_data_fim",
            "mandato_segunda_legislatura_do_mandato_data_inicio", "mandato_segunda_legislatura_do_mandato_data_fim",
        ],
    },
    "materias": {digits_number: ["codigo", "numero", "ano"], iso_date: ["data"]},
    "votacoes": {
        digits_number: [
            "ano", "codigo_materia", "codigo_sessao", "codigo_sessao_legislativa", "codigo_sessao_votacao", "numero_sessao",
            "sequencial_sessao", "sequencial_votacao", "total_votos_abstencao", "total_votos_nao", "total_votos_sim",
        ],
        iso_date: ["data_apresentacao", "data_sessao", "informe_legislativo_data"],
    },
    "votos": {digits_number: ["codigo_parlamentar", "codigo_sessao_votacao", "codigo_materia"], iso_date: ["data_sessao"]},
    "ceaps": {
        digits_number: ["id", "ano", "mes", "cod_senador"],
        brazilian_decimal: ["valor_reembolsado"],
        iso_date: ["data"],
    },
    "empresas_contratadas": {digits_number: ["codigo"]},
}
DOCUMENT_YEARS = (2024, 2025, 2026)
CALENDAR = ("2024-01-01", "2026-12-31", 1096)


# ---------------------------------------------------------------- silver


SEGMENT, POSITION = "_segment", "_position"


def _audited(df: DataFrame, dataset: str, segment: str = SEGMENT, position: str = POSITION) -> DataFrame:
    """Type the columns, add record number, record key and content hash.

    ``segment`` and ``position`` say where a row stood in the source: which file or split, and
    the consecutive place in it.
    """
    order = (segment, position)
    texts = [f.name for f in df.schema.fields if f.dataType.simpleString() == "string" and f.name not in order]
    typed = retype_existing(df.withColumns({c: clean_text(c) for c in texts}), TYPED[dataset])
    data = [c for c in typed.columns if c not in order]
    numbered = ranking.number_in_source_order(typed, "linha_origem", segment, position)
    return numbered.select(
        joined(F.lit(dataset), "linha_origem").alias("chave_registro"),
        content_hash(numbered, data).alias("hash_registro"),
        F.lit(dataset).alias("dataset"),
        *data,
        F.col("linha_origem").cast("bigint").alias("linha_origem"),
    )


def _placed(df: DataFrame) -> DataFrame:
    """Source order of rows as read: documents by path, then the records as they stand in them.

    A document is read by one task, so its row ids are consecutive. Rows that don't come from
    documents count by split, the upper bits of the row id.
    """
    numbered = df.withColumn(POSITION, F.monotonically_increasing_id())
    if FILE in df.columns:
        return numbered.withColumnRenamed(FILE, SEGMENT)
    return numbered.withColumn(SEGMENT, F.shiftright(POSITION, 33))


def _flat(df: DataFrame) -> DataFrame:
    return flatten(_placed(df), keep=(SEGMENT, POSITION))


def silver_senators(records: DataFrame) -> DataFrame:
    """SLV-15: nested identification and mandate flattened."""
    return _audited(_flat(records), "senadores")


def silver_bills(records: DataFrame) -> DataFrame:
    """SLV-16."""
    return _audited(_flat(records), "materias")


def silver_votings(documents: DataFrame) -> DataFrame:
    """SLV-17: the voting itself, without its votes."""
    return _audited(_flat(documents.drop("votos")), "votacoes")


def silver_votes(documents: DataFrame) -> DataFrame:
    """SLV-18: one row per vote, with the keys of its voting."""
    carry = {"codigo_sessao_votacao": "codigoSessaoVotacao", "codigo_materia": "codigoMateria", "data_sessao": "dataSessao"}
    if FILE in documents.columns:
        carry[FILE] = FILE
    return _audited(_placed(unnest(documents, "votos", carry)), "votos")


def silver_expenses(raw: DataFrame, segment: str, position: str) -> DataFrame:
    """SLV-19: expense files of all years; the order is file and line."""
    return _audited(raw, "ceaps", segment, position)


def silver_companies(raw: DataFrame, segment: str, position: str) -> DataFrame:
    """SLV-20."""
    return _audited(raw, "empresas_contratadas", segment, position)


# ---------------------------------------------------------------- gold


def _date_parts(c: str, suffix: str) -> dict[str, Column]:
    return {f"ano_{suffix}": F.year(c), f"mes_{suffix}": F.month(c).cast("tinyint"), f"periodo_{suffix}": year_month(c)}


def fact_bills(bills: DataFrame) -> DataFrame:
    """GLD-SN-01."""
    return bills.withColumns(
        {
            "id_materia": F.col("codigo"),
            "titulo_materia": title_of("sigla", "numero", "ano"),
            **_date_parts("data", "apresentacao"),
            "possui_ementa": F.col("ementa").isNotNull(),
        }
    )


def fact_votings(votings: DataFrame) -> DataFrame:
    """GLD-SN-02."""
    result = F.col("resultado_votacao")
    return votings.withColumns(
        {
            "id_votacao": F.col("codigo_sessao_votacao"),
            **_date_parts("data_sessao", "votacao"),
            "total_votos_informados": filled_sum("total_votos_sim", "total_votos_nao", "total_votos_abstencao"),
            "resultado_votacao_normalizado": F.when(result.isin("A", "APROVADO", "APROVADA"), "APROVADA")
            .when(result.isin("R", "REJEITADO", "REJEITADA"), "REJEITADA")
            .otherwise(F.upper(or_label("resultado_votacao", "SEM_RESULTADO"))),
        }
    )


def vote_category(vote: str) -> Column:
    word = F.upper(F.col(vote))
    return (
        F.when(word.isin("SIM", "S"), "SIM")
        .when(word.isin("NAO", "NÃO", "N"), "NAO")
        .when(word.contains("ABST"), "ABSTENCAO")
        .when(word.contains("VOTOU"), "VOTOU")
        .otherwise(F.coalesce(word, F.lit("NAO_INFORMADO")))
    )


def fact_votes(votes: DataFrame) -> DataFrame:
    """GLD-SN-03."""
    return rename_if_absent(votes, "sigla_ufparlamentar", "sigla_uf_parlamentar").withColumns(
        {
            "chave_voto": joined("codigo_sessao_votacao", "codigo_parlamentar", "linha_origem"),
            **_date_parts("data_sessao", "voto"),
            "categoria_voto": vote_category("sigla_voto_parlamentar"),
        }
    )


def fact_expenses(expenses: DataFrame, years: tuple[int, ...] = DOCUMENT_YEARS) -> DataFrame:
    """GLD-SN-04: dates outside the window are rebuilt and flagged."""
    repaired = expenses.withColumns(
        {
            "data_documento_original": F.col("data"),
            "data_referencia": repair_date("data", "ano", "mes", years),
            "data_referencia_ajustada": is_outside("data", years),
        }
    )
    return repaired.withColumns(
        {
            "id_gasto": F.col("id"),
            **_date_parts("data_referencia", "gasto"),
            "cpf_cnpj_fornecedor_normalizado": digits_only("cpf_cnpj_fornecedor"),
            "valor_gasto": F.coalesce("valor_reembolsado", F.lit(0.0)),
        }
    )


def _spent() -> dict[str, Column]:
    return {"quantidade_despesas": agg.rows(), "valor_total": F.round(agg.total("valor_gasto"), 2)}


def _place(value: str, ranked: bool) -> dict[str, str]:
    return {"posicao": value} if ranked else {}


SUPPLIER = "cpf_cnpj_fornecedor_normalizado"


def ranking_senators_spending(expenses: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-SN-05."""
    metrics = {**_spent(), "quantidade_fornecedores": agg.n_unique(SUPPLIER)}
    return ranking.ranked_summary(expenses, ["cod_senador", "nome_senador"], metrics, _place("valor_total", ranked))


def ranking_suppliers(expenses: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-SN-06."""
    metrics = {**_spent(), "quantidade_senadores": agg.n_unique("cod_senador")}
    return ranking.ranked_summary(expenses, [SUPPLIER, "nome_fornecedor"], metrics, _place("valor_total", ranked))


def ranking_types(expenses: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-SN-07."""
    metrics = {**_spent(), "quantidade_senadores": agg.n_unique("cod_senador")}
    return ranking.ranked_summary(expenses, ["tipo_despesa"], metrics, _place("valor_total", ranked))


def _vote_counts() -> dict[str, Column]:
    names = {"votos_sim": "SIM", "votos_nao": "NAO", "abstencoes": "ABSTENCAO"}
    return {name: agg.count_where(F.col("categoria_voto") == category) for name, category in names.items()}


def ranking_senators_votes(votes: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-SN-08."""
    return ranking.ranked_summary(
        votes,
        ["codigo_parlamentar", "nome_parlamentar", "sigla_partido_parlamentar", "sigla_uf_parlamentar"],
        {"quantidade_votos": agg.rows(), "quantidade_votacoes": agg.n_unique("codigo_sessao_votacao"), **_vote_counts()},
        _place("quantidade_votos", ranked),
    )


def ranking_parties(votes: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-SN-09."""
    return ranking.ranked_summary(
        votes.withColumn("sigla_partido", or_label("sigla_partido_parlamentar", "SEM_PARTIDO")),
        ["sigla_partido"],
        {"quantidade_senadores": agg.n_unique("codigo_parlamentar"), "quantidade_votos": agg.rows(), **_vote_counts()},
        _place("quantidade_votos", ranked),
    )


def monthly_spending(expenses: DataFrame) -> DataFrame:
    """GLD-SN-10."""
    return ranking.summarize(
        expenses,
        ["ano_gasto", "mes_gasto", "periodo_gasto"],
        {
            **_spent(),
            "quantidade_senadores": agg.n_unique("cod_senador"),
            "quantidade_fornecedores": agg.n_unique(SUPPLIER),
        },
    )


def monthly_activity(votings: DataFrame) -> DataFrame:
    """GLD-SN-11."""
    result = F.col("resultado_votacao_normalizado")
    return ranking.summarize(
        votings,
        ["ano_votacao", "mes_votacao", "periodo_votacao"],
        {
            "quantidade_votacoes": agg.rows(),
            "quantidade_aprovadas": agg.count_where(result == "APROVADA"),
            "quantidade_rejeitadas": agg.count_where(result == "REJEITADA"),
            "total_votos_informados": agg.whole_total("total_votos_informados"),
        },
    )


def gold(silver_tables: dict[str, DataFrame], ranked: bool = True) -> dict[str, DataFrame]:
    """All marts; without ranks for a reader of their totals."""
    votings, votes = fact_votings(silver_tables["votacoes"]), fact_votes(silver_tables["votos"])
    expenses = fact_expenses(silver_tables["ceaps"])
    return {
        "fato_materias": fact_bills(silver_tables["materias"]),
        "fato_votacoes": votings,
        "fato_votos": votes,
        "fato_gastos_senadores": expenses,
        "dim_senadores_base": silver_tables["senadores"],
        "dim_empresas_contratadas_base": silver_tables["empresas_contratadas"],
        "ranking_senadores_gastos": ranking_senators_spending(expenses, ranked),
        "ranking_fornecedores_ceaps": ranking_suppliers(expenses, ranked),
        "ranking_tipos_despesa_ceaps": ranking_types(expenses, ranked),
        "ranking_senadores_votos": ranking_senators_votes(votes, ranked),
        "ranking_partidos_votos": ranking_parties(votes, ranked),
        "resumo_gastos_mensal": monthly_spending(expenses),
        "resumo_atividade_mensal": monthly_activity(votings),
    }


# ---------------------------------------------------------------- dimensions


def dim_senator(senators: DataFrame, votes: DataFrame, expenses: DataFrame) -> DataFrame:
    """DIM-SN-01: senators in office, then those seen in votes, then those seen in expenses (DDP-06)."""
    person = "identificacao_parlamentar"
    blank = F.lit(None).cast("string")

    def shape(df: DataFrame, code: str, current: bool, **columns: Column | str) -> DataFrame:
        fields = ("nome_senador", "nome_completo", "sigla_partido", "sigla_uf", "sexo")
        picked = {f: columns.get(f, blank) for f in fields}
        found = df.select(
            F.col(code).cast("bigint").alias("codigo_senador"),
            *[(F.col(c) if isinstance(c, str) else c).cast("string").alias(f) for f, c in picked.items()],
            F.lit(current).alias("senador_em_exercicio"),
        ).distinct()
        return found.where(F.col("codigo_senador").isNotNull()) if current else found

    frames = [
        shape(
            senators, f"{person}_codigo_parlamentar", True,
            nome_senador=f"{person}_nome_parlamentar", nome_completo=f"{person}_nome_completo_parlamentar",
            sigla_partido=f"{person}_sigla_partido_parlamentar", sigla_uf=f"{person}_uf_parlamentar",
            sexo=f"{person}_sexo_parlamentar",
        ),
        shape(
            votes, "codigo_parlamentar", False,
            nome_senador="nome_parlamentar", sigla_partido="sigla_partido_parlamentar", sigla_uf="sigla_uf_parlamentar",
            sexo="sexo_parlamentar",
        ),
        shape(expenses, "cod_senador", False, nome_senador="nome_senador"),
    ]
    one = dedup.merge_by_priority(frames, "codigo_senador")
    return one.withColumns(
        {
            "id_senador": F.col("codigo_senador"),
            "nome_senador": or_label("nome_senador", "NAO INFORMADO"),
            "sigla_partido": or_label("sigla_partido", "SEM PARTIDO"),
            "sigla_uf": or_label("sigla_uf", "NI"),
        }
    ).select("id_senador", *one.columns)


def dim_bill(bills: DataFrame) -> DataFrame:
    """DIM-SN-02."""
    columns = [
        "id_materia", "codigo", "identificacao_processo", "descricao_identificacao", "sigla", "numero", "ano",
        "sigla_comissao", "ementa", "autor", "data", "url_detalhe_materia", "titulo_materia",
    ]
    return dedup.keep_first(bills.select(columns), ["id_materia"], [])


def _code_dim(frames: list[tuple[DataFrame, str]], name: str, label: str, number: str) -> DataFrame:
    rows = union_relaxed([df.select(F.col(c).alias(name)).distinct() for df, c in frames])
    clean = rows.select(F.upper(strip(or_label(name, label))).alias(name)).distinct()
    return dimensions.surrogate(clean, number, [name])


def dim_party(votes: DataFrame, senators: DataFrame) -> DataFrame:
    """DIM-SN-03."""
    return _code_dim([(votes, "sigla_partido_parlamentar"), (senators, "sigla_partido")], "sigla_partido", "SEM PARTIDO", "id_partido")


def dim_state(votes: DataFrame, senators: DataFrame) -> DataFrame:
    """DIM-SN-04."""
    return _code_dim([(votes, "sigla_uf_parlamentar"), (senators, "sigla_uf")], "sigla_uf", "NI", "id_uf")


def dim_bill_type(bills: DataFrame) -> DataFrame:
    """DIM-SN-05: the first description in alphabetical order per type."""
    rows = bills.select(
        F.upper(or_label("sigla", "NI")).alias("sigla_tipo_materia"), F.col("descricao_identificacao").alias("descricao_tipo_materia")
    )
    one = rows.groupBy("sigla_tipo_materia").agg(F.min("descricao_tipo_materia").alias("descricao_tipo_materia"))
    return dimensions.surrogate(one, "id_tipo_materia", ["sigla_tipo_materia"])


def dim_vote_type(votes: DataFrame) -> DataFrame:
    """DIM-SN-06."""
    rows = votes.select("categoria_voto", F.col("sigla_voto_parlamentar").alias("descricao_voto_original")).distinct()
    return dimensions.surrogate(rows, "id_tipo_voto", ["categoria_voto", "descricao_voto_original"])


def dim_result(votings: DataFrame) -> DataFrame:
    """DIM-SN-07."""
    rows = votings.select(
        F.col("resultado_votacao").alias("resultado_original"), F.col("resultado_votacao_normalizado").alias("resultado_normalizado")
    ).distinct()
    return dimensions.surrogate(rows, "id_resultado_votacao", ["resultado_normalizado", "resultado_original"])


def dim_expense_type(expenses: DataFrame) -> DataFrame:
    """DIM-SN-08."""
    rows = expenses.select(strip(or_label("tipo_despesa", "NAO INFORMADO")).alias("tipo_despesa")).distinct()
    return dimensions.surrogate(rows, "id_tipo_despesa", ["tipo_despesa"])


def dim_supplier(expenses: DataFrame) -> DataFrame:
    """DIM-SN-09: per document and name, with the kind of document (EXP-25)."""
    one = expenses.groupBy(F.col(SUPPLIER).alias("documento_fornecedor"), "nome_fornecedor").agg(
        F.min("cpf_cnpj_fornecedor").alias("documento_fornecedor_formatado")
    )
    kinds = one.withColumn("tipo_documento", document_kind("documento_fornecedor"))
    return dimensions.surrogate(kinds, "id_fornecedor", ["nome_fornecedor", "documento_fornecedor"])


def dim_time(spark: SparkSession) -> DataFrame:
    """DIM-SN-10."""
    first, last, expected = CALENDAR
    days = dimensions.fixed_calendar(spark, first, last)
    if days.count() != expected:
        raise RuntimeError(f"Calendar must have {expected} days")
    return days


def dims(gold_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    bills, votings, votes = (gold_tables[t] for t in ("fato_materias", "fato_votacoes", "fato_votos"))
    expenses = gold_tables["fato_gastos_senadores"]
    senators = dim_senator(gold_tables["dim_senadores_base"], votes, expenses)
    return {
        "dim_senador": senators,
        "dim_materia": dim_bill(bills),
        "dim_partido": dim_party(votes, senators),
        "dim_uf": dim_state(votes, senators),
        "dim_tipo_materia": dim_bill_type(bills),
        "dim_tipo_voto": dim_vote_type(votes),
        "dim_resultado_votacao": dim_result(votings),
        "dim_tipo_despesa": dim_expense_type(expenses),
        "dim_fornecedor": dim_supplier(expenses),
        "dim_tempo": dim_time(bills.sparkSession),
    }


# ---------------------------------------------------------------- audits


def _check(df: DataFrame, name: str, actual: Column, severity: str = checks.ERROR, detail: str = "") -> DataFrame:
    """Expected zero."""
    one = df.agg(actual.cast("double").alias("actual"))
    return one.select(
        F.lit(name).alias("check"), F.lit(severity).alias("severity"), (F.col("actual") == 0).alias("passed"),
        F.lit(0.0).alias("expected"), "actual", F.lit(detail).alias("detail"),
    )


def _expense_total(column: str) -> Column:
    return F.round(agg.total(column), 2)


def quality(silver_tables: dict[str, DataFrame], gold_tables: dict[str, DataFrame]) -> DataFrame:
    """DQ-14 and REC-08: 16 checks; the financial tie-out runs over the fact and its four marts."""
    bills, votings, votes = (gold_tables[t] for t in ("fato_materias", "fato_votacoes", "fato_votos"))
    expenses = gold_tables["fato_gastos_senadores"]
    counted = {"materias": bills, "votacoes": votings, "votos": votes}
    marts = {
        "valor_fato_ranking_senadores": "ranking_senadores_gastos",
        "valor_fato_ranking_fornecedores": "ranking_fornecedores_ceaps",
        "valor_fato_ranking_tipos": "ranking_tipos_despesa_ceaps",
        "valor_fato_resumo_mensal": "resumo_gastos_mensal",
    }
    spent = _expense_total("valor_gasto")
    sides = []
    for name, fact in counted.items():
        sides.append(reconcile.side(silver_tables[name], {f"{name}_silver_gold": agg.rows()}, "silver"))
        asked = {"gold": {f"{name}_silver_gold": agg.rows()}}
        if name == "votacoes":
            asked["silver"] = {"quantidade_votacoes_resumo": agg.rows()}
        sides.append(reconcile.sides(fact, asked))
    sides += [
        reconcile.side(
            silver_tables["ceaps"],
            {"ceaps_silver_gold": agg.rows(), "valor_ceaps_silver_gold": _expense_total("valor_reembolsado")},
            "silver",
        ),
        reconcile.sides(
            expenses,
            {"gold": {"ceaps_silver_gold": agg.rows(), "valor_ceaps_silver_gold": spent}, "silver": dict.fromkeys(marts, spent)},
        ),
        *[reconcile.side(gold_tables[t], {name: _expense_total("valor_total")}, "gold") for name, t in marts.items()],
        reconcile.side(
            gold_tables["resumo_atividade_mensal"],
            {"quantidade_votacoes_resumo": agg.whole_total("quantidade_votacoes")},
            "gold",
        ),
    ]
    equal = reconcile.compare(sides).select(
        "check", F.lit(checks.ERROR).alias("severity"), F.col("approved").alias("passed"),
        F.col("silver_value").alias("expected"), F.col("gold_value").alias("actual"), F.lit("").alias("detail"),
    )
    keys = {"materia": (bills, "id_materia"), "votacao": (votings, "id_votacao"), "gasto": (expenses, "id_gasto")}
    repeated = [
        _check(checks.duplicate_groups(df, [key]), f"duplicidade_id_{name}", agg.rows()) for name, (df, key) in keys.items()
    ]
    repeated.append(_check(checks.duplicate_groups(votes, ["chave_voto"]), "duplicidade_chave_voto", agg.rows()))
    audit = audit_extracts(gold_tables)
    orphans = [
        _check(audit["votos_sem_votacao"], "votos_sem_votacao", agg.rows()),
        _check(
            audit["votacoes_sem_materia"], "votacoes_sem_materia", agg.rows(), checks.WARNING,
            "Votações podem apontar para matérias fora do recorte.",
        ),
    ]
    return checks.suite([equal, *repeated, *orphans])


def audit_extracts(gold_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """SNK-06: the offending rows themselves."""
    bills, votings, votes = (gold_tables[t] for t in ("fato_materias", "fato_votacoes", "fato_votos"))
    known = votings.select(F.col("id_votacao").alias("codigo_sessao_votacao")).distinct()
    person = ["codigo_parlamentar", "nome_parlamentar", "sigla_partido_parlamentar", "sigla_uf_parlamentar"]
    return {
        # A vote without the key of its voting is an orphan as well.
        "votos_sem_votacao": votes.join(known, "codigo_sessao_votacao", "left_anti"),
        "votacoes_sem_materia": checks.orphan_rows(votings, bills, "codigo_materia", "id_materia"),
        "parlamentares_identificados_nos_votos": votes.where(F.col("codigo_parlamentar").isNotNull()).select(person).distinct(),
    }


# ---------------------------------------------------------------- star


def _points(name: str, fact: str, column: str, dim: str, key: str, allow_orphans: bool = False) -> Relationship:
    return Relationship(name, f"fato_{fact}", column, f"dim_{dim}", key, allow_orphans)


_loose = partial(_points, allow_orphans=True)

# The fourteen relationships of the star.
RELATIONSHIPS = [
    _points("senador_gastos", "gastos_senadores", "cod_senador", "senador", "id_senador"),
    _points("senador_votos", "votos", "codigo_parlamentar", "senador", "id_senador"),
    _loose("materia_votacoes", "votacoes", "codigo_materia", "materia", "id_materia"),
    _loose("materia_votos", "votos", "codigo_materia", "materia", "id_materia"),
    _points("tempo_gastos", "gastos_senadores", "data_referencia", "tempo", "data"),
    _points("tempo_votacoes", "votacoes", "data_sessao", "tempo", "data"),
    _points("tempo_votos", "votos", "data_sessao", "tempo", "data"),
    _loose("tempo_materias", "materias", "data", "tempo", "data"),
    _points("tipo_despesa_gastos", "gastos_senadores", "tipo_despesa", "tipo_despesa", "tipo_despesa"),
    _points("tipo_materia_materias", "materias", "sigla", "tipo_materia", "sigla_tipo_materia"),
    _points("resultado_votacoes", "votacoes", "resultado_votacao_normalizado", "resultado_votacao", "resultado_normalizado"),
    _loose("partido_votos", "votos", "sigla_partido_parlamentar", "partido", "sigla_partido"),
    _loose("uf_votos", "votos", "sigla_uf_parlamentar", "uf", "sigla_uf"),
    _loose("tipo_voto_votos", "votos", "sigla_voto_parlamentar", "tipo_voto", "descricao_voto_original"),
]


def validate_star(star: dict[str, DataFrame]) -> DataFrame:
    """DQ-16 over all relationships, each table of the star read once."""
    return validate_all(RELATIONSHIPS, star)


def measure_registry() -> dict[str, Measure]:
    """MSR-01..05: the 28 measures, by name. The names are fixed values: reports refer to them."""
    spending, bills, votings, votes = "fato_gastos_senadores", "fato_materias", "fato_votacoes", "fato_votos"
    deputies = "fato_gastos_deputados"
    found: dict[str, Measure] = {}

    def add(measure: Measure) -> Measure:
        found[measure.name] = measure
        return measure

    total = add(measures.sum_of("Total Gastos Senado", spending, "valor_gasto"))
    lines = add(measures.row_count("Quantidade Despesas Senado", spending))
    add(measures.distinct_count("Quantidade Senadores com Gastos", spending, "cod_senador"))
    add(measures.distinct_count("Quantidade Fornecedores Senado", spending, SUPPLIER))
    add(measures.divide("Ticket Médio Despesa Senado", total, lines))
    add(measures.distinct_count("Total Matérias Senado", bills, "id_materia"))
    held = add(measures.distinct_count("Total Votações Senado", votings, "id_votacao"))
    cast = add(measures.row_count("Total Votos Senado", votes))
    category = F.col("categoria_voto")
    yes = add(cast.where(category == "SIM", "Votos Sim Senado"))
    add(cast.where(category == "NAO", "Votos Não Senado"))
    add(cast.where(category == "ABSTENCAO", "Abstenções Senado"))
    add(measures.divide("Percentual Votos Sim Senado", yes, cast))
    passed = add(held.where(F.col("resultado_votacao_normalizado") == "APROVADA", "Votações Aprovadas Senado"))
    add(measures.divide("Percentual Votações Aprovadas Senado", passed, held))

    spent = add(measures.sum_of("Total Gastos Deputados", deputies, "valor_liquido_apos_restituicao"))
    documents = add(measures.sum_of("Valor Documentos Deputados", deputies, "valor_documento"))
    add(measures.sum_of("Total Líquido Deputados", deputies, "valor_liquido"))
    cut = add(measures.sum_of("Total Glosas Deputados", deputies, "valor_glosa"))
    add(measures.sum_of("Total Restituições Deputados", deputies, "valor_restituicao"))
    entries = add(measures.row_count("Quantidade Despesas Deputados", deputies))
    people = add(measures.distinct_count("Quantidade Deputados", deputies, "codigo_beneficiario"))
    add(measures.distinct_count("Quantidade Fornecedores Deputados", deputies, "chave_fornecedor"))
    add(measures.distinct_count("Quantidade Partidos Deputados", deputies, "partido"))
    add(measures.divide("Ticket Médio Deputados", spent, entries))
    add(measures.divide("Percentual Glosado Deputados", cut, documents))
    add(entries.where(F.col("possui_restituicao"), "Despesas com Restituição"))
    add(entries.where(F.col("valor_glosa") > 0, "Despesas com Glosa"))
    add(measures.divide("Média por Deputado", spent, people))
    return found
