"""Budget amendments: history files, API pages, rankings, dimensions, reconciliation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions.dates import brazilian_date
from plumbline.functions.numbers import average_per, brazilian_decimal, brazilian_money, percentage, whole_number
from plumbline.functions.text import city_of, header_name, snake_name, state_of, strip
from plumbline.operators import checks, dedup, dimensions, ranking, reconcile
from plumbline.operators.dedup import most_frequent
from plumbline.operators.unions import union_relaxed
from plumbline.sources.delimited import FILE, with_line_numbers

# Spellings of "no value" in the history files.
NULL_TOKENS = ("", "Sem informação", "S/I")

# The mandatory headers of the three history files.
HEADERS = {
    "emendas": [
        "Código da Emenda", "Ano da Emenda", "Tipo de Emenda", "Código do Autor da Emenda", "Nome do Autor da Emenda",
        "Número da emenda", "Localidade de aplicação do recurso", "Código Município IBGE", "Município", "Código UF IBGE",
        "UF", "Região", "Código Função", "Nome Função", "Código Subfunção", "Nome Subfunção", "Código Programa",
        "Nome Programa", "Código Ação", "Nome Ação", "Código Plano Orçamentário", "Nome Plano Orçamentário",
        "Valor Empenhado", "Valor Liquidado", "Valor Pago", "Valor Restos A Pagar Inscritos",
        "Valor Restos A Pagar Cancelados", "Valor Restos A Pagar Pagos",
    ],
    "convenios": [
        "Código da Emenda", "Código Função", "Nome Função", "Código Subfunção", "Nome Subfunção", "Localidade do gasto",
        "Tipo de Emenda", "Data Publicação Convênio", "Convenente", "Objeto Convênio", "Número Convênio", "Valor Convênio",
    ],
    "favorecidos": [
        "Código da Emenda", "Código do Autor da Emenda", "Nome do Autor da Emenda", "Número da emenda", "Tipo de Emenda",
        "Ano/Mês", "Código do Favorecido", "Favorecido", "Natureza Jurídica", "Tipo Favorecido", "UF Favorecido",
        "Município Favorecido", "Valor Recebido",
    ],
}

EXECUTED = ["valor_empenhado", "valor_liquidado", "valor_pago"]
LEFTOVERS = ["valor_restos_pagar_inscritos", "valor_restos_pagar_cancelados", "valor_restos_pagar_pagos"]
AUTHOR = ["codigo_autor_emenda", "nome_autor_emenda"]
BENEFICIARY = [
    "codigo_favorecido", "favorecido", "natureza_juridica", "tipo_favorecido", "uf_favorecido", "municipio_favorecido",
]


def column_of(header: str) -> str:
    """Header -> column: normalised, connecting words dropped."""
    words = [w for w in header_name(header).split("_") if w not in ("da", "de", "do", "a")]
    name = "_".join(words)
    return "localidade_aplicacao" if name.startswith("localidade_aplicacao") else name


# ---------------------------------------------------------------- silver


def executed_shares() -> dict[str, Column]:
    return {
        "percentual_liquidado": percentage("valor_liquidado", "valor_empenhado"),
        "percentual_pago": percentage("valor_pago", "valor_empenhado"),
    }


def silver_amendments(raw: DataFrame, years: list[int]) -> DataFrame:
    """SLV-11. ``raw`` holds text plus ``arquivo_origem`` and ``linha_arquivo`` (the file order)."""
    typed = raw.withColumn("ano_emenda", whole_number("ano_emenda", "int")).where(F.col("ano_emenda").isin(years))
    typed = typed.withColumns({c: brazilian_money(c) for c in (*EXECUTED, *LEFTOVERS)})
    shares = executed_shares() | {"percentual_restos_pagos": percentage("valor_restos_pagar_pagos", "valor_empenhado")}
    grain = [
        "codigo_emenda", "codigo_municipio_ibge", "codigo_funcao", "codigo_subfuncao", "codigo_programa", "codigo_acao",
        "codigo_plano_orcamentario",
    ]
    kept = dedup.keep_last_line(typed.withColumns(shares), grain, "arquivo_origem", "linha_arquivo")
    return kept.drop("arquivo_origem", "linha_arquivo")


def _year_of_code() -> Column:
    return whole_number(F.substring("codigo_emenda", 1, 4), "int")


def silver_grants(raw: DataFrame, years: list[int]) -> DataFrame:
    """SLV-12."""
    typed = raw.withColumn("ano_emenda", _year_of_code()).where(F.col("ano_emenda").isin(years))
    typed = typed.withColumns(
        {
            "valor_convenio": brazilian_money("valor_convenio"),
            "data_publicacao_convenio": brazilian_date("data_publicacao_convenio"),
        }
    )
    kept = dedup.keep_last_line(typed, ["codigo_emenda", "numero_convenio"], "arquivo_origem", "linha_arquivo")
    return kept.drop("arquivo_origem", "linha_arquivo")


BENEFICIARY_GRAIN = [
    "codigo_emenda", *AUTHOR, "numero_emenda", "tipo_emenda", "ano_mes", "ano_emenda", "ano_recebimento",
    "mes_recebimento", *BENEFICIARY,
]


def silver_beneficiaries(raw: DataFrame, years: list[int], near: list[str] | None = None) -> DataFrame:
    """SLV-13: payments collapsed to one row per beneficiary, amendment and month (AGG-18).

    ``near`` names columns of the grain by which a mart groups these rows: payments move by them once, and the mart moves nothing. Of a
    beneficiary's payments an amendment and a month hold one or two, so partial sums before that would merge next to nothing.
    """
    month = whole_number("ano_mes", "int")
    typed = raw.withColumn("ano_emenda", _year_of_code()).where(F.col("ano_emenda").isin(years))
    typed = typed.withColumns({"ano_mes": month, "valor_recebido": brazilian_money("valor_recebido")}).withColumns(
        {
            "ano_recebimento": F.substring(F.col("ano_mes").cast("string"), 1, 4).try_cast("int"),
            "mes_recebimento": F.substring(F.col("ano_mes").cast("string"), 5, 2).try_cast("tinyint"),
        }
    )
    if near:
        typed = typed.repartition(*near)
    return ranking.summarize(typed, BENEFICIARY_GRAIN, {"valor_recebido": agg.total("valor_recebido")})


SILVER = {"emendas": silver_amendments, "convenios": silver_grants, "favorecidos": silver_beneficiaries}


def numbered(read: DataFrame) -> DataFrame:
    """File order as columns, from a ``read_mapped`` frame."""
    return with_line_numbers(read).withColumnRenamed(FILE, "arquivo_origem")


# The fields of one record of an API page.
PAGE_VALUES = [
    "valorEmpenhado", "valorLiquidado", "valorPago", "valorRestoInscrito", "valorRestoCancelado", "valorRestoPago",
]
PAGE_COLUMNS = [
    "codigoEmenda", "ano", "tipoEmenda", "autor", "nomeAutor", "numeroEmenda", "localidadeDoGasto", "funcao", "subfuncao",
    *PAGE_VALUES,
]


def silver_api_pages(pages: DataFrame) -> DataFrame:
    """SLV-14: decimal money, city and state from the place, last record per code wins."""
    place = F.col("localidadeDoGasto")
    typed = pages.withColumns({c: brazilian_decimal(c, "decimal(18,2)") for c in PAGE_VALUES}).withColumns(
        {"municipio": city_of(place), "uf": state_of(place)}
    )
    names = {c: "localidade_gasto" if c == "localidadeDoGasto" else snake_name(c) for c in PAGE_COLUMNS}
    renamed = typed.withColumnsRenamed(names).withColumns(executed_shares())
    kept = dedup.keep_first(renamed, ["codigo_emenda"], [F.col("_file").desc(), F.col("_place").desc()], total_order=True)
    return kept.drop("_file", "_place")


# ---------------------------------------------------------------- gold


def _totals(columns: list[str]) -> dict[str, Column]:
    return {c: agg.total(c) for c in columns}


def ranking_authors(amendments: DataFrame, beneficiaries: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-EM-01."""
    keys = ["ano_emenda", *AUTHOR]
    spent = ranking.summarize(
        amendments,
        keys,
        {
            "quantidade_emendas": agg.n_unique("codigo_emenda"),
            "quantidade_municipios": agg.n_unique("codigo_municipio_ibge"),
            "quantidade_ufs": agg.n_present("uf"),
            "quantidade_funcoes": agg.n_present("nome_funcao"),
            **_totals([*EXECUTED, *LEFTOVERS]),
        },
    )
    received = ranking.summarize(
        beneficiaries,
        keys,
        {
            "quantidade_favorecidos": agg.n_present("codigo_favorecido"),
            "valor_recebido_favorecidos": agg.total("valor_recebido"),
        },
    )
    both = spent.join(received, keys, "left").withColumns(
        {
            "quantidade_favorecidos": F.coalesce("quantidade_favorecidos", F.lit(0)),
            "valor_recebido_favorecidos": F.coalesce("valor_recebido_favorecidos", F.lit(0.0)),
            **executed_shares(),
            "valor_medio_por_emenda": average_per("valor_empenhado", "quantidade_emendas"),
        }
    )
    ranks = {
        "posicao_valor_empenhado": "valor_empenhado",
        "posicao_valor_pago": "valor_pago",
        "posicao_percentual_pago": "percentual_pago",
    }
    return ranking.add_ranks(both, ranks, ["ano_emenda"]) if ranked else both


# Those keys of the two marts of payments by which rows move.
NEAR_BENEFICIARY = ["ano_emenda", "codigo_favorecido", "favorecido"]
NEAR_PAIR = [*NEAR_BENEFICIARY, "codigo_autor_emenda"]


def ranking_beneficiaries(beneficiaries: DataFrame, ranked: bool = True) -> DataFrame:
    """GLD-EM-02. Of a beneficiary's payments one is flagged per amendment, author and month: rows move once, without a copy per distinct count."""
    keys = ["ano_emenda", *BENEFICIARY]
    rows = beneficiaries
    counts = {
        "quantidade_emendas": agg.n_unique("codigo_emenda"),
        "quantidade_autores": agg.n_present("codigo_autor_emenda"),
        "quantidade_meses_recebimento": agg.n_unique("ano_mes"),
    }
    if ranked:
        different = {f"_{c}": F.col(c) for c in ("codigo_emenda", "codigo_autor_emenda", "ano_mes")}
        rows = ranking.together(beneficiaries, keys, different, near=NEAR_BENEFICIARY)
        counts = {
            "quantidade_emendas": agg.count_where("_codigo_emenda"),
            "quantidade_autores": agg.count_where(F.col("_codigo_autor_emenda") & F.col("codigo_autor_emenda").isNotNull()),
            "quantidade_meses_recebimento": agg.count_where("_ano_mes"),
        }
    ranks = {"posicao_valor_recebido": "valor_recebido"} if ranked else {}
    return ranking.ranked_summary(rows, keys, {**counts, "valor_recebido": agg.total("valor_recebido")}, ranks, by=["ano_emenda"])


def _place_ranking(df: DataFrame, keys: list[str], distincts: dict[str, str]) -> DataFrame:
    counts = {name: agg.n_present(column) for name, column in distincts.items()}
    return ranking.ranked_summary(
        df,
        ["ano_emenda", *keys],
        {
            "quantidade_emendas": agg.n_unique("codigo_emenda"),
            "quantidade_autores": agg.n_present("codigo_autor_emenda"),
            **counts,
            **_totals(EXECUTED),
        },
        {"posicao_valor_pago": "valor_pago"},
        derived={"percentual_pago": percentage("valor_pago", "valor_empenhado")},
        by=["ano_emenda"],
    )


def _upper_state(df: DataFrame) -> DataFrame:
    return df.withColumn("uf", F.upper(strip("uf")))


def ranking_states(amendments: DataFrame) -> DataFrame:
    """GLD-EM-03."""
    rows = _upper_state(amendments.where(F.col("uf").isNotNull()))
    return _place_ranking(rows, ["uf", "regiao"], {"quantidade_municipios": "codigo_municipio_ibge"})


def ranking_cities(amendments: DataFrame) -> DataFrame:
    """GLD-EM-04."""
    rows = _upper_state(amendments.where(F.col("codigo_municipio_ibge").isNotNull()))
    keys = ["codigo_municipio_ibge", "municipio", "uf", "regiao"]
    return _place_ranking(rows, keys, {"quantidade_funcoes": "nome_funcao"})


def ranking_functions(amendments: DataFrame) -> DataFrame:
    """GLD-EM-05."""
    keys = ["codigo_funcao", "nome_funcao"]
    return _place_ranking(amendments, keys, {"quantidade_municipios": "codigo_municipio_ibge"})


def author_beneficiary(beneficiaries: DataFrame) -> DataFrame:
    """GLD-EM-06."""
    return ranking.concentration(
        beneficiaries,
        ["ano_emenda", *AUTHOR, *BENEFICIARY],
        {"quantidade_emendas": agg.n_unique("codigo_emenda"), "valor_recebido": agg.total("valor_recebido")},
        value="valor_recebido",
        by=["ano_emenda", "codigo_autor_emenda"],
        total="total_recebido_por_autor",
        share="percentual_concentracao_autor",
        rank="posicao_favorecido_por_autor",
    )


def gold(silver_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    amendments, beneficiaries = silver_tables["emendas"], silver_tables["favorecidos"]
    return {
        "ranking_parlamentares": ranking_authors(amendments, beneficiaries),
        "ranking_favorecidos": ranking_beneficiaries(beneficiaries),
        "ranking_uf": ranking_states(amendments),
        "ranking_municipios": ranking_cities(amendments),
        "ranking_funcoes": ranking_functions(amendments),
        "relacionamento_autor_favorecido": author_beneficiary(beneficiaries),
    }


# ---------------------------------------------------------------- dimensions


def dim_year(frames: list[DataFrame], as_of_year: int) -> DataFrame:
    """DIM-EM-01. The running year is an argument, so a rerun gives the same table."""
    years = union_relaxed([f.select(F.col("ano_emenda").cast("int")).distinct() for f in frames if "ano_emenda" in f.columns])
    running = F.coalesce(F.col("ano_emenda") >= as_of_year, F.lit(False))
    return years.distinct().withColumns(
        {"dados_parciais": running, "status_exercicio": F.when(running, "Em andamento").otherwise("Encerrado")}
    )


def _canonical_with_years(df: DataFrame, key: str, attributes: list[str], name: str, counted: bool = True) -> DataFrame:
    """Most frequent attributes per key, with first and last year (JON-06); ties as in ``dedup.canonical``.

    Rows are counted per key and attributes once; both the attributes and the years of a key come from these counts.
    """
    facts = {"_times": agg.rows(), "_first": F.min("ano_emenda"), "_last": F.max("ano_emenda")}
    counts = ranking.summarize(df, [key, *attributes], facts)
    # The least of these has the most rows, then the lower name; nulls come first.
    place = F.struct((-F.col("_times")).alias("_times"), name, *[a for a in attributes if a != name])
    found = {"_best": F.min(place), "primeiro_ano_emenda": F.min("_first"), "ultimo_ano_emenda": F.max("_last")}
    if counted:
        found["quantidade_registros_origem"] = F.sum("_times")
    one = ranking.summarize(counts, [key], found)
    return one.select(key, *[F.col(f"_best.{a}").alias(a) for a in attributes], *[c for c in found if c != "_best"])


def _trimmed(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    return dimensions.valid_keys(df, key).withColumns({c: strip(c) for c in (key, *attributes)})


def pair_keys(beneficiaries: DataFrame) -> DataFrame:
    """The keys of ``author_beneficiary``, without its amounts, shares and ranks."""
    return beneficiaries.select("ano_emenda", *AUTHOR, *BENEFICIARY).distinct()


def dim_author(authors: DataFrame, pairs: DataFrame) -> DataFrame:
    """DIM-EM-02. Of both marts only the keys are read."""
    columns = ["ano_emenda", *AUTHOR]
    rows = union_relaxed([authors.select(columns), pairs.select(columns)])
    return _canonical_with_years(_trimmed(rows, AUTHOR[0], AUTHOR[1:]), AUTHOR[0], AUTHOR[1:], AUTHOR[1])


def dim_beneficiary(beneficiaries: DataFrame, pairs: DataFrame) -> DataFrame:
    """DIM-EM-03. Of both marts only the keys are read."""
    columns = ["ano_emenda", *BENEFICIARY]
    rows = union_relaxed([beneficiaries.select(columns), pairs.select(columns)])
    key, attributes = BENEFICIARY[0], BENEFICIARY[1:]
    return _canonical_with_years(_trimmed(rows, key, attributes), key, attributes, "favorecido")


def dim_function(functions: DataFrame) -> DataFrame:
    """DIM-EM-04: the first name in alphabetical order per code."""
    rows = _trimmed(functions.select("codigo_funcao", "nome_funcao"), "codigo_funcao", ["nome_funcao"])
    return rows.groupBy("codigo_funcao").agg(F.min("nome_funcao").alias("nome_funcao"))


# States that are no states, and the region shown for them.
MULTIPLE_STATES, NATIONAL = "MÚLTIPLO", "NACIONAL"


def dim_state(states: DataFrame, cities: DataFrame) -> DataFrame:
    """DIM-EM-05: the most frequent region per state."""
    rows = union_relaxed([states.select("uf", "regiao"), cities.select("uf", "regiao")])
    rows = dimensions.valid_keys(rows, "uf").select(F.upper(strip("uf")).alias("uf"), strip("regiao").alias("regiao"))
    modes = most_frequent(rows, ["uf"], "regiao")
    shown = F.when(F.col("uf") == MULTIPLE_STATES, "Múltiplas regiões").when(F.col("uf") == NATIONAL, "Nacional")
    return modes.withColumn("regiao", shown.otherwise(F.col("regiao")))


def dim_city(cities: DataFrame) -> DataFrame:
    """DIM-EM-06."""
    key, attributes = "codigo_municipio_ibge", ["municipio", "uf", "regiao"]
    rows = _trimmed(cities.select("ano_emenda", key, *attributes), key, attributes).withColumn("uf", F.upper("uf"))
    return _canonical_with_years(rows, key, attributes, "municipio", counted=False)


def dims(gold_tables: dict[str, DataFrame], as_of_year: int) -> dict[str, DataFrame]:
    pairs = gold_tables["relacionamento_autor_favorecido"]
    states, cities = gold_tables["ranking_uf"], gold_tables["ranking_municipios"]
    return {
        "dim_ano": dim_year(list(gold_tables.values()), as_of_year),
        "dim_autor": dim_author(gold_tables["ranking_parlamentares"], pairs),
        "dim_favorecido": dim_beneficiary(gold_tables["ranking_favorecidos"], pairs),
        "dim_funcao": dim_function(gold_tables["ranking_funcoes"]),
        "dim_uf": dim_state(states, cities),
        "dim_municipio": dim_city(cities),
    }


# ---------------------------------------------------------------- audits


def quality(silver_tables: dict[str, DataFrame]) -> DataFrame:
    """Every Silver table has rows and no missing year."""
    suite = []
    for name, df in sorted(silver_tables.items()):
        if "ano_emenda" in df.columns:
            suite.append(checks.expect(df, f"{name}_empty", F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)))
            suite.append(checks.expect(df, f"{name}_year_null", agg.null_count("ano_emenda")))
    return checks.suite(suite).withColumn("approved", F.col("passed"))


def reconciliation(silver_tables: dict[str, DataFrame], gold_tables: dict[str, DataFrame]) -> DataFrame:
    """REC-05."""
    spent = reconcile.by_group(
        silver_tables["emendas"], gold_tables["ranking_parlamentares"], "ano_emenda", EXECUTED, "ranking_parlamentares"
    )
    received = reconcile.by_group(
        silver_tables["favorecidos"], gold_tables["ranking_favorecidos"], "ano_emenda", ["valor_recebido"], "ranking_favorecidos"
    )
    return spent.unionByName(received)
