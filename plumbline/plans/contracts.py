"""Federal contracts: history, current snapshot, summaries, rankings, dimensions, audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions.dates import brazilian_date, days_between
from plumbline.functions.keys import content_hash, joined, keyed, keyed_again, lighter, or_label
from plumbline.functions.numbers import brazilian_decimal, percentage
from plumbline.functions.text import clean_text, contains_any
from plumbline.operators import checks, dedup, dimensions, ranking, reconcile
from plumbline.operators.typing import retype
from plumbline.operators.unions import backfill
from plumbline.runtime import materialize

AGENCY = ["codigo_orgao_superior", "nome_orgao_superior", "codigo_orgao", "nome_orgao"]
UNIT = ["codigo_ug", "nome_ug"]
NOT_INFORMED = "NÃO INFORMADA"

# The columns whose text forms each content hash.
HASHED_CONTRACT = [
    "objeto", "fundamento_legal", "modalidade_compra", "situacao_contrato", "codigo_orgao_superior",
    "codigo_orgao", "codigo_ug", "data_assinatura_contrato", "data_publicacao_dou", "data_inicio_vigencia",
    "data_fim_vigencia", "codigo_contratado", "valor_inicial_compra", "valor_final_compra",
    "numero_licitacao", "codigo_ug_licitacao", "codigo_modalidade_compra_licitacao",
]
HASHED_ITEM = [
    "codigo_item_compra", "descricao_item_compra", "descricao_complementar_item_compra",
    "quantidade_item", "valor_item",
]
HASHED_TERM = ["numero_termo_aditivo", "data_publicacao", "objeto"]
HASHED_APOSTILLE = [
    "numero_apostilamento", "descricao_apostilamento", "valor_apostilamento",
    "data_de_inclusao", "situacao_apostilamento",
]


# ---------------------------------------------------------------- silver


def group_key() -> Column:
    return keyed(codigo_ug="SEM_UG", numero_contrato="SEM_CONTRATO")


def parse_contracts(raw: DataFrame) -> DataFrame:
    if "numero_do_contrato" in raw.columns:
        raw = raw.withColumnRenamed("numero_do_contrato", "numero_contrato")
    return retype(
        raw,
        {
            clean_text: [
                "numero_contrato", "objeto", "fundamento_legal", "modalidade_compra", "situacao_contrato", *AGENCY, *UNIT,
                "codigo_contratado", "nome_contratado", "numero_licitacao", "codigo_ug_licitacao", "nome_ug_licitacao",
                "codigo_modalidade_compra_licitacao", "modalidade_compra_licitacao",
            ],
            brazilian_date: ["data_assinatura_contrato", "data_publicacao_dou", "data_inicio_vigencia", "data_fim_vigencia"],
            brazilian_decimal: ["valor_inicial_compra", "valor_final_compra"],
        },
    )


def derive_contracts(typed: DataFrame) -> DataFrame:
    change = F.col("valor_final_compra") - F.col("valor_inicial_compra")
    secret = (
        contains_any("objeto", "sigilo")
        | contains_any("nome_contratado", "sigil")
        | F.col("codigo_contratado").isin("-11", "-3")
    )
    return typed.withColumns(
        {
            "chave_grupo_contrato": group_key(),
            "hash_conteudo_contrato": content_hash(typed, HASHED_CONTRACT),
            "variacao_valor_contrato": change,
            "percentual_variacao_valor": percentage(change, "valor_inicial_compra"),
            "duracao_vigencia_dias": days_between("data_inicio_vigencia", "data_fim_vigencia"),
            "contrato_sigiloso": secret,
        }
    ).withColumn("chave_registro_contrato", joined("chave_grupo_contrato", "hash_conteudo_contrato"))


def silver_contracts(raw: DataFrame) -> DataFrame:
    """SLV-01."""
    return derive_contracts(parse_contracts(raw))


def parse_items(raw: DataFrame) -> DataFrame:
    return retype(
        raw,
        {
            clean_text: [
                "codigo_orgao", "nome_orgao", *UNIT, "numero_contrato", "codigo_item_compra",
                "descricao_item_compra", "descricao_complementar_item_compra",
            ],
            brazilian_decimal: ["quantidade_item", "valor_item"],
        },
    )


def derive_items(typed: DataFrame) -> DataFrame:
    return typed.withColumns(
        {
            "chave_grupo_contrato": group_key(),
            "hash_conteudo_item": content_hash(typed, HASHED_ITEM),
            "valor_total_item_calculado": F.col("quantidade_item") * F.col("valor_item"),
            "item_codigo_zero": F.col("codigo_item_compra") == "0",
            "item_sigiloso": contains_any("descricao_item_compra", "sigilo")
            | contains_any("descricao_complementar_item_compra", "sigilo"),
        }
    ).withColumn("chave_item_contrato", joined(*_ahead_of_item_hash(), "hash_conteudo_item"))


def _ahead_of_item_hash() -> list[Column | str]:
    return ["chave_grupo_contrato", or_label("codigo_item_compra", "SEM_ITEM")]


def silver_items(raw: DataFrame) -> DataFrame:
    """SLV-02."""
    return derive_items(parse_items(raw))


def parse_terms(raw: DataFrame) -> DataFrame:
    return retype(
        raw,
        {
            clean_text: ["numero_contrato", *AGENCY, *UNIT, "numero_termo_aditivo", "objeto"],
            brazilian_date: ["data_publicacao"],
        },
    )


def derive_terms(typed: DataFrame) -> DataFrame:
    return typed.withColumns(
        {
            "chave_grupo_contrato": group_key(),
            "hash_conteudo_termo": content_hash(typed, HASHED_TERM),
            "termo_prorrogacao": contains_any("objeto", "prorroga"),
            "termo_reajuste": contains_any("objeto", "reajuste", "repactua", "revisao", "revisão"),
            "termo_alteracao_quantitativa": contains_any("objeto", "acrescimo", "acréscimo", "supressao", "supressão"),
        }
    ).withColumn("chave_termo_aditivo", joined(*_ahead_of_term_hash(), "hash_conteudo_termo"))


def _ahead_of_term_hash() -> list[Column | str]:
    return ["chave_grupo_contrato", or_label("numero_termo_aditivo", "SEM_TERMO")]


def silver_terms(raw: DataFrame) -> DataFrame:
    """SLV-03."""
    return derive_terms(parse_terms(raw))


_APOSTILLE_TEXT = [
    "numero_contrato", *AGENCY, *UNIT, "numero_apostilamento", "descricao_apostilamento", "situacao_apostilamento",
]


def silver_apostilles(raw: DataFrame) -> DataFrame:
    """SLV-04: any column may be missing, the file may be empty."""
    expected = dict.fromkeys([*_APOSTILLE_TEXT, "valor_apostilamento", "data_de_inclusao"], "string")
    typed = retype(
        backfill(raw, expected),
        {clean_text: _APOSTILLE_TEXT, brazilian_decimal: ["valor_apostilamento"], brazilian_date: ["data_de_inclusao"]},
    )
    derived = typed.withColumns(
        {"chave_grupo_contrato": group_key(), "hash_conteudo_apostilamento": content_hash(typed, HASHED_APOSTILLE)}
    )
    return derived.withColumn(
        "chave_apostilamento",
        joined(
            "chave_grupo_contrato", or_label("numero_apostilamento", "SEM_APOSTILAMENTO"), "hash_conteudo_apostilamento"
        ),
    )


def deduplicated(df: DataFrame, key: str) -> DataFrame:
    return dedup.keep_latest(df, [key])


def current_contracts(history: DataFrame, by_group: bool = False) -> DataFrame:
    """All records of each group's latest period (DDP-05, JON-02).

    ``by_group`` is for readers that go on by contract group: its records, which are few, are in one partition then. Of the record key
    the hash moves, as bytes.
    """
    group, record = "chave_grupo_contrato", ("chave_registro_contrato", "hash_conteudo_contrato")
    rows = lighter(history, *record) if by_group else history
    snapshot = dedup.latest_snapshot(rows, group, "periodo_origem", "periodo_mais_recente", digits=True, within=group if by_group else None)
    if by_group:
        snapshot = keyed_again(snapshot, *record, group, text=True).select(*history.columns, "periodo_mais_recente")
    return snapshot.withColumn("registro_periodo_atual", F.lit(True))


SILVER = {
    "contratos": (silver_contracts, "chave_registro_contrato"),
    "itens_contrato": (silver_items, "chave_item_contrato"),
    "termos_aditivos": (silver_terms, "chave_termo_aditivo"),
    "apostilamentos": (silver_apostilles, "chave_apostilamento"),
}


def silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    clean = {name: deduplicated(build(raw[name]), key) for name, (build, key) in SILVER.items()}
    history = clean.pop("contratos")
    return {"contratos_historico": history, "contratos_atuais": current_contracts(history), **clean}


# ---------------------------------------------------------------- gold


def current_items(items: DataFrame, by_group: bool = False) -> DataFrame:
    """GLD-CT-01: latest period per logical item; zero-code items are kept as physical rows.

    Rows without an item code are neither, and leave, as the two filters demand. ``by_group`` is for readers that go on by
    contract group: the items of a group, which are few, are in one partition then, and their keys are bytes.
    """
    known, coded = items.where(F.col("item_codigo_zero").isNotNull()), ~F.col("item_codigo_zero")
    logical = joined("chave_grupo_contrato", or_label("codigo_item_compra", ""))
    period = {"period": "periodo_origem", "latest": "periodo_mais_recente_item", "where": coded, "digits": True}
    if by_group:
        record = "chave_item_contrato", "hash_conteudo_item"
        # Within a contract group a logical item is its code; both keys are made where the rows are.
        current = dedup.latest_snapshot(lighter(known, *record), "codigo_item_compra", within="chave_grupo_contrato", **period)
        current = keyed_again(current, *record, *_ahead_of_item_hash()).withColumn("chave_logica_item", logical)
    else:
        current = dedup.latest_snapshot(known.withColumn("chave_logica_item", logical), "chave_logica_item", **period)
    return current.withColumns(
        {
            "criterio_selecao_item": F.when(coded, "codigo_item").otherwise("registro_fisico_codigo_zero"),
            "item_utilizavel_valor_oficial": coded,
        }
    )


def _first(column: str) -> Column:
    return agg.first_present_by(column, F.col("chave_registro_contrato"))


def _group_facts() -> dict[str, Column]:
    """Representative attributes and totals of a contract group, first by record key."""
    return {
        "quantidade_registros_atuais": agg.rows().cast("bigint"),
        "numero_contrato": agg.first_by("numero_contrato", F.col("chave_registro_contrato")),
        **{c: _first(c) for c in ("codigo_orgao", "nome_orgao", "codigo_ug", "nome_ug")},
        "codigo_contratado_representativo": _first("codigo_contratado"),
        "nome_contratado_representativo": _first("nome_contratado"),
        "valor_inicial_total_grupo": agg.total("valor_inicial_compra"),
        "valor_final_total_grupo": agg.total("valor_final_compra"),
        "variacao_total_grupo": agg.total("variacao_valor_contrato"),
    }


def _term_counts() -> dict[str, Column]:
    return {
        "quantidade_prorrogacoes": agg.count_where("termo_prorrogacao").cast("bigint"),
        "quantidade_reajustes": agg.count_where("termo_reajuste").cast("bigint"),
        "quantidade_alteracoes_quantitativas": agg.count_where("termo_alteracao_quantitativa").cast("bigint"),
    }


def term_keys_as_bytes(terms: DataFrame, *moved_by: str) -> DataFrame:
    """Terms with their keys made anew of their hashes, as bytes, after the terms were moved if asked."""
    record = "chave_termo_aditivo", "hash_conteudo_termo"
    light = lighter(terms, *record)
    return keyed_again(light.repartition(*moved_by) if moved_by else light, *record, *_ahead_of_term_hash())


def _terms_together(terms: DataFrame, anew: bool = False) -> DataFrame:
    """Terms moved by contract group, with a flag on one row of each term key, which is taken as it is or made anew."""
    key, term = ["chave_grupo_contrato"], F.col("chave_termo_aditivo")
    rows = term_keys_as_bytes(terms, *key) if anew else terms
    return ranking.together(rows, key, {"_term": term}, moved=anew).withColumn("_term", F.col("_term") & term.isNotNull())


def _zero_filled(df: DataFrame, counts: list[str], amounts: list[str] | None = None) -> DataFrame:
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in counts}
    filled |= {c: F.coalesce(F.col(c), F.lit(0.0)) for c in amounts or []}
    return df.withColumns(filled)


def contract_summary(contracts: DataFrame, items: DataFrame, terms: DataFrame, by_group: bool = False) -> DataFrame:
    """GLD-CT-02: one row per contract group from three pre-aggregated sides; the rows of each move once.

    ``by_group`` says that the records of a group are in one partition already and that terms are those of ``derive_terms``, whose keys can be
    made anew where the rows are.
    """
    key = ["chave_grupo_contrato"]
    contractor = F.col("codigo_contratado")
    groups = ranking.summarize(
        ranking.together(contracts, key, {"_contractor": contractor}, moved=by_group),
        key,
        {
            **_group_facts(),
            "chave_registro_representativo": F.min("chave_registro_contrato"),
            "codigo_orgao_superior": _first("codigo_orgao_superior"),
            "nome_orgao_superior": _first("nome_orgao_superior"),
            "objeto_representativo": _first("objeto"),
            "modalidade_compra": _first("modalidade_compra"),
            "situacao_contrato": _first("situacao_contrato"),
            "primeira_data_assinatura": F.min("data_assinatura_contrato"),
            "ultima_data_assinatura": F.max("data_assinatura_contrato"),
            "primeiro_inicio_vigencia": F.min("data_inicio_vigencia"),
            "ultimo_fim_vigencia": F.max("data_fim_vigencia"),
            "possui_contrato_sigiloso": agg.any_true("contrato_sigiloso"),
            "periodo_origem": F.max("periodo_origem"),
            "quantidade_contratados_grupo": agg.count_where(F.col("_contractor") & contractor.isNotNull()),
        },
    ).withColumns(
        {
            "grupo_com_multiplos_registros": F.col("quantidade_registros_atuais") > 1,
            "percentual_variacao_grupo": percentage("variacao_total_grupo", "valor_inicial_total_grupo"),
        }
    )
    # Distinct item keys under three conditions: one row per key first, then plain counts.
    official, zero = F.col("item_utilizavel_valor_oficial"), F.col("item_codigo_zero")
    value = "valor_total_item_calculado"
    per_item = ranking.summarize(
        items,
        [*key, "chave_item_contrato"],
        {
            "_official": agg.any_true(official),
            "_zero": agg.any_true(zero),
            "_official_value": agg.exact_total(value, official),
            "_zero_value": agg.exact_total(value, zero),
            "_secret": agg.count_where("item_sigiloso"),
        },
    )
    item_side = ranking.summarize(
        per_item,
        key,
        {
            "quantidade_itens": agg.rows(),
            "quantidade_itens_identificados": agg.count_where("_official"),
            "quantidade_itens_codigo_zero": agg.count_where("_zero"),
            "valor_total_itens_identificados": F.sum("_official_value").cast("double"),
            "valor_total_itens_codigo_zero": F.sum("_zero_value").cast("double"),
            "quantidade_itens_sigilosos": F.sum("_secret"),
        },
    )
    term_side = ranking.summarize(_terms_together(terms, by_group), key, {"quantidade_termos_aditivos": agg.count_where("_term"), **_term_counts()})
    both = groups.join(item_side, key, "left").join(term_side, key, "left")
    filled = _zero_filled(
        both,
        [
            "quantidade_itens", "quantidade_itens_identificados", "quantidade_itens_codigo_zero", "quantidade_itens_sigilosos",
            "quantidade_termos_aditivos", *_term_counts(),
        ],
        ["valor_total_itens_identificados", "valor_total_itens_codigo_zero"],
    )
    return filled.withColumns(
        {
            "valor_total_itens_informativo": F.col("valor_total_itens_identificados")
            + F.col("valor_total_itens_codigo_zero"),
            "grupo_com_acrescimo": F.col("valor_final_total_grupo") > F.col("valor_inicial_total_grupo"),
            "grupo_com_reducao": F.col("valor_final_total_grupo") < F.col("valor_inicial_total_grupo"),
            "possui_termo_aditivo": F.col("quantidade_termos_aditivos") > 0,
            "possui_item_sigiloso": F.col("quantidade_itens_sigilosos") > 0,
        }
    )


def _amounts() -> dict[str, Column]:
    return {
        "valor_inicial_total": agg.total("valor_inicial_compra"),
        "valor_final_total": agg.total("valor_final_compra"),
        "variacao_total": agg.total("variacao_valor_contrato"),
        "valor_medio_contrato": agg.mean("valor_final_compra"),
        "maior_valor_contrato": F.max("valor_final_compra"),
        "quantidade_contratos_sigilosos": agg.count_where("contrato_sigiloso").cast("bigint"),
    }


def ranking_contractors(contracts: DataFrame) -> DataFrame:
    """GLD-CT-03."""
    return ranking.ranked_summary(
        contracts.where(F.col("codigo_contratado").isNotNull()),
        ["codigo_contratado", "nome_contratado"],
        {
            "quantidade_contratos": agg.n_unique("chave_registro_contrato"),
            "quantidade_grupos_contrato": agg.n_unique("chave_grupo_contrato"),
            "quantidade_orgaos": agg.n_present("codigo_orgao"),
            "quantidade_ugs": agg.n_present("codigo_ug"),
            **_amounts(),
        },
        {"posicao_valor_final": "valor_final_total", "posicao_quantidade_contratos": "quantidade_contratos"},
    )


def ranking_agencies(contracts: DataFrame) -> DataFrame:
    """GLD-CT-04."""
    return ranking.ranked_summary(
        contracts,
        AGENCY,
        {
            "quantidade_contratos": agg.n_unique("chave_registro_contrato"),
            "quantidade_contratados": agg.n_present("codigo_contratado"),
            "quantidade_ugs": agg.n_present("codigo_ug"),
            **_amounts(),
        },
        {"posicao_valor_final": "valor_final_total"},
    )


def changed_contracts(contracts: DataFrame) -> DataFrame:
    """GLD-CT-05: contracts whose value changed (FLT-04)."""
    return contracts.where(F.col("variacao_valor_contrato") != 0).select(
        "chave_registro_contrato", "chave_grupo_contrato", "numero_contrato", *AGENCY, *UNIT, "codigo_contratado",
        "nome_contratado", "objeto", "data_assinatura_contrato", "data_inicio_vigencia", "data_fim_vigencia",
        "valor_inicial_compra", "valor_final_compra", "variacao_valor_contrato", "percentual_variacao_valor", "periodo_origem",
    )


def terms_per_contract(contracts: DataFrame, terms: DataFrame) -> DataFrame:
    """GLD-CT-06."""
    key = ["chave_grupo_contrato"]
    term_side = ranking.summarize(
        _terms_together(terms),
        key,
        {
            "quantidade_termos": agg.count_where("_term"),
            "primeira_publicacao_termo": F.min("data_publicacao"),
            "ultima_publicacao_termo": F.max("data_publicacao"),
            **_term_counts(),
        },
    )
    both = ranking.summarize(contracts, key, _group_facts()).join(term_side, key, "left")
    return _zero_filled(both, ["quantidade_termos", *_term_counts()])


def agency_contractor(contracts: DataFrame) -> DataFrame:
    """GLD-CT-07: share and rank of each contractor inside its agency."""
    return ranking.concentration(
        contracts.where(F.col("codigo_contratado").isNotNull()),
        [*AGENCY, "codigo_contratado", "nome_contratado"],
        {
            "quantidade_contratos": agg.n_unique("chave_registro_contrato"),
            "valor_final_total": agg.total("valor_final_compra"),
            "valor_inicial_total": agg.total("valor_inicial_compra"),
            "variacao_total": agg.total("variacao_valor_contrato"),
        },
        value="valor_final_total",
        by=["codigo_orgao"],
        total="valor_total_orgao",
        share="percentual_concentracao",
        rank="posicao_contratado_no_orgao",
    )


def gold(silver_tables: dict[str, DataFrame], stored: bool = True) -> dict[str, DataFrame]:
    """The marts. ``stored=False`` is for readers of their rows and totals: current items, of which each reader needs a few columns, aren't stored
    and have keys of bytes."""
    contracts, terms = silver_tables["contratos_atuais"], silver_tables["termos_aditivos"]
    items = silver_tables["itens_contrato"]
    items = materialize(current_items(items)) if stored else current_items(items, by_group=True)
    return {
        "contratos_atuais_detalhe": contracts,
        "itens_contrato_atuais": items,
        "contratos_atuais_resumo": contract_summary(contracts, items, terms),
        "ranking_contratados": ranking_contractors(contracts),
        "ranking_orgaos": ranking_agencies(contracts),
        "contratos_com_variacao": changed_contracts(contracts),
        "termos_por_contrato": terms_per_contract(contracts, terms),
        "relacionamento_orgao_contratado": agency_contractor(contracts),
    }


# ---------------------------------------------------------------- dimensions


def _agency_key() -> Column:
    return keyed(codigo_orgao_superior="", codigo_orgao="")


def dim_agency(contracts: DataFrame) -> DataFrame:
    """DIM-CT-01. One row per key and name; see README on renamed agencies."""
    return dimensions.with_key(contracts, AGENCY, chave_orgao=_agency_key())


def dim_unit(contracts: DataFrame) -> DataFrame:
    """DIM-CT-02, with the foreign key to the agency."""
    return dimensions.with_key(
        contracts,
        ["codigo_orgao_superior", "codigo_orgao", *UNIT],
        chave_unidade_gestora=keyed(codigo_orgao="", codigo_ug=""),
        chave_orgao=_agency_key(),
    )


def dim_contractor(contracts: DataFrame) -> DataFrame:
    """DIM-CT-03: the last name in alphabetical order, and how many names occur."""
    one = ranking.summarize(
        contracts.where(F.col("codigo_contratado").isNotNull()),
        ["codigo_contratado"],
        {
            "nome_contratado": F.max("nome_contratado"),
            "quantidade_nomes_encontrados": agg.n_present("nome_contratado").cast("bigint"),
            "quantidade_contratos": agg.n_unique("chave_registro_contrato"),
            "quantidade_orgaos": agg.n_present("codigo_orgao"),
            "valor_final_total": agg.total("valor_final_compra"),
        },
    )
    return one.select(
        F.col("codigo_contratado").alias("chave_contratado"),
        "codigo_contratado",
        "nome_contratado",
        "quantidade_nomes_encontrados",
        (F.col("quantidade_nomes_encontrados") > 1).alias("possui_variacao_nome"),
        "quantidade_contratos",
        "quantidade_orgaos",
        "valor_final_total",
    )


def dim_modality(contracts: DataFrame) -> DataFrame:
    """DIM-CT-04."""
    values = dimensions.labelled(contracts, "modalidade_compra", NOT_INFORMED)
    return dimensions.surrogate(values, "codigo_modalidade", ["modalidade_compra"])


def dim_status(contracts: DataFrame) -> DataFrame:
    """DIM-CT-05."""
    values = dimensions.labelled(contracts, "situacao_contrato", NOT_INFORMED)
    return dimensions.surrogate(values, "codigo_situacao", ["situacao_contrato"])


def dim_time(spark: SparkSession, first_period: str, last_period: str) -> DataFrame:
    """DIM-CT-06."""
    return dimensions.calendar_of_periods(spark, first_period, last_period)


def dims(contracts: DataFrame, first_period: str, last_period: str) -> dict[str, DataFrame]:
    return {
        "dim_orgao": dim_agency(contracts),
        "dim_unidade_gestora": dim_unit(contracts),
        "dim_contratado": dim_contractor(contracts),
        "dim_modalidade_compra": dim_modality(contracts),
        "dim_situacao_contrato": dim_status(contracts),
        "dim_tempo": dim_time(contracts.sparkSession, first_period, last_period),
    }


# ---------------------------------------------------------------- audits


def date_checks(history: DataFrame) -> DataFrame:
    """DQ-05."""
    rules = [
        ("signature_after_start", F.col("data_assinatura_contrato") > F.col("data_inicio_vigencia")),
        ("end_before_start", F.col("data_fim_vigencia") < F.col("data_inicio_vigencia")),
        ("negative_contract_duration", F.col("duracao_vigencia_dias") < 0),
    ]
    counted = [{"check": name, "value": agg.count_where(rule)} for name, rule in rules]
    return checks.rule_checks(history, "contratos_historico", counted, value_name="rows")


def snapshot_checks(current: DataFrame) -> DataFrame:
    """DQ-06: groups with several records are known; a record of an older period is an error."""
    per_group = current.groupBy("chave_grupo_contrato").agg(
        agg.rows().alias("_n"),
        agg.count_where(F.col("periodo_origem") != F.col("periodo_mais_recente")).alias("_stale"),
    )
    one = per_group.agg(
        agg.whole_total("_n").alias("_rows"),
        agg.rows().alias("_groups"),
        agg.count_where(F.col("_n") > 1).alias("_multiple"),
        agg.whole_total("_stale").alias("_stale"),
    )
    none = F.lit(None).cast("bigint")
    several, stale = F.col("_multiple") > 0, F.col("_stale") > 0
    return _rows_of(
        one,
        "contratos_atuais",
        [
            {
                "check": "current_contract_groups", "rows": F.col("_rows"), "distinct_keys": F.col("_groups"),
                "multiple_record_groups": F.col("_multiple"), "severity": F.when(several, "warning").otherwise("info"), "approved": F.lit(True),
            },
            {
                "check": "current_period_consistency", "rows": F.col("_stale"), "distinct_keys": none,
                "multiple_record_groups": none, "severity": F.when(stale, "error").otherwise("info"), "approved": ~stale,
            },
        ],
    )


def _rows_of(one: DataFrame, dataset: str, records: list[dict]) -> DataFrame:
    """Check rows from the columns of a one-row profile."""
    structs = [
        F.struct(
            F.lit(r["check"]).alias("check"), F.lit(dataset).alias("dataset"), *[c.alias(n) for n, c in r.items() if n != "check"]
        )
        for r in records
    ]
    return one.select(F.inline(F.array(*structs)))


def item_checks(items: DataFrame) -> DataFrame:
    """DQ-07."""
    one = items.agg(
        agg.rows().alias("rows"),
        agg.count_where("item_codigo_zero").alias("item_code_zero"),
        agg.count_where("item_sigiloso").alias("confidential_items"),
    )
    special = (F.col("item_code_zero") > 0) | (F.col("confidential_items") > 0)
    record = {c: F.col(c) for c in one.columns}
    level = F.when(special, "warning").otherwise("info")
    return _rows_of(one, "itens_contrato", [{"check": "special_contract_items", **record, "severity": level, "approved": F.lit(True)}])


def quality(tables: dict[str, DataFrame]) -> DataFrame:
    """DQ-14 for contracts."""
    history, current = tables["contratos_historico"], tables["contratos_atuais"]
    items, apostilles = tables["itens_contrato"], tables["apostilamentos"]
    group = "chave_grupo_contrato"
    return checks.suite(
        [
            checks.key_checks(
                tables,
                unique=[
                    ("contratos_historico", "chave_registro_contrato"), ("contratos_atuais", "chave_registro_contrato"),
                    ("itens_contrato", "chave_item_contrato"), ("termos_aditivos", "chave_termo_aditivo"),
                ],
                references=[
                    ("contratos_atuais", "contratos_historico", "chave_registro_contrato", "chave_registro_contrato", checks.ERROR),
                    ("itens_contrato", "contratos_historico", group, group, checks.ERROR),
                    ("termos_aditivos", "contratos_historico", group, group, checks.ERROR),
                ],
            ),
            checks.negative_values(history, "contratos_historico", ["valor_inicial_compra", "valor_final_compra"]),
            checks.negative_values(
                items, "itens_contrato", ["quantidade_item", "valor_item", "valor_total_item_calculado"], checks.WARNING
            ),
            date_checks(history),
            snapshot_checks(current),
            item_checks(items),
            availability(apostilles),
        ]
    )


def availability(apostilles: DataFrame) -> DataFrame:
    """An empty apostille dataset is a warning, one without columns an error (DQ-07)."""
    width = len(apostilles.columns)
    return apostilles.agg(agg.rows().alias("rows")).select(
        F.lit("apostilamentos_availability").alias("check"),
        F.lit("apostilamentos").alias("dataset"),
        "rows",
        F.lit(width).alias("column_count"),
        F.when(F.lit(width == 0), "error").when(F.col("rows") == 0, "warning").otherwise("info").alias("severity"),
        F.lit(width > 0).alias("approved"),
    )


def reconciliation(silver_tables: dict[str, DataFrame], gold_tables: dict[str, DataFrame]) -> DataFrame:
    """REC-02: 15 checks, the snapshot recomputed from Silver; like is compared with like.

    Sides that move items or terms are computed one after the other: what one has moved is deleted before the next begins.
    """
    contracts, terms = silver_tables["contratos_atuais"], silver_tables["termos_aditivos"]
    known = F.col("codigo_contratado").isNotNull()
    items = silver_tables["itens_contrato"]
    logical = items.where(~F.col("item_codigo_zero")).withColumn(
        "chave_logica_item", joined("chave_grupo_contrato", or_label("codigo_item_compra", ""))
    )
    newest = logical.groupBy("chave_logica_item").agg(F.max("periodo_origem").alias("periodo_origem"))
    coded = logical.join(newest, ["chave_logica_item", "periodo_origem"], "left_semi")
    zero = items.where("item_codigo_zero")
    summary, current = gold_tables["contratos_atuais_resumo"], gold_tables["itens_contrato_atuais"]
    term_gold = gold_tables["termos_por_contrato"]

    group_count = agg.n_unique("chave_grupo_contrato")
    large = [
        reconcile.sides(
            summary,
            {
                "gold": {
                    "grupos_contrato": agg.rows(),
                    "grupos_unicos_resumo": group_count,
                    "valor_inicial_contratos": agg.total("valor_inicial_total_grupo"),
                    "valor_final_contratos": agg.total("valor_final_total_grupo"),
                    "variacao_valor_contratos": agg.total("variacao_total_grupo"),
                    "valor_itens_identificados": agg.total("valor_total_itens_identificados"),
                    "valor_itens_codigo_zero": agg.total("valor_total_itens_codigo_zero"),
                },
                "silver": {"grupos_unicos_resumo": agg.rows()},
            },
        ),
        reconcile.side(
            coded,
            {
                "itens_identificados_atuais": agg.rows(),
                "valor_itens_identificados": agg.total("valor_total_item_calculado"),
            },
            "silver",
        ),
        reconcile.side(
            current,
            {
                "itens_identificados_atuais": agg.count_where("item_utilizavel_valor_oficial"),
                "itens_codigo_zero": agg.count_where("item_codigo_zero"),
            },
            "gold",
        ),
        reconcile.side(terms, {"termos_aditivos": agg.n_unique("chave_termo_aditivo")}, "silver"),
        reconcile.side(
            term_gold, {"termos_aditivos": agg.whole_total("quantidade_termos"), "grupos_termos": agg.rows()}, "gold"
        ),
    ]
    sides = [
        *map(materialize, large),
        reconcile.side(
            contracts,
            {
                "contratos_fisicos": agg.rows(),
                "grupos_contrato": group_count,
                "valor_inicial_contratos": agg.total("valor_inicial_compra"),
                "valor_final_contratos": agg.total("valor_final_compra"),
                "variacao_valor_contratos": agg.total("variacao_valor_contrato"),
                "grupos_termos": group_count,
            },
            "silver",
        ),
        reconcile.side(gold_tables["contratos_atuais_detalhe"], {"contratos_fisicos": agg.rows()}, "gold"),
        reconcile.side(
            zero,
            {"itens_codigo_zero": agg.rows(), "valor_itens_codigo_zero": agg.total("valor_total_item_calculado")},
            "silver",
        ),
        reconcile.side(
            reconcile.distinct_rows(contracts.where(known), ["codigo_contratado", "nome_contratado"]),
            {"contratados_ranking": agg.rows()},
            "silver",
        ),
        reconcile.side(gold_tables["ranking_contratados"], {"contratados_ranking": agg.rows()}, "gold"),
        reconcile.side(reconcile.distinct_rows(contracts, AGENCY), {"orgaos_ranking": agg.rows()}, "silver"),
        reconcile.side(gold_tables["ranking_orgaos"], {"orgaos_ranking": agg.rows()}, "gold"),
        reconcile.side(
            reconcile.distinct_rows(contracts.where(known), [*AGENCY, "codigo_contratado", "nome_contratado"]),
            {"relacionamentos_orgao_contratado": agg.rows()},
            "silver",
        ),
        reconcile.side(
            gold_tables["relacionamento_orgao_contratado"], {"relacionamentos_orgao_contratado": agg.rows()}, "gold"
        ),
    ]
    money = [
        "valor_inicial_contratos", "valor_final_contratos", "variacao_valor_contratos",
        "valor_itens_identificados", "valor_itens_codigo_zero",
    ]
    return reconcile.compare(sides, dict.fromkeys(money, reconcile.MONEY_TOLERANCE))
