"""Public tenders: headers, winning items, participants, commitments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions.dates import before, brazilian_date, days_between
from plumbline.functions.keys import joined, keyed, or_label
from plumbline.functions.numbers import brazilian_decimal, percentage
from plumbline.functions.text import clean_text, contains_any, upper_text
from plumbline.operators import checks, dedup, dimensions, ranking, reconcile
from plumbline.operators.typing import retype
from plumbline.runtime import materialize

AGENCY = ["codigo_orgao_superior", "nome_orgao_superior", "codigo_orgao", "nome_orgao"]
MODALITY = ["codigo_modalidade_compra", "modalidade_compra"]
TENDER_PARTS = ["numero_licitacao", "codigo_ug", "nome_ug", *MODALITY, "numero_processo"]

# Codes that stand for an unknown party, and the words of a winner flag.
UNIDENTIFIED = ("-11", "-3", "0")
WINNER_WORDS = ("SIM", "S", "YES")


def tender_key() -> Column:
    return keyed(codigo_ug="SEM_UG", codigo_modalidade_compra="SEM_MODALIDADE", numero_licitacao="SEM_NUMERO")


def _identified(code: str) -> Column:
    return F.coalesce(~F.col(code).isin(*UNIDENTIFIED), F.lit(False))


def _with_item_key(typed: DataFrame) -> DataFrame:
    keyed_rows = typed.withColumn("chave_licitacao", tender_key())
    return keyed_rows.withColumn(
        "chave_item_licitacao", joined("chave_licitacao", or_label("codigo_item_compra", "SEM_ITEM"))
    )


# ---------------------------------------------------------------- silver


def parse_tenders(raw: DataFrame) -> DataFrame:
    return retype(
        raw,
        {
            clean_text: [*TENDER_PARTS, "objeto", "situacao_licitacao", *AGENCY],
            upper_text: ["uf", "municipio"],
            brazilian_date: ["data_resultado_compra", "data_abertura"],
            brazilian_decimal: ["valor_licitacao"],
        },
    )


def derive_tenders(typed: DataFrame) -> DataFrame:
    return typed.withColumns(
        {
            "chave_licitacao": tender_key(),
            "licitacao_sigilosa": contains_any("objeto", "sigilo"),
            "duracao_processo_dias": days_between("data_abertura", "data_resultado_compra"),
            "data_processo_inconsistente": before("data_resultado_compra", "data_abertura"),
        }
    )


def silver_tenders(raw: DataFrame) -> DataFrame:
    """SLV-05."""
    return derive_tenders(parse_tenders(raw))


def parse_items(raw: DataFrame) -> DataFrame:
    return retype(
        raw,
        {
            clean_text: [
                *TENDER_PARTS, "codigo_orgao", "nome_orgao", "codigo_item_compra", "descricao", "codigo_vencedor", "nome_vencedor",
            ],
            brazilian_decimal: ["quantidade_item", "valor_item"],
        },
    )


def derive_items(typed: DataFrame) -> DataFrame:
    return _with_item_key(typed).withColumns(
        {
            "chave_item_vencedor": joined("chave_item_licitacao", or_label("codigo_vencedor", "SEM_VENCEDOR")),
            "valor_total_item_calculado": F.col("quantidade_item") * F.col("valor_item"),
            "vencedor_identificado": _identified("codigo_vencedor"),
            "vencedor_sigiloso": contains_any("nome_vencedor", "sigil"),
        }
    )


def silver_items(raw: DataFrame) -> DataFrame:
    """SLV-06."""
    return derive_items(parse_items(raw))


def parse_participants(raw: DataFrame) -> DataFrame:
    return retype(
        raw,
        {
            clean_text: [
                *TENDER_PARTS, "codigo_orgao", "nome_orgao", "codigo_item_compra", "descricao_item_compra",
                "codigo_participante", "nome_participante",
            ],
            upper_text: ["flag_vencedor"],
        },
    )


def derive_participants(typed: DataFrame) -> DataFrame:
    return _with_item_key(typed).withColumns(
        {
            "chave_participacao": joined("chave_item_licitacao", or_label("codigo_participante", "SEM_PARTICIPANTE")),
            "participante_vencedor": F.col("flag_vencedor").isin(*WINNER_WORDS),
            "participante_identificado": _identified("codigo_participante"),
            "participante_sigiloso": contains_any("nome_participante", "sigil"),
        }
    )


def silver_participants(raw: DataFrame) -> DataFrame:
    """SLV-07."""
    return derive_participants(parse_participants(raw))


def silver_commitments(raw: DataFrame) -> DataFrame:
    """SLV-08."""
    typed = retype(
        raw,
        {
            clean_text: [*TENDER_PARTS, "codigo_empenho", "observacao_empenho"],
            brazilian_date: ["data_emissao_empenho"],
            brazilian_decimal: ["valor_empenho_r"],
        },
    )
    return derive_commitments(typed)


def derive_commitments(typed: DataFrame) -> DataFrame:
    return typed.withColumn("chave_licitacao", tender_key()).withColumn(
        "chave_empenho_licitacao", joined("chave_licitacao", or_label("codigo_empenho", "SEM_EMPENHO"))
    )


SILVER = {
    "licitacoes": (silver_tenders, "chave_licitacao"),
    "itens_licitacao": (silver_items, "chave_item_vencedor"),
    "participantes_licitacao": (silver_participants, "chave_participacao"),
    "empenhos_relacionados": (silver_commitments, "chave_empenho_licitacao"),
}


def silver(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: dedup.keep_latest(build(raw[name]), [key]) for name, (build, key) in SILVER.items()}


# ---------------------------------------------------------------- gold


def competition(tenders: DataFrame, participants: DataFrame, items: DataFrame) -> DataFrame:
    """GLD-LC-01: each tender with its participants and winners, both sides pre-aggregated.

    A tender has few lines: they move once, before they are counted, and meet the tender where they are.
    """
    key = ["chave_licitacao"]
    entrant, winner, item = F.col("codigo_participante"), F.when(F.col("vencedor_identificado"), F.col("codigo_vencedor")), F.col("codigo_item_compra")
    # A participant's row that won, if there is one, stands for the participant.
    won = F.col("participante_vencedor").desc_nulls_last()
    participants = ranking.together(participants, key, {"_entrant": entrant, "_item": item}, {"_entrant": won})
    items = ranking.together(items, key, {"_winner": winner, "_item": item})
    sides = {
        "quantidade_participantes": agg.count_where(F.col("_entrant") & entrant.isNotNull()),
        "quantidade_vencedores": agg.count_where(F.col("_entrant") & entrant.isNotNull() & F.col("participante_vencedor")),
        "quantidade_itens_disputados": agg.count_where(F.col("_item") & item.isNotNull()),
        "quantidade_participacoes_sigilosas": agg.count_where("participante_sigiloso"),
    }
    results = {
        "quantidade_itens_resultado": agg.count_where(F.col("_item") & item.isNotNull()),
        "quantidade_fornecedores_vencedores": agg.count_where(F.col("_winner") & winner.isNotNull()),
    }
    both = tenders.join(ranking.summarize(participants, key, sides), key, "left").join(
        ranking.summarize(items, key, {**results, "valor_itens_vencedores": agg.total("valor_item")}), key, "left"
    )
    filled = {c: F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in (*sides, *results)}
    filled["valor_itens_vencedores"] = F.coalesce(F.col("valor_itens_vencedores"), F.lit(0.0))
    entrants = F.col("quantidade_participantes")
    return both.withColumns(filled).withColumns(
        {
            "baixa_competitividade": entrants <= 1,
            "participante_unico": entrants == 1,
            "sem_participante_identificado": entrants == 0,
            "sem_vencedor_identificado": F.col("quantidade_vencedores") == 0,
        }
    )


def _low_competition_share(df: DataFrame) -> DataFrame:
    share = percentage("quantidade_baixa_competitividade", "quantidade_licitacoes")
    return df.withColumn("percentual_baixa_competitividade", share)




def ranking_agencies(tenders: DataFrame, competing: DataFrame) -> DataFrame:
    """GLD-LC-02."""
    left = ranking.summarize(
        tenders,
        AGENCY,
        {
            "quantidade_licitacoes": agg.n_unique("chave_licitacao"),
            "quantidade_ugs": agg.n_present("codigo_ug"),
            "quantidade_modalidades": agg.n_present("codigo_modalidade_compra"),
            "valor_total_licitado": agg.total("valor_licitacao"),
            "valor_medio_licitacao": agg.mean("valor_licitacao"),
            "maior_valor_licitacao": F.max("valor_licitacao"),
        },
    )
    right = ranking.summarize(
        competing,
        AGENCY,
        {
            "media_participantes": agg.mean("quantidade_participantes", 4),
            # The state of an exact median is the distinct participant counts, not the tenders.
            "mediana_participantes": F.median("quantidade_participantes"),
            "quantidade_baixa_competitividade": agg.count_where("baixa_competitividade").cast("bigint"),
            "quantidade_participante_unico": agg.count_where("participante_unico").cast("bigint"),
            "quantidade_licitacoes_sigilosas": agg.count_where("licitacao_sigilosa").cast("bigint"),
        },
    )
    both = _low_competition_share(left.join(right, AGENCY, "left"))
    return ranking.add_ranks(both, {"posicao_valor_licitado": "valor_total_licitado"})


def ranking_suppliers(items: DataFrame) -> DataFrame:
    """GLD-LC-03."""
    return ranking.ranked_summary(
        items.where("vencedor_identificado"),
        ["codigo_vencedor", "nome_vencedor"],
        {
            "quantidade_licitacoes_vencidas": agg.n_unique("chave_licitacao"),
            "quantidade_itens_vencidos": agg.n_unique("chave_item_licitacao"),
            "quantidade_orgaos": agg.n_present("codigo_orgao"),
            "valor_itens_vencidos": agg.total("valor_item"),
            "valor_medio_item": agg.mean("valor_item"),
            "maior_valor_item": F.max("valor_item"),
        },
        {
            "posicao_valor_itens_vencidos": "valor_itens_vencidos",
            "posicao_quantidade_licitacoes": "quantidade_licitacoes_vencidas",
        },
    )


def ranking_modalities(tenders: DataFrame, competing: DataFrame) -> DataFrame:
    """GLD-LC-04."""
    left = ranking.summarize(
        tenders,
        MODALITY,
        {
            "quantidade_licitacoes": agg.n_unique("chave_licitacao"),
            "quantidade_orgaos": agg.n_present("codigo_orgao"),
            "valor_total_licitado": agg.total("valor_licitacao"),
            "valor_medio_licitacao": agg.mean("valor_licitacao"),
            "quantidade_sigilosas": agg.count_where("licitacao_sigilosa").cast("bigint"),
        },
    )
    right = ranking.summarize(
        competing,
        MODALITY,
        {
            "media_participantes": agg.mean("quantidade_participantes", 4),
            "quantidade_baixa_competitividade": agg.count_where("baixa_competitividade").cast("bigint"),
            "quantidade_participante_unico": agg.count_where("participante_unico").cast("bigint"),
        },
    )
    both = _low_competition_share(left.join(right, MODALITY, "left"))
    return ranking.add_ranks(both, {"posicao_valor_licitado": "valor_total_licitado"})


def ranking_states(tenders: DataFrame) -> DataFrame:
    """GLD-LC-05: cities ranked inside their state."""
    return ranking.ranked_summary(
        tenders.where(F.col("uf").isNotNull()),
        ["uf", "municipio"],
        {
            "quantidade_licitacoes": agg.n_unique("chave_licitacao"),
            "quantidade_orgaos": agg.n_present("codigo_orgao"),
            "valor_total_licitado": agg.total("valor_licitacao"),
            "valor_medio_licitacao": agg.mean("valor_licitacao"),
        },
        {"posicao_municipio_na_uf": "valor_total_licitado"},
        by=["uf"],
    )


def agency_supplier(tenders: DataFrame, items: DataFrame) -> DataFrame:
    """GLD-LC-06: winners joined to the tender's superior agency, grouped by the item's own agency.

    Items are first reduced to one row per tender, agency and winner. An item key starts with
    its tender key, so its distinct counts add up over tenders; the join then moves far fewer
    rows, and a tender with very many items is one row per winner.
    """
    supplier = ["codigo_vencedor", "nome_vencedor"]
    per_tender = ranking.summarize(
        items.where("vencedor_identificado"),
        ["chave_licitacao", "codigo_orgao", "nome_orgao", *supplier],
        {
            "_itens": agg.n_unique("chave_item_licitacao"),
            "_valor": agg.exact_total("valor_item"),
        },
    )
    header = tenders.select("chave_licitacao", "codigo_orgao_superior", "nome_orgao_superior")
    return ranking.concentration(
        per_tender.join(header, "chave_licitacao", "left"),
        [*AGENCY, *supplier],
        {
            "quantidade_licitacoes": agg.rows(),
            "quantidade_itens": agg.whole_total("_itens"),
            "valor_itens_vencidos": F.coalesce(F.sum(F.col("_valor")), F.lit(0)).cast("double"),
        },
        value="valor_itens_vencidos",
        by=["codigo_orgao"],
        total="total_itens_vencidos_orgao",
        share="percentual_concentracao_fornecedor",
        rank="posicao_fornecedor_no_orgao",
    )


def gold(silver_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    tenders, items = silver_tables["licitacoes"], silver_tables["itens_licitacao"]
    competing = materialize(competition(tenders, silver_tables["participantes_licitacao"], items))
    return {
        "concorrencia_licitacoes": competing,
        "ranking_orgaos": ranking_agencies(tenders, competing),
        "ranking_fornecedores": ranking_suppliers(items),
        "ranking_modalidades": ranking_modalities(tenders, competing),
        "ranking_uf": ranking_states(tenders),
        "relacionamento_orgao_fornecedor": agency_supplier(tenders, items),
    }


# ---------------------------------------------------------------- dimensions


def dim_agency(tenders: DataFrame) -> DataFrame:
    """DIM-LC-01."""
    return dimensions.with_key(tenders, AGENCY, chave_orgao=keyed(codigo_orgao_superior="", codigo_orgao=""))


def dim_unit(tenders: DataFrame) -> DataFrame:
    """DIM-LC-02."""
    columns = ["codigo_orgao", "codigo_ug", "nome_ug"]
    return dimensions.with_key(tenders, columns, chave_unidade_gestora=keyed(codigo_orgao="", codigo_ug=""))


def dim_supplier(items: DataFrame) -> DataFrame:
    """DIM-LC-03."""
    return dimensions.with_key(items, ["codigo_vencedor", "nome_vencedor"], chave_fornecedor=F.col("codigo_vencedor"))


def dim_modality(tenders: DataFrame) -> DataFrame:
    """DIM-LC-04."""
    return dimensions.with_key(tenders, MODALITY, chave_modalidade=F.col("codigo_modalidade_compra"))


def dim_status(tenders: DataFrame) -> DataFrame:
    """DIM-LC-05."""
    values = dimensions.labelled(tenders, "situacao_licitacao", "NÃO INFORMADA")
    return dimensions.surrogate(values, "chave_situacao", ["situacao_licitacao"])


def dim_place(tenders: DataFrame) -> DataFrame:
    """DIM-LC-06."""
    places = tenders.select(or_label("uf", "NÃO INFORMADA").alias("uf"), or_label("municipio", "NÃO INFORMADO").alias("municipio"))
    return dimensions.with_key(places, ["uf", "municipio"], chave_localidade=joined("uf", "municipio"))


def dim_time(tenders: DataFrame) -> DataFrame:
    """DIM-LC-07."""
    return dimensions.calendar(tenders, "data_abertura", "data_resultado_compra")


def dims(silver_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    tenders = silver_tables["licitacoes"]
    return {
        "dim_orgao": dim_agency(tenders),
        "dim_unidade_gestora": dim_unit(tenders),
        "dim_fornecedor": dim_supplier(silver_tables["itens_licitacao"]),
        "dim_modalidade": dim_modality(tenders),
        "dim_situacao": dim_status(tenders),
        "dim_localidade": dim_place(tenders),
        "dim_tempo": dim_time(tenders),
    }


# ---------------------------------------------------------------- audits


def date_checks(tenders: DataFrame) -> DataFrame:
    """DQ-05."""
    return checks.rule_checks(
        tenders,
        "licitacoes",
        [
            {"check": "result_before_opening", "value": agg.count_where(before("data_resultado_compra", "data_abertura"))},
            {"check": "negative_process_duration", "value": agg.count_where(F.col("duracao_processo_dias") < 0)},
        ],
        value_name="rows",
    )


def winner_check(participants: DataFrame) -> DataFrame:
    """DQ-08."""
    nameless = F.col("participante_vencedor") & ~F.col("participante_identificado") & ~F.col("participante_sigiloso")
    return checks.rule_checks(
        participants,
        "participantes_licitacao",
        [{"check": "winner_without_identification", "value": agg.count_where(nameless), "blocking": True}],
        value_name="rows",
    )


def orphan_profile(participants: DataFrame, items: DataFrame) -> DataFrame:
    """DQ-09: one pass over the participants whose item has no result."""
    known = items.select("chave_item_licitacao").distinct()
    orphans = participants.join(known, "chave_item_licitacao", "left_anti")
    per_key = orphans.groupBy("chave_item_licitacao").agg(
        agg.rows().alias("_rows"),
        agg.count_where("participante_vencedor").alias("_winners"),
        agg.count_where(~F.col("participante_vencedor")).alias("_losers"),
        agg.count_where(F.col("codigo_item_compra") == "0").alias("_zero"),
        agg.count_where(F.col("codigo_participante") == "-11").alias("_secret"),
    )
    one = per_key.agg(
        agg.whole_total("_rows").alias("rows"),
        agg.rows().alias("missing_keys"),
        agg.whole_total("_winners").alias("orphan_winners"),
        agg.whole_total("_losers").alias("orphan_non_winners"),
        agg.whole_total("_zero").alias("item_code_zero"),
        agg.whole_total("_secret").alias("confidential_participants"),
    )
    return one.select(
        F.lit("orphan_participants_detail").alias("check"),
        F.lit("participantes_licitacao").alias("dataset"),
        *one.columns,
        F.when(F.col("rows") > 0, "warning").otherwise("info").alias("severity"),
        F.lit(True).alias("approved"),
    )


def quality(tables: dict[str, DataFrame]) -> DataFrame:
    """DQ-14 for tenders."""
    tenders, items = tables["licitacoes"], tables["itens_licitacao"]
    participants, commitments = tables["participantes_licitacao"], tables["empenhos_relacionados"]
    key = "chave_licitacao"
    return checks.suite(
        [
            checks.key_checks(
                tables,
                unique=[
                    ("licitacoes", key), ("itens_licitacao", "chave_item_vencedor"), ("participantes_licitacao", "chave_participacao"),
                    ("empenhos_relacionados", "chave_empenho_licitacao"),
                ],
                references=[
                    ("itens_licitacao", "licitacoes", key, key, checks.ERROR),
                    ("participantes_licitacao", "licitacoes", key, key, checks.ERROR),
                    ("participantes_licitacao", "itens_licitacao", "chave_item_licitacao", "chave_item_licitacao", checks.WARNING),
                    ("empenhos_relacionados", "licitacoes", key, key, checks.ERROR),
                ],
            ),
            checks.negative_values(tenders, "licitacoes", ["valor_licitacao"]),
            checks.negative_values(items, "itens_licitacao", ["quantidade_item", "valor_item", "valor_total_item_calculado"]),
            checks.negative_values(commitments, "empenhos_relacionados", ["valor_empenho_r"]),
            date_checks(tenders),
            winner_check(participants),
            orphan_profile(participants, items),
        ]
    )


def reconciliation(silver_tables: dict[str, DataFrame], gold_tables: dict[str, DataFrame]) -> DataFrame:
    """REC-03: 20 checks. Each Gold table is compared with the rows it is made of, so rows without
    a state or without an identified winner are left out on both sides."""
    tenders, items = silver_tables["licitacoes"], silver_tables["itens_licitacao"]
    competing = gold_tables["concorrencia_licitacoes"]
    winners = items.where("vencedor_identificado")
    with_state = F.col("uf").isNotNull()

    def distinct(df: DataFrame, columns: list[str], check: str) -> DataFrame:
        return reconcile.side(reconcile.distinct_rows(df, columns), {check: agg.rows()}, "silver")

    header = tenders.select("chave_licitacao", "codigo_orgao_superior", "nome_orgao_superior")
    pairs = winners.select("chave_licitacao", "codigo_orgao", "nome_orgao", "codigo_vencedor", "nome_vencedor").distinct()
    won_by_someone = agg.total("valor_item", F.col("vencedor_identificado"))
    sides = [
        reconcile.sides(
            tenders,
            {
                "silver": {
                    "quantidade_licitacoes": agg.rows(),
                    "chaves_licitacao_unicas_silver": agg.rows(),
                    "valor_total_licitacoes": agg.total("valor_licitacao"),
                    "ranking_modalidades_quantidade": agg.rows(),
                    "ranking_modalidades_valor": agg.total("valor_licitacao"),
                    "ranking_orgaos_quantidade": agg.rows(),
                    "ranking_orgaos_valor": agg.total("valor_licitacao"),
                    "ranking_uf_quantidade": agg.count_where(with_state),
                    "ranking_uf_valor": agg.total("valor_licitacao", with_state),
                },
                "gold": {"chaves_licitacao_unicas_silver": agg.n_unique("chave_licitacao")},
            },
        ),
        reconcile.sides(
            competing,
            {
                "silver": {"chaves_licitacao_unicas_gold": agg.rows()},
                "gold": {
                    "quantidade_licitacoes": agg.rows(),
                    "chaves_licitacao_unicas_gold": agg.n_unique("chave_licitacao"),
                    "valor_total_licitacoes": agg.total("valor_licitacao"),
                    "valor_itens_concorrencia": agg.total("valor_itens_vencedores"),
                },
            },
        ),
        reconcile.side(
            items,
            {"valor_itens_concorrencia": agg.total("valor_item"), "valor_itens_fornecedores": won_by_someone, "valor_itens_relacionamento": won_by_someone},
            "silver",
        ),
        distinct(winners, ["codigo_vencedor", "nome_vencedor", "chave_item_licitacao"], "quantidade_itens_fornecedores"),
        distinct(
            winners,
            ["codigo_orgao", "nome_orgao", "codigo_vencedor", "nome_vencedor", "chave_item_licitacao"],
            "quantidade_itens_relacionamento",
        ),
        distinct(winners, ["codigo_vencedor", "nome_vencedor"], "quantidade_fornecedores"),
        distinct(tenders, MODALITY, "quantidade_modalidades"),
        distinct(tenders, AGENCY, "quantidade_orgaos"),
        distinct(tenders.where(with_state), ["uf", "municipio"], "quantidade_localidades"),
        distinct(
            pairs.join(header, "chave_licitacao", "left"), [*AGENCY, "codigo_vencedor", "nome_vencedor"], "quantidade_relacionamentos"
        ),
    ]
    amounts = "valor_total_licitado"
    per_table = {
        "ranking_modalidades": {
            "ranking_modalidades_quantidade": agg.whole_total("quantidade_licitacoes"),
            "ranking_modalidades_valor": agg.total(amounts),
            "quantidade_modalidades": agg.rows(),
        },
        "ranking_orgaos": {
            "ranking_orgaos_quantidade": agg.whole_total("quantidade_licitacoes"),
            "ranking_orgaos_valor": agg.total(amounts),
            "quantidade_orgaos": agg.rows(),
        },
        "ranking_uf": {
            "ranking_uf_quantidade": agg.whole_total("quantidade_licitacoes"),
            "ranking_uf_valor": agg.total(amounts),
            "quantidade_localidades": agg.rows(),
        },
        "ranking_fornecedores": {
            "quantidade_itens_fornecedores": agg.whole_total("quantidade_itens_vencidos"),
            "valor_itens_fornecedores": agg.total("valor_itens_vencidos"),
            "quantidade_fornecedores": agg.rows(),
        },
        "relacionamento_orgao_fornecedor": {
            "quantidade_itens_relacionamento": agg.whole_total("quantidade_itens"),
            "valor_itens_relacionamento": agg.total("valor_itens_vencidos"),
            "quantidade_relacionamentos": agg.rows(),
        },
    }
    sides += [reconcile.side(gold_tables[name], values, "gold") for name, values in per_table.items()]
    money = [
        "valor_total_licitacoes", "ranking_modalidades_valor", "ranking_orgaos_valor", "ranking_uf_valor",
        "valor_itens_fornecedores", "valor_itens_relacionamento", "valor_itens_concorrencia",
    ]
    return reconcile.compare(sides, dict.fromkeys(money, reconcile.MONEY_TOLERANCE))
