"""Chamber of Deputies: bills, authors, themes, votings and votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions.dates import day_of, iso_date, iso_datetime, year_month
from plumbline.functions.keys import content_hash, joined, keyed, or_label
from plumbline.functions.numbers import filled_sum, whole_number
from plumbline.functions.text import boolean_word, camel_name, clean_text, extract, fold_vote, strip, title_of
from plumbline.operators import checks, dedup, dimensions, ranking, reconcile
from plumbline.operators.links import Link, counted_keys, described
from plumbline.operators.typing import retype_existing
from plumbline.operators.unions import existing, rename_if_absent, union_relaxed

LINEAGE = ["ano_arquivo_origem", "arquivo_origem", "linha_arquivo"]

# Typed source columns per dataset; every other column is text.
_BILL_LINK = ["proposicao_id", "proposicao_codTipo", "proposicao_numero", "proposicao_ano"]
TYPED = {
    "proposicoes": {
        whole_number: [
            "id", "numero", "ano", "codTipo", "ultimoStatus_sequencia", "ultimoStatus_idOrgao",
            "ultimoStatus_idTipoTramitacao", "ultimoStatus_idSituacao",
        ],
        iso_datetime: ["dataApresentacao", "ultimoStatus_dataHora"],
    },
    "proposicoes_temas": {whole_number: ["numero", "ano", "codTema", "relevancia"]},
    "proposicoes_autores": {
        whole_number: ["idProposicao", "idDeputadoAutor", "codTipoAutor", "ordemAssinatura"],
        boolean_word: ["proponente"],
    },
    "votacoes": {
        whole_number: [
            "idOrgao", "idEvento", "votosSim", "votosNao", "votosOutros", "ultimaApresentacaoProposicao_idProposicao",
        ],
        iso_datetime: [
            "dataHoraRegistro", "ultimaAberturaVotacao_dataHoraRegistro", "ultimaApresentacaoProposicao_dataHoraRegistro",
        ],
        iso_date: ["data"],
        boolean_word: ["aprovacao"],
    },
    "votacoes_orientacoes": {},
    "votacoes_votos": {whole_number: ["deputado_id", "deputado_idLegislatura"], iso_datetime: ["dataHoraVoto"]},
    "votacoes_objetos": {whole_number: _BILL_LINK, iso_date: ["data"]},
    "votacoes_proposicoes": {whole_number: _BILL_LINK, iso_date: ["data"]},
}


# ---------------------------------------------------------------- silver


def silver_dataset(raw: DataFrame, dataset: str) -> DataFrame:
    """SLV-10: clean, type, rename, record key and content hash for any of the eight datasets."""
    if dataset not in TYPED:
        raise ValueError(f"Unknown dataset: {dataset}")
    data = [c for c in raw.columns if c not in LINEAGE]
    clean = raw.withColumns({c: clean_text(c) for c in data})
    typed = retype_existing(clean, TYPED[dataset]).withColumnsRenamed({c: camel_name(c) for c in data})
    names = [camel_name(c) for c in data]
    return typed.select(
        joined(F.lit(dataset), *LINEAGE).alias("chave_registro"),
        content_hash(typed, names).alias("hash_registro"),
        F.lit(dataset).alias("dataset"),
        *names,
        *LINEAGE,
    )


# ---------------------------------------------------------------- gold


def _moment_parts(c: str, suffix: str) -> dict[str, Column]:
    return {
        f"ano_{suffix}": F.year(c),
        f"mes_{suffix}": F.month(c).cast("tinyint"),
        f"periodo_{suffix}": year_month(c),
    }


def fact_bills(bills: DataFrame) -> DataFrame:
    """GLD-PV-01."""
    return bills.withColumns(
        {
            "id_proposicao": F.col("id"),
            "titulo_proposicao": title_of("sigla_tipo", "numero", "ano"),
            "data_apresentacao_data": day_of("data_apresentacao"),
            **_moment_parts("data_apresentacao", "apresentacao"),
            "data_ultimo_status": day_of("ultimo_status_data_hora"),
            "possui_ementa": F.col("ementa").isNotNull(),
            "possui_inteiro_teor": F.col("url_inteiro_teor").isNotNull(),
        }
    )


def bill_themes(themes: DataFrame) -> DataFrame:
    """GLD-PV-02."""
    return themes.withColumns(
        {
            "id_proposicao": extract("uri_proposicao", r"/(\d+)$").try_cast("bigint"),
            "chave_proposicao_tema": keyed(uri_proposicao="", cod_tema="", tema=""),
        }
    )


def bill_authors(authors: DataFrame) -> DataFrame:
    """GLD-PV-03."""
    named = rename_if_absent(authors, "sigla_ufautor", "sigla_uf_autor")
    deputy = F.col("id_deputado_autor")
    return named.withColumns(
        {
            "chave_proposicao_autor": joined(
                "id_proposicao",
                or_label("id_deputado_autor", "SEM_DEPUTADO"),
                or_label("cod_tipo_autor", ""),
                or_label("ordem_assinatura", ""),
            ),
            "categoria_autor": F.when(deputy.isNotNull(), "DEPUTADO").otherwise(F.upper(or_label("tipo_autor", "OUTRO"))),
        }
    )


def fact_votings(votings: DataFrame) -> DataFrame:
    """GLD-PV-04."""
    passed = F.col("aprovacao")
    return votings.withColumns(
        {
            "id_votacao": F.col("id"),
            "data_votacao": day_of("data_hora_registro"),
            **_moment_parts("data_hora_registro", "votacao"),
            "total_votos_informados": filled_sum("votos_sim", "votos_nao", "votos_outros"),
            "resultado_votacao": F.when(passed, "APROVADA").when(~passed, "REJEITADA").otherwise("SEM_RESULTADO"),
        }
    )


def vote_category(vote: str, folded: str) -> Column:
    """SIM, NAO, ABSTENCAO, OBSTRUCAO; another text as it is, in capitals."""
    return F.when(F.col(folded).isin("sim", "nao", "abstencao", "obstrucao"), F.upper(folded)).otherwise(
        F.upper(or_label(vote, "NAO_INFORMADO"))
    )


def fact_votes(votes: DataFrame) -> DataFrame:
    """GLD-PV-05."""
    moment = F.date_format("data_hora_voto", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return votes.withColumns(
        {
            "voto_normalizado": fold_vote("voto"),
            "data_voto": day_of("data_hora_voto"),
            **_moment_parts("data_hora_voto", "voto"),
            "chave_voto": joined(
                "id_votacao", or_label("deputado_id", "SEM_DEPUTADO"), F.coalesce(moment, F.lit("")), "linha_arquivo"
            ),
        }
    ).withColumn("categoria_voto", vote_category("voto", "voto_normalizado"))


def voting_guidance(guidance: DataFrame) -> DataFrame:
    """GLD-PV-06."""
    key = joined(
        "id_votacao", or_label("sigla_bancada", "SEM_BANCADA"), or_label("orientacao", "SEM_ORIENTACAO"), "linha_arquivo"
    )
    return guidance.withColumn("chave_votacao_orientacao", key)


def _bill_link(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, joined("id_votacao", or_label("proposicao_id", "SEM_PROPOSICAO"), "linha_arquivo"))


def voting_objects(objects: DataFrame) -> DataFrame:
    """GLD-PV-07."""
    return _bill_link(objects, "chave_votacao_objeto")


def voting_bills(links: DataFrame) -> DataFrame:
    """GLD-PV-08."""
    return _bill_link(links, "chave_votacao_proposicao")


def ranking_authors(authors: DataFrame) -> DataFrame:
    """GLD-PV-09."""
    return ranking.ranked_summary(
        authors,
        ["id_deputado_autor", "nome_autor", "categoria_autor", "sigla_partido_autor", "sigla_uf_autor"],
        {
            "quantidade_proposicoes": agg.n_unique("id_proposicao"),
            "quantidade_autorias": agg.rows(),
            "quantidade_como_proponente": agg.count_where("proponente"),
        },
        {"posicao": "quantidade_proposicoes"},
    )


def ranking_themes(themes: DataFrame) -> DataFrame:
    """GLD-PV-10."""
    return ranking.ranked_summary(
        themes,
        ["cod_tema", "tema"],
        {
            "quantidade_proposicoes": agg.n_unique("id_proposicao"),
            "quantidade_classificacoes": agg.rows(),
            "relevancia_media": agg.mean("relevancia"),
        },
        {"posicao": "quantidade_proposicoes"},
    )


def _vote_counts(obstruction: bool = True) -> dict[str, Column]:
    names = {"votos_sim": "SIM", "votos_nao": "NAO", "abstencoes": "ABSTENCAO"}
    if obstruction:
        names["obstrucoes"] = "OBSTRUCAO"
    return {name: agg.count_where(F.col("categoria_voto") == category) for name, category in names.items()}


def ranking_deputies(votes: DataFrame) -> DataFrame:
    """GLD-PV-11."""
    return ranking.ranked_summary(
        votes,
        ["deputado_id", "deputado_nome", "deputado_sigla_partido", "deputado_sigla_uf"],
        {"quantidade_votos": agg.rows(), "quantidade_votacoes": agg.n_unique("id_votacao"), **_vote_counts()},
        {"posicao": "quantidade_votos"},
    )


def ranking_parties(votes: DataFrame) -> DataFrame:
    """GLD-PV-12."""
    return ranking.ranked_summary(
        votes.withColumn("deputado_sigla_partido", or_label("deputado_sigla_partido", "SEM_PARTIDO")),
        ["deputado_sigla_partido"],
        {
            "quantidade_deputados": agg.n_unique("deputado_id"),
            "quantidade_votos": agg.rows(),
            "quantidade_votacoes": agg.n_unique("id_votacao"),
            **_vote_counts(),
        },
        {"posicao": "quantidade_votos"},
    )


def monthly_votings(votings: DataFrame) -> DataFrame:
    """GLD-PV-13."""
    result = F.col("resultado_votacao")
    return ranking.summarize(
        votings,
        ["ano_votacao", "mes_votacao", "periodo_votacao"],
        {
            "quantidade_votacoes": agg.rows(),
            "quantidade_aprovadas": agg.count_where(result == "APROVADA"),
            "quantidade_rejeitadas": agg.count_where(result == "REJEITADA"),
            "quantidade_sem_resultado": agg.count_where(result == "SEM_RESULTADO"),
            "total_votos_sim": agg.whole_total("votos_sim"),
            "total_votos_nao": agg.whole_total("votos_nao"),
            "total_votos_outros": agg.whole_total("votos_outros"),
        },
    )


# Silver dataset -> Gold dataset and its builder; rows are preserved one to one.
FACTS = {
    "proposicoes": ("fato_proposicoes", fact_bills),
    "proposicoes_temas": ("rel_proposicoes_temas", bill_themes),
    "proposicoes_autores": ("rel_proposicoes_autores", bill_authors),
    "votacoes": ("fato_votacoes", fact_votings),
    "votacoes_orientacoes": ("rel_votacoes_orientacoes", voting_guidance),
    "votacoes_votos": ("fato_votos", fact_votes),
    "votacoes_objetos": ("rel_votacoes_objetos", voting_objects),
    "votacoes_proposicoes": ("rel_votacoes_proposicoes", voting_bills),
}


def gold(silver_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    facts = {name: build(silver_tables[source]) for source, (name, build) in FACTS.items()}
    return {
        **facts,
        "ranking_autores": ranking_authors(facts["rel_proposicoes_autores"]),
        "ranking_temas": ranking_themes(facts["rel_proposicoes_temas"]),
        "ranking_deputados_votos": ranking_deputies(facts["fato_votos"]),
        "ranking_partidos_votos": ranking_parties(facts["fato_votos"]),
        "resumo_votacoes_mensal": monthly_votings(facts["fato_votacoes"]),
    }


# ---------------------------------------------------------------- dimensions


def _first_row(df: DataFrame, columns: list[str], key: list[str]) -> DataFrame:
    """One row per key of a projection; the projected values decide which (DDP-03)."""
    return dedup.keep_first(df.select(*existing(df, columns)), existing(df, key), [])


def dim_bill(bills: DataFrame) -> DataFrame:
    """DIM-PV-01."""
    columns = [
        "id_proposicao", "sigla_tipo", "cod_tipo", "numero", "ano", "titulo_proposicao", "ementa", "ementa_detalhada",
        "keywords", "data_apresentacao_data", "ano_apresentacao", "ultimo_status_descricao_situacao",
        "ultimo_status_sigla_orgao", "ultimo_status_descricao_tramitacao", "url_inteiro_teor", "possui_ementa",
        "possui_inteiro_teor",
    ]
    return _first_row(bills.where(F.col("id_proposicao").isNotNull()), columns, ["id_proposicao"])


def dim_author(authors: DataFrame) -> DataFrame:
    """DIM-PV-02."""
    columns = existing(
        authors,
        [
            "id_deputado_autor", "nome_autor", "tipo_autor", "categoria_autor", "cod_tipo_autor", "sigla_partido_autor",
            "sigla_uf_autor", "uri_autor",
        ],
    )
    order = [c for c in ("categoria_autor", "nome_autor") if c in columns]
    rest = [c for c in columns if c not in order]
    return dimensions.surrogate(authors.select(columns).distinct(), "id_autor_dim", order + rest)


def dim_theme(themes: DataFrame) -> DataFrame:
    """DIM-PV-03."""
    return _first_row(themes, ["cod_tema", "tema", "relevancia"], ["cod_tema", "tema"])


def dim_deputy(votes: DataFrame) -> DataFrame:
    """DIM-PV-04."""
    columns = [
        "deputado_id", "deputado_nome", "deputado_sigla_partido", "deputado_sigla_uf", "deputado_id_legislatura",
        "deputado_uri", "deputado_url_foto",
    ]
    return _first_row(votes.where(F.col("deputado_id").isNotNull()), columns, ["deputado_id"])


def _values(frames: list[tuple[DataFrame, str]], name: str) -> DataFrame:
    found = [df.select(F.col(c).cast("string").alias(name)).distinct() for df, c in frames if c in df.columns]
    return union_relaxed(found)


def dim_party(votes: DataFrame, authors: DataFrame) -> DataFrame:
    """DIM-PV-05."""
    rows = _values([(votes, "deputado_sigla_partido"), (authors, "sigla_partido_autor")], "sigla_partido")
    clean = rows.select(F.upper(strip(or_label("sigla_partido", "SEM_PARTIDO"))).alias("sigla_partido")).distinct()
    return dimensions.surrogate(clean, "id_partido", ["sigla_partido"])


def dim_state(votes: DataFrame, authors: DataFrame) -> DataFrame:
    """DIM-PV-06: two-letter codes only (FLT-06)."""
    rows = _values([(votes, "deputado_sigla_uf"), (authors, "sigla_uf_autor")], "sigla_uf")
    clean = rows.select(F.upper(strip("sigla_uf")).alias("sigla_uf")).where(F.length("sigla_uf") == 2).distinct()
    return dimensions.surrogate(clean, "id_uf", ["sigla_uf"])


def dim_body(bills: DataFrame, votings: DataFrame) -> DataFrame:
    """DIM-PV-07: bodies of bills first, then of votings; either may lack the acronym (SET-03)."""
    frames = []
    if "ultimo_status_id_orgao" in bills.columns:
        names = {"ultimo_status_id_orgao": "id_orgao", "ultimo_status_sigla_orgao": "sigla_orgao"}
        frames.append(bills.select(*[F.col(c).alias(n) for c, n in names.items() if c in bills.columns]))
    if "id_orgao" in votings.columns:
        frames.append(votings.select(*existing(votings, ["id_orgao", "sigla_orgao"])))
    sourced = [f.distinct().withColumn("_source", F.lit(i)) for i, f in enumerate(frames)]
    rows = union_relaxed(sourced, allow_missing=True).where(F.col("id_orgao").isNotNull())
    return dedup.keep_first(rows, ["id_orgao"], [F.col("_source")]).drop("_source")


def dim_bill_type(bills: DataFrame) -> DataFrame:
    """DIM-PV-08."""
    return _first_row(bills, ["cod_tipo", "sigla_tipo", "descricao_tipo"], ["cod_tipo", "sigla_tipo"])


def dim_vote_type(votes: DataFrame) -> DataFrame:
    """DIM-PV-09."""
    values = dimensions.labelled(votes, "tipo_voto", "NAO_INFORMADO", source="categoria_voto")
    return dimensions.surrogate(values, "id_tipo_voto", ["tipo_voto"])


def dim_result(votings: DataFrame) -> DataFrame:
    """DIM-PV-10."""
    values = dimensions.labelled(votings, "resultado_votacao", "SEM_RESULTADO")
    return dimensions.surrogate(values, "id_resultado_votacao", ["resultado_votacao"])


def dim_time(bills: DataFrame, votings: DataFrame, votes: DataFrame) -> DataFrame:
    """DIM-PV-11."""
    return dimensions.observed_calendar(
        [(bills, "data_apresentacao_data"), (votings, "data_votacao"), (votes, "data_voto")]
    )


def dims(gold_tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    bills, votings, votes = (gold_tables[t] for t in ("fato_proposicoes", "fato_votacoes", "fato_votos"))
    authors = gold_tables["rel_proposicoes_autores"]
    return {
        "dim_proposicao": dim_bill(bills),
        "dim_autor": dim_author(authors),
        "dim_tema": dim_theme(gold_tables["rel_proposicoes_temas"]),
        "dim_deputado": dim_deputy(votes),
        "dim_partido": dim_party(votes, authors),
        "dim_uf": dim_state(votes, authors),
        "dim_orgao": dim_body(bills, votings),
        "dim_tipo_proposicao": dim_bill_type(bills),
        "dim_tipo_voto": dim_vote_type(votes),
        "dim_resultado_votacao": dim_result(votings),
        "dim_tempo": dim_time(bills, votings, votes),
    }


# ---------------------------------------------------------------- audits


def orphan_check(
    child: DataFrame, parent: DataFrame, name: str, key: str, severity: str = checks.ERROR, details: str = ""
) -> DataFrame:
    """DQ-03: a side without the key column counts every child row as an orphan."""
    if key in child.columns and key in parent.columns:
        child = checks.orphan_rows(child, parent, key, key)
    return checks.expect(child, name, agg.rows(), severity=severity, details=details)


def quality(gold_tables: dict[str, DataFrame], silver_approved: bool, made_from_it: bool) -> DataFrame:
    """DQ-13: 14 checks. The first two say what the manifests say of Silver, and of Gold's origin."""
    votings = gold_tables["fato_votacoes"]
    found = {"silver_manifest_approved": silver_approved, "gold_uses_approved_silver": silver_approved and made_from_it}
    manifest = [checks.expect(votings.sparkSession.range(1), name, F.max(F.lit(int(value))), expected=1) for name, value in found.items()]
    unique = {"fato_proposicoes_id": ("fato_proposicoes", "id_proposicao"), "fato_votacoes_id": ("fato_votacoes", "id_votacao"), "fato_votos_chave": ("fato_votos", "chave_voto")}
    voting, bill = ("fato_votacoes", "id_votacao"), ("fato_proposicoes", "id_proposicao")
    beyond = "Autoria de proposição que não está nos anos lidos."
    points = [
        ("votos_sem_votacao", "fato_votos", *voting, checks.ERROR, ""),
        ("orientacoes_sem_votacao", "rel_votacoes_orientacoes", *voting, checks.ERROR, ""),
        ("objetos_sem_votacao", "rel_votacoes_objetos", *voting, checks.ERROR, ""),
        ("relacoes_proposicoes_sem_votacao", "rel_votacoes_proposicoes", *voting, checks.ERROR, ""),
        ("autores_sem_proposicao", "rel_proposicoes_autores", *bill, checks.WARNING, beyond),
        ("temas_sem_proposicao", "rel_proposicoes_temas", *bill, checks.ERROR, ""),
    ]
    return checks.suite([*manifest, *_key_checks(gold_tables, unique, points)])


def _key_checks(tables: dict[str, DataFrame], unique: dict[str, tuple[str, str]], points: list[tuple[str, str, str, str, str, str]]) -> list[DataFrame]:
    """Null keys, repeated keys (null among them) and orphans of all tables in one pass (DQ-03); tables without their key are looked at alone."""

    def there(table: str, key: str) -> bool:
        return key in tables[table].columns

    links, facts, alone = [], [], []
    for name, (table, key) in unique.items():
        if there(table, key):
            links.append(Link(table, key))
            facts.append(dict(check=name, kind="unique", level=checks.ERROR, note=""))
        else:
            alone += [checks.expect(tables[table], f"{name}_null", agg.rows()), checks.expect(tables[table], f"{name}_duplicate_groups", agg.rows())]
    for name, child, parent, key, level, note in points:
        if there(child, key) and there(parent, key):
            links.append(Link(parent, key, child, key))
            facts.append(dict(check=name, kind="orphans", level=level, note=note))
        else:
            alone.append(orphan_check(tables[child], tables[parent], name, key, level, note))
    if not links:
        return alone
    found = described(counted_keys(tables, links), facts)

    def row(suffix: str, value: Column) -> Column:
        return F.struct(F.concat("check", F.lit(suffix)).alias("name"), value.cast("bigint").alias("value"))

    repeated = F.col("repeated_keys") + (F.col("to_nulls") > 1).cast("int")
    questions = F.when(
        F.col("kind") == "unique", F.array(row("_null", F.col("to_nulls")), row("_duplicate_groups", repeated))
    ).otherwise(F.array(row("", F.col("orphan_rows"))))
    asked = found.select(F.inline(questions), "level", "note")
    return [
        asked.select(
            "name", "value", F.lit(0).cast("bigint").alias("expected"), (F.col("value") == 0).alias("passed"),
            F.col("level").alias("severity"), F.col("note").alias("details"),
        ),
        *alone,
    ]


def reconciliation(silver_tables: dict[str, DataFrame], gold_tables: dict[str, DataFrame]) -> DataFrame:
    """REC-07: 12 checks; rows preserved per dataset and totals of the marts."""
    sides = []
    for source, (target, _) in FACTS.items():
        check = f"{source}_record_count_preserved"
        sides.append(reconcile.side(silver_tables[source], {check: agg.rows()}, "silver"))
        sides.append(reconcile.side(gold_tables[target], {check: agg.rows()}, "gold"))
    votes, votings = gold_tables["fato_votos"], gold_tables["fato_votacoes"]
    per_vote = {"ranking_deputados_total_votos": "ranking_deputados_votos", "ranking_partidos_total_votos": "ranking_partidos_votos"}
    sides.append(reconcile.side(votes, {check: agg.rows() for check in per_vote}, "silver"))
    for check, mart in per_vote.items():
        sides.append(reconcile.side(gold_tables[mart], {check: agg.whole_total("quantidade_votos")}, "gold"))
    sides.append(reconcile.side(votings, {"resumo_mensal_total_votacoes": agg.rows()}, "silver"))
    sides.append(
        reconcile.side(
            gold_tables["resumo_votacoes_mensal"], {"resumo_mensal_total_votacoes": agg.whole_total("quantidade_votacoes")}, "gold"
        )
    )
    one = votings.sparkSession.range(1)
    sides.append(reconcile.side(one, {"gold_dataset_count": F.max(F.lit(13))}, "silver"))
    sides.append(reconcile.side(one, {"gold_dataset_count": F.max(F.lit(len(gold_tables)))}, "gold"))
    return reconcile.compare(sides)
