"""Column expressions on whole tables (EXP, FLT, PRJ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import dates, keys, numbers, text
from plumbline.functions.nested import flatten, unnest
from plumbline.operators import dimensions, unions
from plumbline.operators.typing import retype_existing
from plumbline.workload.base import has, pct, query, sha, staged, table

NBSP = " "

# ---------------------------------------------------------------- headers and text

query(
    "exp_01a_headers_normalised",
    "SELECT s_suppkey AS codigo_do_fornecedor, s_name AS nome_razao_social, s_acctbal AS valor_r FROM {supplier}",
)(
    lambda s, d: text.rename_all(
        table(s, d, "supplier").select(
            F.col("s_suppkey").alias("Código  do Fornecedor"), F.col("s_name").alias("Nome / Razão-Social"), F.col("s_acctbal").alias("Valor (R$)")
        ),
        text.header_name,
    )
)
query(
    "exp_01b_camel_case_headers",
    "SELECT s_suppkey AS id_fornecedor, s_name AS ultimo_status_nome, s_acctbal AS sigla_ufautor, s_nationkey AS total2_votos FROM {supplier}",
    wide=("total2_votos",),
)(
    lambda s, d: text.rename_all(
        table(s, d, "supplier").select(
            F.col("s_suppkey").alias("idFornecedor"), F.col("s_name").alias("ultimoStatus_nome"),
            F.col("s_acctbal").alias("siglaUFAutor"), F.col("s_nationkey").alias("total2Votos"),
        ),
        text.camel_name,
    ).withColumn("total2_votos", F.col("total2_votos").cast("int"))
)
query(
    "exp_02_clean_text",
    "SELECT c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_name END AS nome, upper(c_mktsegment) AS segmento FROM {customer}",
)(
    lambda s, d: table(s, d, "customer").select(
        "c_custkey",
        text.clean_text(F.when(F.col("c_custkey") % 5 == 0, f" \t{NBSP}").otherwise(F.concat(F.lit(f"{NBSP} "), "c_name", F.lit(" \n")))).alias("nome"),
        text.upper_text(F.concat(F.lit(" "), F.lower("c_mktsegment"))).alias("segmento"),
    )
)
_DIRTY = """SELECT o_orderkey, o_totalprice, o_orderdate, CASE o_orderkey % 6 WHEN 0 THEN 'x' WHEN 1 THEN '' WHEN 2 THEN 'NaN' WHEN 3 THEN '12d' END AS ruim FROM {orders}"""


def _brl(c: str) -> F.Column:
    return F.translate(F.format_number(c, 2), ",.", ".,")


@query(
    "exp_03_brazilian_decimal",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 6 > 3 THEN o_totalprice END AS a, CASE WHEN o_orderkey % 6 > 3 THEN o_totalprice ELSE 0.0 END AS b,
    CASE WHEN o_orderkey % 6 > 3 THEN -o_totalprice END AS c, o_totalprice AS d FROM {orders}""",
)
def brazilian_decimal(spark: SparkSession, sf: str) -> DataFrame:
    """1.234,56 with words, blanks, NaN and a Java suffix among it; null, zero, decimal and comma-only forms."""
    rows = staged(spark, sf, _DIRTY)
    shown = F.coalesce("ruim", _brl("o_totalprice"))
    return rows.select(
        "o_orderkey",
        numbers.brazilian_decimal(shown).alias("a"),
        numbers.brazilian_money(shown).alias("b"),
        numbers.brazilian_decimal(F.coalesce("ruim", F.concat(F.lit("-"), _brl("o_totalprice"))), "decimal(18,2)").alias("c"),
        numbers.comma_decimal(F.translate(F.col("o_totalprice").cast("string"), ".", ",")).alias("d"),
    )


@query(
    "exp_04_05_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) END AS dia,
    CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL 3661 SECOND END AS momento, CAST(o_orderdate AS DATE) AS inferida FROM {orders}""",
)
def tolerant_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Days without leading zero, impossible days, ISO moments, and dates in two spellings."""
    bad = F.col("o_orderkey") % 7 == 0
    moment = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 3661 SECOND"), "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.brazilian_date(F.when(bad, "31/02/2025").otherwise(F.date_format("o_orderdate", "d/M/yyyy"))).alias("dia"),
        dates.iso_datetime(F.when(bad, "2025").otherwise(moment)).alias("momento"),
        dates.iso_date(F.when(bad, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))).alias("inferida"),
    )


query("exp_06_digits_number", "SELECT o_orderkey, o_custkey AS n, CASE WHEN o_orderkey % 9 <> 0 THEN -o_custkey END AS m FROM {orders}")(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey",
        numbers.digits_number(F.concat(F.lit("cod. "), F.col("o_custkey").cast("string"), F.lit(" /x"))).alias("n"),
        numbers.digits_number(F.when(F.col("o_orderkey") % 9 == 0, "sem").otherwise(F.concat(F.lit("- "), F.col("o_custkey").cast("string")))).alias("m"),
    ).withColumn("m", F.when(F.col("m") == 0, F.lit(0)).otherwise(F.col("m")))
)
query(
    "exp_07_typed_by_configuration",
    """SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS data, o_orderstatus = 'F' AS aprovacao, CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey END AS numero,
    o_orderpriority AS texto FROM {orders}""",
)(
    lambda s, d: retype_existing(
        table(s, d, "orders").select(
            F.col("o_orderkey").cast("string").alias("id"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("data"),
            F.when(F.col("o_orderstatus") == "F", "Sim").otherwise("não").alias("aprovacao"),
            F.when(F.col("o_orderkey") % 4 == 0, "1.5").otherwise(F.col("o_custkey").cast("string")).alias("numero"),
            F.col("o_orderpriority").alias("texto"),
        ),
        {numbers.whole_number: ["id", "numero", "ausente"], dates.iso_date: ["data"], text.boolean_word: ["aprovacao"]},
    )
)
query(
    "exp_08_boolean_words",
    """SELECT o_orderkey, CASE o_orderkey % 7 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE WHEN 4 THEN TRUE WHEN 5 THEN FALSE END AS v FROM {orders}""",
)(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey",
        text.boolean_word(
            F.element_at(F.array(*[F.lit(w) for w in (" Sim", "NÃO ", "yes", "0", "S", "nao", "talvez")]), (F.col("o_orderkey") % 7 + 1).cast("int"))
        ).alias("v"),
    )
)
query(
    "exp_09_vote_folding",
    "SELECT doc_id, translate(lower(trim(substr(text, 1, 60), ' \t\n')), 'ãçéíóú', 'aceiou') AS v FROM {documents}",
)(lambda s, d: table(s, d, "documents").select("doc_id", text.fold_vote(F.substring("text", 1, 60)).alias("v")))
query(
    "exp_10_substring_parts",
    "SELECT o_orderkey, year(o_orderdate) AS ano, strftime(o_orderdate, '%Y%m') AS periodo, month(o_orderdate) AS mes FROM {orders}",
)(
    lambda s, d: table(s, d, "orders").select(
        "o_orderkey",
        numbers.whole_number(F.substring(F.date_format("o_orderdate", "yyyy-MM-dd"), 1, 4), "int").alias("ano"),
        dates.year_month("o_orderdate").alias("periodo"),
        numbers.whole_number(F.substring(dates.year_month("o_orderdate"), 5, 2), "tinyint").alias("mes"),
    )
)
query(
    "exp_11_regex_extract",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN 'São João ' || CAST(o_custkey % 9 AS VARCHAR) END AS cidade,
    CASE WHEN o_orderkey % 3 <> 0 THEN 'MG' END AS uf, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey END AS id FROM {orders}""",
)(
    lambda s, d: table(s, d, "orders")
    .withColumn("lugar", F.when(F.col("o_orderkey") % 3 == 0, "Nacional").otherwise(F.concat(F.lit("São João "), (F.col("o_custkey") % 9).cast("string"), F.lit("  - MG"))))
    .withColumn("uri", F.when(F.col("o_orderkey") % 5 == 0, "http://x/").otherwise(F.concat(F.lit("http://x/"), F.col("o_orderkey").cast("string"))))
    .select("o_orderkey", text.city_of("lugar").alias("cidade"), text.state_of("lugar").alias("uf"), text.extract("uri", r"/(\d+)$").try_cast("bigint").alias("id"))
)
query(
    "exp_12_keyword_flags",
    f"""SELECT doc_id, {has("text", "erste", "zwischen")} AS um, {has("text", "tion")} AS dois, {has("text", "é", "ção")} AS tres FROM {{documents}}""",
)(
    lambda s, d: table(s, d, "documents").select(
        "doc_id",
        text.contains_any("text", "erste", "zwischen").alias("um"),
        text.contains_any("text", "tion").alias("dois"),
        text.contains_any("text", "é", "ção").alias("tres"),
    )
)
query(
    "exp_13_sentinel_codes",
    "SELECT l_orderkey, l_linenumber, l_partkey, coalesce(CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE l_suppkey % 4 NOT IN (0, 3) END, FALSE) AS identificado FROM {lineitem}",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.coalesce(~F.when(F.col("l_suppkey") % 9 != 0, F.col("l_suppkey") % 4).isin(0, 3), F.lit(False)).alias("identificado"),
    )
)

# ---------------------------------------------------------------- dates

query(
    "exp_14_15_day_difference",
    """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(o_orderdate AS DATE) AS a,
      CASE WHEN l_partkey % 13 <> 0 THEN CAST(l_shipdate AS DATE) - CAST(l_partkey % 80 AS INT) END AS b FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey)
    SELECT l_orderkey, l_linenumber, l_partkey, datediff('day', a, b) AS dias, coalesce(b < a, FALSE) AS inconsistente FROM t""",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem")
    .join(table(s, d, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    .withColumns(
        {
            "a": dates.day_of("o_orderdate"),
            "b": F.when(F.col("l_partkey") % 13 != 0, F.date_sub(dates.day_of("l_shipdate"), (F.col("l_partkey") % 80).cast("int"))),
        }
    )
    .select("l_orderkey", "l_linenumber", "l_partkey", dates.days_between("a", "b").alias("dias"), dates.before("b", "a").alias("inconsistente"))
)
query(
    "exp_16_date_parts",
    """SELECT event_id, year(ts) AS ano, month(ts) AS mes, day(ts) AS dia, quarter(ts) AS trimestre, weekofyear(ts) AS semana, isodow(ts) AS dia_semana,
    strftime(ts, '%Y%m') AS periodo, CAST(strftime(ts, '%Y%m%d') AS BIGINT) AS chave, strftime(ts, '%m/%Y') AS mes_ano, strftime(ts, '%Y-%m') AS ano_mes,
    CAST(ts AS DATE) AS data FROM {events}""",
)(
    lambda s, d: table(s, d, "events").select(
        "event_id", F.year("ts").alias("ano"), F.month("ts").alias("mes"), F.dayofmonth("ts").alias("dia"), F.quarter("ts").alias("trimestre"),
        F.weekofyear("ts").alias("semana"), dates.iso_weekday("ts").alias("dia_semana"), dates.year_month("ts").alias("periodo"),
        dates.date_key("ts").alias("chave"), F.date_format("ts", "MM/yyyy").alias("mes_ano"), F.date_format("ts", "yyyy-MM").alias("ano_mes"),
        dates.day_of("ts").alias("data"),
    )
)
query(
    "exp_17_date_repair",
    """WITH t AS (SELECT o_orderkey, year(o_orderdate) + CASE WHEN o_orderkey % 9 = 0 THEN 50 ELSE 0 END AS ano, o_orderkey % 12 + 1 AS mes,
      CASE WHEN o_orderkey % 8 <> 0 THEN CAST(o_orderdate AS DATE) END AS data FROM {orders})
    SELECT o_orderkey, CASE WHEN year(data) IN (1997, 1998) THEN data ELSE TRY_CAST(lpad(CAST(ano AS VARCHAR), 4, '0') || '-' || lpad(CAST(coalesce(month(data), mes) AS VARCHAR), 2, '0')
      || '-' || lpad(CAST(coalesce(day(data), 1) AS VARCHAR), 2, '0') AS DATE) END AS data_referencia, coalesce(year(data) NOT IN (1997, 1998), TRUE) AS ajustada FROM t""",
)(
    lambda s, d: table(s, d, "orders")
    .select(
        "o_orderkey",
        (F.year("o_orderdate") + F.when(F.col("o_orderkey") % 9 == 0, 50).otherwise(0)).alias("ano"),
        (F.col("o_orderkey") % 12 + 1).alias("mes"),
        F.when(F.col("o_orderkey") % 8 != 0, dates.day_of("o_orderdate")).alias("data"),
    )
    .select(
        "o_orderkey", dates.repair_date("data", "ano", "mes", (1997, 1998)).alias("data_referencia"), dates.is_outside("data", (1997, 1998)).alias("ajustada")
    )
)

# ---------------------------------------------------------------- numbers, classes, keys

query(
    "exp_18_safe_percentage",
    f"""SELECT l_orderkey, l_linenumber, l_partkey, {pct("l_extendedprice", "(CASE WHEN l_linenumber = 3 THEN 0 ELSE l_quantity * 1000 END)")} AS p FROM {{lineitem}}""",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        numbers.percentage("l_extendedprice", F.when(F.col("l_linenumber") == 3, 0).otherwise(F.col("l_quantity") * 1000)).alias("p"),
    )
)
query(
    "exp_19_classification",
    """SELECT event_id, CASE WHEN value < 5 THEN 'ESTORNO' WHEN event_type IN ('click', 'view') THEN 'VISITA' ELSE upper(coalesce(nullif(event_type, 'error'), 'outro')) END AS classe FROM {events}""",
)(
    lambda s, d: table(s, d, "events").select(
        "event_id",
        F.when(F.col("value") < 5, "ESTORNO").when(F.col("event_type").isin("click", "view"), "VISITA")
        .otherwise(F.upper(keys.or_label(F.nullif("event_type", F.lit("error")), "outro"))).alias("classe"),
    )
)
query(
    "exp_20_composite_key",
    "SELECT DISTINCT coalesce(CASE WHEN l_suppkey % 7 <> 0 THEN CAST(l_suppkey AS VARCHAR) END, 'SEM_UG') || '|' || coalesce(CASE WHEN l_linenumber <> 4 THEN CAST(l_linenumber AS VARCHAR) END, 'SEM_CONTRATO') AS chave FROM {lineitem}",
)(
    lambda s, d: table(s, d, "lineitem")
    .select(F.when(F.col("l_suppkey") % 7 != 0, F.col("l_suppkey")).alias("ug"), F.when(F.col("l_linenumber") != 4, F.col("l_linenumber")).alias("n"))
    .select(keys.keyed(ug="SEM_UG", n="SEM_CONTRATO").alias("chave"))
    .distinct()
)
# Each customer twice; the two differ only in where a bar stands.
_BARS = """SELECT c_custkey, 1 AS n, CASE WHEN c_custkey % 3 <> 0 THEN c_name || '|x' END AS nome, c_mktsegment AS segmento FROM {customer}
    UNION ALL SELECT c_custkey, 2, CASE WHEN c_custkey % 3 <> 0 THEN c_name ELSE '' END, CASE WHEN c_custkey % 3 <> 0 THEN 'x|' ELSE '' END || c_mktsegment FROM {customer}"""
query("exp_21_content_hash", f"SELECT c_custkey, n, {sha('c_custkey', 'nome', 'segmento')} AS h FROM ({_BARS})", wide=("n",))(
    lambda s, d: (lambda df: df.select("c_custkey", "n", keys.content_hash(df, ["c_custkey", "nome", "ausente", "segmento"]).alias("h")))(staged(s, d, _BARS))
)
query(
    "exp_22_23_conditional_key",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 6 > 0 THEN CAST(l_orderkey AS VARCHAR) ELSE 'SEM_DOCUMENTO|' || CAST(l_partkey AS VARCHAR) END AS chave,
    CAST(year(l_shipdate) AS VARCHAR) || lpad(CAST(month(l_shipdate) AS VARCHAR), 2, '0') AS periodo FROM {lineitem}""",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.when(F.col("l_orderkey") % 6 > 0, keys.joined("l_orderkey")).otherwise(keys.joined(F.lit("SEM_DOCUMENTO"), "l_partkey")).alias("chave"),
        F.concat(F.year("l_shipdate").cast("string"), F.lpad(F.month("l_shipdate").cast("string"), 2, "0")).alias("periodo"),
    )
)
query(
    "exp_24_tolerance",
    """SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice - l_quantity * 1000 - l_tax, 2) AS diferenca,
    abs(round(l_extendedprice - l_quantity * 1000 - l_tax, 2)) <= 500.0 AS consistente FROM {lineitem}""",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem")
    .withColumn("diferenca", F.round(F.col("l_extendedprice") - F.col("l_quantity") * 1000 - F.col("l_tax"), 2))
    .select("l_orderkey", "l_linenumber", "l_partkey", "diferenca", numbers.within("diferenca", 500.0).alias("consistente"))
)
query(
    "exp_25_26_document_kind",
    """WITH t AS (SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), CASE c_custkey % 3 WHEN 0 THEN 14 WHEN 1 THEN 11 ELSE 6 END, '0') AS n FROM {customer})
    SELECT c_custkey, n AS digitos, CASE length(n) WHEN 14 THEN 'CNPJ' WHEN 11 THEN 'CPF' ELSE 'OUTRO' END AS tipo FROM t""",
)(
    lambda s, d: table(s, d, "customer")
    .withColumn("n", F.expr("lpad(CAST(c_custkey AS STRING), CASE c_custkey % 3 WHEN 0 THEN 14 WHEN 1 THEN 11 ELSE 6 END, '0')"))
    .withColumn("digitos", text.digits_only(F.concat(F.substring("n", 1, 2), F.lit("."), F.expr("substring(n, 3)"), F.lit("/-"))))
    .select("c_custkey", "digitos", text.document_kind("digitos").alias("tipo"))
)
query(
    "exp_29_30_backfill_and_default",
    "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END, 0.0) AS saldo, CAST(NULL AS VARCHAR) AS situacao, CAST(NULL AS DATE) AS data FROM {customer}",
)(
    lambda s, d: unions.backfill(
        table(s, d, "customer").select("c_custkey", F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("saldo")),
        {"saldo": "double", "situacao": "string", "data": "date"},
    ).withColumn("saldo", F.coalesce("saldo", F.lit(0.0)))
)
_EVENT_DOC = "struct<k:int>"
query(
    "exp_31_flatten",
    """SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS dados_propriedades_k, event_type AS dados_tipo_evento, '[' || CAST(user_id AS VARCHAR) || ',1]' AS dados_lista FROM {events}""",
)(
    lambda s, d: flatten(
        table(s, d, "events").select(
            "event_id",
            F.struct(
                F.from_json("props", _EVENT_DOC).alias("Propriedades"), F.col("event_type").alias("tipoEvento"), F.array("user_id", F.lit(1)).alias("lista")
            ).alias("dados"),
        )
    )
)
query(
    "exp_32_unnest",
    """SELECT o_orderkey AS codigo_pai, i AS numero_voto, o_orderstatus AS voto_sigla FROM {orders}, (SELECT unnest(generate_series(1, 3)) AS i) WHERE i <= o_orderkey % 4""",
)(
    lambda s, d: unnest(
        table(s, d, "orders").select(
            F.col("o_orderkey").alias("codigoPai"),
            F.expr("CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE transform(sequence(1, CAST(o_orderkey % 4 AS INT)), i -> named_struct('numeroVoto', i, 'votoSigla', o_orderstatus)) END").alias("votos"),
        ),
        "votos",
        {"codigo_pai": "codigoPai"},
    )
)
query(
    "exp_33_35_title_total_flags",
    """SELECT o_orderkey, coalesce(o_orderstatus, '') || ' ' || coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_custkey AS VARCHAR) END, '') || ' ' || CAST(year(o_orderdate) AS VARCHAR) AS titulo,
    coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END, 0) + coalesce(o_orderkey % 7, 0) AS total, o_orderkey % 5 <> 0 AS presente FROM {orders}""",
)(
    lambda s, d: table(s, d, "orders")
    .withColumn("n", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")))
    .select(
        "o_orderkey",
        text.title_of("o_orderstatus", "n", F.year("o_orderdate")).alias("titulo"),
        numbers.filled_sum("n", F.col("o_orderkey") % 7).alias("total"),
        F.col("n").isNotNull().alias("presente"),
    )
)

# ---------------------------------------------------------------- filters and projections

query("flt_01_year_membership", "SELECT o_orderkey, o_totalprice FROM {orders} WHERE year(o_orderdate) IN (1997, 1999)")(
    lambda s, d: table(s, d, "orders").where(F.year("o_orderdate").isin(1997, 1999)).select("o_orderkey", "o_totalprice")
)
query(
    "flt_02_valid_keys",
    "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE o_orderstatus END AS k FROM {orders} WHERE o_orderkey % 3 = 2",
)(
    lambda s, d: dimensions.valid_keys(
        staged(s, d, "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE o_orderstatus END AS k FROM {orders}"), "k"
    )
)
query(
    "flt_03_07_flags_and_ranges",
    """SELECT event_id FROM {events} WHERE NOT (CASE WHEN event_id % 3 = 0 THEN NULL ELSE value > 20 END) AND month(ts) BETWEEN 1 AND 12
    AND event_type NOT IN ('error', 'signup') AND length(event_type) = 5""",
)(
    lambda s, d: table(s, d, "events")
    .withColumn("f", F.when(F.col("event_id") % 3 != 0, F.col("value") > 20))
    .where(~F.col("f") & F.month("ts").between(1, 12) & ~F.col("event_type").isin("error", "signup") & (F.length("event_type") == 5))
    .select("event_id")
)
query(
    "flt_08_period_range",
    "SELECT strftime(o_orderdate, '%Y%m') AS periodo_origem, count(*) AS n FROM {orders} WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199703' AND '199908' GROUP BY 1",
)(
    lambda s, d: table(s, d, "orders")
    .select(dates.year_month("o_orderdate").alias("periodo_origem"))
    .where(F.col("periodo_origem").between("199703", "199908"))
    .groupBy("periodo_origem")
    .agg(F.count(F.lit(1)).alias("n"))
)
query("prj_01_02_project_rename", "SELECT s_name AS nome, s_suppkey AS codigo FROM {supplier}")(
    lambda s, d: table(s, d, "supplier").withColumnsRenamed({"s_name": "nome", "s_suppkey": "codigo"}).drop("s_acctbal").select("nome", "codigo")
)
