"""Joins, aggregates, windows, sorts, set operations on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.operators import checks, dedup, gates, quantiles, ranking, reconcile, unions
from plumbline.runtime import materialize
from plumbline.workload.base import bigint, cnt, mean, npres, nuni, pct, query, rank, staged, table, tot

# lineitem with nulls put in
L = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus, l_shipdate,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_suppkey END AS fornecedor, CASE WHEN l_suppkey % 10 = 3 THEN NULL ELSE l_extendedprice END AS valor,
  CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_returnflag = 'R' END AS marca FROM {lineitem}"""
O = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice, o_orderdate, CASE WHEN o_custkey % 12 = 0 THEN NULL ELSE o_custkey END AS cliente FROM {orders}"


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, L)


def orders(spark: SparkSession, sf: str) -> DataFrame:
    return staged(spark, sf, O)


# ---------------------------------------------------------------- joins

query(
    "jon_01_rows_of_latest_period",
    f"SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_shipdate FROM ({L}) QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_suppkey)",
    wide=("l_linenumber",),
)(
    lambda s, d: dedup.latest_snapshot(
        lines(s, d).select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"), "l_suppkey", "l_shipdate", "ultimo"
    ).drop("ultimo")
)
query(
    "jon_03_aggregate_left_join_zero_fill",
    f"""SELECT o_orderkey, coalesce(n, 0) AS itens, coalesce(v, 0.0) AS valor FROM {{orders}} LEFT JOIN
    (SELECT l_orderkey, count(*) AS n, {tot("valor")} AS v FROM ({L}) WHERE l_linestatus = 'F' GROUP BY 1) ON o_orderkey = l_orderkey""",
)(
    lambda s, d: table(s, d, "orders")
    .select("o_orderkey")
    .join(
        ranking.summarize(lines(s, d).where("l_linestatus = 'F'"), ["l_orderkey"], {"n": agg.rows(), "v": agg.total("valor")}),
        F.col("o_orderkey") == F.col("l_orderkey"),
        "left",
    )
    .select("o_orderkey", F.coalesce("n", F.lit(0)).alias("itens"), F.coalesce("v", F.lit(0.0)).alias("valor"))
)
query(
    "jon_04_composite_key_left_join",
    f"""WITH a AS (SELECT cliente, o_orderstatus, count(*) AS n FROM ({O}) GROUP BY 1, 2),
    b AS (SELECT cliente, o_orderstatus, max(o_totalprice) AS m FROM ({O}) WHERE o_totalprice > 250000 GROUP BY 1, 2)
    SELECT cliente, o_orderstatus, n, m FROM a LEFT JOIN b USING (cliente, o_orderstatus)""",
)(
    lambda s, d: ranking.summarize(orders(s, d), ["cliente", "o_orderstatus"], {"n": agg.rows()}).join(
        ranking.summarize(orders(s, d).where("o_totalprice > 250000"), ["cliente", "o_orderstatus"], {"m": F.max("o_totalprice")}),
        ["cliente", "o_orderstatus"],
        "left",
    )
)
query(
    "jon_05_colliding_names",
    """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey AS codigo, o.o_custkey AS codigo_pedido FROM {lineitem} l LEFT JOIN {orders} o ON l.l_orderkey = o.o_orderkey""",
    wide=("l_linenumber",),
)(
    lambda s, d: table(s, d, "lineitem")
    .select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("codigo"))
    .join(table(s, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("codigo_pedido")), "l_orderkey", "left")
)
query(
    "jon_07_full_outer_totals",
    f"""WITH a AS (SELECT year(o_orderdate) AS ano, {tot("o_totalprice")} AS v FROM {{orders}} WHERE year(o_orderdate) < 2000 GROUP BY 1),
    b AS (SELECT year(o_orderdate) AS ano, {tot("o_totalprice")} AS v FROM {{orders}} WHERE year(o_orderdate) > 1996 GROUP BY 1),
    j AS (SELECT coalesce(a.ano, b.ano) AS ano, coalesce(a.v, 0.0) AS x, coalesce(b.v, 0.0) AS y FROM a FULL JOIN b ON a.ano = b.ano)
    SELECT ano, 'o_totalprice' AS metrica, 'pedidos' AS dataset, x AS valor_silver, y AS valor_gold, round(y - x, 2) AS diferenca, abs(round(y - x, 2)) <= 0.01 AS reconciliado FROM j""",
)(
    lambda s, d: (
        lambda f: reconcile.by_group(f.where("ano < 2000"), f.where("ano > 1996"), "ano", ["o_totalprice"], "pedidos")
    )(orders(s, d).withColumn("ano", F.year("o_orderdate").cast("bigint")))
)
query(
    "jon_08_anti_join",
    "SELECT DISTINCT l_suppkey * 3 AS chave FROM {lineitem} WHERE l_suppkey * 3 NOT IN (SELECT s_suppkey FROM {supplier})",
)(
    lambda s, d: checks.missing_keys(
        table(s, d, "lineitem").withColumn("k", F.col("l_suppkey") * 3), table(s, d, "supplier"), "k", "s_suppkey"
    ).withColumnRenamed("_key", "chave")
)

# ---------------------------------------------------------------- aggregates

query(
    "agg_01_07_null_faithful",
    f"""SELECT l_returnflag, l_linestatus, {tot("valor")} AS soma, count(*) AS linhas, {nuni("fornecedor")} AS distintos, {npres("fornecedor")} AS presentes,
    {npres("fornecedor", "marca")} AS presentes_marcados, {tot("valor", "marca")} AS soma_marcada, {cnt("marca")} AS marcados,
    {tot("valor", "l_suppkey % 10 = 3")} AS soma_de_nulos FROM ({L}) GROUP BY 1, 2""",
)(
    lambda s, d: ranking.summarize(
        lines(s, d),
        ["l_returnflag", "l_linestatus"],
        {
            "soma": agg.total("valor"),
            "linhas": agg.rows(),
            "distintos": agg.n_unique("fornecedor"),
            "presentes": agg.n_present("fornecedor"),
            "presentes_marcados": agg.n_present("fornecedor", F.col("marca")),
            "soma_marcada": agg.total("valor", F.col("marca")),
            "marcados": agg.count_where("marca"),
            "soma_de_nulos": agg.total("valor", F.col("l_suppkey") % 10 == 3),
        },
    )
)
query(
    "agg_08_10_mean_median_extremes",
    f"""SELECT l_suppkey, {mean("valor")} AS media, median(l_quantity) AS mediana, min(valor) AS menor, max(valor) AS maior, min(l_shipdate) AS primeiro,
    max(l_shipdate) AS ultimo FROM ({L}) GROUP BY 1""",
)(
    lambda s, d: quantiles.with_median(
        ranking.summarize(
            lines(s, d),
            ["l_suppkey"],
            {
                "media": agg.mean("valor"),
                "menor": F.min("valor"),
                "maior": F.max("valor"),
                "primeiro": F.min("l_shipdate"),
                "ultimo": F.max("l_shipdate"),
            },
        ),
        lines(s, d), ["l_suppkey"], "l_quantity", "mediana",
    )
)
query(
    "agg_09_exact_median",
    """SELECT 'tudo' AS grupo, median(l_extendedprice) AS mediana FROM {lineitem}
    UNION ALL SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'terço' WHEN l_orderkey % 97 = 1 THEN NULL ELSE l_returnflag END, median(CASE WHEN l_linenumber < 7 THEN l_extendedprice END)
    FROM {lineitem} GROUP BY 1""",
)(lambda s, d: _medians(s, d))


def _medians(spark: SparkSession, sf: str) -> DataFrame:
    """The median of one group of all rows, and of groups one of which has a third of them."""
    rows = table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, "terço").when(F.col("l_orderkey") % 97 != 1, F.col("l_returnflag")).alias("grupo"),
        "l_extendedprice", F.when(F.col("l_linenumber") < 7, F.col("l_extendedprice")).alias("parte"),
    )
    whole = quantiles.exact_median(rows.withColumn("grupo", F.lit("tudo")), ["grupo"], "l_extendedprice", "mediana")
    return whole.unionByName(quantiles.with_median(rows.select("grupo").distinct(), rows, ["grupo"], "parte", "mediana"))


_POS = "l_partkey * 1000000 + l_suppkey * 100 + l_linenumber"
query(
    "agg_11_13_first_and_any",
    f"""SELECT l_orderkey, arg_min_null(valor, {_POS}) AS primeiro, arg_min(valor, CASE WHEN valor IS NOT NULL THEN {_POS} END) AS primeiro_presente,
    coalesce(bool_or(marca), FALSE) AS algum FROM (SELECT DISTINCT * FROM ({L})) WHERE l_orderkey % 3 >= 0 GROUP BY 1
    HAVING count(*) = count(DISTINCT {_POS})""",
)(
    lambda s, d: ranking.summarize(
        lines(s, d).distinct().withColumn("_pos", F.col("l_partkey") * 1000000 + F.col("l_suppkey") * 100 + F.col("l_linenumber")),
        ["l_orderkey"],
        {
            "primeiro": agg.first_by("valor", F.col("_pos")),
            "primeiro_presente": agg.first_present_by("valor", F.col("_pos")),
            "algum": agg.any_true("marca"),
            "_n": agg.rows(),
            "_u": F.count_distinct("_pos"),
        },
    )
    .where("_n = _u")
    .drop("_n", "_u")
)
query(
    "agg_14_mode",
    f"""SELECT l_suppkey, l_returnflag AS moda FROM (SELECT l_suppkey, l_returnflag, count(*) AS n FROM ({L}) GROUP BY 1, 2)
    QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_returnflag) = 1""",
)(lambda s, d: dedup.most_frequent(lines(s, d), ["l_suppkey"], "l_returnflag").withColumnRenamed("l_returnflag", "moda"))
query(
    "agg_15_global_totals",
    f"SELECT {tot('valor')} AS soma, count(*) - count(valor) AS nulos, {nuni('fornecedor')} AS fornecedores FROM ({L})",
)(lambda s, d: lines(s, d).agg(agg.total("valor").alias("soma"), agg.null_count("valor").alias("nulos"), agg.n_unique("fornecedor").alias("fornecedores")))
query(
    "agg_16_exact_duplicates",
    "SELECT l_suppkey, l_linenumber, l_returnflag, l_linestatus, l_tax, count(*) AS quantidade FROM {lineitem} GROUP BY 1, 2, 3, 4, 5 HAVING count(*) > 1",
    wide=("l_linenumber",),
)(
    lambda s, d: (lambda f: checks.duplicate_groups(f, f.columns))(
        table(s, d, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_tax")
    )
)
query(
    "agg_17_having",
    "SELECT l_orderkey, l_linenumber, count(*) AS quantidade FROM {lineitem} GROUP BY 1, 2 HAVING count(*) > 1",
    wide=("l_linenumber",),
)(lambda s, d: checks.duplicate_groups(table(s, d, "lineitem"), ["l_orderkey", "l_linenumber"]))
query(
    "agg_18_collapse_to_grain",
    f"SELECT l_suppkey, l_returnflag, l_linestatus, l_linenumber, CAST(date_trunc('month', l_shipdate) AS DATE) AS mes, {tot('valor')} AS valor FROM ({L}) GROUP BY ALL",
    wide=("l_linenumber",),
)(
    lambda s, d: ranking.summarize(
        lines(s, d).withColumn("mes", F.trunc("l_shipdate", "month")),
        ["l_suppkey", "l_returnflag", "l_linestatus", "l_linenumber", "mes"],
        {"valor": agg.total("valor")},
    )
)

# ---------------------------------------------------------------- windows

_BY_CUSTOMER = f"SELECT o_custkey, {tot('o_totalprice')} AS total, count(*) AS pedidos FROM {{orders}} GROUP BY 1"


def by_customer(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.summarize(table(spark, sf, "orders"), ["o_custkey"], {"total": agg.total("o_totalprice"), "pedidos": agg.rows()})


query("win_01_global_dense_rank", f"SELECT *, {rank('total')} AS posicao, {rank('pedidos')} AS posicao_pedidos FROM ({_BY_CUSTOMER})")(
    lambda s, d: ranking.add_ranks(by_customer(s, d), {"posicao": "total", "posicao_pedidos": "pedidos"})
)
_PRICED = "SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_totalprice END AS valor, o_custkey % 300 AS nota, CASE WHEN o_custkey % 9 = 0 THEN NULL ELSE o_orderstatus END AS grupo FROM {orders}"
query(
    "hrd_1_ranged_global_rank",
    f"SELECT *, {rank('valor')} AS posicao, {rank('nota')} AS posicao_nota FROM ({_PRICED})",
)(lambda s, d: ranking.add_ranks(staged(s, d, _PRICED), {"posicao": "valor", "posicao_nota": "nota"}))
query(
    "hrd_1_ranged_partitioned_rank",
    f"SELECT *, {rank('valor', 'grupo')} AS posicao, {rank('nota', 'grupo')} AS posicao_nota FROM ({_PRICED})",
)(lambda s, d: ranking.add_ranks(staged(s, d, _PRICED), {"posicao": "valor", "posicao_nota": "nota"}, ["grupo"]))
query(
    "hrd_1_ranged_surrogate",
    "SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS id, p_name, p_partkey FROM {part}",
)(
    lambda s, d: ranking.number_rows(table(s, d, "part").select("p_name", "p_partkey"), "id", ["p_name", "p_partkey"])
)
query(
    "win_02_partitioned_dense_rank",
    f"SELECT *, {rank('total', 'n')} AS posicao FROM (SELECT o_custkey % 7 AS n, o_custkey, {tot('o_totalprice')} AS total FROM {{orders}} GROUP BY ALL)",
)(
    lambda s, d: ranking.ranked_summary(
        table(s, d, "orders").withColumn("n", F.col("o_custkey") % 7), ["n", "o_custkey"], {"total": agg.total("o_totalprice")}, {"posicao": "total"}, by=["n"]
    )
)
query(
    "win_03_share_of_group",
    f"""SELECT *, {pct("valor", "soma")} AS parte FROM (SELECT *, CAST(sum(CAST(valor AS DECIMAL(28,8))) OVER (PARTITION BY n) AS DOUBLE) AS soma
    FROM (SELECT l_suppkey % 9 AS n, l_suppkey, {tot("valor")} AS valor FROM ({L}) GROUP BY ALL))""",
)(
    lambda s, d: ranking.add_share(
        materialize(ranking.summarize(lines(s, d).withColumn("n", F.col("l_suppkey") % 9), ["n", "l_suppkey"], {"valor": agg.total("valor")})),
        "valor",
        ["n"],
        "soma",
        "parte",
    )
)
query("win_04_surrogate_number", "SELECT row_number() OVER (ORDER BY c_name) AS id, c_name FROM (SELECT DISTINCT c_name FROM {customer})")(
    lambda s, d: ranking.number_rows(table(s, d, "customer").select("c_name").distinct(), "id", ["c_name"])
)

# ---------------------------------------------------------------- sorting, set operations, duplicates

query(
    "srt_01_mixed_directions",
    f"""SELECT situacao, o_orderkey, valor, row_number() OVER (ORDER BY situacao ASC NULLS FIRST, valor DESC NULLS FIRST, o_orderkey) AS posicao
    FROM (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderstatus END AS situacao, o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN o_totalprice END AS valor FROM {{orders}})""",
)(
    lambda s, d: ranking.positions(
        table(s, d, "orders").select(
            F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderstatus")).alias("situacao"), "o_orderkey", F.when(F.col("o_orderkey") % 11 != 0, F.col("o_totalprice")).alias("valor")
        ),
        "posicao",
        [F.col("situacao").asc_nulls_first(), F.col("valor").desc_nulls_first(), F.col("o_orderkey")],
    )
)
query(
    "srt_02_nulls_last",
    f"SELECT *, row_number() OVER (ORDER BY cliente DESC NULLS LAST) AS posicao FROM (SELECT cliente, max(o_totalprice) AS maior FROM ({O}) GROUP BY 1)",
)(
    lambda s, d: ranking.positions(
        ranking.summarize(orders(s, d), ["cliente"], {"maior": F.max("o_totalprice")}), "posicao", [F.col("cliente").desc_nulls_last()]
    )
)
query("srt_03_schema_frame", "SELECT o_orderkey, o_totalprice FROM {orders} LIMIT 0")(
    lambda s, d: table(s, d, "orders").select("o_orderkey", "o_totalprice").limit(0)
)
query("set_01_union_strict", "SELECT s_nationkey AS n FROM {supplier} UNION ALL SELECT c_nationkey FROM {customer}", wide=("n",))(
    lambda s, d: unions.union_strict(
        [table(s, d, "supplier").select(F.col("s_nationkey").alias("n")), table(s, d, "customer").select(F.col("c_nationkey").alias("n"))]
    )
)
query(
    "set_02_union_relaxed",
    """SELECT CAST(s_nationkey AS VARCHAR) AS k, CAST(s_suppkey AS DOUBLE) AS v, s_acctbal AS m, CAST(DATE '2024-01-31' AS TIMESTAMP) AS t FROM {supplier}
    UNION ALL SELECT c_name, c_acctbal, round(c_acctbal, 1), TIMESTAMP '2024-02-29 12:30:00' FROM {customer}""",
)(
    lambda s, d: unions.union_relaxed(
        [
            table(s, d, "supplier").select(
                F.col("s_nationkey").alias("k"), F.col("s_suppkey").alias("v"), F.col("s_acctbal").cast("decimal(18,2)").alias("m"), F.lit("2024-01-31").cast("date").alias("t")
            ),
            table(s, d, "customer").select(
                F.col("c_name").alias("k"), F.col("c_acctbal").alias("v"), F.round("c_acctbal", 1).alias("m"), F.lit("2024-02-29 12:30:00").cast("timestamp_ntz").alias("t")
            ),
        ]
    )
)
query(
    "set_03_union_diagonal",
    """SELECT CAST(s_suppkey AS DOUBLE) AS k, s_name AS nome, CAST(NULL AS VARCHAR) AS segmento FROM {supplier}
    UNION ALL SELECT CAST(c_custkey AS DOUBLE), NULL, c_mktsegment FROM {customer}""",
)(
    lambda s, d: unions.union_relaxed(
        [
            table(s, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("nome")),
            table(s, d, "customer").select(F.col("c_custkey").cast("decimal(20,2)").alias("k"), F.col("c_mktsegment").alias("segmento")),
        ],
        allow_missing=True,
    )
)
query("set_04_distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM {lineitem}", wide=("l_linenumber",))(
    lambda s, d: table(s, d, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()
)
query(
    "set_05_split_and_reunite",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, l_shipdate AS ultimo FROM {lineitem} WHERE l_linenumber = 1
    UNION ALL SELECT l_orderkey, l_partkey, l_suppkey, l_shipdate, m FROM (SELECT *, max(l_shipdate) OVER (PARTITION BY l_partkey) AS m FROM {lineitem} WHERE l_linenumber <> 1) WHERE l_shipdate = m""",
)(
    lambda s, d: dedup.latest_snapshot(table(s, d, "lineitem"), "l_partkey", "l_shipdate", "ultimo", where=F.col("l_linenumber") != 1).select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "ultimo"
    )
)
query(
    "ddp_02_keep_last_line",
    """SELECT l_suppkey, l_linenumber, l_returnflag, l_orderkey, l_partkey, l_extendedprice FROM {lineitem}
    QUALIFY row_number() OVER (PARTITION BY l_suppkey, l_linenumber, l_returnflag ORDER BY l_orderkey DESC, l_partkey DESC, l_extendedprice DESC) = 1""",
    wide=("l_linenumber",),
)(
    lambda s, d: dedup.keep_first(
        table(s, d, "lineitem").select("l_suppkey", "l_linenumber", "l_returnflag", "l_orderkey", "l_partkey", "l_extendedprice"),
        ["l_suppkey", "l_linenumber", "l_returnflag"],
        [F.col("l_orderkey").desc(), F.col("l_partkey").desc(), F.col("l_extendedprice").desc()],
        total_order=True,
    )
)
query(
    "ddp_03_keep_first_row",
    """SELECT o_custkey, o_orderkey, o_orderpriority FROM {orders} QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
)(
    lambda s, d: dedup.keep_first(
        table(s, d, "orders").select("o_custkey", "o_orderkey", "o_orderpriority"), ["o_custkey"], [F.col("o_orderkey")], total_order=True
    )
)

# ---------------------------------------------------------------- checks and gates

query(
    "dq_17_missing_column_fails",
    """SELECT 'unique_key' AS "check", 'pedidos' AS dataset, 'ausente' AS "key", count(*) AS rows, 'error' AS severity, FALSE AS approved,
    'Sem a coluna-chave ausente' AS message FROM {orders}""",
)(lambda s, d: checks.unique_key(table(s, d, "orders"), "pedidos", "ausente"))
query(
    "dq_17_void_column_fails",
    """SELECT 'typed_column' AS "check", 'pedidos' AS dataset, c AS "column", CASE WHEN c = 'vazio' THEN 'error' ELSE 'info' END AS severity, c <> 'vazio' AS approved,
    CASE WHEN c = 'vazio' THEN 'Sem tipo: vazio' END AS message FROM (SELECT unnest(['o_orderkey', 'o_totalprice', 'vazio']) AS c FROM (SELECT count(*) FROM {orders}))""",
)(lambda s, d: checks.typed_columns(table(s, d, "orders").select("o_orderkey", "o_totalprice", F.lit(None).alias("vazio")), "pedidos"))
query(
    "rec_01_equal_within_tolerance",
    f"""WITH t AS (SELECT {tot("o_totalprice")} AS v, count(*) AS n FROM {{orders}})
    SELECT 'igual' AS "check", v AS silver_value, v AS gold_value, 0.0::DOUBLE AS difference, 0.05::DOUBLE AS tolerance, TRUE AS approved, 'info' AS severity FROM t
    UNION ALL SELECT 'no_limite', n, n + 0.05, 0.05, 0.05, TRUE, 'info' FROM t
    UNION ALL SELECT 'fora', n, n + 0.06, 0.06, 0.05, FALSE, 'error' FROM t
    UNION ALL SELECT 'ausente', n, 0.0, -n, 0.0, FALSE, 'error' FROM t""",
)(
    lambda s, d: reconcile.compare(
        [
            reconcile.side(
                table(s, d, "orders"), {"igual": agg.total("o_totalprice"), "no_limite": agg.rows(), "fora": agg.rows(), "ausente": agg.rows()}, "silver"
            ),
            reconcile.side(
                table(s, d, "orders"), {"igual": agg.total("o_totalprice"), "no_limite": agg.rows() + F.lit(0.05).cast("double"), "fora": agg.rows() + F.lit(0.06).cast("double")}, "gold"
            ),
        ],
        {"igual": 0.05, "no_limite": 0.05, "fora": 0.05},
    )
)
query(
    "pip_04_approval_verdict",
    f"""WITH s AS (SELECT * FROM {{orders}}) SELECT 3::BIGINT AS check_count, {bigint("(count(*) > 0)::INT")} AS failed_count, 1::BIGINT AS warning_count, count(*) = 0 AS approved FROM s""",
)(
    lambda s, d: gates.approval(
        checks.rule_checks(
            table(s, d, "orders"),
            "pedidos",
            [
                {"check": "vazio", "value": agg.count_where(F.col("o_totalprice") < 0), "blocking": True},
                {"check": "grandes", "value": agg.count_where(F.col("o_totalprice") > 1000), "blocking": True},
                {"check": "aviso", "value": agg.count_where(F.col("o_totalprice") > 1000)},
            ],
        )
    )
)
query(
    "snk_07_quarantine",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 45 THEN 'quantidade_alta' ELSE '' END || '|' || CASE WHEN l_partkey % 9 = 0 THEN 'sem_item' ELSE '' END AS motivos
    FROM {lineitem} WHERE l_quantity > 45 OR l_partkey % 9 = 0""",
    wide=("l_linenumber",),
)(
    lambda s, d: gates.quarantine(
        table(s, d, "lineitem").withColumn("item", F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey"))),
        {"quantidade_alta": F.col("l_quantity") > 45, "sem_item": F.col("item").isNull()},
    )[1].select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(
            F.when(F.array_contains("motivos_rejeicao", "quantidade_alta"), "quantidade_alta").otherwise(""), F.lit("|"),
            F.when(F.array_contains("motivos_rejeicao", "sem_item"), "sem_item").otherwise(""),
        ).alias("motivos"),
    )
)

