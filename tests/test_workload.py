"""A sample of the registered queries against DuckDB, and invariants over the marts.

``PLUMBLINE_ALL=1`` runs every query that has an oracle.
"""

import math
import os

import duckdb
import pytest

from plumbline.workload import catalog
from plumbline.workload.base import TABLES

SAMPLE = [
    "slv_02_itens_contrato", "slv_09_despesas", "slv_13_favorecidos_historico", "slv_18_votos", "ddp_01_latest_period_wins",
    "gld_ct_02_contratos_atuais_resumo", "gld_ct_07_relacionamento_orgao_contratado", "gld_lc_01_concorrencia_licitacoes",
    "gld_lc_06_relacionamento_orgao_fornecedor", "gld_em_01_ranking_parlamentares", "gld_cv_01_fato_convenios",
    "gld_gd_03_ranking_partidos", "gld_pv_11_ranking_deputados_votos", "gld_sn_04_fato_gastos_senadores", "dim_sn_01_senador",
    "dim_em_06_municipio", "dq_09_orphan_profile", "rec_05_amendments_by_year", "msr_06_measures_by_party", "hrd_1_ranged_global_rank",
]
NAMES = sorted(catalog.ORACLES) if os.environ.get("PLUMBLINE_ALL") else SAMPLE


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def shown(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return repr(value + 0.0) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, sf, name):
    df = catalog.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted((tuple(shown(r[c]) for c in columns) for r in df.collect()), key=str)
    result = duck.execute(catalog.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted((tuple(shown(r[i]) for i in places) for r in result.fetchall()), key=str)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_same_result_with_other_partitioning(spark, sf):
    name = "gld_gd_05_ranking_fornecedores"
    a = sorted(map(tuple, catalog.QUERIES[name](spark, sf).collect()), key=str)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        b = sorted(map(tuple, catalog.QUERIES[name](spark, sf).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert a == b


def test_ranking_total_is_fact_total_and_ranks_are_dense(spark, sf):
    mart = catalog.QUERIES["gld_lc_03_ranking_fornecedores"](spark, sf).toPandas()
    ranks = sorted(set(mart["posicao_valor_itens_vencidos"]))
    assert ranks == list(range(1, len(ranks) + 1))


def test_scans_prune_columns_and_push_filters(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    plan = orders.where("o_totalprice > 400000").select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,400000.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_latest_row_is_limited_before_the_shuffle(spark, sf):
    plan = catalog.QUERIES["ddp_01_latest_period_wins"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_no_python_in_the_plans(spark, sf):
    for name in SAMPLE:
        if name.startswith(("slv", "ddp", "gld_cv", "gld_lc_01")):
            plan = catalog.QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
            assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
