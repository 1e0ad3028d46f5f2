"""What queries store between their steps: compressed columns, only where they are read again, only those that are read."""

import os

import pytest
from pyspark.sql import functions as F

from plumbline.operators import ranking, reconcile
from plumbline.plans import amendments as amendments_plan
from plumbline.runtime import ensure_checkpoint_dir, materialize
from plumbline.workload import amendments, catalog, contracts, tenders


def stored_bytes(spark):
    ensure_checkpoint_dir(spark)
    top = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names)


@pytest.fixture
def kept(monkeypatch):
    """The columns of every frame that a query of these modules stores."""
    found = []

    def spy(df):
        found.append(df.columns)
        return materialize(df)

    for module in (contracts, tenders, amendments):
        if hasattr(module, "materialize"):
            monkeypatch.setattr(module, "materialize", spy)
    return found


def test_stored_rows_are_compressed_columns(spark):
    df = spark.range(50_000, numPartitions=2).select("id", *[F.lit(f"UNIDADE GESTORA NUMERO {i}").alias(f"t{i}") for i in range(8)])
    before = stored_bytes(spark)
    found = materialize(df)
    assert stored_bytes(spark) - before < 1_000_000  # 10 MB of text
    plan = found.select("t3")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c4:string>" in plan
    assert found.columns == df.columns and found.count() == 50_000


def test_stored_rows_keep_names_types_and_nulls(spark):
    odd = spark.sql("SELECT 1 AS `a b;{}`, 2L AS x, 3 AS x, DATE'0101-01-01' AS d, TIMESTAMP_NTZ'1500-01-01 00:00:01.000001' AS t, CAST(NULL AS DECIMAL(28,8)) AS n, array(named_struct('k', 1)) AS s")
    found = materialize(odd)
    assert [(f.name, f.dataType.simpleString()) for f in found.schema] == [(f.name, f.dataType.simpleString()) for f in odd.schema]
    assert found.collect() == odd.collect()
    untyped = spark.sql("SELECT 1 AS a, NULL AS v")
    assert materialize(untyped).collect() == untyped.collect()


def test_several_ranks_do_not_depend_on_how_stored_rows_are_read(spark):
    df = spark.range(3_000, numPartitions=7).select("id", (F.col("id") % 50).alias("u"), (F.col("id") % 31).alias("v"))
    ranked = ranking.add_ranks(df, {"pu": "u", "pv": "v"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    try:
        assert ranked.where((F.col("pu") != 50 - F.col("u")) | (F.col("pv") != 31 - F.col("v"))).count() == 0
        assert ranked.count() == 3_000 and ranked.columns == ["id", "u", "v", "pu", "pv"]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_both_sides_of_a_table_come_from_one_aggregation(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    found = reconcile.sides(df, {"gold": {"keys": F.count_distinct("k")}, "silver": {"keys": F.count(F.lit(1))}})
    assert sorted(map(tuple, found.collect())) == [("keys", "gold", 2.0), ("keys", "silver", 3.0)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


@pytest.mark.parametrize("name", ["dq_14_contracts_suite", "dq_14_tenders_suite"])
def test_suites_store_nothing(spark, sf, kept, name):
    assert catalog.QUERIES[name](spark, sf).count() > 0
    assert kept == []


def test_contract_reconciliation_stores_what_it_reads(spark, sf, kept):
    catalog.QUERIES["rec_02_contracts"](spark, sf)
    assert len(kept) == 3
    assert not any(c.startswith("hash_") or c == "arquivo_origem" for columns in kept for c in columns)


def test_tender_reconciliation_stores_what_it_reads(spark, sf, kept):
    catalog.QUERIES["rec_03_tenders"](spark, sf)
    assert sorted(len(columns) for columns in kept) == [9, 12]


@pytest.mark.parametrize("name", ["dim_em_02_autor", "dim_em_03_favorecido"])
def test_dimensions_of_keys_rank_nothing(spark, sf, monkeypatch, name):
    def unasked(*_, **__):
        raise AssertionError("ranks aren't asked for")

    monkeypatch.setattr(amendments_plan.ranking, "_ranks", unasked)
    assert catalog.QUERIES[name](spark, sf).count() > 0


def test_contract_reconciliation_stores_no_keys_of_items_terms_and_records(spark, sf, kept):
    """A hash is most of such a key, and its text doesn't compress; keys are made when they are read."""
    catalog.QUERIES["rec_02_contracts"](spark, sf)
    assert len(kept) == 3
    assert not any(c in ("chave_registro_contrato", "chave_item_contrato", "chave_termo_aditivo") for columns in kept for c in columns)
