"""Operators: deduplication, ranks, dimensions, checks, gates, measures."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from plumbline.operators import checks, dedup, dimensions, gates, measures, quantiles, ranking, reconcile, relationships, unions
from plumbline.operators.relationships import Relationship, propagate, validate
from tests.conftest import rows


def test_latest_period_wins(spark):
    df = spark.createDataFrame([("a", "202501", 1), ("a", "202503", 2), ("b", "202502", 3)], "k string, periodo_origem string, v int")
    kept = dedup.keep_latest(df, ["k"])
    assert rows(kept) == [("a", "202503", 2), ("b", "202502", 3)]
    assert rows(dedup.keep_latest(kept, ["k"])) == rows(kept)


def test_snapshot_keeps_ties(spark):
    df = spark.createDataFrame([("g", "202503", 1), ("g", "202503", 2), ("g", "202501", 3)], "g string, p string, v int")
    assert rows(dedup.latest_snapshot(df, "g", "p", "ultimo").select("v")) == [(1,), (2,)]


def test_canonical_name(spark):
    df = spark.createDataFrame([(1, "ANNA"), (1, "ANA"), (1, "ANA"), (2, "C"), (2, "B")], "k int, nome string")
    assert rows(dedup.canonical(df, "k", ["nome"], "nome")) == [(1, "ANA"), (2, "B")]


def test_priority_merge(spark):
    a = spark.createDataFrame([(1, "atual")], "k int, v string")
    b = spark.createDataFrame([(1, "voto"), (2, "voto")], "k int, v string")
    assert rows(dedup.merge_by_priority([a, b], "k")) == [(1, "atual"), (2, "voto")]


def ranks(spark):
    df = spark.createDataFrame([("x", 3.0), ("x", 1.0), ("y", 1.0), ("y", None), (None, 2.0), (None, 3.0)], "g string, v double")
    return rows(ranking.add_ranks(df, {"r": "v"})), rows(ranking.add_ranks(df, {"r": "v"}, ["g"]))


EXPECTED = (
    sorted([("x", 3.0, 1), ("x", 1.0, 3), ("y", 1.0, 3), ("y", None, None), (None, 2.0, 2), (None, 3.0, 1)], key=str),
    sorted([("x", 3.0, 1), ("x", 1.0, 2), ("y", 1.0, 1), ("y", None, None), (None, 2.0, 2), (None, 3.0, 1)], key=str),
)


def test_dense_rank(spark):
    assert ranks(spark) == EXPECTED
    assert dict(ranking.add_ranks(spark.range(3), {"r": "id"}).dtypes)["r"] == "bigint"


def test_ranged_rank_equals_window_with_one_hot_value(spark):
    """A third of the rows share one value, and one group holds a third of the rows."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 7).alias("g"),
        F.when(F.col("id") % 3 == 1, F.lit(5.0)).otherwise((F.col("id") * 37 % 1999).cast("double")).alias("v"),
        "id",
    )
    window = Window.partitionBy("g")
    want = df.withColumns({n: F.dense_rank().over(window.orderBy(F.desc(c))).cast("bigint") for n, c in (("r", "v"), ("q", "id"))})
    assert rows(ranking.add_ranks(df, {"r": "v", "q": "id"}, ["g"])) == rows(want)


def test_ranks_of_several_types_come_from_one_numbering(spark):
    df = spark.range(500).select(
        (F.col("id") % 4).cast("string").alias("g"), (F.col("id") * 7 % 50).alias("whole"), F.when(F.col("id") % 9 > 0, F.col("id") * 3.5 % 77).alias("real"),
        (F.col("id") % 13).cast("decimal(20,3)").alias("exact"), F.lit(None).cast("double").alias("none"),
    )
    window = Window.partitionBy("g")
    names = {"a": "whole", "b": "real", "c": "exact", "d": "none"}
    want = df.withColumns({n: F.when(F.col(c).isNotNull(), F.dense_rank().over(window.orderBy(F.desc_nulls_last(c))).cast("bigint")) for n, c in names.items()})
    got = ranking.add_ranks(df, names, ["g"])
    assert got.columns == want.columns and rows(got) == rows(want)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan


@pytest.mark.parametrize("slices", [1, 3, 50])
def test_exact_median(spark, slices):
    df = spark.range(3001).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 > 3, F.concat(F.lit("g"), F.col("id") % 5)).alias("g"),
        F.when(F.col("id") % 7 > 0, F.when(F.col("id") % 2 == 0, 5.0).otherwise((F.col("id") * 37 % 1009).cast("double"))).alias("v"),
        (F.col("id") % 2).alias("h"),
    ).unionByName(spark.createDataFrame([("empty", None, 0)], "g string, v double, h bigint"))
    for by in (["g"], ["g", "h"]):
        want = df.groupBy(*by).agg(F.median("v").alias("m"))
        assert rows(quantiles.with_median(df.select(*by).distinct(), df, by, "v", "m", slices)) == rows(want)
    assert rows(quantiles.exact_median(df.withColumn("g", F.lit(1)), ["g"], "v", "m", slices)) == rows(df.groupBy(F.lit(1).alias("g")).agg(F.median("v")))


def test_numbers_follow_segments_in_order(spark):
    """Segments of very different sizes, rows dealt at random; positions start anywhere."""
    sizes = [1, 500, 0, 3, 70, 1, 1]
    data = [(f"f{i}", 1000 * i + 5 + j) for i, n in enumerate(sizes) for j in range(n)]
    df = spark.createDataFrame(data, "seg string, pos long").repartition(5, "pos")
    got = ranking.number_in_source_order(df, "n", "seg", "pos").collect()
    assert {(r.seg, r.pos): r.n for r in got} == {key: i for i, key in enumerate(data, 1)}


def concentrated(spark):
    df = spark.createDataFrame([("a", "x", 30.0), ("a", "y", 10.0), ("b", "x", 0.0), (None, "x", 5.0)], "g string, s string, v double")
    from plumbline.functions import aggregates as agg

    out = ranking.concentration(df, ["g", "s"], {"t": agg.total("v")}, "t", ["g"], "soma", "parte", "pos")
    return rows(out)


def test_concentration(spark):
    assert concentrated(spark) == sorted(
        [("a", "x", 30.0, 40.0, 75.0, 1), ("a", "y", 10.0, 40.0, 25.0, 2), ("b", "x", 0.0, 0.0, None, 1), (None, "x", 5.0, 5.0, 100.0, 1)], key=str
    )


def test_surrogates_are_stable(spark):
    df = spark.range(500).select(F.concat(F.lit("n"), F.col("id")).alias("nome"))
    a = rows(ranking.number_rows(df, "id", ["nome"]))
    b = rows(ranking.number_rows(df.repartition(7), "id", ["nome"]))
    assert a == b and sorted(r[0] for r in a) == list(range(1, 501))


def test_calendar(spark):
    days = dimensions.fixed_calendar(spark, "2024-01-01", "2026-12-31")
    assert days.count() == 1096
    wide = dimensions.calendar_of_periods(spark, "202412", "202412").where("data = DATE'2024-12-30'").first()
    assert (wide["semana_ano"], wide["dia_semana_numero"], wide["nome_mes"], wide["fim_de_semana"]) == (1, 1, "Dezembro", False)
    assert dimensions.calendar_of_periods(spark, "202501", "202503").count() == 90


def test_calendar_without_dates_is_empty(spark):
    df = spark.createDataFrame([(None,)], "d date")
    assert dimensions.calendar(df, "d").count() == 0


def test_unions(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2.5,)], "k double")
    with pytest.raises(ValueError, match="Schemas differ"):
        unions.union_strict([a, b])
    assert rows(unions.union_relaxed([a, b], allow_missing=True)) == [(1.0, "x"), (2.5, None)]
    one = spark.sql("select 1.50bd as m, date'2024-01-31' as d, 7 as n")
    two = spark.sql("select 2.25d as m, timestamp_ntz'2024-02-01 10:00:00' as d, 1.5bd as n")
    kinds = dict(unions.union_relaxed([one, two]).dtypes)
    assert (kinds["m"], kinds["d"], kinds["n"].startswith("decimal")) == ("double", "timestamp_ntz", True)
    with pytest.raises(TypeError, match="no common type"):
        unions.union_relaxed([spark.sql("select true as x"), spark.sql("select array(1) as x")])
    assert dict(unions.void_to_string(a.withColumn("n", F.lit(None))).dtypes)["n"] == "string"


def test_checks(spark):
    df = spark.createDataFrame([(1, 5.0), (1, -1.0), (None, 2.0)], "k int, v double")
    got = checks.unique_key(df, "d", "k").first()
    assert (got["rows"], got["distinct_keys"], got["duplicates"], got["null_keys"], got["approved"]) == (3, 2, 1, 1, False)
    assert checks.unique_key(df, "d", "zz").first()["approved"] is False
    neg = {r["column"]: (r["negative_rows"], r["approved"]) for r in checks.negative_values(df, "d", ["v", "zz"]).collect()}
    assert neg == {"v": (1, False), "zz": (None, False)}


def test_reference_ignores_null_keys(spark):
    child = spark.createDataFrame([(1,), (None,), (9,), (9,)], "k int")
    parent = spark.createDataFrame([(1,)], "k int")
    got = checks.reference(child, parent, "c", "p", "k").first()
    assert (got["missing_keys"], got["approved"]) == (1, False)
    assert checks.reference(child, parent, "c", "p", "k", severity="warning").first()["approved"] is True
    assert checks.orphan_rows(child, parent, "k", "k").count() == 2


def test_tolerance(spark):
    df = spark.range(1)

    def side(v, which):
        return reconcile.side(df, {"c": F.max(F.lit(v))}, which)

    ok = reconcile.compare([side(10.0, "silver"), side(10.05, "gold")], {"c": 0.05}).first()
    bad = reconcile.compare([side(10.0, "silver"), side(10.06, "gold")], {"c": 0.05}).first()
    assert ok["approved"] is True and bad["approved"] is False


def test_gates(spark):
    good = spark.createDataFrame([(True, "info")], "approved boolean, severity string")
    bad = good.unionByName(spark.createDataFrame([(False, "warning")], "approved boolean, severity string"))
    gates.require_approved(good, "x")
    gates.require_approved(bad, "x", only_errors=True)
    with pytest.raises(gates.GateError):
        gates.require_approved(bad, "x")


def test_quarantine(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, -1)], "k int, v int")
    ok, rejected = gates.quarantine(df, {"sem_chave": F.col("k").isNull(), "negativo": F.col("v") < 0})
    assert rows(ok) == [(1, 2)]
    assert sorted(len(r["motivos_rejeicao"]) for r in rejected.collect()) == [1, 2]


def test_relationships(spark):
    fact = spark.createDataFrame([(1,), (7,), (None,)], "k bigint")
    dim = spark.createDataFrame([(1, "a")], "id bigint, nome string")
    rel = Relationship("r", "f", "k", "d", "id")
    assert validate(rel, fact, dim).first()["approved"] is False
    assert validate(Relationship("r", "f", "k", "d", "id", True), fact, dim).first()["approved"] is True
    assert validate(Relationship("r", "f", "k", "d", "id", True), fact, dim.withColumn("id", F.col("id").cast("int"))).first()["approved"] is False
    assert rows(propagate(fact, dim, rel, ["nome"]).groupBy("nome").count()) == [("a", 1), (None, 2)]


def test_measures(spark):
    f = spark.createDataFrame([("x", 1.0, None), ("x", 2.0, "p"), ("y", 0.0, "p")], "g string, v double, p string")
    total, lines = measures.sum_of("t", "f", "v"), measures.row_count("n", "f")
    parties = measures.distinct_count("p", "f", "p")
    got = measures.evaluate(
        {"f": f}, [total, lines, parties, measures.divide("avg", total, lines), parties.where(F.col("v") > 0.5, "p_pos"), lines.where(F.col("v") > 1, "n_pos")]
    ).first()
    assert tuple(got) == (3.0, 3, 2, 1.0, 2, 1)
    empty = measures.evaluate({"f": f.where("v > 9")}, [measures.divide("avg", total, lines)]).first()
    assert empty["avg"] == 0.0


def test_priority_dates():
    assert dt.date(2024, 12, 30).isocalendar().week == 1


def test_hot_group_snapshot_and_dedup_equal_brute_force(spark):
    """One group, and one null key, hold a third of the rows each."""
    data = [(i, None if i % 3 == 0 else ("hot" if i % 3 == 1 else f"g{i % 17}"), f"2025{i % 12 + 1:02d}") for i in range(3000)]
    df = spark.createDataFrame(data, "v int, g string, periodo_origem string")
    newest: dict = {}
    for _, g, p in data:
        newest[g] = max(newest.get(g, ""), p)
    expected = sorted((v, g, p, p) for v, g, p in data if g is not None and newest[g] == p)
    for digits in (False, True):
        got = dedup.latest_snapshot(df, "g", "periodo_origem", "ultimo", digits=digits)
        assert sorted(map(tuple, got.collect())) == expected
    kept = {r["g"]: r["periodo_origem"] for r in dedup.keep_latest(df, ["g"]).collect()}
    assert kept == newest


def test_source_numbers_are_consecutive(spark):
    df = spark.range(0, 1000, 1, 5).select("id", F.monotonically_increasing_id().alias("p")).withColumn("s", F.shiftright("p", 33))
    got = ranking.number_in_source_order(df, "n", "s", "p")
    assert got.where("n <> id + 1").count() == 0 and got.count() == 1000


def test_stacked_keys_agree_with_single_checks(spark):
    child = spark.createDataFrame([(1, "a", 1.0), (1, "b", -0.0), (2, None, None), (None, "c", 0.0), (9, "a", 2.0)], "k int, s string, d double")
    parent = spark.createDataFrame([(1, "a", 0.0), (1, "b", 1.0), (None, "x", 1.0), (None, None, None)], "k int, s string, d double")
    none = spark.createDataFrame([], "k int, s string, d double")
    tables = {"child": child, "parent": parent, "none": none}
    columns = ["check", "dataset", "key", "rows", "distinct_keys", "duplicates", "null_keys", "source_dataset", "target_dataset", "source_key", "target_key", "missing_keys", "severity", "approved", "message"]
    pairs = [("child", "parent", c) for c in ("k", "s", "d")] + [("parent", "child", "s"), ("child", "none", "k"), ("none", "parent", "k")]
    stacked = checks.key_checks(tables, [(t, c) for t in tables for c in ("k", "s", "d", "absent")], [(a, b, c, c, level) for a, b, c in pairs for level in ("error", "warning")])
    single = [checks.unique_key(tables[t], t, c) for t in tables for c in ("k", "s", "d", "absent")]
    single += [checks.reference(tables[a], tables[b], a, b, c, severity=level) for a, b, c in pairs for level in ("error", "warning")]
    assert rows(stacked.select(columns)) == rows(checks.suite(single).select(columns))
    rels = [relationships.Relationship(f"{a}_{b}_{c}_{loose}", a, c, b, c, loose) for a, b, c in pairs for loose in (True, False)]
    found = relationships.validate_all(rels, tables)
    assert rows(found) == rows(checks.suite([relationships.validate(r, tables[r.from_table], tables[r.to_table]) for r in rels]))
    plan = relationships.validate_all(rels, tables)._jdf.queryExecution().executedPlan().toString()
    # One scan of each table, whatever the number of links; no join.
    assert "Join" not in plan and plan.count("Scan ExistingRDD") == 3


def test_keys_of_two_types(spark):
    tables = {
        "n": spark.createDataFrame([(1,), (2,), (3,)], "k int"),
        "b": spark.createDataFrame([(1,), (2,)], "k bigint"),
        "s": spark.createDataFrame([("1",), ("02",), ("x",)], "k string"),
    }
    rel = lambda a, b: relationships.Relationship(a + b, a, "k", b, "k")
    found = relationships.validate_all([rel("n", "b"), rel("n", "s"), rel("s", "n")], tables)
    assert rows(found.select("name", "orphan_rows", "from_dtype", "to_dtype", "approved")) == [
        ("nb", 1, "int", "bigint", False), ("ns", 2, "int", "string", False), ("sn", 2, "string", "int", False)]
