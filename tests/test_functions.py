"""Column expressions on the pinned micro-fixtures."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from plumbline.functions import aggregates as agg
from plumbline.functions import dates, keys, numbers, text
from plumbline.functions.nested import flatten, unnest


def one(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(fn("v")).collect()]


def test_brazilian_decimal(spark):
    values = ["1.234,56", "-5,00", "", "x", "NaN", "1d", "1,2,3", None, " 7 "]
    assert one(spark, values, numbers.brazilian_decimal) == [1234.56, -5.0, None, None, None, None, None, None, 7.0]
    assert one(spark, ["x", "2,5"], numbers.brazilian_money) == [0.0, 2.5]


def test_dates(spark):
    got = one(spark, ["01/02/2025", "1/2/2025", "31/02/2025", "", None], dates.brazilian_date)
    assert got == [dt.date(2025, 2, 1), dt.date(2025, 2, 1), None, None, None]
    got = one(spark, ["2025-01-02T03:04:05", "2025", "sem"], dates.iso_datetime)
    assert got == [dt.datetime(2025, 1, 2, 3, 4, 5), None, None]
    assert one(spark, ["2025-03-04", "4/3/2025", "x"], dates.iso_date) == [dt.date(2025, 3, 4), dt.date(2025, 3, 4), None]


def test_unicode_strip(spark):
    assert one(spark, [" João ", "  \t", None], text.clean_text) == ["João", None, None]


def test_booleans_and_votes(spark):
    assert one(spark, ["Sim", "não", "1", "talvez", None], text.boolean_word) == [True, False, True, None, None]
    assert one(spark, [" Não", "Abstenção", "Obstrução"], text.fold_vote) == ["nao", "abstencao", "obstrucao"]


def test_whole_numbers(spark):
    assert one(spark, ["12", " 7 ", "1.5", "x", ""], numbers.whole_number) == [12, 7, None, None, None]
    assert one(spark, ["cod 12-", "a", "-5"], numbers.digits_number) == [None, None, -5]


def test_city_and_state(spark):
    df = spark.createDataFrame([("São Paulo - SP",), ("Nacional",)], "v string")
    got = [tuple(r) for r in df.select(text.city_of("v"), text.state_of("v")).collect()]
    assert got == [("São Paulo", "SP"), (None, None)]


def test_keys(spark):
    df = spark.createDataFrame([("UG1", None), (None, "C")], "ug string, n string")
    got = [r[0] for r in df.select(keys.keyed(ug="SEM_UG", n="SEM_CONTRATO")).collect()]
    assert got == ["UG1|SEM_CONTRATO", "SEM_UG|C"]
    assert df.select(keys.joined("ug", "n").isNull()).distinct().collect()[0][0] is True
    import hashlib

    got = [r[0] for r in df.select(keys.content_hash(df, ["ug", "zz", "n"])).collect()]
    assert got[0] == hashlib.sha256(b"3:UG1-").hexdigest()
    alike = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("", None), (None, ""), ("1:", "-")], "ug string, n string")
    assert alike.select(keys.content_hash(alike, ["ug", "n"]).alias("h")).distinct().count() == 5
    assert df.select(keys.content_hash(df, ["zz"])).first()[0] == hashlib.sha256(b"").hexdigest()


def test_date_repair(spark):
    df = spark.createDataFrame(
        [(2025, dt.date(1925, 3, 10), 3), (2025, None, 4), (2025, dt.date(2025, 5, 6), 1), (2025, dt.date(1920, 2, 29), 2)],
        "ano int, data date, mes int",
    )
    window = (2024, 2025, 2026)
    got = [tuple(r) for r in df.select(dates.repair_date("data", "ano", "mes", window), dates.is_outside("data", window)).collect()]
    assert got == [(dt.date(2025, 3, 10), True), (dt.date(2025, 4, 1), True), (dt.date(2025, 5, 6), False), (None, True)]


def test_document_kind(spark):
    assert one(spark, ["1" * 14, "1" * 11, "12"], text.document_kind) == ["CNPJ", "CPF", "OUTRO"]


def test_null_faithful_aggregates(spark):
    df = spark.createDataFrame([("k", None), (None, None), ("k", None), (None, None), ("z", None)], "c string, v double")
    got = df.agg(
        agg.n_unique("c"), agg.n_present("c"), agg.total("v"), agg.mean("v"), agg.any_true(F.col("v") > 1), agg.count_where(F.col("c") == "k")
    ).first()
    assert tuple(got) == (3, 2, 0.0, None, False, 2)


def test_total_is_exact_in_any_order(spark):
    df = spark.range(30000).select((F.col("id") % 97 / 100 + 1e9).alias("v"))
    a = df.repartition(3).agg(agg.total("v")).first()[0]
    b = df.repartition(7, "v").agg(agg.total("v")).first()[0]
    assert a == b


def test_mean_rounds_half_up(spark):
    df = spark.createDataFrame([(1.0,), (1.01,)], "v double")
    assert df.agg(agg.mean("v")).first()[0] == 1.01


def test_first_by_order(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "o int, v string")
    assert tuple(df.agg(agg.first_by("v", F.col("o")), agg.first_present_by("v", F.col("o"))).first()) == (None, "b")


def test_flatten_and_unnest(spark):
    schema = "Codigo string, Pai struct<NomeCompleto:string,Filho:struct<idade:int>>, votos array<struct<siglaVoto:string>>"
    df = spark.createDataFrame([("1", ("Ana", (3,)), [("S",), ("N",)]), ("2", ("Bia", None), []), ("3", None, None)], schema)
    flat = flatten(df.drop("votos"))
    assert flat.columns == ["codigo", "pai_nome_completo", "pai_filho_idade"]
    assert flat.count() == 3
    assert '"siglaVoto":"S"' in flatten(df).where("codigo = '1'").first()["votos"]
    child = unnest(df, "votos", {"codigo_pai": "Codigo"})
    assert child.columns == ["sigla_voto", "codigo_pai"] and child.count() == 2


@pytest.mark.parametrize(
    ("name", "expected"),
    [("Código  Órgão", "codigo_orgao"), ("Valor (R$)", "valor_r"), ("Ano/Mês", "ano_mes")],
)
def test_header_names(name, expected):
    assert text.header_name(name) == expected


def test_camel_names():
    assert text.camel_name("ultimoStatus_idOrgao") == "ultimo_status_id_orgao"
    assert text.camel_name("siglaUFAutor") == "sigla_ufautor"
    assert text.snake_name("NomeCompletoParlamentar") == "nome_completo_parlamentar"
