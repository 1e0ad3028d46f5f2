"""Readers, writers, inventory and the landing stream on real files."""

import json
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from plumbline.operators.gates import landing_approval
from plumbline.plans import amendments, senate
from plumbline import runtime
from plumbline.sources import delimited, documents, landing, records, tables
from plumbline.streaming import snapshots
from plumbline.streaming.landing import land_once, landed_rows
from tests.conftest import rows


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_cp1252_csv(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'Código;Situação\n"1";"Não"\n2;\n', "cp1252")
    df = delimited.normalized_headers(delimited.read_delimited(spark, p))
    assert delimited.data_columns(df) == ["codigo", "situacao"]
    assert rows(df.select("codigo", "situacao")) == [("1", "Não"), ("2", None)]


def test_strict_reader_fails_on_ragged_rows(spark, tmp_path):
    p = put(tmp_path / "a.csv", "a;b\n1;2\n3;4;5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_delimited(spark, p, encoding=delimited.UTF8).select("a", "b").collect()
    loose = delimited.read_delimited(spark, p, encoding=delimited.UTF8, strict=False)
    assert rows(loose.select("a", "b")) == [("1", "2"), ("3", "4")]


@contextmanager
def splits_of(spark, size):
    """Files are cut into splits of so many bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        yield
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("few", [2, 500_000])
def test_line_numbers_over_several_splits(spark, tmp_path, monkeypatch, few):
    """Also where there are more splits than a map-side join takes."""
    monkeypatch.setattr(runtime, "MAP_SIDE_ROWS", few)
    for name, n in (("x", 4000), ("y", 10)):
        put(tmp_path / f"{name}.csv", "id;texto\n" + "".join(f"{i};{'z' * 50}\n" for i in range(n)))
    with splits_of(spark, "20000"):
        df = delimited.read_delimited(spark, [str(tmp_path / "x.csv"), str(tmp_path / "y.csv")], encoding=delimited.UTF8, breaks=False)
        assert df.select(delimited.SPLIT).distinct().count() > 3
        got = delimited.with_line_numbers(df)
        assert got.where(F.col("linha_arquivo") != F.col("id").cast("bigint") + 2).count() == 0
        assert got.count() == 4010


def plain_records(text):
    """(number, text, unclosed) of each record, by walking through the lines."""
    lines, out, held, stray = text.split("\n"), [], None, False

    def walk(line, inside):
        """Is a quote open behind the line, and does one close a value of an earlier line amid text?"""
        i, amid, first = 0, False, inside
        while True:
            if inside:
                while True:
                    i = line.find('"', i)
                    if i < 0:
                        return True, amid
                    if line[i + 1 : i + 2] != '"':
                        break
                    i += 2
                amid = amid or first and line[i + 1 : i + 2] not in ("", ";")
                first = False
            i = line.find(";", i)
            if i < 0:
                return False, amid
            inside = line[i + 1 : i + 2] == '"'
            i += 2 if inside else 1
            first = first and inside

    begun = None
    for n, line in enumerate(lines):
        if held is None:
            if not line.strip():
                continue
            # A separator before the line makes its first field like any other.
            if walk(";" + line, False)[0]:
                held, stray, begun = [line], False, n
            else:
                out.append((line, False))
        else:
            held.append(line)
            still, amid = walk(line, True)
            stray = stray or amid
            if not still:
                out.append(("\n".join(held), stray))
                held = None
    if held is not None:
        out += [(line, walk(";" + line, False)[0]) for line in lines[begun:] if line.strip()]
    return [(i, *r) for i, r in enumerate(out, 1)]


@pytest.mark.parametrize("size", ["7", "64", "100000"])
def test_records_are_put_together_whatever_the_splits(spark, tmp_path, size):
    rnd, want = random.Random(int(size)), set()
    for f in range(40):
        text = "x" * rnd.randint(0, 9) + "\n" + "\n".join("".join(rnd.choices(["a", ";", '"', '""', '";"', " "], [4, 4, 2, 1, 1, 1], k=rnd.randint(0, 6))) for _ in range(rnd.randint(0, 25)))
        name = put(tmp_path / f"{f}.csv", text)
        want |= {(name, *r) for r in plain_records(text)}
    with splits_of(spark, size):
        found = records._assembled(records._lines(spark, str(tmp_path)))
        got = {(r["_file"].removeprefix("file:"), r["record"], r["value"], r["unclosed"]) for r in found.collect()}
    assert got == want and sum(x[3] for x in want) > 10


def broken(tmp_path):
    """A file with records of every kind; what is read of it."""
    text = 'id;texto\n1;"linha um\n\nlinha ""dois"""\n\n2\n3;c;sobra\n4;b\u0081\n5;"aberto\n6;x\n7;"y;z\n8;"fim"\n'
    return put(tmp_path / "b.csv", text, "latin-1"), [
        ("1", 'linha um\n\nlinha "dois"', 2, None, None), ("2", None, 3, "ragged", "2"), ("3", "c", 4, "ragged", "3;c;sobra"), ("4", "b\ufffd", 5, "undecodable", "4;b\ufffd"),
        ("5", None, 6, "unclosed_quote", '5;"aberto\n6;x\n7;"y;z'), ("8", "fim", 7, None, None),
    ]


def test_broken_records_are_told(spark, tmp_path):
    p, want = broken(tmp_path)
    found = records.read_records(spark, p)
    got = sorted(tuple(r) for r in found.select("id", F.when(F.col("id") != "5", F.col("texto")), "_place_in_split", "_reason", "_raw").collect())
    assert got == want
    assert records.accepted(found).count() + records.rejected(found).count() == 6
    for reason in ("ragged", "undecodable", "unclosed_quote"):
        with pytest.raises(Exception, match=rf"Malformed record \({reason}\)"):
            records.checked(found.where(F.col("_reason") == reason)).collect()
    assert delimited.read_delimited(spark, p, strict=False).count() == 6


def test_a_quote_that_is_never_closed_costs_its_line_only(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'id;texto\n1;a\n2;"aberto\n\n3;c\n4;d\n')
    with pytest.raises(Exception, match="unclosed_quote"):
        delimited.read_delimited(spark, p, encoding=delimited.UTF8).collect()
    for breaks in (True, False):
        found = records.read_records(spark, p, encoding=delimited.UTF8, breaks=breaks)
        assert rows(records.accepted(found).select("id", "texto")) == [("1", "a"), ("3", "c"), ("4", "d")]
        assert rows(records.rejected(found).select("id", "_reason", "_raw")) == [("2", "unclosed_quote", '2;"aberto')]
        lined = delimited.with_line_numbers(found)
        assert rows(lined.select("id", "linha_arquivo")) == [("1", 2), ("2", 3), ("3", 4), ("4", 5)]


def test_headers_must_name_the_columns(spark, tmp_path):
    for name, text in (("a", "id;texto\n1;x\n"), ("b", 'id;texto\n1;"x\ny"\n')):
        p = put(tmp_path / f"{name}.csv", text)
        assert delimited.read_delimited(spark, p, ["ID", "texto"], delimited.UTF8).count() == 1
        with pytest.raises(Exception, match="(?i)header"):
            delimited.read_delimited(spark, p, ["outro", "texto"], delimited.UTF8).collect()


def test_mapped_history_file(spark, tmp_path):
    headers = amendments.HEADERS["favorecidos"]
    values = ["202500010001", "10", "Ana", "1", "Individual", "202503", "77", "S/I", "Sem informação", "PJ", "SP", "Cidade", "1.000,50"]
    p = put(tmp_path / "f.csv", ";".join(headers) + "\n" + ";".join(values) + "\n" + ";".join(values) + "\n", "cp1252")
    read = delimited.read_mapped(spark, p, headers, amendments.column_of, amendments.NULL_TOKENS)
    got = amendments.silver_beneficiaries(amendments.numbered(read), [2025]).first()
    assert (got["favorecido"], got["natureza_juridica"], got["valor_recebido"], got["ano_recebimento"], got["mes_recebimento"]) == (
        None, None, 2001.0, 2025, 3,
    )
    with pytest.raises(ValueError, match="Missing columns"):
        delimited.read_mapped(spark, put(tmp_path / "g.csv", "x;y\n1;2\n"), headers, amendments.column_of, ())


def test_header_rule():
    named = {h: amendments.column_of(h) for hs in amendments.HEADERS.values() for h in hs}
    assert named["Localidade de aplicação do recurso"] == "localidade_aplicacao"
    assert named["Código do Autor da Emenda"] == "codigo_autor_emenda"
    assert named["Valor Restos A Pagar Inscritos"] == "valor_restos_pagar_inscritos"
    assert named["Data Publicação Convênio"] == "data_publicacao_convenio"


def test_layout_drift(spark, tmp_path):
    a = put(tmp_path / "202501_Compras.csv", "x;y\n1;2\n")
    b = put(tmp_path / "202502_Compras.csv", "y;z\n3;4\n")
    df = delimited.read_by_layout(spark, {("x", "y"): [a], ("y", "z"): [b]}, encoding=delimited.UTF8)
    lined = delimited.with_period_lineage(df)
    assert rows(lined.select("x", "y", "z", "periodo_origem", "mes_origem")) == [("1", "2", None, "202501", 1), (None, "3", "4", "202502", 2)]


def test_bom_and_snake_case(spark, tmp_path):
    p = put(tmp_path / "c.csv", '﻿"CodSenador";"NomeSenador"\n"1";" Ana "\n"";"Bia"\n')
    df = delimited.read_snake_cased(spark, p)
    assert rows(df.select("cod_senador", "nome_senador")) == [("1", "Ana"), (None, "Bia")]


def test_json_pages(spark, tmp_path):
    record = dict.fromkeys(amendments.PAGE_COLUMNS, "1") | {"codigoEmenda": "A", "localidadeDoGasto": "São Paulo - SP", "valorEmpenhado": "8.000,00"}
    put(tmp_path / "pagina_1.json", json.dumps([record]))
    put(tmp_path / "pagina_2.json", json.dumps([record | {"valorEmpenhado": "9.000,00"}, record | {"codigoEmenda": "B"}]))
    got = amendments.silver_api_pages(documents.read_pages(spark, str(tmp_path), amendments.PAGE_COLUMNS))
    assert got.count() == 2
    b = got.where("codigo_emenda = 'B'").first()
    assert (b["municipio"], b["uf"], float(b["valor_empenhado"])) == ("São Paulo", "SP", 8000.0)
    put(tmp_path / "pagina_3.json", json.dumps({"erro": 1}))
    with pytest.raises(TypeError, match="Not a list"):
        documents.read_pages(spark, str(tmp_path), amendments.PAGE_COLUMNS)


def test_nested_document(spark, tmp_path):
    p = put(tmp_path / "d.json", "﻿" + json.dumps({"A": {"B": [{"x": 1}, {"x": 2}]}}))
    read = documents.read_nested(spark, p, "A.B")
    assert rows(read.select("x")) == [(1,), (2,)] and read.first()["_file"].endswith("/d.json")


@pytest.mark.parametrize("pack", ["100", "100000000"])
def test_nested_records_count_in_path_order(spark, tmp_path, pack):
    """Two documents of unequal size: splits are packed by size, records count by path."""
    for name, lo, n in (("a_2025", 0, 3), ("b_2026", 100, 400)):
        put(tmp_path / f"{name}.json", json.dumps([{"codigoSessaoVotacao": lo + i, "votos": [{"codigoParlamentar": i}, {"codigoParlamentar": i + 1}]} for i in range(n)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", pack)
    try:
        read = documents.read_nested(spark, f"{tmp_path}/*.json", schema="codigoSessaoVotacao string, codigoMateria string, dataSessao string, votos array<struct<codigoParlamentar:string>>")
        votings = {r["linha_origem"]: r["codigo_sessao_votacao"] for r in senate.silver_votings(read).collect()}
        votes = {r["linha_origem"]: (r["codigo_sessao_votacao"], r["codigo_parlamentar"]) for r in senate.silver_votes(read).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    order = [*range(3), *range(100, 500)]
    assert votings == dict(enumerate(order, 1))
    assert votes == dict(enumerate(((c, c % 100 + 100 * (c // 100 - 1) * (c >= 100) + k) for c in order for k in (0, 1)), 1))


def test_landing_inventory(spark, tmp_path):
    put(tmp_path / "202301_Licitação.csv", "Número;Valor\n1;2\n3;4\n", "cp1252")
    put(tmp_path / "202302_ItemLicitação.csv", "Número;Item\n", "cp1252")
    put(tmp_path / "sub" / "202302_Outro.csv", "a\n1\n", "cp1252")
    put(tmp_path / "leiame.csv", "a\n1\n")
    found = landing.inventory(spark, str(tmp_path), landing.TENDER_ENTITIES).cache()
    by = {r["file"].split("/")[-1]: r for r in found.collect()}
    lic = by["202301_Licitação.csv"]
    assert (lic["entity"], lic["periodo"], lic["record_count"], lic["column_count"], lic["encoding"]) == ("licitacoes", "202301", 2, 2, "cp1252")
    assert lic["columns"] == ["Número", "Valor"]
    assert all(len(r["content_digest"]) == 64 and r["encoding"] for r in by.values())
    assert by["202302_ItemLicitação.csv"]["empty_file"] is True
    assert by["leiame.csv"]["reason"] == "nome_fora_do_padrao" and by["leiame.csv"]["encoding"] == "utf-8-sig"
    assert by["202302_Outro.csv"]["reason"] == "entidade_nao_reconhecida:Outro"
    assert rows(landing.totals_by_entity(found)) == [("itens_licitacao", 1, 0, 1), ("licitacoes", 1, 2, 0)]
    assert landing.period_range(found, "202405").first()["source_outdated"] is True
    assert landing.ignored(found).count() == 2 and landing.layouts(found).count() == 2
    assert landing_approval(found).first()["approved"] is True


def test_inventory_counts_records_and_splits_change_nothing(spark, tmp_path):
    put(tmp_path / "x" / "a b" / "202301_Licitação.csv", 'id;texto\n1;"linha um\nlinha dois"\n\n2;ok\n3;"a ""b"" c"\n', "utf-8")
    put(tmp_path / "x" / "202302_Licitação.csv", "id;texto\n1;não\x81\n", "latin-1")
    put(tmp_path / "x" / "202303_Licitação.csv", "")
    put(tmp_path / "x" / "202304_Licitação.csv", "id;texto\n" + "".join(f"{i};é{i}\n" for i in range(5000)), "cp1252")
    put(tmp_path / "x" / "202305_Licitação.csv", "id;texto\n" + "".join(f"{i};é{i}\n" for i in (1, 0, *range(2, 5000))), "cp1252")

    def found():
        return {r["file"]: r for r in landing.inventory(spark, str(tmp_path / "x")).collect()}

    whole = found()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        split = found()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert whole == split
    a, b, c, d, e = (whole[k] for k in sorted(whole, key=lambda f: f.split("/")[-1]))
    assert [r["record_count"] for r in (a, b, c, d, e)] == [3, 1, 0, 5000, 5000]
    assert [r["encoding"] for r in (a, b, c, d, e)] == ["utf-8-sig", "latin-1", "utf-8-sig", "cp1252", "cp1252"]
    assert len({r["content_digest"] for r in (a, b, c, d, e)}) == 5
    assert c["empty_file"] and c["file_size_bytes"] == 0 and a["columns"] == ["id", "texto"]
    assert landing_approval(landing.inventory(spark, str(tmp_path / "x"))).first()["approved"] is False


def test_inventory_splits_files_without_line_breaks(spark, tmp_path):
    put(tmp_path / "x" / "202301_Licitação.csv", "id;texto\n" + "".join(f'{i};"é ""{i}"""\n' for i in range(5000)), "cp1252")
    put(tmp_path / "x" / "202302_Licitação.csv", "id;texto\r\n1;a\r\n\r\n2;b")
    put(tmp_path / "x" / "202303_Licitação.csv", "")
    root = str(tmp_path / "x")
    found = lambda **how: sorted(landing.inventory(spark, root, **how).collect(), key=str)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert found(breaks=False) == found() and sorted(r["record_count"] for r in found(breaks=False)) == [0, 2, 5000]
        tasks = {b: landing._records(spark, root, b).select("file", F.spark_partition_id().alias("p")).distinct().groupBy("file").count().agg(F.max("count")).first()[0] for b in (True, False)}
        assert tasks[True] == 1 and tasks[False] > 5
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quoted_line_breaks(spark, tmp_path):
    p = put(tmp_path / "a.csv", 'id;texto\n1;"linha um\nlinha dois"\n2;ok\n')
    for strict in (True, False):
        read = delimited.with_line_numbers(delimited.read_delimited(spark, p, encoding=delimited.UTF8, strict=strict))
        assert rows(read.select("id", "texto", "linha_arquivo")) == [("1", "linha um\nlinha dois", 2), ("2", "ok", 3)]


def test_no_exchange_carries_lines(spark, tmp_path):
    """Numbering and the inventory move counts and headers, never the lines."""
    p = put(tmp_path / "x.csv", "id;texto\n" + "1;a\n" * 50)
    numbered = delimited.with_line_numbers(delimited.read_delimited(spark, p, encoding=delimited.UTF8))
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    facts, heads = landing._line_facts(spark, str(tmp_path))
    for df in (facts, heads):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in text and "partial_" in text


def test_write_read_publish(spark, tmp_path):
    root, out = str(tmp_path / "gold"), str(tmp_path / "pub")
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string").withColumn("vazio", F.lit(None))
    stats = tables.write_dataset(df, root, "ranking_x", order_by=[F.col("k")])
    assert (stats["record_count"], stats["column_count"]) == (2, 3)
    assert dict(tables.read_dataset(spark, root, "ranking_x").dtypes)["vazio"] == "string"
    assert tables.read_dataset(spark, root, "ranking_x", ["k"]).columns == ["k"]
    tables.write_dataset(df, root, "outra", csv=False)
    tables.write_dataset(df, f"{root}/dimensions", "fato_lateral", csv=False)
    assert tables.find_marts(spark, root) == ["ranking_x"]
    catalog = tables.publish(spark, "dominio", root, out, ["ranking_x"], "gold")
    assert rows(catalog.select("table", "rows", "ok")) == [("dominio_ranking_x", 2, True)]
    again = tables.update_catalog(catalog, catalog, "dominio", "gold")
    assert again.count() == 1
    plan = spark.createDataFrame([("dominio", "ranking_x", "novo")], "domain string, current string, new string")
    assert tables.renamed_by_plan(catalog, plan).first()["table"] == "novo"
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.read_dataset(spark, root, "nada")


def test_partitions_and_latest_execution(spark, tmp_path):
    df = spark.createDataFrame([(1, "20250101T000000Z"), (2, "20250201T000000Z")], "k int, execucao string")
    tables.write_dataset(df, str(tmp_path), "b", csv=False, partition_by=["execucao"])
    newest = tables.latest_execution(tables.read_dataset(spark, str(tmp_path), "b"))
    assert rows(newest.select("k")) == [(2,)]


def test_each_file_lands_once(spark, tmp_path):
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    put(tmp_path / "src" / "a.csv", "k;v\n1;x\n2;y\n")
    assert land_once(landed_rows(spark, src, ["k", "v"]), out, ck) == 2
    assert land_once(landed_rows(spark, src, ["k", "v"]), out, ck) == 0
    put(tmp_path / "src" / "b.csv", "k;v\n3;z\n")
    assert land_once(landed_rows(spark, src, ["k", "v"]), out, ck) == 1
    assert spark.read.parquet(out).count() == 3


def _follow(spark, folder, n):
    merge = snapshots.latest_period("g", "p")
    return snapshots.follow(spark, f"{folder}/landed", f"{folder}/state{n}", ["g"], merge, lambda df: df.selectExpr("g", "p", "int(v) AS v"), buckets=8)


def test_incremental_snapshot_equals_one_run(spark, tmp_path):
    landed = lambda: landed_rows(spark, str(tmp_path / "in"), ["g", "p", "v"])
    land = lambda: snapshots.land(landed(), str(tmp_path / "landed"), str(tmp_path / "check"))
    sets = [
        # A hot group, a group in all sets, a late period, repeated rows, no group, no period.
        [("hot", "202501", i) for i in range(50)] + [("a", "202501", 1), ("b", "202502", 2), ("b", "202502", 2), (None, "202501", 3), ("n", None, 4)],
        [("a", "202502", 5), ("a", "202502", 5), ("b", "202501", 6), ("hot", "202501", 50)],
        [],
        [("a", "202502", 7), ("c", "202503", 8)],
    ]
    for i, rows_ in enumerate(sets):
        spark.createDataFrame(rows_, "g string, p string, v int").coalesce(1).write.mode("append").option("sep", ";").option("header", True).csv(str(tmp_path / "in"))
        assert land() == len(rows_)
        touched = _follow(spark, tmp_path, 1)
        assert (touched == 0) == (not rows_) and _follow(spark, tmp_path, 1) == 0
    wanted = sorted([("a", "202502", v) for v in (5, 5, 7)] + [("b", "202502", 2)] * 2 + [("c", "202503", 8)] + [("hot", "202501", i) for i in range(51)])
    assert sorted(map(tuple, snapshots.read_snapshot(spark, str(tmp_path / "state1")).collect())) == wanted
    _follow(spark, tmp_path, 2)
    assert sorted(map(tuple, snapshots.read_snapshot(spark, str(tmp_path / "state2")).collect())) == wanted
    # Buckets that the last run did not touch stay where an earlier run wrote them.
    held = snapshots._state(spark, str(tmp_path / "state1"))[1]
    assert len(set(held.values())) > 1 and len(set(snapshots._state(spark, str(tmp_path / "state2"))[1].values())) == 1


def test_failed_and_replayed_runs_change_nothing(spark, tmp_path):
    def land(rows_):
        spark.createDataFrame(rows_, "g string, p string, v int").coalesce(1).write.mode("append").option("sep", ";").option("header", True).csv(str(tmp_path / "in"))
        return snapshots.land(landed_rows(spark, str(tmp_path / "in"), ["g", "p", "v"]), str(tmp_path / "landed"), str(tmp_path / "check"))

    with pytest.raises(FileNotFoundError):
        snapshots.read_snapshot(spark, str(tmp_path / "state1"))
    land([("a", "1", 1)])
    _follow(spark, tmp_path, 1)
    shown = lambda: sorted(map(tuple, snapshots.read_snapshot(spark, str(tmp_path / "state1")).collect()))
    land([("a", "1", 2), ("b", "1", 3)])
    with pytest.raises(Exception, match="lost"):
        snapshots.follow(spark, str(tmp_path / "landed"), str(tmp_path / "state1"), ["g"], lambda df: df.withColumn("v", F.raise_error(F.lit("lost")).cast("int")),
                         lambda df: df.selectExpr("g", "p", "int(v) AS v"), buckets=8)
    assert shown() == [("a", "1", 1)]
    # The stream forgets that it finished its last batch and does it again.
    last = max((tmp_path / "check" / "commits").glob("[0-9]*"), key=lambda f: int(f.name))
    for gone in (last, last.with_name(f".{last.name}.crc")):
        gone.unlink()
    land([])
    assert _follow(spark, tmp_path, 1) > 0
    assert shown() == [("a", "1", 1), ("a", "1", 2), ("b", "1", 3)]
