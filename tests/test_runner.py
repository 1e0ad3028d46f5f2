"""Whole domains on small landed files: silver, checks, gold, reconciliation, dimensions, publication."""

import json

import pytest
from pyspark.sql import functions as F

from plumbline.operators.gates import GateError
from plumbline.plans import amendments, chamber, contracts, deputy_expenses, runner, senate
from plumbline.runtime import materialize
from plumbline.sources import delimited
from plumbline.sources.tables import find_marts, new_run_id, publish, read_catalog, read_dataset, read_file_control, read_manifest, sweep, write_catalog
from tests.conftest import rows


def put(path, header, lines, encoding="cp1252"):
    path.parent.mkdir(parents=True, exist_ok=True)
    text = ";".join(header) + "\n" + "".join(";".join(line) + "\n" for line in lines)
    path.write_bytes(text.encode(encoding))


CONTRACT_HEADER = [
    "Número do Contrato", "Objeto", "Fundamento Legal", "Modalidade Compra", "Situação Contrato", "Código Órgão Superior",
    "Nome Órgão Superior", "Código Órgão", "Nome Órgão", "Código UG", "Nome UG", "Data Assinatura Contrato", "Data Publicação DOU",
    "Data Início Vigência", "Data Fim Vigência", "Código Contratado", "Nome Contratado", "Valor Inicial Compra", "Valor Final Compra",
    "Número Licitação", "Código UG Licitação", "Nome UG Licitação", "Código Modalidade Compra Licitação", "Modalidade Compra Licitação",
]
ITEM_HEADER = ["Código Órgão", "Nome Órgão", "Código UG", "Nome UG", "Número Contrato", "Código Item Compra", "Descrição Item Compra",
               "Descrição Complementar Item Compra", "Quantidade Item", "Valor Item"]
TERM_HEADER = ["Número Contrato", "Código Órgão Superior", "Nome Órgão Superior", "Código Órgão", "Nome Órgão", "Código UG", "Nome UG",
               "Número Termo Aditivo", "Data Publicação", "Objeto"]


def contract(number, initial, final, supplier="900", name="ALFA", obj="Serviço"):
    return [number, obj, "Lei", "Pregão", "Publicado", "1", "SUP", "10", "ORG", "UG1", "Unidade", "01/01/2025", "02/01/2025", "05/01/2025",
            "05/01/2026", supplier, name, initial, final, "7", "UG1", "Unidade", "5", "Pregão"]


@pytest.fixture
def contract_files(tmp_path):
    land = tmp_path / "bronze"
    put(land / "202501_Compras.csv", CONTRACT_HEADER, [contract("C1", "1.000,00", "1.000,00"), contract("C2", "500,00", "450,00", "901", "BETA")])
    put(land / "202502_Compras.csv", CONTRACT_HEADER, [contract("C1", "1.000,00", "1.200,50"), contract("C1", "300,00", "300,00", obj="sob SIGILO")])
    put(land / "202501_ItemCompra.csv", ITEM_HEADER, [["10", "ORG", "UG1", "Unidade", "C1", "77", "Item", "", "2", "10,50"],
                                                       ["10", "ORG", "UG1", "Unidade", "C1", "0", "Item", "", "1", "5,00"]])
    put(land / "202502_ItemCompra.csv", ITEM_HEADER, [["10", "ORG", "UG1", "Unidade", "C1", "77", "Item", "", "3", "10,50"]])
    put(land / "202502_TermoAditivo.csv", TERM_HEADER, [["C1", "1", "SUP", "10", "ORG", "UG1", "Unidade", "1", "10/02/2025", "Prorrogação"]])
    put(land / "202502_Apostilamento.csv", ["Número Contrato", "Código UG"], [])
    put(land / "notas.csv", ["x"], [["1"]])
    return land


def test_contracts_end_to_end(spark, tmp_path, contract_files):
    silver, gold, pub = (str(tmp_path / d) for d in ("silver", "gold", "pub"))
    runner.run_silver_contracts(spark, str(contract_files), silver, "202501", "202502")
    quality = runner.run_quality(spark, "contratos", silver)
    assert quality.where("not approved").count() == 0
    runner.run_gold(spark, "contratos", silver, gold)
    summary = {r["numero_contrato"]: r for r in read_dataset(spark, gold, "contratos_atuais_resumo").collect()}
    c1 = summary["C1"]
    assert (c1["quantidade_registros_atuais"], c1["valor_final_total_grupo"], c1["quantidade_itens_identificados"]) == (2, 1500.5, 1)
    assert (c1["valor_total_itens_identificados"], c1["valor_total_itens_codigo_zero"], c1["quantidade_prorrogacoes"]) == (31.5, 5.0, 1)
    assert (c1["possui_contrato_sigiloso"], c1["grupo_com_acrescimo"], summary["C2"]["grupo_com_reducao"]) == (True, True, True)
    ranks = rows(read_dataset(spark, gold, "ranking_contratados", ["codigo_contratado", "posicao_valor_final"]))
    assert ranks == [("900", 1), ("901", 2)]
    checks = runner.run_reconciliation(spark, "contratos", silver, gold)
    assert checks.count() == 15 and checks.where("not approved").count() == 0
    runner.run_dimensions(spark, "contratos", silver, gold, checks, "202501", "202502")
    assert read_dataset(spark, f"{gold}/dimensions", "dim_tempo").count() == 59
    catalog = runner.run_publish(spark, "contratos", gold, pub, checks)
    assert catalog.where("ok").count() == 8 + 6
    manifest = {r["dataset"]: r for r in read_manifest(spark, silver, "silver").collect()}
    found = manifest["contratos_historico"]
    assert (found["first_period"], found["last_period"], found["input_rows"], found["record_count"], found["removed_rows"]) == ("202501", "202502", 4, 4, 0)
    assert (manifest["itens_contrato"]["input_rows"], manifest["itens_contrato"]["removed_rows"]) == (3, 0)
    control = read_file_control(spark, silver, "silver").where("dataset = 'apostilamentos'")
    assert rows(control.select("period", "input_rows", "output_rows")) == [("202502", 0, 0)]
    # Gold is made anew: its dimensions are older, publishing is refused; and every run keeps its rows.
    runner.run_gold(spark, "contratos", silver, gold)
    assert read_manifest(spark, gold, "gold", all_runs=True).select("run_id").distinct().count() == 2
    with pytest.raises(GateError, match="older"):
        runner.run_publish(spark, "contratos", gold, pub, checks)


def test_failed_quality_stops_gold(spark, tmp_path, contract_files):
    silver = str(tmp_path / "silver")
    put(contract_files / "202502_ItemCompra.csv", ITEM_HEADER, [["10", "ORG", "UG1", "Unidade", "C1", "77", "Item", "", "3", "x"]] * 1)
    runner.run_silver_contracts(spark, str(contract_files), silver, "202501", "202502")
    broken = read_dataset(spark, silver, "contratos_historico").withColumn("chave_registro_contrato", F.lit(None).cast("string"))
    runner.write_layer({**runner.read_layer(spark, silver, "silver"), "contratos_historico": materialize(broken)}, f"{silver}2", "contratos_federais", "silver")
    with pytest.raises(GateError, match="quality"):
        runner.run_gold(spark, "contratos", f"{silver}2", str(tmp_path / "gold"))


def test_an_empty_file_stops_silver(spark, tmp_path, contract_files):
    (contract_files / "202502_Compras.csv").write_bytes(b"")
    with pytest.raises(GateError, match="empty"):
        runner.run_silver_contracts(spark, str(contract_files), str(tmp_path / "silver"), "202501", "202502")


def test_corrupted_gold_is_rejected(spark, tmp_path, contract_files):
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    runner.run_silver_contracts(spark, str(contract_files), silver, "202501", "202502")
    tables = runner.read_layer(spark, silver, "silver")
    marts = contracts.gold(tables)
    marts["ranking_orgaos"] = marts["ranking_orgaos"].limit(0)
    checks = contracts.reconciliation(tables, marts)
    assert rows(checks.where("not approved").select("check")) == [("orgaos_ranking",)]
    runner.run_gold(spark, "contratos", silver, gold)
    with pytest.raises(GateError):
        runner.run_dimensions(spark, "contratos", silver, gold, checks, "202501", "202502")


def test_tenders_end_to_end(spark, tmp_path):
    land, silver, gold = tmp_path / "bronze", str(tmp_path / "silver"), str(tmp_path / "gold")
    parts = ["Número Licitação", "Código UG", "Nome UG", "Código Modalidade Compra", "Modalidade Compra", "Número Processo"]
    head = ["1", "UG1", "Unidade", "5", "Pregão", "P1"]
    put(land / "202301_Licitação.csv", [*parts, "Objeto", "Situação Licitação", "Código Órgão Superior", "Nome Órgão Superior", "Código Órgão",
        "Nome Órgão", "UF", "Município", "Data Resultado Compra", "Data Abertura", "Valor Licitação"],
        [[*head, "Obj", "Ok", "1", "SUP", "10", "ORG", "sp", "São Paulo", "10/01/2023", "05/01/2023", "100,00"]])
    put(land / "202301_ItemLicitação.csv", [*parts, "Código Órgão", "Nome Órgão", "Código Item Compra", "Descrição", "Quantidade Item", "Valor Item",
        "Código Vencedor", "Nome Vencedor"], [[*head, "10", "ORG", "1", "d", "2", "60,00", "900", "ALFA"], [*head, "10", "ORG", "2", "d", "1", "40,00", "900", "ALFA"]])
    put(land / "202301_ParticipantesLicitação.csv", [*parts, "Código Órgão", "Nome Órgão", "Código Item Compra", "Descrição Item Compra",
        "Código Participante", "Nome Participante", "Flag Vencedor"],
        [[*head, "10", "ORG", "1", "d", "900", "ALFA", "SIM"], [*head, "10", "ORG", "1", "d", "901", "BETA", "NÃO"]])
    put(land / "202301_EmpenhosRelacionados.csv", [*parts, "Código Empenho", "Data Emissão Empenho", "Observação Empenho", "Valor Empenho (R$)"],
        [[*head, "E1", "11/01/2023", "x", "100,00"]])
    runner.run_silver_tenders(spark, str(land), silver, "202301", "202301")
    quality = runner.run_quality(spark, "licitacoes", silver)
    assert quality.where("not approved").count() == 0
    runner.run_gold(spark, "licitacoes", silver, gold)
    one = read_dataset(spark, gold, "concorrencia_licitacoes").first()
    assert (one["quantidade_participantes"], one["quantidade_vencedores"], one["valor_itens_vencedores"], one["uf"]) == (2, 1, 100.0, "SP")
    checks = runner.run_reconciliation(spark, "licitacoes", silver, gold)
    assert checks.count() == 20 and checks.where("not approved").count() == 0
    runner.run_dimensions(spark, "licitacoes", silver, gold, checks)
    assert read_dataset(spark, f"{gold}/dimensions", "dim_tempo").count() == 6


def test_history_and_agreements(spark, tmp_path):
    values = {h: "1" for hs in amendments.HEADERS.values() for h in hs}
    values |= {"Ano da Emenda": "2025", "Código da Emenda": "202500010001", "Valor Empenhado": "100,00", "Valor Pago": "25,00",
               "Valor Liquidado": "50,00", "Data Publicação Convênio": "01/02/2025", "Valor Convênio": "10,00", "Ano/Mês": "202503", "UF": "SP"}
    files = {}
    for entity, headers in amendments.HEADERS.items():
        line = [values[h] for h in headers]
        put(tmp_path / f"{entity}.csv", headers, [line, line])
        files[entity] = str(tmp_path / f"{entity}.csv")
    silver = str(tmp_path / "silver")
    runner.run_silver_history(spark, files, silver, [2025])
    tables = runner.read_layer(spark, silver, "silver")
    assert {name: df.count() for name, df in tables.items()} == {"emendas": 1, "convenios": 1, "favorecidos": 1}
    assert tables["emendas"].first()["percentual_pago"] == 25.0
    for domain, count in (("emendas", 4), ("convenios", 15)):
        gold = str(tmp_path / f"gold_{domain}")
        runner.run_gold(spark, domain, silver, gold)
        checks = runner.run_reconciliation(spark, domain, silver, gold)
        assert checks.count() == count
        runner.run_dimensions(spark, domain, silver, gold, checks, as_of_year=2026)
    assert rows(read_dataset(spark, f"{tmp_path}/gold_emendas/dimensions", "dim_ano")) == [(2025, False, "Encerrado")]
    assert runner.run_quality(spark, "convenios", silver).where("not approved").count() == 0


def test_deputy_expenses(spark, tmp_path):
    columns = deputy_expenses.SOURCE_COLUMNS
    base = dict.fromkeys(columns, "1") | {"datEmissao": "2025-03-01T10:00:00", "vlrDocumento": "10.5", "vlrGlosa": "0", "vlrLiquido": "10.5",
                                           "numMes": "3", "numAno": "2025", "vlrRestituicao": "", "datPagamentoRestituicao": ""}
    refund = base | {"vlrLiquido": "-3", "numSubCota": "998", "cpf": "", "ideCadastro": "", "nuCarteiraParlamentar": ""}
    put(tmp_path / "bronze" / "ano=2025" / "Ano-2025.csv", columns, [[base[c] for c in columns], [refund[c] for c in columns]], "utf-8")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    runner.run_silver_deputy_expenses(spark, str(tmp_path / "bronze"), silver)
    table = read_dataset(spark, silver, "despesas")
    assert table.columns == deputy_expenses.OUTPUT and len(table.columns) == 49
    got = rows(table.select("linha_arquivo", "tipo_movimento", "tipo_beneficiario", "chave_despesa"))
    assert got == [(2, "DESPESA", "PARLAMENTAR", "2025|Ano-2025.csv|2"), (3, "ESTORNO_AEREO", "LIDERANCA_OU_ORGAO", "2025|Ano-2025.csv|3")]
    quality = runner.run_quality(spark, "gastos_deputados", silver, [2025])
    assert quality.count() == 13 and quality.where("not approved").count() == 0
    runner.run_gold(spark, "gastos_deputados", silver, gold, [2025])
    checks = runner.run_reconciliation(spark, "gastos_deputados", silver, gold)
    assert checks.count() == 18 and checks.where("not approved").count() == 0
    runner.run_dimensions(spark, "gastos_deputados", silver, gold, checks)


CHAMBER = {
    "proposicoes": (["id", "siglaTipo", "numero", "ano", "codTipo", "ementa", "urlInteiroTeor", "dataApresentacao", "ultimoStatus_dataHora"],
                    ["1", "PL", "10", "2025", "139", "Ementa", "", "2025-02-03T10:00", "2025-03-01T00:00"]),
    "proposicoes_temas": (["uriProposicao", "numero", "ano", "codTema", "tema", "relevancia"], ["http://x/1", "10", "2025", "40", "Economia", "0"]),
    "proposicoes_autores": (["idProposicao", "idDeputadoAutor", "codTipoAutor", "tipoAutor", "nomeAutor", "ordemAssinatura", "proponente",
                             "siglaPartidoAutor", "siglaUFAutor"], ["1", "", "2", "Órgão", "Mesa", "1", "1", "", "SP"]),
    "votacoes": (["id", "data", "dataHoraRegistro", "idOrgao", "siglaOrgao", "votosSim", "votosNao", "votosOutros", "aprovacao"],
                 ["9-1", "2025-02-04", "2025-02-04T12:00:00", "180", "PLEN", "3", "", "1", "1"]),
    "votacoes_orientacoes": (["idVotacao", "siglaBancada", "orientacao"], ["9-1", "", "Sim"]),
    "votacoes_votos": (["idVotacao", "dataHoraVoto", "voto", "deputado_id", "deputado_nome", "deputado_siglaPartido", "deputado_siglaUf"],
                       ["9-1", "2025-02-04T12:01:00", "Abstenção", "5", "Ana", "", "SP"]),
    "votacoes_objetos": (["idVotacao", "data", "proposicao_id"], ["9-1", "2025-02-04", "1"]),
    "votacoes_proposicoes": (["idVotacao", "data", "proposicao_id"], ["9-1", "2025-02-04", ""]),
}


def test_chamber_end_to_end(spark, tmp_path):
    for dataset, (header, line) in CHAMBER.items():
        put(tmp_path / "bronze" / f"dataset={dataset}" / "ano=2025" / f"{dataset}-2025.csv", header, [line], "utf-8")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    runner.run_silver_chamber(spark, str(tmp_path / "bronze"), silver)
    runner.run_gold(spark, "proposicoes_votacoes", silver, gold)
    vote = read_dataset(spark, gold, "fato_votos").first()
    assert (vote["categoria_voto"], vote["chave_voto"], vote["chave_registro"]) == (
        "ABSTENCAO", "9-1|5|2025-02-04 12:01:00.000000|2", "votacoes_votos|2025|votacoes_votos-2025.csv|2",
    )
    author = read_dataset(spark, gold, "rel_proposicoes_autores").first()
    assert (author["categoria_autor"], author["sigla_uf_autor"]) == ("ÓRGÃO", "SP")
    marts = runner.read_layer(spark, gold, "gold")
    assert chamber.quality(marts, True, True).where("not passed").count() == 0
    assert chamber.quality(marts, True, False).where("not passed").count() == 1
    assert runner.run_quality(spark, "proposicoes_votacoes", silver, gold=gold).where("not passed").count() == 0
    checks = runner.run_reconciliation(spark, "proposicoes_votacoes", silver, gold)
    assert checks.count() == 12 and checks.where("not approved").count() == 0
    runner.run_dimensions(spark, "proposicoes_votacoes", silver, gold, checks)
    assert read_dataset(spark, f"{gold}/dimensions", "dim_tempo").count() == 2
    # Silver is read anew: Gold no longer comes from the newest run, so the suite stops the dimensions.
    runner.run_silver_chamber(spark, str(tmp_path / "bronze"), silver)
    with pytest.raises(GateError, match="quality"):
        runner.run_dimensions(spark, "proposicoes_votacoes", silver, gold, checks)


def test_senate_end_to_end(spark, tmp_path):
    bronze = tmp_path / "bronze"

    def doc(dataset, name, content):
        path = bronze / f"dataset={dataset}" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(content, ensure_ascii=False), encoding="utf-8")

    person = {"CodigoParlamentar": "5", "NomeParlamentar": "Ana", "NomeCompletoParlamentar": "Ana Lima", "SiglaPartidoParlamentar": "P1",
              "UfParlamentar": "SP", "SexoParlamentar": "Feminino"}
    doc("senadores", "senadores_atuais.json", {"ListaParlamentarEmExercicio": {"Parlamentares": {"Parlamentar": [
        {"IdentificacaoParlamentar": person, "Mandato": {"CodigoMandato": "1", "Suplentes": [{"x": 1}]}}]}}})
    bill = {"Codigo": "70", "Numero": "1", "Ano": "2025", "Sigla": "PL", "Data": "2025-02-01", "Ementa": "E", "Autor": "A",
            "IdentificacaoProcesso": "8", "DescricaoIdentificacao": "PL 1/2025", "SiglaComissao": "CCJ", "UrlDetalheMateria": "u"}
    doc("materias", "materias.json", {"PesquisaBasicaMateria": {"Materias": {"Materia": [bill]}}})
    vote = {"codigoParlamentar": 5, "nomeParlamentar": "Ana", "siglaPartidoParlamentar": "P1", "siglaUFParlamentar": "SP", "sexoParlamentar": "F",
            "siglaVotoParlamentar": "Sim"}
    voting = {"codigoSessaoVotacao": 3, "codigoMateria": 70, "dataSessao": "2025-02-05", "resultadoVotacao": "A", "totalVotosSim": 1,
              "totalVotosNao": None, "totalVotosAbstencao": 0, "informeLegislativo": {"data": "2025-02-05"}}
    doc("votacoes", "votacoes.json", [voting | {"votos": [vote, vote | {"codigoParlamentar": 6, "nomeParlamentar": "Bia"}]}, voting | {"codigoSessaoVotacao": 4, "votos": []},
                                      voting | {"codigoSessaoVotacao": 5}])
    header = ["ID", "TIPO_DOCUMENTO", "ANO", "MES", "COD_SENADOR", "NOME_SENADOR", "TIPO_DESPESA", "CPF_CNPJ_FORNECEDOR", "NOME_FORNECEDOR",
              "DOCUMENTO", "DATA", "DETALHAMENTO", "VALOR_REEMBOLSADO"]
    put(bronze / "dataset=ceaps" / "ano=2025" / "ceaps_2025.csv", ["﻿" + header[0], *header[1:]],
        [["1", "NF", "2025", "2", "5", "Ana", "Passagens", "12.345.678/0001-00", "ALFA", "1", "2025-02-03", "", "1.000,50"],
         ["2", "NF", "2025", "3", "7", "Caio", "Passagens", "", "ALFA", "1", "1925-03-10", "", "10,00"]], "utf-8")
    put(bronze / "dataset=empresas_contratadas" / "empresas.csv", ["codigo", "cnpj_cpf", "nome"], [["1", "123", "ALFA"]], "utf-8")
    silver, gold = str(tmp_path / "silver"), str(tmp_path / "gold")
    runner.run_silver_senate(spark, str(bronze), silver)
    tables = runner.read_layer(spark, silver, "silver")
    assert (tables["votacoes"].count(), tables["votos"].count()) == (3, 2)
    assert rows(tables["ceaps"].select("chave_registro", "valor_reembolsado")) == [("ceaps|1", 1000.5), ("ceaps|2", 10.0)]
    runner.run_gold(spark, "senado_federal", silver, gold)
    repaired = rows(read_dataset(spark, gold, "fato_gastos_senadores").selectExpr("id_gasto", "string(data_referencia)", "data_referencia_ajustada"))
    assert repaired == [(1, "2025-02-03", False), (2, "2025-03-10", True)]
    checks = runner.run_reconciliation(spark, "senado_federal", silver, gold)
    assert checks.count() == 16 and checks.where("not passed").count() == 0
    runner.run_dimensions(spark, "senado_federal", silver, gold, checks)
    dims = runner.read_layer(spark, f"{gold}/dimensions", "dimensions")
    assert rows(dims["dim_senador"].select("id_senador", "nome_completo", "senador_em_exercicio")) == [(5, "Ana Lima", True), (6, None, False), (7, None, False)]
    star = runner.read_layer(spark, gold, "gold") | dims
    verdicts = {r["name"]: r["approved"] for r in senate.validate_star(star).collect()}
    assert len(verdicts) == 14 and all(verdicts.values())
    assert read_dataset(spark, f"{gold}/quality", "votacoes_sem_materia").count() == 0
    assert rows(read_dataset(spark, f"{gold}/quality", "parlamentares_identificados_nos_votos", ["codigo_parlamentar"])) == [(5,), (6,)]
    assert runner.run_publish(spark, "senado_federal", gold, str(tmp_path / "pub"), checks).where("not ok").count() == 0
    assert read_dataset(spark, f"{gold}/quality", "validacao_relacionamentos").count() == 14


def test_unapproved_silver_blocks_gold(spark, tmp_path):
    silver = str(tmp_path / "silver")
    runner.write_layer({"convenios": spark.createDataFrame([(1,)], "k int")}, silver, "x", "silver", approved=False)
    with pytest.raises(GateError):
        runner.run_gold(spark, "convenios", silver, str(tmp_path / "gold"))


def test_period_row_control_keeps_empty_files(spark, contract_files):
    raw, files = runner._period_files(spark, str(contract_files), runner.landing.CONTRACT_ENTITIES, contracts.SILVER, "202501", "202502")
    assert raw["contratos"].count() == 4
    apostilles = delimited.read_delimited(spark, f"{contract_files}/202502_Apostilamento.csv", ["Número Contrato", "Código UG"])
    control = delimited.row_control(apostilles, raw["apostilamentos"], files.where("entity = 'apostilamentos'").select("file"))
    assert rows(control.select("period", "input_rows", "output_rows")) == [("202502", 0, 0)]


def test_a_missing_entity_is_reported(spark, contract_files):
    with pytest.raises(FileNotFoundError, match="termos_aditivos"):
        runner._period_files(spark, str(contract_files), runner.landing.CONTRACT_ENTITIES, contracts.SILVER, "202501", "202501")


def test_a_layer_changes_only_when_its_run_is_committed(spark, tmp_path):
    root = str(tmp_path / "silver")
    layer = lambda n: {"a": spark.range(n), "b": spark.range(2 * n)}
    sizes = lambda: {name: df.count() for name, df in runner.read_layer(spark, root, "silver").items()}
    runner.write_layer(layer(3), root, "x", "silver")
    dies = layer(5) | {"b": spark.range(9).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))}
    with pytest.raises(Exception, match="lost"):
        runner.write_layer(dies, root, "x", "silver")
    held = read_dataset(spark, root, "a")
    assert sizes() == {"a": 3, "b": 6} and held.count() == 3
    for n in (7, 8):
        runner.write_layer(layer(n), root, "x", "silver")
    # Readers of an earlier run go on until it is swept.
    assert sizes() == {"a": 8, "b": 16} and read_dataset(spark, root, "b").count() == 16 and held.count() == 3
    gone = sweep(spark, root, "silver")
    assert len(gone) == 2 and len(list((tmp_path / "silver" / "a" / "runs").iterdir())) == 2 and sizes() == {"a": 8, "b": 16}
    assert sweep(spark, root, "silver") == []


def test_publication_is_committed_by_its_catalog(spark, tmp_path):
    gold, target = str(tmp_path / "gold"), str(tmp_path / "pub")
    for n in (2, 4):
        runner.write_layer({"ranking_x": spark.range(n), "rascunho": spark.range(1)}, gold, "d", "gold")
        assert find_marts(spark, gold) == ["ranking_x"]
        run = new_run_id()
        write_catalog(publish(spark, "d", gold, target, ["ranking_x"], "gold", run), target, "d", run)
        shown = read_catalog(spark, target, "d").first()
        assert (shown["table"], shown["rows"], spark.read.parquet(shown["path"]).count()) == ("d_ranking_x", n, n)
    # Tables alone, without a catalog, are not published.
    publish(spark, "d", gold, target, ["rascunho"], "gold", new_run_id())
    assert read_catalog(spark, target, "d").count() == 1
