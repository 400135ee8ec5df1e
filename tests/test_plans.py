from datetime import datetime

import pytest
from pyspark.sql import functions as F

from canteiro.functions.ids import surrogate_key
from canteiro.plans import cleaning, contracts, features, ingest, quality, structured, suppliers, works
from canteiro.routes import ROUTES, RAW_TABLES, Route, check_routes, column_names

AS_OF = datetime(2026, 1, 1)
RAW_CONTRACT = (
    "id_contrato string, fonte string, cnpj_fornecedor string, nome_fornecedor string, objeto string, "
    "modalidade string, situacao string, valor_inicial double, valor_global double, valor_aditivos double, "
    "qtd_aditivos int, data_assinatura string, data_inicio_vigencia string, data_fim_vigencia string"
)


@pytest.fixture
def as_of(spark):
    return F.lit(AS_OF).cast("timestamp")


@pytest.fixture
def raw_contracts(spark):
    f = "tce_rj_contratos"
    return spark.createDataFrame(
        [
            ("C1", f, "111", "Alfa antiga", "Construção de escola no BAIRRO Lagomar, MACAÉ", "m", None, 100000.0, 1.0, 0.0, 0, "2020-01-01", None, "2020-12-31"),
            ("C2", f, " 111 ", "Alfa", "Reforma da praça", "m", "Vigente", 200000.0, 1.0, 50000.0, 2, "2021-05-01", "2021-06-01", "2030-01-01"),
            ("C3", f, "222", None, "Compra de papel", "m", "nan", None, 1.0, 10.0, 1, None, None, None),
            ("C4", f, None, "x", "Pavimentação", "m", "", 5.0, 1.0, None, None, "2019-01-01", None, None),
        ],
        RAW_CONTRACT,
    )


def test_routes_are_consistent():
    assert check_routes() == []
    assert len(ROUTES) == 17 and len(RAW_TABLES) == 12
    broken = {"x": Route("raw_sinapi", "s", ("uf",), ()), "y": Route("raw_sinapi", "s", ("nada",), ("nada",)), "z": Route("t", "s", (), ())}
    assert len(check_routes(broken)) == 5


def test_suppliers(raw_contracts):
    got = {r.cnpj: r for r in suppliers.suppliers(raw_contracts).collect()}
    assert set(got) == {"111", "222"}
    alfa = got["111"]
    assert (alfa.razao_social, alfa.total_contratos, alfa.valor_total, alfa.anos_atuacao) == ("Alfa", 2, 300000.0, 2)
    assert (alfa.primeiro_contrato, alfa.ultimo_contrato) == (datetime(2020, 1, 1), datetime(2021, 5, 1))
    assert alfa.taxa_aditivo == 50.0
    other = got["222"]
    assert (other.razao_social, other.valor_total, other.taxa_aditivo) == ("Fornecedor 222", 0.0, 100.0)
    assert other.primeiro_contrato is None and other.anos_atuacao == 0


def test_amended_flag(spark):
    frame = spark.createDataFrame(
        [("1", "Sim"), ("1", "1º Aditivo"), ("1", "Contrato Original"), ("1", None)], "cnpj_fornecedor string, possui_aditivo string"
    )
    assert suppliers.suppliers(frame).first().taxa_aditivo == 50.0
    assert suppliers.suppliers(frame, parity=True).first().taxa_aditivo == 25.0


def test_works_from_contracts(raw_contracts):
    got = {r.id_origem: r for r in works.from_contracts(raw_contracts).collect()}
    assert set(got) == {"C1", "C2", "C4"}
    assert got["C1"].bairro == "Lagomar" and got["C1"].situacao == "Indefinido"
    assert got["C1"].data_inicio == datetime(2020, 1, 1) and got["C2"].data_inicio == datetime(2021, 6, 1)
    assert got["C2"].tipo == "Obra Municipal" and got["C2"].situacao == "Em andamento"


def test_works_from_health(spark, as_of):
    frame = spark.createDataFrame(
        [
            (1, "UBS A", "Construção", "Em funcionamento", "2014-07-13", None, "2014-08-05"),
            (2, " ", "Reforma", "x", None, "2014-07-13", None),
            (3, None, "", None, None, None, None),
        ],
        "proposta_id long, nome_estabelecimento string, tipo_obra string, situacao string, "
        "dt_prevista_conclusao_final string, dt_prevista_conclusao string, dt_conclusao_final string",
    )
    got = {r.id_origem: r for r in works.finished(works.from_health(frame), as_of).collect()}
    assert [got[i].nome for i in "123"] == ["UBS A", "Reforma", "Obra SISMOB 3"]
    assert got["1"].dias_atraso == 23 and got["1"].percentual_executado == 100.0
    assert got["2"].data_prevista_fim == datetime(2014, 7, 13) and got["3"].dias_atraso is None


def test_works_from_map_and_stopped(spark):
    frame = spark.createDataFrame(
        [("Ponte", "R$ 2.378.752", "2022-07-01", "360 DIAS"), ("Praça", None, None, "Dezembro/2023")],
        "nome_obra string, valor string, data_inicio string, previsao_termino string",
    )
    got = {r.nome: r for r in works.from_map(frame).collect()}
    assert got["Ponte"].valor_contrato == 2378752.0 and got["Ponte"].data_prevista_fim == datetime(2023, 6, 26)
    assert got["Praça"].data_prevista_fim == datetime(2023, 12, 1)
    stopped = spark.createDataFrame(
        [("o", None, None, "Educação", None, 100.0, 52.0), ("p", "Creche", "SEMED", "Educação", 0.0, 100.0, 250.0)],
        "id_obra string, tipo_obra string, orgao string, funcao_governo string, percentual_executado double, "
        "valor_contrato double, valor_pago_obra double",
    )
    got = {r.id_origem: r for r in works.from_stopped(stopped).collect()}
    assert (got["o"].percentual_executado, got["o"].tipo, got["o"].secretaria) == (52.0, "Obra Paralisada", "Educação")
    assert (got["p"].percentual_executado, got["p"].secretaria, got["p"].situacao) == (0.0, "SEMED", "Paralisada")


def legacy(spark, *numbers):
    return spark.createDataFrame(
        [(f"L{i}", "Obra", "Concluída", n) for i, n in enumerate(numbers)],
        "id_obra string, nome_obra string, situacao string, num_licitacao string",
    )


def test_federal_enrichment(spark, as_of):
    terms = spark.createDataFrame(
        [("900", 2, 10.0, "Prestação de Contas Aprovada", "2019-06-30", "2014-06-30"), ("901", 1, 0.0, "Em execução", "2019-06-30", "2014-06-30")],
        "nr_convenio string, qtd_aditivos int, valor_aditivos double, situacao string, data_fim_vigencia string, data_fim_vigencia_original string",
    )
    raw = {"raw_obras_legado": legacy(spark, "900", "901", None), "raw_aditivos_federais": terms}
    got = {r.id_origem: r for r in works.works(raw, as_of)[0].collect()}
    assert (got["L0"].dias_atraso, got["L0"].valor_aditivos, got["L0"].qtd_aditivos) == (1826, 10.0, 2)
    assert (got["L1"].data_conclusao, got["L1"].valor_aditivos, got["L1"].data_prevista_fim) == (None, 0.0, None)
    assert got["L2"].qtd_aditivos is None

    real = spark.createDataFrame(
        [("900", "2018-01-01", "Concluído"), ("901", "2018-01-01", "ANULADO"), ("902", "2099-01-01", "Concluído")],
        "nr_convenio string, data_conclusao string, situacao string",
    )
    raw = {"raw_obras_legado": legacy(spark, "900", "901", "902"), "raw_aditivos_federais": terms, "raw_convenios_federais": real}
    got = {r.id_origem: r for r in works.works(raw, as_of)[0].collect()}
    assert got["L0"].data_conclusao == datetime(2018, 1, 1)
    assert got["L1"].data_conclusao is None and got["L2"].data_conclusao is None


def test_works_without_id_are_rejected(spark, as_of):
    frame = spark.createDataFrame([("1", "a"), (None, "b"), ("1", "c")], "id_obra string, nome_obra string")
    kept, rejected = works.works({"raw_obras_atual": frame}, as_of)
    assert [r.nome for r in kept.collect()] == ["a"]
    assert [r.nome for r in rejected.collect()] == ["b"]


def test_gazetteer(spark):
    gazetteer = spark.createDataFrame(
        [
            ("Rua A, Centro, Macaé, RJ, Brasil", -22.3, -41.7),
            ("Rua B, Centro, Macaé, RJ, Brasil", None, None),
            ("Rua C, Centro, Macaé, RJ, Brasil", 10.0, 10.0),
            ("Centro, Macaé, RJ, Brasil", -22.4, -41.8),
            ("Rua D, Macaé, RJ, Brasil", -22.5, -41.9),
        ],
        "consulta string, latitude double, longitude double",
    )
    frame = spark.createDataFrame(
        [(1, "Rua A", "Centro", None, None), (2, "Rua B", "Centro", None, None), (3, "Rua C", "Centro", None, None),
         (4, "Rua D", None, None, None), (5, None, None, None, None), (6, "Rua A", "Centro", 1.0, 2.0)],
        "i int, endereco string, bairro string, latitude double, longitude double",
    )
    got = {r.i: (r.latitude, r.longitude) for r in works.with_gazetteer(frame, gazetteer).collect()}
    assert got == {1: (-22.3, -41.7), 2: (-22.4, -41.8), 3: (-22.4, -41.8), 4: (-22.5, -41.9), 5: (None, None), 6: (1.0, 2.0)}


def test_contracts_and_amendments(spark, raw_contracts, as_of):
    linked = raw_contracts.withColumn("num_licitacao", F.when(F.col("id_contrato") == "C2", F.lit("T9")))
    works_df = works.finished(works.from_contracts(linked), as_of)
    suppliers_df = suppliers.suppliers(linked)
    got, rejected = contracts.contracts(linked, works_df, suppliers_df, as_of)
    by_id = {r.id_contrato_origem: r for r in got.collect()}
    assert set(by_id) == {"C1", "C2", "C4"}
    assert [r.id_contrato for r in rejected.collect()] == ["C3"]
    assert (by_id["C1"].situacao, by_id["C2"].situacao, by_id["C4"].situacao) == ("Expirado", "Vigente", "Indefinido")
    assert by_id["C2"].numero == "T9" and by_id["C1"].numero == "C1"
    assert by_id["C2"].id_fornecedor == by_id["C1"].id_fornecedor and by_id["C4"].id_fornecedor is None
    assert (by_id["C4"].qtd_aditivos, by_id["C2"].qtd_aditivos) == (0.0, 2.0)
    amended, lost = contracts.amendments(linked, got)
    assert [(r.valor, r.tipo) for r in amended.collect()] == [(50000.0, "Consolidado")]
    assert [r.id_contrato for r in lost.collect()] == ["C3"]
    assert contracts.amendments(linked, got, parity=True)[0].count() == 0


def test_features(spark, raw_contracts, as_of):
    works_df = works.finished(works.from_contracts(raw_contracts), as_of)
    contracts_df, _ = contracts.contracts(raw_contracts, works_df, suppliers.suppliers(raw_contracts), as_of)
    table = features.features(works_df, contracts_df, as_of, F.lit(1000))
    key = {r.id: r.id_origem for r in works_df.select("id", "id_origem").collect()}
    got = {key[r.id_obra]: r for r in table.collect()}
    assert (got["C2"].valor_total, got["C2"].percentual_aditivo, got["C2"].valor_por_habitante) == (250000.0, 25.0, 250.0)
    assert (got["C1"].duracao_prevista_dias, got["C1"].duracao_real_dias) == (365, None)
    assert got["C1"].flag_atrasada is True and got["C2"].flag_atrasada is False and got["C4"].flag_atrasada is None
    assert got["C1"].flag_fornecedor_unico is True and got["C4"].flag_fornecedor_unico is None


def test_clean(spark, as_of):
    frame = spark.createDataFrame(
        [("1", "C1", "15/03/2026", "04.252.011/0001-10", "R$ 1.000,50", "-95", None), ("2", "C1", "x", "123", "7", "10", " "),
         ("3", None, None, None, None, None, "Rio"), ("4", None, None, None, None, None, "Rio")],
        "seq string, id_contrato string, data_assinatura string, cnpj string, valor string, latitude string, municipio string",
    )
    got = cleaning.clean(frame, as_of, order=["seq"]).orderBy("seq").collect()
    assert [r.seq for r in got] == ["1", "3"]  # the two id-less rows are equal
    first = got[0]
    assert (first.data_assinatura, first.cnpj, first.valor) == (datetime(2026, 3, 15), "04252011000110", 1000.5)
    assert (first.latitude, first.municipio, first.fonte, first.coletado_em) == (None, "Macae", "desconhecida", AS_OF)


def test_raw_rows(spark, as_of):
    frame = spark.createDataFrame(
        [(0, "C1", "10,5", "e", None), (1, "C1", "11", "f", ""), (2, None, "1", "g", "9")],
        "_row int, id_contrato string, valor_contrato string, campo_extra string, municipio_ibge string",
    )
    batch, rejected = ingest.raw_rows(frame, ROUTES["tce_contratos"], as_of, order=("_row",))
    row = batch.collect()
    assert len(row) == 1 and rejected.count() == 1
    assert (row[0].valor_inicial, row[0].municipio_ibge, row[0].fonte) == (10.5, "3302403", "tce_rj_compras_diretas")
    assert "campo_extra" not in batch.columns and "campo_extra" in row[0].payload_bruto
    assert set(batch.columns) <= set(column_names("raw_contratos"))


def test_ingest_and_structured_run(spark, as_of, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    (landed / "tce_contratos.json").write_text(
        '{"metadata": {"nome": "x"}, "dados": ['
        '{"id_contrato": "C1", "objeto": "Obra da ponte", "valor_contrato": "R$ 1.000,00", "valor_aditivos": "10", "cnpj_fornecedor": "04.252.011/0001-10"},'
        '{"id_contrato": "C1", "objeto": "Obra da ponte", "valor_contrato": "R$ 2.000,00", "valor_aditivos": null, "cnpj_fornecedor": null},'
        '{"id_contrato": "C2", "objeto": "Papel", "valor_contrato": "3", "valor_aditivos": null, "cnpj_fornecedor": null}]}',
        encoding="utf-8",
    )
    (landed / "painel_atual.json").write_text('[{"id_obra": "P1", "nome_obra": "Escola", "situacao": "Entregue"}]', encoding="utf-8")
    (landed / "sinapi.csv").write_text("uf,competencia,tipo_obra,custo_m2\nRJ,2026-01,ubs,3200.00\nRJ,2026-01,upa,3500.00\n", encoding="utf-8")
    (landed / "desconhecido.json").write_text('[{"a": 1}]', encoding="utf-8")
    (landed / "egim.json").write_text('[{"nome_obra": "sem coordenada"}]', encoding="utf-8")
    log = {r.dataset: r for r in ingest.ingest_folder(spark, str(landed), str(tmp_path / "raw"), as_of).collect()}
    assert {n: r.status for n, r in log.items()} == {
        "tce_contratos": "ok", "painel_atual": "ok", "sinapi": "ok", "desconhecido": "ignorado", "egim": "erro",
    }
    assert (log["tce_contratos"].qtd_registros, log["sinapi"].qtd_registros) == (2, 2)
    outcome = structured.run(spark, str(tmp_path / "raw"), str(tmp_path / "structured"), as_of)
    assert {n: (o.version, o.error) for n, o in outcome.items()} == dict.fromkeys(("fornecedores", "obras", "contratos", "aditivos"), (1, None))
    assert (outcome["contratos"].written, outcome["contratos"].rejected) == (1, 1)
    lost = spark.read.parquet(str(tmp_path / "structured" / "rejeitados")).collect()
    assert [(r.tabela, r.motivo) for r in lost] == [("contratos", "sem obra")] and "C2" in lost[0].registro
    read = lambda name: structured.VersionedTable(spark, str(tmp_path / "structured" / name)).read()
    assert read("obras").count() == 2
    assert read("contratos").count() == 1 and read("aditivos").first().valor == 10.0
    assert read("fornecedores").first().cnpj == "04252011000110"
    assert structured.run(spark, str(tmp_path / "raw"), str(tmp_path / "structured"), as_of)["obras"].version == 2
    assert read("obras").count() == 2
    sections = quality.report({"obras": read("obras"), "contratos": read("contratos"), "raw_contratos": structured.read_sources(spark, str(tmp_path / "raw" / "raw_contratos"))})
    assert sections["obras_sem_percentual"].isEmpty() and sections["contratos_sem_situacao"].isEmpty()
    assert sections["cobertura_raw_contratos"].first().total == 2
    assert sections["contagens"].count() == 3


def test_no_row_vanishes_from_a_load(spark, as_of, tmp_path):
    landed, raw = tmp_path / "landed", str(tmp_path / "raw")
    landed.mkdir()
    (landed / "sinapi.csv").write_text(
        "uf;competencia;tipo_obra;custo_m2\nRJ;2026-01;ubs;1\nRJ;2026-01;ubs;2\n;;x;3\nRJ;2026-01;a;b;c\n", encoding="utf-8"
    )
    (landed / "tce_contratos.jsonl").write_text('{"id_contrato": "C1", "data_assinatura": "logo"}\n{broken\n{"id_contrato": null, "objeto": "o"}\n', encoding="utf-8")
    (landed / "painel_atual.json").write_text("[]", encoding="utf-8")
    (landed / "tce_licitacoes.csv").write_text("no separator\nhere\n", encoding="utf-8")
    (landed / "sismob.json").write_text('[{"a": 1, "A": 2}]', encoding="utf-8")
    log = {r.dataset: r for r in ingest.ingest_folder(spark, str(landed), raw, as_of).collect()}
    assert {n: r.status for n, r in log.items()} == {
        "sinapi": "ok", "tce_contratos": "ok", "painel_atual": "vazio", "tce_licitacoes": "erro", "sismob": "erro",
    }
    counts = {n: (r.qtd_lidos, r.qtd_registros, r.qtd_substituidos, r.qtd_erros) for n, r in log.items()}
    assert counts["sinapi"] == (4, 1, 1, 2) and counts["tce_contratos"] == (3, 1, 0, 2)
    assert log["tce_contratos"].datas_ilegiveis == {"data_assinatura": 1}
    lost = spark.read.parquet(f"{raw}/rejeitados").collect()
    assert sorted((r.dataset, r.motivo) for r in lost) == [
        ("sinapi", "registro ilegível"), ("sinapi", "sem chave"), ("tce_contratos", "registro ilegível"), ("tce_contratos", "sem chave"),
    ]
    assert {r.registro for r in lost if r.motivo == "registro ilegível"} == {"RJ;2026-01;a;b;c", "{broken"}


def test_extracts_as_sources_give_them(spark, as_of, tmp_path):
    from canteiro.plans.extracts import BY_RECORD, NORMALISERS

    landed, raw = tmp_path / "landed", str(tmp_path / "raw")
    landed.mkdir()
    extracts = {
        "tce_rj_contratos": '[{"Ente": "MACAÉ", "NumeroContrato": "1", "ValorContrato": "1.000,50"}, {"Ente": "X", "NumeroContrato": "2"}]',
        "tce_rj_aditivos": '[{"Ente": "MACAE", "NumeroConvenio": "7", "AnoConvenio": "2020", "QuantidadeAditivos": "1"}]',
        "tce_rj_obras": '[{"Ente": "MACAE", "NumeroContrato": "9", "DataParalisacao": "2020-01-02", "Nome": "n"}]',
        "tce_contratos": '[{"NumeroContrato": "A", "DataRescisao": "x"}, {"Codigo": "B"}, {"CODIGO": 3, "Codigo": null}]',
        "tce_licitacoes": '[{"ProcessoLicitatorio": "P"}, {"NumeroEdital": "E"}]',
        "portal_macae_contratos": '[{"Contrato": "c", "Objeto": "o", "Valor": "R$ 1,00"}]',
        "portal_macae_licitacoes": '[{"Número": "n", "Objeto": "o"}]',
        "painel_atual": '[{"Id Obra": "i", "Nome da Obra": "n", "Situação": "Em andamento", "Município": "Macaé"}]',
    }
    for name, text in extracts.items():
        (landed / f"{name}.json").write_text(text, encoding="utf-8")
    ingested = ingest.ingest_folder(spark, str(landed), raw, as_of, NORMALISERS, by_record=BY_RECORD)
    log = {r.dataset: r for r in ingested.collect()}
    assert {n: (r.status, r.mensagem) for n, r in log.items() if r.status != "ok"} == {}
    assert {n: r.qtd_registros for n, r in log.items()} == {n: {"tce_contratos": 3, "tce_licitacoes": 2}.get(n, 1) for n in extracts}
    assert log["tce_contratos"].datas_ilegiveis == {"data_rescisao": 1}


def test_structured_tables_are_one_plan(spark, raw_contracts, as_of):
    tables = structured.structured_tables({"raw_contratos": raw_contracts}, as_of)
    assert {n: df.count() for n, df in tables.items()} == {"fornecedores": 2, "obras": 3, "contratos": 3, "aditivos": 1}
    key = tables["obras"].select("id", surrogate_key("fonte_origem", "id_origem").alias("k")).first()
    assert key.id == key.k


def test_incremental_run_equals_the_full_one(spark, data, as_of):
    from canteiro.plans.incremental import changed_keys, refreshed
    from canteiro.queries.consolidation import earlier_contracts, raw_contracts
    from canteiro.queries.registry import Tables

    tables = Tables(spark, data)
    old, new = earlier_contracts(tables).cache(), raw_contracts(tables).cache()
    n = changed_keys(old, new, ["id_contrato", "fonte"]).count()
    assert 0 < n < new.count() / 2
    # the secretariat comes from another column once one contract has it, which reaches all works
    for latest in (new, new.withColumn("secretaria", F.when(F.col("id_contrato") == "33", "SEMED")).withColumn("orgao", F.lit("x"))):
        before = structured.structured_tables({"raw_contratos": old}, as_of)
        got = refreshed(before, old, latest, as_of, lambda df: df.cache())
        full = structured.structured_tables({"raw_contratos": latest}, as_of)
        for name, frame in full.items():
            shape = lambda df, names=frame.columns: sorted(map(repr, df.select(*names).collect()))
            assert shape(got[name]) == shape(frame), name


def test_changed_keys_of_typed_and_of_retyped_cells(spark):
    from canteiro.plans.incremental import changed_keys

    schema = "k string, f string, t timestamp, d date, b boolean, n bigint, v double, s string"
    row = ("1", "a", datetime(2020, 1, 1), datetime(2020, 1, 1).date(), True, 5, 0.5, "x")
    changes = [(), (2, datetime(2020, 1, 1, 0, 0, 0, 1)), (3, datetime(2020, 1, 2).date()), (4, None), (5, 6), (6, 1.5), (7, None), (7, "")]
    was = [(str(i), *row[1:]) for i in range(len(changes))]
    now = [tuple(c[1] if c and c[0] == at else cell for at, cell in enumerate(r)) for r, c in zip(was, changes, strict=True)]
    old, new = spark.createDataFrame(was, schema), spark.createDataFrame(now, schema)
    assert sorted(r.k for r in changed_keys(old, new, ["k", "f"]).collect()) == [str(i) for i in range(1, len(changes))]
    # a cell of another type is the same when its text is
    assert changed_keys(old, old.withColumns({"n": F.col("n").cast("string"), "t": F.col("t").cast("string")}), ["k", "f"]).count() == 0
