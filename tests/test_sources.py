import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from canteiro.operators.records import parsed_records
from canteiro.sources import common, costs, court, federal, files, geography, georef, health, panels, payloads, portal, snapshots

AS_OF = datetime(2026, 1, 1)


@pytest.fixture
def as_of(spark):
    return F.lit(AS_OF).cast("timestamp")


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def names(df):
    return common.record_columns(df)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('[{"a": 1}, {"a": 2}]', [1, 2]),
        ('{"metadata": {"nome": "x"}, "dados": [{"a": 1}, {"a": 3}]}', [1, 3]),
        ('{"a": 7}', [7]),
    ],
)
def test_json_shapes(spark, tmp_path, text, expected):
    rows, rejects = files.read_json_records(spark, write(tmp_path / "x.json", text))
    assert [r.a for r in rows.orderBy(*common.carried(rows)).collect()] == expected
    assert rejects.count() == 0


def test_json_with_schema_and_rejects(spark, tmp_path):
    schema = spark.createDataFrame([], "a string, b string").schema
    path = write(tmp_path / "x.jsonl", '{"a": 1, "b": "z"}\n{broken\n{"a": 2}\n')
    rows, rejects = files.read_json_records(spark, path, schema, lines=True)
    assert sorted((r.a, r.b) for r in rows.collect()) == [("1", "z"), ("2", None)]
    assert [r._corrupt_record for r in rejects.collect()] == ["{broken"]
    assert (rows.count(), rejects.count()) == (2, 1)
    rows, rejects = files.read_json_records(spark, write(tmp_path / "z.json", "no json"), schema)
    assert (rows.count(), rejects.count()) == (0, 1)
    envelope = write(tmp_path / "y.json", '{"metadata": {"n": 1}, "dados": [{"a": "p"}, {"a": "q"}]}')
    rows, _ = files.read_json_records(spark, envelope, schema)
    assert [r.a for r in rows.orderBy("_item").collect()] == ["p", "q"]


MIXED = [
    '{"ProcessoLicitatorio": "P1", "ValorEstimado": 1234.5, "Extra": {"a": [1, "x"]}}',
    '{"processoLicitatorio": "P2", "valorestimado": "R$ 1.234,50", "DataHomologacao": "logo"}',
    '{"NumeroEdital": 7, "Parecer": null, "parecer": "Fracassada", "DataHomologacao": "2020-01-02"}',
    '{"processo_licitatorio": "", "NumeroEdital": "8"}',
    '{"NumeroEdital": "9", "NumeroEdital": "10"}',
    "[1]",
    "{broken",
    None,
]


def test_records_keep_their_own_spellings_and_types(spark, as_of):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(MIXED)], "_row long, t string")
    records, rejects = parsed_records(texts, "t")
    assert sorted(r.t for r in rejects.collect()) == ["[1]", "{broken"]
    rows = {r._row: r for r in court.tenders(records, as_of).collect()}
    assert {k: (r.id_licitacao, r.valor_estimado, r.situacao) for k, r in rows.items()} == {
        0: ("P1", 1234.5, "Indefinido"), 1: ("P2", 1234.5, "Indefinido"), 2: ("7", None, "Fracassada"),
        3: (None, None, "Indefinido"), 4: ("10", None, "Indefinido"),
    }
    assert json.loads(rows[0].payload_bruto)["Extra"] == {"a": [1, "x"]}
    assert [rows[k]._ilegiveis for k in range(3)] == [[], ["data_homologacao"], []]


def test_json_files_lose_no_key(spark, tmp_path, as_of):
    path = write(tmp_path / "x.json", "[" + ",".join(t for t in MIXED[:4]) + "]")
    records, rejects = files.read_records(spark, path)
    assert rejects.count() == 0
    assert [r.id_licitacao for r in court.tenders(records, as_of).orderBy("_item").collect()] == ["P1", "P2", "7", None]
    columns, _ = files.read_json_records(spark, path)
    got = columns.orderBy("_item").collect()
    assert [r.ProcessoLicitatorio for r in got] == ["P1", "P2", None, None]
    assert [r.ValorEstimado for r in got] == ["1234.5", "R$ 1.234,50", None, None]
    assert got[0].Extra.a == ["1", "x"] and [r.Parecer for r in got] == [None, None, "Fracassada", None]
    assert [r.id_licitacao for r in court.tenders(columns, as_of).orderBy("_item").collect()] == ["P1", "P2", "7", None]


def test_court_records_by_name(spark, as_of):
    texts = spark.createDataFrame([('{"Ente": "MACAÉ", "NumeroContrato": 5, "ValorContrato": "1.000,50", "outro": 1}',)], "t string")
    records, _ = parsed_records(texts, "t")
    row = court.contracts(records, as_of).first()
    assert (row.id_contrato, row.valor_contrato, json.loads(row.payload_bruto)["outro"]) == ("5", 1000.5, 1)


def test_csv_is_all_text_in_source_order(spark, tmp_path):
    path = write(tmp_path / "x.csv", "a,b\n01,x\n2,\"y, z\"\n")
    rows, _ = files.read_csv_records(spark, path)
    assert [(r.a, r.b) for r in rows.orderBy(*common.carried(rows)).collect()] == [("01", "x"), ("2", "y, z")]


@pytest.mark.parametrize(
    "separator, encoding", [(";", "utf-8"), (",", "utf-8"), ("\t", "utf-8"), (";", "cp1252"), (";", "utf-8-sig")]
)
def test_delimited(spark, tmp_path, separator, encoding):
    lines = [["Situação", "Preço"], ["Concluída", "€ 5 – já"]]
    path = write(tmp_path / "x.csv", "\n".join(separator.join(line) for line in lines) + "\n", encoding)
    rows, _ = files.read_delimited(spark, path)
    assert names(rows) == ["Situação", "Preço"]
    assert [tuple(r) for r in rows.select("`Situação`", "`Preço`").collect()] == [("Concluída", "€ 5 – já")]


def test_csv_loses_no_row(spark, tmp_path):
    text = 'a;b;c\n1;"two\nlines; ""quoted""";3\n4;5\n\n6;7;8;9\n"";x"y;"z" w\n' + "10;" + "q" * 50_000 + ";12"
    rows, rejects = files.read_csv_records(spark, write(tmp_path / "x.csv", text), ";")
    expected = [("1", 'two\nlines; "quoted"', "3"), ("4", "5", None), (None, 'x"y', "z w"), ("10", "q" * 50_000, "12")]
    assert [tuple(r)[:3] for r in rows.orderBy("_row").collect()] == expected
    # as many rows whichever columns are read
    assert rows.count() == rows.select("a").count() == len(rows.select("c").collect()) == 4
    assert [r._corrupt_record for r in rejects.collect()] == ["6;7;8;9"]


def brute_csv(text, separator):
    """Records of a whole text: a quote opens a cell at its start, and is plain when nothing closes it."""
    import re

    mark = re.escape(separator)
    record = rf'(?:(?:"(?:[^"]++|"")*+")?+[^{mark}\r\n]*+(?:{mark}|(?=[\r\n]|\Z)))++'
    found = [m[0] for m in re.finditer(record, text) if m[0].strip(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0")]
    cell = rf'((?:"(?:[^"]++|"")*+")?+[^{mark}]*+){mark}'
    rows = [re.findall(cell, r + separator) for r in found]
    plain = lambda c: re.sub(r'(?s)^"(.*)"([^"]*)$', r"\1\2", c).replace('""', '"') if re.match(r'(?s)^"(.*)"([^"]*)$', c) else c
    return [[plain(c) or None for c in row] for row in rows]


@pytest.mark.parametrize("seed", range(4))
def test_csv_is_read_by_several_tasks(spark, tmp_path, seed):
    import random

    rng = random.Random(seed)
    pieces = ["a", ";", ";", "\n", "\n", '"', '"', '""', ' "', "\r\n", "é", "xyz", ";\n", '";"']
    texts = {}
    for name in ("p", "q", "r"):
        body = "".join(rng.choice(pieces) for _ in range(150 if name != "r" else 12))
        texts[name] = "c0;c1;c2;c3;c4;c5;c6;c7;c8\n" + body
        write(tmp_path / f"{name}.csv", texts[name])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        for name, text in texts.items():
            rows, rejects = files.read_csv_records(spark, str(tmp_path / f"{name}.csv"), ";")
            if name != "r":
                assert len({r._block for r in rows.select("_block").distinct().collect()}) > 1
            expected = brute_csv(text, ";")[1:]
            fits = [(row + [None] * 9)[:9] for row in expected if len(row) <= 9]
            got = rows.orderBy("_block", "_row", "_item").collect()
            assert [list(r)[:9] for r in got] == fits, name
            assert rejects.count() == len(expected) - len(fits)
        whole, _ = files.read_csv_records(spark, str(tmp_path), ";")
        assert whole.count() == sum(sum(len(r) <= 9 for r in brute_csv(t, ";")[1:]) for t in texts.values())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_without_line_breaks_in_cells_needs_no_shuffle(spark, tmp_path):
    from test_plan_shapes import plan_of

    rows, _ = files.read_csv_records(spark, write(tmp_path / "x.csv", 'a,b\n1,"x, y"\n2,z\n'))
    plan = plan_of(rows)
    assert "Window" not in plan and "hashpartitioning(_block" not in plan
    assert [(r.a, r.b) for r in rows.orderBy("_row").collect()] == [("1", "x, y"), ("2", "z")]


def test_csv_header_names(spark, tmp_path):
    rows, _ = files.read_csv_records(spark, write(tmp_path / "x.csv", "A,a,,\n1,2,3,4\n"))
    assert names(rows) == ["A0", "a1", "_c2", "_c3"]
    rows, rejects = files.read_csv_records(spark, write(tmp_path / "y.csv", ""))
    assert (rows.count(), rejects.count()) == (0, 0)


def test_delimited_without_table(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_delimited(spark, write(tmp_path / "x.csv", "only\none\n"))


def test_dump_drops_byte_order_mark(spark, tmp_path):
    rows, _ = files.read_dump(spark, write(tmp_path / "d.csv", "NR_CONVENIO;X\n1;2\n", "utf-8-sig"))
    assert names(rows) == ["NR_CONVENIO", "X"]


def test_reader_by_suffix_and_listing(spark, tmp_path):
    write(tmp_path / "b.json", '[{"a": 1}]')
    write(tmp_path / "a.csv", "a;b\n1;2\n")
    write(tmp_path / "c.txt", "x")
    found = files.datasets(spark, str(tmp_path))
    assert [n for n, _ in found] == ["b", "a"]
    assert [files.read_by_suffix(spark, p)[0].count() for _, p in found] == [1, 1]
    with pytest.raises(ValueError):
        files.read_by_suffix(spark, str(tmp_path / "c.txt"))
    assert files.datasets(spark, str(tmp_path / "nada")) == []


KML = """<?xml version="1.0" encoding="UTF-8"?>
<kml xmlns="http://www.opengis.net/kml/2.2"><Document><name>Mapa</name>
<Placemark><name>Solto</name><Point><coordinates>-41.7,-22.3,0</coordinates></Point></Placemark>
<Folder><name>Obras concluídas</name>
<Placemark><name>Escola</name><styleUrl>#icon-blue</styleUrl>
<description><![CDATA[<table><tr><td>Obra</td><td>Em andamento</td></tr><tr><td>Início</td><td>Janeiro/2025</td></tr>
<tr><td>Fim</td><td>24 meses</td></tr><tr><td>Valor</td><td>R$ 10</td></tr></table>]]></description>
<Point><coordinates> -41.8,-22.4,0 </coordinates></Point></Placemark>
<Placemark><name>Bairro</name><Polygon/></Placemark></Folder>
<Folder><Placemark><name>Um só</name><MultiGeometry><Point><coordinates>-41.9,-22.5</coordinates></Point></MultiGeometry></Placemark></Folder>
</Document></kml>"""


def test_map_layers(spark, tmp_path, as_of):
    placemarks = files.read_placemarks(spark, write(tmp_path / "m.kml", KML))
    works = {r.nome_obra: r for r in georef.works(georef.parse_placemarks(placemarks), as_of).collect()}
    assert set(works) == {"Solto", "Escola", "Um só"}
    school = works["Escola"]
    assert (school.camada_mapa, school.latitude, school.longitude, school.status) == ("Obras concluídas", -22.4, -41.8, "em andamento")
    assert (school.valor, school.data_inicio, school.percentual) == ("R$ 10", datetime(2025, 1, 1), 50.7)
    assert (works["Um só"].camada_mapa, works["Um só"].status) == ("sem_camada", "indefinido")
    assert works["Solto"].camada_mapa == "Mapa" and works["Solto"].percentual is None


def test_map_layers_nest(spark, tmp_path):
    text = """<kml><Document><name>M</name><Folder><name>Fora</name><Folder><name>Dentro &amp; fundo</name>
<Placemark><name>A</name><Point><coordinates>-41,-22</coordinates></Point></Placemark></Folder>
<Placemark><name>B</name><Point><coordinates>-41,-22</coordinates></Point></Placemark></Folder>
<Placemark><name>C</name><Point><coordinates>-41,-22</coordinates></Point></Placemark></Document></kml>"""
    rows, _ = files.read_by_suffix(spark, write(tmp_path / "m.kml", text))
    assert sorted((r.nome, r.camada) for r in rows.collect()) == [("A", "Dentro & fundo"), ("B", "Fora"), ("C", "M")]


def test_spellings_are_found_per_record(spark, as_of):
    frame = spark.createDataFrame(
        [("P1", None, None), (None, "E2", None), (None, None, "E3"), ("", "E4", None)],
        "ProcessoLicitatorio string, NumeroEdital string, numeroedital_ string",
    ).withColumnRenamed("numeroedital_", "PROCESSO_LICITATORIO")
    got = [r.id_licitacao for r in court.tenders(frame, as_of).collect()]
    assert got == ["P1", "E2", "E3", None]


def test_record_lists(spark):
    frame = spark.createDataFrame(
        [
            (1, '{"x": 1, "Obras": [{"a": 1}, 5, {"a": 2}]}'),
            (2, '[{"a": 3}]'),
            (3, '{"qualquer": [{"a": 4}], "n": 1}'),
            (4, '{"data": {"a": 9}}'),
            (5, "not json"),
            (6, '{"Convenios": [{"a": 6}], "data": [{"a": 7}]}'),
        ],
        "i int, p string",
    )
    got = payloads.explode_records(frame, "p", "a int", preferred=("Convenios",)).collect()
    assert sorted((r.i, r.a) for r in got) == [(1, 1), (1, 2), (2, 3), (3, 4), (6, 6)]


def test_matrix_records(spark):
    frame = spark.createDataFrame([([["1", "a"], ["2"]],), (None,)], "rows array<array<string>>")
    got = files.matrix_records(frame, ["Id Obra", "Título (R$)"])
    assert got.columns == ["id_obra", "titulo_r"]
    assert [tuple(r) for r in got.collect()] == [("1", "a"), ("2", None)]


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    assert snapshots.load_snapshot(spark, root, "x") is None
    assert snapshots.snapshot_log(spark, root).count() == 0
    frame = spark.range(3)
    snapshots.save_snapshot(frame, root, "x", F.lit(AS_OF - timedelta(hours=30)))
    snapshots.save_snapshot(frame.limit(2), root, "x", F.lit(AS_OF - timedelta(hours=2.25)))
    snapshots.save_snapshot(frame, root, "y", F.lit(AS_OF - timedelta(hours=30)))
    report = {r.nome: r for r in snapshots.freshness(snapshots.snapshot_log(spark, root), F.lit(AS_OF).cast("timestamp")).collect()}
    assert (report["x"].idade_horas, report["x"].registros, report["x"].valido) == (2.2, 2, True)
    assert (report["y"].idade_horas, report["y"].valido) == (30.0, False)
    assert snapshots.load_snapshot(spark, root, "x").count() == 2
    assert snapshots.fresh_or_snapshot(frame.limit(0), spark, root, "x").count() == 2
    assert snapshots.fresh_or_snapshot(frame.limit(1), spark, root, "x").count() == 1


def test_strategy_order(spark):
    strategies = [None, spark.range(0), spark.range(1, 2), spark.range(5)]
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    got = snapshots.first_with_rows([lambda frame=frame: frame for frame in strategies])
    assert len(tracker.getJobIdsForGroup(None)) == before  # nothing runs before the result does
    assert [r.id for r in got.collect()] == [1]
    assert snapshots.first_with_rows([lambda: None]) is None
    assert snapshots.first_with_rows([lambda: spark.range(0), lambda: spark.range(0)]).count() == 0


def test_portal_contracts(spark, as_of):
    schema = (
        "Contrato string, Objeto string, `Início` string, Fim string, `Unidade Gestora` string, Aditivo string, `Tipo de Contrato` string, CNPJ string, "
        "Empresa string, `Órgão Solicitante` string, `Modalidade de Licitação` string, `Nº Licitacao` string, `Nº Processo` string, Prazo string, Valor string"
    )
    frame = spark.createDataFrame(
        [("001", "Reforma", "01/02/2024", "01/02/2025", "PMM", "1º Aditivo", "Obras", "1", "Alfa", "SEMED", "Pregão", "9/24", "P1", "12 MESES", "R$ 1.234,56")],
        schema,
    )
    row = portal.contracts(frame, as_of).first()
    assert (row.id_contrato, row.valor, row.situacao, row.prazo_dias) == ("001", 1234.56, "Expirado", 360)
    assert (row.num_licitacao, row.num_processo, row.secretaria, row.possui_aditivo) == ("9/24", "P1", "SEMED", "1º Aditivo")
    assert row.data_assinatura == datetime(2024, 2, 1) and json.loads(row.payload_bruto)["Empresa"] == "Alfa"
    assert portal.about_works(frame, "Objeto").count() == 1


def test_court(spark, as_of):
    frame = spark.createDataFrame(
        [("MACAÉ", None, "P-1", "1.000,50", "1700000000000", None), ("Niterói", "N", "P", "1", None, None)],
        "Ente string, NumeroContrato string, ProcessoLicitatorio string, ValorContrato string, DataAssinaturaContrato string, DataVencimentoContrato string",
    )
    row = court.contracts(court.of_municipality(frame, "Ente"), as_of).collect()
    assert len(row) == 1 and (row[0].id_contrato, row[0].valor_contrato, row[0].situacao) == ("P-1", 1000.5, "Indefinido")
    terms = spark.createDataFrame([("12", "2020", "1", "0"), ("13", None, "2", "0")], "NumeroConvenio string, AnoConvenio string, QuantidadeAditivos string, ValorAditivos string")
    assert sorted(str(r.id_aditivo) for r in court.amendments(court.amended_agreements(terms), as_of).collect()) == ["12-2020", "None"]
    stopped = spark.createDataFrame([("7", "2020-05-01")], "NumeroContrato string, DataParalisacao string")
    assert court.stopped_works(stopped, as_of).first().id_obra == "7-2020-05-01T00:00:00+00:00"
    tender = spark.createDataFrame([("55", "", "2020-01-01T00:00:00Z", "10.5")], "ProcessoLicitatorio string, Parecer string, DataHomologacao string, ValorEstimado string")
    row = court.tenders(tender, as_of).first()
    assert (row.id_licitacao, row.situacao, row.valor_estimado) == ("55", "Homologada", 10.5)


def test_present_but_empty_field_stops_the_search(spark, as_of):
    frame = spark.createDataFrame([("", "x"), (None, "y")], "Objeto string, descricao string")
    assert [r.objeto for r in court.purchases(frame, as_of).collect()] == [None, "y"]


def test_health(spark, as_of):
    summary = spark.createDataFrame([(1, "a", "Em Funcionamento"), (2, "b", "x"), (None, "c", "x")], "propostaId int, bairro string, situacaoObra string")
    detail = spark.createDataFrame([(1, None, "5.5", "2020-01-01T00:00:00.000+0000")], "propostaId int, bairro string, vlProposta string, dtOrdemServico string")
    merged = health.merge_detail(summary, detail)
    rows = {r.proposta_id: r for r in health.works(merged, as_of).collect()}
    assert set(rows) == {"1", "2"}
    assert (rows["1"].bairro, rows["1"].valor_total_contrato, rows["1"].percentual_executado) == (None, 5.5, 100.0)
    assert rows["1"].dt_inicio_obra == datetime(2020, 1, 1) and rows["2"].bairro == "b"
    assert (rows["2"].fotos_grupos, rows["2"].qtd_fotos, rows["2"].qtd_empresas, rows["2"].percentual_executado) == ("[]", 0, 0, 0.0)


def test_federal_agreements(spark, as_of):
    lines = [
        '{"situacao": "Concluído", "dataConclusao": "2020-01-02", "valor": "10.5", "dimConvenio": {"codigo": " 77 ", "numero": "n"}, "convenente": {"cnpjFormatado": "1.2/3-4"}}',
        '{"situacao": "Outro", "dimConvenio": {"codigo": "77"}}',
        '{"situacao": "Sem número", "dimConvenio": null}',
    ]
    frame = spark.createDataFrame([(i, line) for i, line in enumerate(lines)], "_row int, p string")
    records = frame.select("_row", F.from_json("p", federal.AGREEMENT_RECORD).alias("r")).select("_row", "r.*")
    rows = federal.agreements(records, as_of, ["_row"]).collect()
    assert [(r.nr_convenio, r.situacao, r.valor, r.cnpj_proponente) for r in rows] == [("77", "Concluído", 10.5, "1234")]


def test_dump_amendments(spark, as_of):
    wanted = federal.agreement_numbers(spark.createDataFrame([("900",), (" 901 ",), (None,), ("None",), ("900",)], "num_licitacao string"))
    assert sorted(r[0] for r in wanted.collect()) == ["900", "901"]
    schema = "NR_CONVENIO string, ID_PROPOSTA string, VL_GLOBAL_CONV string, SIT_CONVENIO string, DIA_FIM_VIGENC_CONV string, DIA_FIM_VIGENC_ORIGINAL_CONV string, QTD_TA string"
    listed = spark.createDataFrame([("900 ", "", "324023,45", "s", "30/06/2019", "", "2"), ("901", "7", "356400", "s", "", "", "x"), ("999", "7", "1", "s", "", "", "1")], schema)
    terms = spark.createDataFrame([("900", "0"), ("900", ""), ("999", "5")], "NR_CONVENIO string, VL_GLOBAL_TA string")
    got = {r.nr_convenio: r for r in federal.dump_amendments(listed, terms, wanted, as_of).collect()}
    assert set(got) == {"900", "901"}
    assert (got["900"].valor_global, got["900"].valor_aditivos, got["900"].qtd_aditivos) == (324023.45, 0.0, 2)
    assert (got["901"].valor_aditivos, got["901"].qtd_aditivos, got["901"].id_proposta) == (None, 0, "7")


def test_current_panel(spark, as_of):
    inner = json.dumps({"Nº Licitação": "L-1", "objeto": "no BAIRRO Centro Macaé RJ"}, ensure_ascii=False)
    outer = json.dumps({"id_contrato": "C-9", "Início": "2020-01-01", "payload_bruto": inner}, ensure_ascii=False)
    frame = spark.createDataFrame(
        [("Escola", "Concluída", "1.000,00", None, outer), ("Ponte", "Em execução", "5", "01/01/2020", None)],
        "`Nome da Obra` string, `Situação` string, `Valor do Contrato (R$)` string, `Data Início` string, payload_bruto string",
    )
    rows = {r.nome_obra: r for r in panels.current_works(frame, as_of).collect()}
    school = rows["Escola"]
    assert (school.num_contrato, school.num_licitacao, school.bairro, school.percentual_executado) == ("C-9", "L-1", "Centro", 100.0)
    assert (school.data_inicio, school.valor_contrato) == (datetime(2020, 1, 1), 1000.0)
    assert rows["Ponte"].id_obra.startswith("obra_") and rows["Ponte"].num_contrato == rows["Ponte"].id_obra
    assert json.loads(school.payload_bruto)["payload_bruto"] == outer


def test_legacy_panel(spark, as_of):
    frame = spark.createDataFrame(
        [("CONSTRUCAO", "Creche", "R$773.000,00", "R$618.400,00", "40,00%", "NaT", "22.21.21.S", "2019"), ("Praça", "x", "NaT", None, None, "01/02/2020", "", None)],
        "titulo_obras string, objeto_proposta_obras string, nome_tipo_obras string, data_criacao_obras string, nome_modalidade_obras string, dia_inic_vigenc_conv_obras string, latitude_obras string, ano_conclusao_obras string",
    )
    rows = panels.legacy_works(frame, as_of).collect()
    assert rows[0].nome_obra == "Creche — CONSTRUCAO"
    assert (rows[0].valor_contrato, rows[0].percentual_executado, rows[0].percentual_executado_financeiro) == (773000.0, 40.0, 80.0)
    assert (rows[0].data_inicio, rows[0].ano_conclusao) == (None, 2019) and rows[0].latitude < -22.35
    assert (rows[1].valor_contrato, rows[1].data_inicio, rows[1].latitude) == (None, datetime(2020, 2, 1), None)


@pytest.mark.parametrize("wanted, exact, expected", [("Macae/RJ", False, "Macaé/RJ"), ("Macae/RJ", True, "Macae/RJ"), ("macaé", False, "Macaé/RJ")])
def test_locality(spark, wanted, exact, expected):
    frame = spark.createDataFrame([("Macae/RJ",), ("Macaé/RJ",), ("Niterói/RJ",)], "q string")
    assert panels.match_locality(frame, "q", wanted, exact).first().q == expected
    assert panels.match_locality(frame, "q", "Campos").count() == 0


def test_profiles(spark, as_of):
    record = '{"id": 3302403, "nome": "Macaé", "microrregiao": {"id": 1, "nome": "m", "mesorregiao": {"id": 2, "nome": "n", "UF": {"id": 33, "sigla": "RJ", "nome": "Rio"}}}, "regiao-imediata": {"id": 4, "nome": "i", "regiao-intermediaria": {"id": 5, "nome": "j"}}}'
    frame = spark.createDataFrame([(record,)], "p string").select(F.from_json("p", geography.PLACE_RECORD).alias("r")).select("r.*")
    statistics = spark.createDataFrame([("3302403", 93, "246391", 0), ("3302403", 93, "1", 1), ("3302403", 6318, "1216,99", 2), ("3302403", 37, "...", 3)], "municipio_id string, variavel int, valor string, o int")
    row = geography.profiles(geography.places(frame), statistics, as_of, "o").first()
    assert (row.uf_sigla, row.regiao_intermediaria_nome, row.populacao_censo_2022, row.area_territorial_km2, row.pib_per_capita) == ("RJ", "j", 246391, 1216.99, None)


def test_costs(spark, as_of):
    frame = spark.createDataFrame([("Construção de ESCOLA",), ("Recapeamento e pavimentação",), ("x",), (None,), ("Praça",)], "tipo string")
    got = [(r.categoria_custo, r.custo_m2_referencia) for r in costs.with_reference_cost(frame).collect()]
    assert got == [("escola", 2800.0), ("pavimentacao_asfalto", 450.0), ("padrao", 2000.0), ("padrao", 2000.0), ("praca_urbanizacao", 800.0)]
    table = costs.reference_table(spark, as_of)
    assert table.count() == 16 and table.first().competencia == "2026-01"
