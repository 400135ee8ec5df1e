from datetime import datetime

import pytest
from pyspark.sql import functions as F

from canteiro.functions import dates, geo, ids, markup, numbers, status, text

AS_OF = datetime(2026, 1, 1)


def _as_of():
    return F.lit(AS_OF).cast("timestamp")


def test_fold(column_of):
    got = column_of(text.fold, [" Macaé ", "CONSTRUÇÃO", "nº 1ª", "plain", None, "é"])
    assert got == ["macae", "construcao", "no 1a", "plain", None, "e"]


def test_slug_and_key(column_of):
    assert column_of(text.slug, ["Nº  Licitação (R$)", None]) == ["no_licitacao_r", None]
    assert column_of(text.key_form, ["nº Contrato"]) == ["nocontrato"]
    assert column_of(text.fold_upper, [" são   joão "]) == ["SAO JOAO"]
    assert text.slug_name("Nº  Licitação (R$)") == "no_licitacao_r"
    assert text.key_name("nº Contrato") == "nocontrato"


def test_missing_is_case_sensitive(column_of):
    assert column_of(text.is_missing, [None, " ", "n/a", "N/A", "NaT", "x"]) == [
        True, True, True, False, True, False,
    ]


def test_works_keywords_are_accent_sensitive(column_of):
    got = column_of(text.mentions_works, ["Manobra", "CONSTRUÇÃO de ponte", "construcao", "café", None])
    assert got == [True, True, False, False, False]


def test_district_and_street(column_of):
    texts = [
        "REFORMA DE ESCOLA NO BAIRRO Lagomar, MACAÉ/RJ",
        "obra no bairro dos CAVALEIROS  VELHOS MACAE",
        "OBRA LOCALIZADA NA RUA ALFREDO TANOS, 12",
        "nada aqui",
        None,
    ]
    assert column_of(text.district_in_text, texts) == ["Lagomar", "Cavaleiros Velhos", None, None, None]
    assert column_of(text.street_in_text, texts) == [None, None, "RUA ALFREDO TANOS", None, None]
    assert column_of(text.district_after_word, ["no BAIRRO Centro Macaé RJ, x", "y"]) == ["Centro", None]


def test_company_tax_id(column_of):
    got = column_of(ids.company_tax_id, ["04.252.011/0001-10", "11.111.111/1111-11", "123", None, "04252011000111"])
    assert got == ["04252011000110", None, None, None, None]


def test_keys(spark):
    row = spark.sql("select 'a' a, cast(null as string) b").select(
        ids.composite_id("a", "a").alias("x"),
        ids.composite_id("a", "b").alias("y"),
        ids.surrogate_key("a", "b").alias("z"),
        F.length(ids.surrogate_key("a", "a")).alias("w"),
    ).first()
    assert (row.x, row.y, row.z, row.w) == ("a-a", None, None, 64)


def test_money(column_of):
    values = ["R$ 1.234.567,89", "1234.56", " 2 500,10 ", "1,234.50", "texto", "1.500", "1.2.3", "-10,5", "-", None, "1,2,3"]
    assert column_of(numbers.money, values) == [
        1234567.89, 1234.56, 2500.10, 1234.50, None, 1500.0, 123.0, -10.5, None, None, None,
    ]


@pytest.mark.parametrize(
    "style, values, expected",
    [
        ("br_strict", ["R$ 2.378.752", "1500.50", "10,5", "x", None], [2378752.0, 150050.0, 10.5, None, None]),
        ("last_separator", ["1.234,5", "1,234.5", "1.500", "7,5"], [1234.5, 1234.5, 1.5, 7.5]),
        ("comma_decimal", ["1.234,5", "1.5", "7,5"], [1234.5, 1.5, 7.5]),
        ("dump", ["324023,45", "356400", "", None, "x"], [324023.45, 356400.0, 0.0, 0.0, 0.0]),
    ],
)
def test_amount_styles(column_of, style, values, expected):
    assert column_of(lambda c: numbers.amount(c, style), values) == expected


def test_other_numbers(column_of):
    assert column_of(numbers.percent, ["40,00%", "NaT", "x"]) == [40.0, None, None]
    assert column_of(numbers.loose_number, ["R$ 1.234,5 mil", "-", "12%"]) == [1234.5, None, 12.0]
    assert column_of(numbers.integer, ["ano 2019", "-", "x"]) == [2019, None, None]
    assert column_of(numbers.statistic, ["12,5", "...", None]) == [12.5, None, None]
    assert column_of(numbers.to_double, ["1d", "NaN", "inf", "1e3", ".5"]) == [None, None, None, 1000.0, 0.5]


def test_derived_percents(spark):
    row = spark.sql(
        "select 50.0d paid, 96.0d total, cast(null as double) given, 0.0d zero, 500.0d big"
    ).select(
        numbers.stopped_work_percent("given", "paid", "total").alias("a"),
        numbers.stopped_work_percent("given", "big", "total").alias("b"),
        numbers.stopped_work_percent("given", "given", "total").alias("c"),
        numbers.stopped_work_percent("zero", "paid", "total").alias("d"),
        numbers.financial_percent("paid", "total").alias("e"),
        numbers.financial_percent("zero", "total").alias("f"),
        numbers.financial_percent("paid", "zero").alias("g"),
    ).first()
    assert tuple(row) == (52.1, 99.0, None, 0.0, 52.08, None, None)


def test_dates(column_of):
    values = [
        "15/03/2026", "2026-03-15", "15-03-2026 10:30:00", "01/13/2026", "31/02/2026", "1700000000",
        "1700000000000", "2026-03-15T10:30:00Z", "2026-03-15T10:30:00.5-03:00", "nan", None, "hoje",
        "5/3/2026 9:05", "2026/03/15", "15/03/2026 10",
    ]
    day = datetime(2026, 3, 15)
    epoch = datetime(2023, 11, 14, 22, 13, 20)
    assert column_of(dates.parse_timestamp, values) == [
        day, day, datetime(2026, 3, 15, 10, 30), None, None, epoch, epoch,
        datetime(2026, 3, 15, 10, 30), datetime(2026, 3, 15, 13, 30, 0, 500000), None, None, None,
        datetime(2026, 3, 5, 9, 5), day, None,
    ]


def test_epoch_out_of_range_is_null(column_of):
    assert column_of(dates.parse_timestamp, ["9" * 25, "9" * 18]) == [None, None]


def test_months_and_durations(column_of):
    assert column_of(dates.month_and_year, ["Abril/2022", "março/2020", "Marco / 2020", "x/2020", "1/2/3", None]) == [
        datetime(2022, 4, 1), datetime(2020, 3, 1), datetime(2020, 3, 1), None, None, None,
    ]
    assert column_of(dates.duration_days, ["300 DIAS", "12 meses", "2 ANOS", "3 semanas", "3 MÊS", None]) == [
        300, 360, 730, 21, None, None,
    ]


def test_expected_end(spark):
    row = spark.sql("select timestamp'2022-07-01' s, '360 DIAS' a, 'Dezembro/2023' b, 'x' c").select(
        dates.expected_end("a", "s").alias("a"),
        dates.expected_end("b", "s").alias("b"),
        dates.expected_end("c", "s").alias("c"),
    ).first()
    assert tuple(row) == (datetime(2023, 6, 26), datetime(2023, 12, 1), None)


def test_delay(spark):
    rows = spark.createDataFrame(
        [
            (datetime(2014, 7, 13), datetime(2014, 8, 5)),
            (datetime(2014, 7, 13), datetime(2014, 7, 1)),
            (datetime(2025, 9, 23), None),
            (None, datetime(2014, 8, 5)),
            (datetime(2014, 7, 13), datetime(2014, 7, 13, 23, 59)),
        ],
        "d timestamp, c timestamp",
    )
    got = [r[0] for r in rows.select(dates.delay_days("d", "c", _as_of())).collect()]
    assert got == [23, 0, 100, None, 0]


def test_percent_complete(spark):
    early, late = datetime(2020, 1, 1), datetime(2021, 1, 1)
    cases = [
        ("Concluída", 0.0, None, None, 100.0),
        ("Concluída", 80.0, None, None, 80.0),
        ("Cancelada", None, None, None, 0.0),
        ("Em fase de planejamento", -1.0, None, None, 0.0),
        ("Em andamento", None, early, late, 99.0),
        ("Em andamento", 75.0, early, late, 75.0),
        ("Em andamento", None, early, None, 0.0),
        ("Em andamento", None, datetime(2025, 1, 1), datetime(2027, 1, 1), 50.0),
        ("Paralisada", None, None, None, 0.0),
        ("Paralisada", -5.0, None, None, -5.0),
    ]
    frame = spark.createDataFrame(
        [(i, *case) for i, case in enumerate(cases)],
        "i int, s string, p double, a timestamp, b timestamp, e double",
    )
    rows = frame.select("i", "e", dates.percent_complete("s", "p", "a", "b", _as_of()).alias("r")).collect()
    assert [(r.i, r.r) for r in rows] == [(r.i, r.e) for r in rows]


def test_geo(spark, column_of):
    assert column_of(geo.coordinate, ["22.21.21.S", "41°46'11\"W", "-22,5", "x", None, "N"]) == [
        -(22 + 21 / 60 + 21 / 3600), -(41 + 46 / 60 + 11 / 3600), -22.5, None, None, None,
    ]
    row = spark.sql("select '-41.78,-22.37,0' t, '1' u, -22.37d lat, -41.78d lon, cast(null as double) n").select(
        *[c.alias(f"p{i}") for i, c in enumerate(geo.point_from_text("t"))],
        *[c.alias(f"q{i}") for i, c in enumerate(geo.point_from_text("u"))],
        geo.wkt_point("lat", "lon").alias("w"),
        geo.wkt_point("n", "lon").alias("v"),
        geo.in_bounding_box("lat", "lon").alias("b"),
    ).first()
    assert tuple(row) == (-22.37, -41.78, None, None, "POINT(-41.78 -22.37)", None, True)


def test_perimeter_points(spark):
    row = spark.sql(
        "select array(array(array(1d,2d),array(1d,3d))) p, cast(null as array<array<array<double>>>) q, "
        "array(array(array(array(1d,2d))), array(array(array(1d,2d), array(2d,2d)))) m, "
        "cast(null as array<array<array<array<double>>>>) n"
    ).select(
        geo.perimeter_points(F.col("p"), F.col("n")).alias("a"),
        geo.perimeter_points(F.col("q"), F.col("m")).alias("b"),
    ).first()
    assert tuple(row) == (2, 3)


def test_official_status(column_of):
    values = [None, "undefined", "Em Execução", "Prazo Expirado", "Em vistoria", "N/A", " CONCLUIDA "]
    assert column_of(status.official_status, values) == [
        "Indefinido", "Indefinido", "Em andamento", "Rescindida", "Em vistoria", "Indefinido", "Concluída",
    ]


def test_agreements(column_of):
    values = ["Prestação de Contas Aprovada", "Convênio Anulado", "Em execução", None]
    assert column_of(status.agreement_settled, values) == [True, False, False, False]
    assert column_of(status.agreement_cancelled, values) == [False, True, False, False]


def test_html(column_of):
    html = [
        "<p>Oi  &amp; tchau</p><script>var a='<p>';</script><b> fim&nbsp;</b><!-- x -->",
        "Obra&eacute; &#233; &#xe9; &amp;lt;",
        "",
        None,
    ]
    assert column_of(markup.html_text, html) == ["Oi  & tchau fim", "Obraé é é &lt;", None, None]


def test_html_attributes(column_of):
    html = [
        "<table><tr><td>OBRA</td><td>Concluída</td></tr><tr><th>Valor</th><td>R$ 10</td></tr>"
        "<tr><td>x</td></tr><tr><td>obra</td><td>Em andamento</td></tr></table>",
        "Início: Abril/2022<br>Fim: 360 DIAS<br>sem par",
        None,
    ]
    assert column_of(markup.html_attributes, html) == [
        {"obra": "Em andamento", "valor": "R$ 10"},
        {"início": "Abril/2022", "fim": "360 DIAS"},
        {},
    ]


def test_attribute_lookup(spark):
    row = spark.sql("select map('setor administrativo','S1','valor total','9') m").select(
        markup.attribute(F.col("m"), "valor", "setor").alias("a"),
        markup.attribute(F.col("m"), "zzz", "SETOR").alias("b"),
        markup.attribute(F.col("m"), "zzz").alias("c"),
    ).first()
    assert tuple(row) == ("9", "S1", None)


def test_marker_status(spark):
    rows = spark.createDataFrame(
        [
            (1, {"obra": "CONCLUÍDA"}, "icon-red", "x", "concluída"),
            (2, {"status da obra": "em obra"}, "icon-red", "x", "em andamento"),
            (3, {}, "#icon-RED-1", "Obras concluídas", "paralisada"),
            (4, {}, "icon-gray", "Projetos", "planejada"),
            (5, {}, None, None, "indefinido"),
        ],
        "i int, m map<string,string>, icon string, layer string, e string",
    )
    got = rows.select("e", status.marker_status(F.col("m"), F.col("icon"), F.col("layer")).alias("r")).collect()
    assert [r.r for r in got] == [r.e for r in got]


def test_active_and_amendments(spark):
    rows = spark.createDataFrame(
        [
            (1, "Em execução", None, None, True),
            (2, "Concluída", datetime(2025, 12, 1), None, False),
            (3, None, datetime(2025, 12, 1), None, True),
            (4, None, datetime(2020, 12, 1), None, False),
        ],
        "i int, s string, d timestamp, a timestamp, e boolean",
    )
    got = rows.select("e", status.is_active_work("s", "d", "a", _as_of()).alias("r")).collect()
    assert [r.r for r in got] == [r.e for r in got]
    flags = spark.createDataFrame(
        [("1", None, None, None, True), (None, "0", None, "Aditivado", True), (None, None, "null", "x", False),
         (None, None, "2020-01-01", None, True)],
        "q string, v string, d string, f string, e boolean",
    )
    got = flags.select("e", status.has_amendment("q", "v", "d", "f").alias("r")).collect()
    assert [r.r for r in got] == [r.e for r in got]
