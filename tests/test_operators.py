from datetime import datetime

import pytest
from pyspark.sql import functions as F

from canteiro.operators import aggregates, dedup, fields, joins, merge, profile


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.fixture
def contracts(spark):
    return spark.createDataFrame(
        [(0, "C-1", "a", "x"), (1, "C-1", "b", "y"), (2, "C-2", "a", "z"), (3, "C-2", "a", "z"), (4, None, "a", "n"), (5, None, "a", "m")],
        "seq int, id_contrato string, fonte string, v string",
    )


def test_keep_first_and_last(contracts):
    assert rows(dedup.keep_first(contracts, ["id_contrato"], ["seq"]).select("seq")) == [(0,), (2,), (4,)]
    assert rows(dedup.keep_last(contracts, ["id_contrato"], ["seq"]).select("seq")) == [(1,), (3,), (5,)]
    assert rows(dedup.keep_first_known(contracts, ["id_contrato"], ["seq"]).select("seq")) == [(0,), (2,), (4,), (5,)]


def test_hot_key_is_cut_before_the_exchange(spark):
    frame = spark.range(1000).select(F.when(F.col("id") < 900, "hot").otherwise("cold").alias("k"), "id")
    text = plan_of(dedup.keep_first(frame, ["k"], ["id"]))
    assert text.index(", Final") < text.index("Exchange") < text.index(", Partial")


def test_distinct_rows(contracts):
    assert rows(dedup.distinct_rows(contracts, ["seq"], ignore=["seq"]).select("seq")) == [(0,), (1,), (2,), (4,), (5,)]
    assert dedup.distinct_rows(contracts.drop("seq")).count() == 5


def test_distinct_rows_skips_nested_columns(spark):
    frame = spark.sql("select 1 a, array(1) b union all select 1, array(2)")
    assert dedup.distinct_rows(frame).count() == 1


def test_source_rank(spark):
    frame = spark.createDataFrame([("sismob_cidadao",), ("painel_obras_atual_macae",), ("x",), (None,)], "s string")
    got = {r[0]: r[1] for r in frame.select("s", dedup.source_rank("s")).collect()}
    assert got == {"sismob_cidadao": 6, "painel_obras_atual_macae": 0, "x": 9, None: 9}


def test_best_across_sources(spark):
    frame = spark.createDataFrame(
        [("1", "sismob_cidadao"), ("1", "painel_obras_atual_macae"), ("2", "sismob_cidadao")], "id_origem string, fonte_origem string"
    )
    best = dedup.best_across_sources(frame, ["fonte_origem"])
    assert rows(best, "id_origem") == [("1", "painel_obras_atual_macae"), ("2", "sismob_cidadao")]
    assert dedup.one_per_source(frame, ["fonte_origem"]).count() == 3


def test_merge_extracts_uses_whole_column_names(spark):
    schema = "seq int, `Unidade Gestora` string, `Número` string, Objeto string"
    a = spark.createDataFrame([(0, "U", "1", "o"), (1, "U", "2", "p"), (2, "U", "3", "q")], schema)
    b = spark.createDataFrame([(3, "U", "3", "q"), (4, "U", "4", "r")], schema)
    assert dedup.merge_extracts([a, b], ["seq"]).count() == 4
    unkeyed = [f.drop("Número") for f in (a, b)]
    assert dedup.merge_extracts(unkeyed, ["seq"]).count() == 4


def test_merge_localities(spark):
    schema = "seq int, id string, nr string, v string"
    a = spark.createDataFrame([(0, "1", None, "a"), (1, None, "N", "b"), (2, None, None, "c")], schema)
    b = spark.createDataFrame([(0, "1", None, "z"), (1, None, "N", "z"), (2, None, None, "c"), (3, "", None, "d")], schema)
    got = dedup.merge_localities([a, b], ["id", "nr"], ["seq"])
    assert rows(got.select("v"), "v") == [("a",), ("b",), ("c",), ("d",)]


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (3, "c", 30)], "k int, v string, w int")
    batch = spark.createDataFrame([(2, "B"), (4, None)], "k int, v string")
    merged = merge.upsert(target, batch, ["k"])
    assert rows(merged, "k") == [(1, "a", 10), (2, "B", 20), (3, "c", 30), (4, None, None)]
    assert rows(merge.upsert(merged, batch, ["k"]), "k") == rows(merged, "k")
    with pytest.raises(ValueError):
        merge.upsert(target, batch.drop("k"), ["k"])


def test_prepare_batch_conserves_rows(spark):
    batch = spark.createDataFrame([(0, "a", 1), (1, "a", 2), (2, None, 3)], "seq int, k string, v int")
    good, rejected = merge.prepare_batch(batch, ["k"], ["seq"])
    assert rows(good.select("k", "v")) == [("a", 2)]
    assert rows(rejected.select("v")) == [(3,)]


def test_marked_batch_is_one_pass(spark):
    batch = spark.createDataFrame(
        [(0, "a", 1), (1, "a", 2), (2, None, 3), (3, None, 4), (4, "b", 5)], "seq int, k string, v int"
    )
    marked = merge.marked_batch(batch, ["k"], ["seq"])
    assert rows(marked.select("v", merge.OUTCOME)) == [(2, "mantido"), (3, "rejeitado"), (4, "rejeitado"), (5, "mantido")]
    plan = marked.sparkSession._jvm.PythonSQLUtils.explainString(marked._jdf.queryExecution(), "simple")
    assert plan.count("Window [") == 1 and plan.count("Exchange") == 1 and "WindowGroupLimit" in plan


def test_versioned_table(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    frame = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    assert table.upsert(frame, ["k"]) == 1
    assert table.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"]) == 2
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "d")]
    (tmp_path / "t" / "v00000009").mkdir()  # an uncommitted version is not read
    assert table.versions() == [1, 2]
    # the same batch once more changes nothing
    table.upsert(spark.createDataFrame([(2, "c"), (3, "d")], "k int, v string"), ["k"])
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "d")]
    table.upsert(spark.createDataFrame([(9, "z")], "k int, v string"), ["k"])
    table.drop_older(keep=1)
    assert len(table.versions()) == 1
    assert rows(table.read()) == [(1, "a"), (2, "c"), (3, "d"), (9, "z")]


def test_small_upsert_rewrites_no_base_file(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"), buckets=8)
    expected = spark.range(2000).selectExpr("id as k", "'old' as v", "cast(id as string) as w")
    table.write(expected, ["k"])
    before = table.folders()
    for turn in range(4):
        batch = spark.range(turn * 10, turn * 10 + 20).selectExpr("id * 97 % 2010 as k", f"'new{turn}' as v", "'x' as w")
        table.upsert(batch, ["k"])
        expected = merge.upsert(expected, batch, ["k"])
        assert table.folders() == before and len(table.folders(deltas=True)) == turn + 1
        assert rows(table.read()) == rows(expected)
    # a column that the batch does not carry keeps its value, also one from a delta
    batch = spark.createDataFrame([(97, "part"), (5000, "added")], "k long, v string")
    table.upsert(batch, ["k"])
    expected = merge.upsert(expected, batch, ["k"])
    assert rows(table.read()) == rows(expected) and table.folders() == before
    # version by version, as it was written
    old = table.versions()[1]
    assert table.folders(old) == before and len(table.folders(old, deltas=True)) == 1


def test_deltas_are_merged_into_the_buckets_they_touch(spark, tmp_path):
    table = merge.VersionedTable(spark, str(tmp_path / "t"), buckets=8)
    table.write(spark.range(1000).selectExpr("id as k", "'old' as v"), ["k"])
    before = table.folders()
    for turn in range(merge.MAX_DELTAS):
        table.upsert(spark.createDataFrame([(5, f"v{turn}")], "k long, v string"), ["k"])
    assert table.folders() == before
    table.upsert(spark.createDataFrame([(5, "new")], "k long, v string"), ["k"])
    after = table.folders()
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1 and not table.folders(deltas=True)
    got = {r.k: r.v for r in table.read().collect()}
    assert len(got) == 1000 and [k for k, v in got.items() if v != "old"] == [5] and got[5] == "new"
    table.upsert(spark.range(500, 900).selectExpr("id as k", "'many' as v"), ["k"])  # a large batch goes to the base
    assert not table.folders(deltas=True) and table.read().where("v = 'many'").count() == 400
    table.drop_older(keep=1)
    assert table.read().count() == 1000
    table.write(spark.range(0).selectExpr("id as k", "'x' as v"), ["k"])
    assert table.read().count() == 0 and table.read().columns == ["k", "v"]


def test_attach_spreads_rows_without_key(spark):
    left = spark.range(2000).select("id", F.when(F.col("id") < 100, F.lit("x")).alias("k"))
    lookup = spark.createDataFrame([("x", 7), ("y", 8), (None, 9)], "k string, v int")
    got = joins.attach(left, lookup, "k", "k", {"v": "v"})
    assert got.count() == 2000
    assert got.where("v = 7").count() == 100
    assert got.where("v is null").count() == 1900
    keys = left.select(joins._spread_key(left, "k").alias("s")).where(F.col("s") != "x")
    assert keys.distinct().count() == 1900


def test_hot_lookup_key_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        left = spark.range(0, 60000, 1, 8).select(
            "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
        )
        lookup = spark.range(0, 60000, 1, 4).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
        lookup = lookup.unionByName(spark.createDataFrame([("hot", -1)], "k string, v bigint"))
        got = joins.attach(left, lookup, "k", "k", {"v": "v"})
        collected = got.select(F.sum("v").alias("s"), F.count("*").alias("n"))
        frame = got.where("v is not null")
        total = frame.count()
        assert total == 60000
        frame.collect()
        assert "skew=true" in plan_of(frame)
        assert collected.first()["n"] == 60000
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_match_or_reject_conserves_rows(spark):
    left = spark.createDataFrame([("1", "a"), ("2", "a"), (None, "a")], "i string, f string")
    right = spark.createDataFrame([("1", "a", 5)], "j string, g string, v int")
    matched, rejected = joins.match_or_reject(left, right, ["i", "f"], ["j", "g"])
    assert matched.count() + rejected.count() == left.count()
    assert matched.select("v").collect()[0][0] == 5


def test_marked_matches_are_the_rows_of_match_or_reject(spark):
    left = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a"), (None, "a"), (None, "a")], "i string, f string")
    right = spark.createDataFrame([("1", "a", 5), ("1", "a", None), ("3", "a", 6), (None, "a", 7)], "j string, g string, v int")
    matched, rejected = joins.match_or_reject(left, right, ["i", "f"], ["j", "g"])
    marked = joins.marked_matches(left, right, ["i", "f"], ["j", "g"])
    cells = ("i", "f", "v")
    assert sorted(map(str, matched.select(*cells).collect())) == sorted(map(str, marked.where(joins.MATCHED).select(*cells).collect()))
    lost = marked.where(~F.col(joins.MATCHED))
    assert sorted(map(str, rejected.collect())) == sorted(map(str, lost.select("i", "f").collect()))
    assert lost.where("v is not null or j is not null").count() == 0


def test_field_helpers(spark):
    frame = spark.createDataFrame([("9999", " ", "t")], "municipio_ibge string, x string, valor string")
    assert rows(fields.with_defaults(frame, {"x": "d", "novo": 1}).select("x", "novo")) == [("d", 1)]
    renamed = fields.rename_guarded(frame, {"valor": "x", "x": "y", "nada": "z"})
    assert renamed.columns == ["municipio_ibge", "y", "valor"]
    assert fields.first_containing(["Nº Contrato", "Valor Total"], "total", "contrato") == "Valor Total"
    assert fields.first_containing_folded(["Situação"], "situacao") == "Situação"
    assert fields.first_named(["NumeroContrato", "numero"], "numerocontrato") == "NumeroContrato"
    assert fields.first_overlapping(["Nº do Contrato"], "contrato") == "Nº do Contrato"
    assert fields.absent_columns(frame, ["x", "q"]) == ["q"]
    assert fields.keep_columns(frame, ["valor", "q", "x"]).columns == ["valor", "x"]


def test_first_column_with_values_is_a_whole_frame_choice(spark):
    frame = spark.createDataFrame([(None, "o1", "u1"), (None, None, "u2")], "secretaria string, orgao string, unidade_gestora string")
    got = frame.select(fields.first_column_with_values(frame, "secretaria", "orgao", "unidade_gestora").alias("r"))
    assert sorted([r[0] for r in got.collect()], key=str) == [None, "o1"]
    bare = frame.drop("orgao", "unidade_gestora")
    assert [r[0] for r in bare.select(fields.first_column_with_values(bare, "secretaria", "orgao").alias("r")).collect()] == [None, None]


def test_payload_lookup(spark):
    outer = '{"Nº Contrato": "", "payload_bruto": "{\\"nº contrato\\": \\"77\\", \\"Início\\": \\"2020-01-01\\"}"}'
    frame = spark.createDataFrame([(outer,), ("not json",), (None,)], "p string")
    got = fields.with_payload_maps(frame, "p").select(
        fields.payload_value("contrato", "nº contrato").alias("a"), fields.payload_value("inicio").alias("b")
    ).collect()
    assert [tuple(r) for r in got] == [("77", "2020-01-01"), (None, None), (None, None)]


def test_latest_value(spark):
    frame = spark.createDataFrame(
        [("k", "a", datetime(2020, 1, 1)), ("k", None, datetime(2021, 1, 1)), ("k", "z", None), ("j", "q", None)],
        "k string, n string, d timestamp",
    )
    got = aggregates.latest_value(frame, "k", "n", ["d", "n"], "n")
    assert rows(got) == [("j", "q"), ("k", "a")]


def test_supplier_profile(spark):
    frame = spark.createDataFrame(
        [("1", "A", 100.0, "Sim", 2020), ("1", "B", 200.0, "nao", 2021), ("", "C", 5.0, None, 2020), (None, "C", 5.0, None, 2020)],
        "cnpj_fornecedor string, nome_fornecedor string, valor_contrato double, possui_aditivo string, ano int",
    )
    row = aggregates.supplier_profile(frame).first()
    assert (row.total_contratos, row.valor_total, row.valor_medio, row.taxa_aditivo, row.anos_atuacao) == (2, 300.0, 150.0, 0.5, 2)
    assert row.nome_fornecedor == "A"


def test_profiles(spark):
    frame = spark.createDataFrame(
        [("a", None, 10.0), ("a", "", 20.05), ("b", "Vigente", None)], "fonte string, situacao string, p double"
    )
    report = profile.coverage(frame, ["fonte"], {"sem": profile.null_or_empty("situacao")}, {"media": "p"})
    assert rows(report) == [("a", 2, 2, 15.0), ("b", 1, 0, None)]
    shares = profile.distribution(frame, "fonte").select("fonte", "qtd", "pct")
    assert rows(shares) == [("a", 2, 66.7), ("b", 1, 33.3)]
    assert rows(profile.filled_counts(frame, ["situacao", "p"])) == [("p", 2), ("situacao", 2)]
    assert rows(profile.row_counts({"x": frame, "y": frame.limit(0)})) == [("x", 3), ("y", 0)]
    long = frame.select(F.repeat(F.lit("é"), 40).alias("t"), F.lit(20).alias("z"))
    row = profile.text_profile(long, ["t"], packed={"t": "z"}).first()
    assert (row.t_textos, row.t_bytes, row.t_economia_pct) == (3, 240, 75.0)
