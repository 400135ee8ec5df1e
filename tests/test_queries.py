import pytest
from compare import compare, duck

import __spark_entry__ as entry_points
from canteiro.queries import REGISTRY


@pytest.fixture(scope="module")
def connection(data):
    return duck(data)


def test_entry_points_agree():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert set(REGISTRY) <= set(queries)
    assert set(sql) <= set(queries)
    others = set(queries) - set(REGISTRY)
    assert all(name == "pipeline" or name.startswith("op") for name in others)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_its_sql(spark, data, connection, name):
    item = REGISTRY[name]
    frame = item.build(spark, data)
    if item.sql is None:
        assert frame.count() > 0
    else:
        assert compare(frame, connection, item.sql) is None


def test_results_do_not_depend_on_partitions(spark, data):
    names = ("supplier_metrics", "dedup_keep_first", "contracts_structured")

    def results():
        return {n: sorted(map(repr, REGISTRY[n].build(spark, data).collect())) for n in names}

    first = results()
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert results() == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
