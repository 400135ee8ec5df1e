"""Plan checks over all registered queries: no cross join, no Python, no forced broadcast."""

import pathlib

import pytest

from canteiro.queries import REGISTRY

ROOT = pathlib.Path(__file__).resolve().parent.parent
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


def plan_of(df):
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_cross_join_and_no_python(spark, data, name):
    plan = plan_of(REGISTRY[name].build(spark, data))
    assert not [word for word in FORBIDDEN if word in plan]


def test_filters_and_columns_reach_the_scan(spark, data):
    plan = plan_of(REGISTRY["court_contracts"].build(spark, data))
    assert "ReadSchema" in plan and "o_orderstatus" in plan
    scan = plan_of(REGISTRY["upsert_merge"].build(spark, data))
    assert "PushedFilters: [IsNotNull(o_orderdate)" in scan


def test_library_never_forces_a_broadcast_or_collects():
    banned = ("broadcast(", ".localCheckpoint(", ".toPandas(", ".rdd", "udf(", ".crossJoin(")
    for path in (ROOT / "canteiro").rglob("*.py"):
        source = path.read_text(encoding="utf-8")
        assert not [word for word in banned if word in source], path


def test_report_reads_each_table_once(spark, data):
    frame = REGISTRY["report_lines"].build(spark, data)
    frame.collect()
    plan = frame.sparkSession._jvm.PythonSQLUtils.explainString(frame._jdf.queryExecution(), "simple")
    final = plan.split("== Initial Plan ==")[0]
    for column in ("l_returnflag", "o_orderstatus", "c_mktsegment", "s_suppkey"):
        assert sum("FileScan" in line and column in line for line in final.splitlines()) <= 1, column


def test_lines_and_rejects_come_from_one_join_in_small_parts(spark, data):
    plan = plan_of(REGISTRY["fk_inner_and_reject"].build(spark, data)).split("== Physical Plan ==")[-1]
    assert len([line for line in plan.splitlines() if "Join" in line]) == 1
    # what a task sorts at once follows from what it reads from a shuffle
    assert int(spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes").rstrip("m")) <= 16


def test_refresh_reads_what_it_made_once(spark, data):
    plan = plan_of(REGISTRY["structured_refresh"].build(spark, data)).split("== Physical Plan ==")[-1]
    # intermediate tables are read back: only the suppliers named again (one read) and the
    # amendments there were (two) come from the given orders
    assert sum("FileScan" in line and "orders.parquet" in line for line in plan.splitlines()) <= 3


def test_fold_has_no_higher_order_function(spark):
    from canteiro.functions.text import fold

    plan = plan_of(spark.createDataFrame([("a",)], "t string").select(fold("t")))
    assert "lambda" not in plan and "aggregate(" not in plan and "transform(" not in plan
