import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]

from canteiro import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "canteiro-tests",
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture
def column_of(spark):
    """Evaluate one column expression over a list of values of one type."""

    def run(build, values, type_name="string"):
        frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {type_name}")
        rows = frame.select("i", build("v").alias("r")).orderBy("i").collect()
        return [row["r"] for row in rows]

    return run
