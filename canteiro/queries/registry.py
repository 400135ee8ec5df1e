"""Registered queries: a Spark build over the given tables, and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro.session import configure

# the reference time of every query, in both engines
AS_OF_TEXT = "2000-01-01 00:00:00"


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


_CONFIGURED: set[str] = set()


def _configured(spark: SparkSession) -> SparkSession:
    """The session with the library's settings, which are applied once per application."""
    application = spark.sparkContext.applicationId
    if application not in _CONFIGURED:
        _CONFIGURED.add(application)
        configure(spark)
    return spark


class Tables:
    """The given tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = _configured(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def as_of() -> Column:
    return F.lit(AS_OF_TEXT).cast("timestamp")


def day(column: str | Column) -> Column:
    """Day of a timestamp as text, so both engines give the same value."""
    return F.date_format(column, "yyyy-MM-dd")


def query(sql: str | None = None) -> Callable:
    """Register a function of ``Tables`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = Query(lambda spark, folder: build(Tables(spark, folder)), sql)
        return build

    return register
