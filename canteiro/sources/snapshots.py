"""Snapshots of source datasets: write, latest, fallback, freshness."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro.operators.dedup import keep_last
from canteiro.operators.merge import VersionedTable, list_names

SNAPSHOT_LOG = "nome string, salvo_em timestamp, total_registros bigint, versao string"


def save_snapshot(df: DataFrame, root: str, name: str, saved_at: Column) -> None:
    """Write a dataset's snapshot and append its line to the snapshot log."""
    spark = df.sparkSession
    table = VersionedTable(spark, f"{root}/data/{name}")
    table.write(df)
    table.read().agg(F.count("*").alias("total_registros")).select(
        F.lit(name).alias("nome"),
        saved_at.cast("timestamp").alias("salvo_em"),
        "total_registros",
        F.lit("1.0").alias("versao"),
    ).write.mode("append").parquet(f"{root}/log")


def snapshot_log(spark: SparkSession, root: str) -> DataFrame:
    if not list_names(spark, f"{root}/log"):
        return spark.createDataFrame([], SNAPSHOT_LOG)
    return spark.read.schema(SNAPSHOT_LOG).parquet(f"{root}/log")


def load_snapshot(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """Latest snapshot of a dataset, however old."""
    return VersionedTable(spark, f"{root}/data/{name}").read()


def latest_lines(log: DataFrame) -> DataFrame:
    """Newest log line per dataset."""
    return keep_last(log.select("nome", "salvo_em", "total_registros", "versao"), ["nome"], ["salvo_em"])


def freshness(log: DataFrame, as_of: Column, max_days: int = 1) -> DataFrame:
    """Age and validity of the newest snapshot of each dataset."""
    hours = (F.unix_micros(as_of) - F.unix_micros("salvo_em")) / F.lit(3_600_000_000)
    return latest_lines(log).select(
        "nome",
        "salvo_em",
        F.bround(hours, 1).alias("idade_horas"),
        F.col("total_registros").alias("registros"),
        (hours <= max_days * 24).alias("valido"),
    )


def fresh_or_snapshot(fresh: DataFrame | None, spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The new load, or the last snapshot when the new load gives nothing; both in one plan."""
    return first_with_rows([lambda: fresh, lambda: load_snapshot(spark, root, name)])


def first_with_rows(strategies: Sequence[Callable[[], DataFrame | None]]) -> DataFrame | None:
    """Rows of the first strategy that yields any; None when there is no frame at all.

    Nothing runs before the result does: the frames are one union, tagged by place, and the least place that has a row
    is a scalar subquery that stops at the first row of each. Columns that only some of them have are NULL in the others.
    """
    frames = [frame for frame in (strategy() for strategy in strategies) if frame is not None]
    if len(frames) < 2:
        return frames[0] if frames else None
    present = [frame.select(F.lit(place).alias("place")).limit(1) for place, frame in enumerate(frames)]
    first = reduce(DataFrame.unionAll, present).agg(F.min("place").alias("place")).scalar()
    tagged = [frame.withColumn("__place", F.lit(place)) for place, frame in enumerate(frames)]
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), tagged)
    return merged.where(F.col("__place") == first).drop("__place")
