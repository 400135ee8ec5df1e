"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import canteiro
from canteiro.operators.staging import checkpoint_dir, shared_folder, written  # noqa: F401

# a word is a run of anything but the six ASCII white-space characters
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str | Column) -> Column:
    """Words of a text in order; none for NULL."""
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def word_count(text: str | Column) -> Column:
    return F.size(words(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def whole_part(value: Column, by: Column | int) -> Column:
    """Integer division."""
    return F.call_function("div", value, by if isinstance(by, Column) else F.lit(by))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of a session, once."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(canteiro.__file__).parent
    # the driver serves the file to executors as they ask for it, so it stays as long as the driver
    archive = Path(tempfile.mkdtemp(prefix="canteiro-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for file in sorted(package.rglob("*.py")):
            packed.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def in_tasks(frame: DataFrame, function: Callable[[Iterator], Iterator], schema: str) -> DataFrame:
    """``mapInArrow`` with this package at hand in the tasks."""
    ship_package(frame.sparkSession)
    return frame.mapInArrow(function, schema)


# parts that a key with most of the rows is spread over
SALTS = 16


def spread_join(rows: DataFrame, small: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Join of rows with a side that has each key once; rows of one key are dealt by a hash of ``by``, so they
    don't meet in one task."""
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int"))
    return salted.join(copies, [key, "__salt"], how).drop("__salt")


def row_hash(*columns: str | Column) -> Column:
    """64-bit hash of cells; NULL and empty differ."""
    parts: list[Column] = []
    for column in columns:
        value = F.col(column) if isinstance(column, str) else column
        parts += [value.isNull(), value]
    return F.xxhash64(*parts)


def with_running_total(
    frame: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str | Column], value: Column, name: str
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same keys, as a long.

    Rows are ordered by ``bucket``, then ``order``. Each window holds one bucket of one key, and a second window adds
    one row per bucket, so a key with most of the rows is spread over as many tasks as it has buckets. The frame is
    read twice: pass a written one. Keys must not be NULL.
    """
    inside = Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(value).cast("long")
    sums = frame.groupBy(*keys, bucket).agg(total.alias("__sum"))
    starts = sums.select(*keys, bucket, F.coalesce(F.sum("__sum").over(above), F.lit(0)).alias("__start"))
    rows = frame.withColumn("__inside", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        rows.join(starts, [*keys, bucket])
        .withColumn(name, (F.col("__start") + F.col("__inside")).cast("long"))
        .drop("__start", "__inside")
    )
