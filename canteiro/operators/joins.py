"""Lookups against a side that is unique by its key.

No broadcast is forced: Spark broadcasts the lookup only when its measured size is under the
session threshold, and otherwise sorts both sides and splits hot partitions (adaptive skew join).
Rows without a key are spread over the tasks instead of meeting in one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NO_KEY = "\u0000"


def _spread_key(df: DataFrame, key: str) -> Column:
    """The key as text; a NULL key becomes a value that no lookup holds and that varies by row."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    flat = [F.col(f"`{f.name}`") for f in df.schema.fields if not isinstance(f.dataType, nested)]
    filler = F.concat(F.lit(_NO_KEY), F.xxhash64(*flat).cast("string"))
    return F.coalesce(F.col(f"`{key}`").cast("string"), filler)


def attach(
    left: DataFrame,
    lookup: DataFrame,
    left_key: str,
    lookup_key: str,
    columns: dict[str, str],
) -> DataFrame:
    """Left join on one nullable key; ``columns`` maps lookup columns to output names."""
    right = lookup.where(F.col(lookup_key).isNotNull()).select(
        F.col(lookup_key).cast("string").alias("__key"),
        *[F.col(source).alias(target) for source, target in columns.items()],
    )
    return (
        left.withColumn("__left_key", _spread_key(left, left_key))
        .join(right, F.col("__left_key") == F.col("__key"), "left")
        .drop("__key", "__left_key")
    )


def match_or_reject(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Rows with a partner, joined to it, and the rows without one."""
    condition = [left[a] == right[b] for a, b in zip(left_keys, right_keys, strict=True)]
    return left.join(right, condition, "inner"), left.join(right, condition, "left_anti")


MATCHED = "__matched"


def marked_matches(
    left: DataFrame, right: DataFrame, left_keys: Sequence[str], right_keys: Sequence[str]
) -> DataFrame:
    """The rows of ``match_or_reject`` in one frame, from one join: ``MATCHED`` is true beside a partner and false on a
    row without one, whose cells of ``right`` are NULL."""
    marked = right.withColumn(MATCHED, F.lit(True))
    condition = [left[a] == marked[b] for a, b in zip(left_keys, right_keys, strict=True)]
    return left.join(marked, condition, "left").withColumn(MATCHED, F.coalesce(F.col(MATCHED), F.lit(False)))


def within_keys(df: DataFrame, key: str, wanted: DataFrame, wanted_key: str) -> DataFrame:
    """Rows whose key is in another dataset."""
    keys = wanted.select(F.col(wanted_key).cast("string").alias("__wanted")).where(
        F.col("__wanted").isNotNull()
    )
    return df.join(keys, df[key].cast("string") == F.col("__wanted"), "left_semi")
