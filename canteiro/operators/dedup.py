"""One row per key.

Every operator filters ``row_number() = 1``. Spark then puts a group limit before the exchange, so
each map task sends at most one row per key: a key holding a third of all rows costs no more
than any other. The order must be total for the result to be repeatable.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro import vocab

_RANK = "__rank"


def with_source_position(df: DataFrame) -> DataFrame:
    """Add the three columns that order file rows as their source does.

    Within one block of one file the row id grows with the row, so (file, block, id) is the
    source order whichever way splits are packed into tasks. Use directly after a file read.
    """
    return df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


SOURCE_POSITION = ("_file", "_block", "_row")


def _columns(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(f"`{n}`") if isinstance(n, str) else n for n in names]


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]) -> DataFrame:
    """First row of each key in the given order. NULL counts as one key value."""
    window = Window.partitionBy(*_columns(keys)).orderBy(*_columns(order))
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each key in the given order."""
    return keep_first(df, keys, [F.col(name).desc() for name in order])


def all_present(keys: Sequence[str]) -> Column:
    return reduce(lambda left, right: left & right, [F.col(f"`{key}`").isNotNull() for key in keys])


def split_null_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the rejects: a row without a key has no identity."""
    complete = all_present(keys)
    return df.where(complete), df.where(~complete)


def keep_first_known(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """As ``keep_first`` among rows with a complete key; rows without one all stay."""
    known, unknown = split_null_keys(df, keys)
    return keep_first(known, keys, order).unionByName(unknown)


def distinct_rows(
    df: DataFrame, order: Sequence[str | Column] = (), ignore: Sequence[str] = ()
) -> DataFrame:
    """Full-row deduplication over the columns that are not nested and not ignored.

    Without an order the rows must be equal in every column; with one, the first row stays.
    """
    skipped = set(ignore)
    compared = [
        f.name
        for f in df.schema.fields
        if f.name not in skipped and not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))
    ]
    if order:
        return keep_first(df, compared, order)
    return df.dropDuplicates(compared)


def source_rank(source: str | Column, priority: Sequence[str] = vocab.SOURCE_PRIORITY) -> Column:
    """Place in the priority list, 0 is best; unknown sources come last."""
    source = F.col(source) if isinstance(source, str) else source
    place = F.array_position(F.array(*[F.lit(name) for name in priority]), source)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(priority))).cast("int")


def one_per_source(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """One work per (source, source id)."""
    return keep_first(df, ["fonte_origem", "id_origem"], order)


def best_across_sources(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """One work per source id whatever its source; the best-ranked source wins."""
    return keep_first(df, ["id_origem"], [source_rank("fonte_origem"), *_columns(order)])


def merge_extracts(
    extracts: Sequence[DataFrame],
    order: Sequence[str | Column],
    candidates: Sequence[str] = ("número", "numero", "processo", "código", "codigo"),
    parity: bool = False,
) -> DataFrame:
    """Union of several extracts, one row per number.

    The key is the first candidate that equals a whole column name; without one, whole rows
    are compared. Rows without a number all stay; ``parity`` makes one row of them.
    """
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), extracts)
    lowered = {name.strip().lower(): name for name in reversed(merged.columns)}
    for candidate in candidates:
        if candidate in lowered:
            keep = keep_first if parity else keep_first_known
            return keep(merged, [lowered[candidate]], order)
    ignored = [name for name in order if isinstance(name, str)]
    return distinct_rows(merged, order, ignore=ignored)


def merge_localities(
    parts: Sequence[DataFrame], identifiers: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Union of per-locality extracts; earlier parts win, rows are known by the first filled
    identifier, else by their whole content."""
    marked = [part.withColumn("_part", F.lit(place)) for place, part in enumerate(parts)]
    merged = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), marked)
    content = [name for name in merged.columns if name not in order and name != "_part"]
    digest = F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in content]), {"ignoreNullFields": "false"}), 256)
    identity = F.coalesce(*[F.nullif(F.col(f"`{name}`").cast("string"), F.lit("")) for name in identifiers], digest)
    return keep_first(merged, [identity], ["_part", *order]).drop("_part")
