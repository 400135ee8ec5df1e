"""Reproducible shuffle into shards: a keyed permutation of global row numbers.

Rows are numbered in the order of the given columns, and a Feistel network permutes the numbers. Shard and slot follow
from the permuted number alone: ``number % shards`` and ``number // shards``. Shard sizes differ by one row at most,
and the row of any slot can be computed without reading the others.

Defined cases: equal rows get different numbers, in any order among themselves; NULLs sort first; an empty table gives
an empty table. Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from canteiro.llm.common import row_hash, whole_part, written
from canteiro.llm.feistel import permuted, seeded

def numbered(frame: DataFrame, order: list[str], name: str = "row_number") -> DataFrame:
    """Global row numbers from 0 in the order of the given columns, which should leave only equal rows tied.

    Rows are dealt into ranges and sorted; a number is the row's place in its range plus the rows of the ranges
    before it. Only one row per range is summed over all.
    """
    ranged = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = written(ranged.withColumn("__place", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("__place", 33), F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    ends = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ends.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    rows = placed.withColumn("__part", part).join(starts, "__part")
    return rows.withColumn(name, (F.col("__start") + inside).cast("long")).drop("__part", "__place", "__start", "__n")


def sharded(frame: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """The rows with row_number, shard and slot. Columns of these names are replaced."""
    names = [c for c in frame.columns if c not in ("row_number", "shard", "slot")]
    # the user's columns travel in a struct; a hash of all of them, maps as JSON texts, settles ties
    cells = [
        F.to_json(F.struct(F.col(f"`{c}`")), {"ignoreNullFields": "false"}) if "map<" in kind else F.col(f"`{c}`")
        for c, kind in frame.dtypes
        if c in names
    ]
    keys = [F.col(f"`{c}`").alias(f"key{place}") for place, c in enumerate(order)]
    whole = F.struct(*[F.col(f"`{c}`") for c in names]).alias("row")
    boxed = frame.select(*keys, row_hash(*cells).alias("tie"), whole)
    rows = numbered(boxed, [*(f"key{place}" for place in range(len(order))), "tie"])
    total = rows.count()
    place = permuted(F.col("row_number"), total, seeded(seed))
    return rows.withColumn("at", place).select(
        *[F.col("row").getField(c).alias(c) for c in names],
        "row_number",
        F.pmod("at", F.lit(shards)).cast("int").alias("shard"),
        whole_part(F.col("at"), shards).alias("slot"),
    )
