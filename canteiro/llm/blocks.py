"""Vectors in blocks, and the meeting of all asking rows with all blocks, for searches that read every row.

Vectors are packed into blocks of bounded size, dimension by dimension, and written. Blocks and asking rows are dealt to
cells: a cell holds a bounded group of asking rows and a group of blocks, and all cells together hold every asking row
with every block once. A task gets the rows of a cell in order, the asking rows first, and then takes one block after
the other, so it holds the asking rows and one block at a time. No pair of rows is ever a row of Spark's.

Weights are whole numbers, floor(scale * x). Where a product's sums stay below 2**53 they are computed in doubles, which
is exact there; else in Python's integers. A score beyond the range of a long counts as that range's end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, written

# components in a block of rows, and in the asking rows of a cell
BLOCK_VALUES = 1 << 18
CELL_VALUES = 1 << 21
# blocks that a cell takes one after the other, where there are enough cells
CELL_BLOCKS = 16
_PLACES = 20
_EXACT = 2.0**53
LEAST, MOST = -(2**63), 2**63 - 1


def takes_part(vector: Column) -> Column:
    """Not NULL, and without NULL, NaN and infinite components."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False)
    )


def blocked(frame: DataFrame, id_column: str, vector: str, label: Column, asks: Column, block_values: int = BLOCK_VALUES) -> DataFrame:
    """Blocks of rows of one label each, written: label, ids, rows (a number for each row), width, wide, flat, asking.

    ``flat`` holds the components, all rows of a dimension together, missing ones as 0; ``asking`` the places of the
    rows that ask. Rows without id, label or usable vector take no part.
    """
    kind = frame.schema[vector].dataType.elementType.simpleString()
    rows = frame.select(
        F.col(id_column).cast("long").alias("id"),
        label.cast("string").alias("label"),
        F.coalesce(asks, F.lit(False)).alias("asks"),
        F.col(vector).cast(f"array<{'float' if kind == 'float' else 'double'}>").alias("vector"),
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & takes_part(F.col("vector")))
    wide = kind != "float"
    # a label with most of the rows is spread by id
    dealt = rows.repartitionByRange("label", "id").sortWithinPartitions("label", "id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 42
        n, width, held, label = 0, 0, [], None
        for batch in batches:
            labels, vectors = batch.column("label").to_pylist(), batch.column("vector")
            ids, asking = batch.column("id").to_pylist(), batch.column("asks").to_pylist()
            for place in range(batch.num_rows):
                vector = vectors[place].values.to_numpy(zero_copy_only=False)
                grown = max(width, len(vector))
                if held and (labels[place] != label or (len(held) + 1) * grown > block_values or len(held) >> _PLACES):
                    yield _block(first + (n << _PLACES), label, held, width, wide)
                    n, width, held = n + 1, 0, []
                    grown = len(vector)
                width, label = grown, labels[place]
                held.append((ids[place], asking[place], vector))
        if held:
            yield _block(first + (n << _PLACES), label, held, width, wide)

    schema = "block long, label string, n int, width int, wide boolean, ids array<long>, asking array<int>, flat binary"
    return written(in_tasks(dealt, pack, schema), "blocks")


def _block(block: int, label: str, held: list, width: int, wide: bool) -> pa.RecordBatch:
    table = np.zeros((width, len(held)), dtype="<f8" if wide else "<f4")
    for place, (_, _, vector) in enumerate(held):
        table[: len(vector), place] = vector
    cells = {
        "block": pa.array([block], type=pa.int64()),
        "label": pa.array([label], type=pa.string()),
        "n": pa.array([len(held)], type=pa.int32()),
        "width": pa.array([width], type=pa.int32()),
        "wide": pa.array([wide]),
        "ids": pa.array([[i for i, _, _ in held]], type=pa.list_(pa.int64())),
        "asking": pa.array([[k for k, (_, asks, _) in enumerate(held) if asks]], type=pa.list_(pa.int32())),
        "flat": pa.array([table.tobytes()], type=pa.binary()),
    }
    return pa.RecordBatch.from_arrays(list(cells.values()), names=list(cells))


def asking_rows(blocks: DataFrame) -> DataFrame:
    """One row per asking row: row, label, id, width, wide, flat."""

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place in range(batch.num_rows):
                block = Block(batch, place)
                asking = batch.column("asking")[place].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(block.rows[k]) for k in asking], type=pa.int64()),
                        pa.array([block.label] * len(asking), type=pa.string()),
                        pa.array([int(block.ids[k]) for k in asking], type=pa.int64()),
                        pa.array([block.flat.shape[0]] * len(asking), type=pa.int32()),
                        pa.array([batch.column("wide")[place].as_py()] * len(asking), type=pa.bool_()),
                        pa.array([block.flat[:, k].tobytes() for k in asking], type=pa.binary()),
                    ],
                    names=["row", "label", "id", "width", "wide", "flat"],
                )

    asked = blocks.where(F.size("asking") > 0)
    return in_tasks(asked, pick, "row long, label string, id long, width int, wide boolean, flat binary")


class Block:
    """A block in a task: ids, rows, labels and flat (dimensions by rows) of its rows."""

    def __init__(self, batch: pa.RecordBatch, place: int):
        self.label = batch.column("label")[place].as_py()
        self.ids = batch.column("ids")[place].values.to_numpy(zero_copy_only=False)
        kind = "<f8" if batch.column("wide")[place].as_py() else "<f4"
        data = np.frombuffer(batch.column("flat")[place].as_buffer(), dtype=kind)
        width = batch.column("width")[place].as_py()
        self.flat = data.reshape(width, len(self.ids))
        self.rows = batch.column("block")[place].as_py() + np.arange(len(self.ids), dtype=np.int64)


def scaled(flat: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as doubles, or as Python's integers where a double would not hold it."""
    wide = flat.astype("f8")
    if not flat.size or np.abs(wide).max() * scale < _EXACT:
        return np.floor(wide * scale)
    values = [math.floor(x * scale) if math.isfinite(x * scale) else int(x) * scale for x in wide.ravel().tolist()]
    return np.array(values, dtype=object).reshape(wide.shape)


def exact(a: np.ndarray, b: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if all sums of their products are exact there, else both as Python's integers."""
    if a.dtype != object and b.dtype != object:
        if np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(width, 1) < _EXACT:
            return a, b
    whole = lambda w: w if w.dtype == object else np.array([int(x) for x in w.ravel()], dtype=object).reshape(w.shape)
    return whole(a), whole(b)


def held(scores: np.ndarray) -> np.ndarray:
    """Scores within the range of a long."""
    return np.array([min(max(s, LEAST), MOST) for s in scores], dtype=object) if scores.dtype == object else scores


def longs(scores: np.ndarray) -> np.ndarray:
    return np.array([int(s) for s in scores], dtype=np.int64)


def dealt(asking: DataFrame, blocks: DataFrame, by_label: bool, extra: dict[str, str] | None = None) -> DataFrame:
    """Asking rows and blocks in cells, each cell's rows together, the asking rows first; both sides are written frames.

    ``by_label``: only rows and blocks of one label meet. ``extra``: columns of the asking rows that go along.
    """
    spark = blocks.sparkSession
    key = F.col("label") if by_label else F.lit("")
    asks = asking.groupBy(key.alias("of")).agg(F.count("*").alias("n"), F.max("width").alias("width"))
    lists = blocks.groupBy(key.alias("of")).agg(F.count("*").alias("n_blocks"))
    fewest = max(1, 3 * spark.sparkContext.defaultParallelism)
    halves = F.ceil(F.col("n") * F.greatest(F.col("width"), F.lit(1)) / CELL_VALUES).cast("int")
    shares = F.least(F.col("n_blocks"), F.greatest(F.ceil(F.col("n_blocks") / CELL_BLOCKS), F.lit(1 if by_label else fewest))).cast("int")
    plan = written(asks.join(lists, "of").select("of", halves.alias("askers"), shares.alias("shares")), "cells")
    none = {name: F.lit(None).cast(kind).alias(name) for name, kind in (extra or {}).items()}
    number = F.pmod(F.xxhash64("row"), F.col("askers")).cast("int")
    left = (
        asking.withColumn("of", key)
        .join(plan, "of")
        .select(
            "of",
            number.alias("asker"),
            F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"),
            F.lit(0).alias("kind"),
            F.col("row").alias("block"),
            "label",
            F.array("id").alias("ids"),
            "width",
            "wide",
            "flat",
            *none,
        )
    )
    right = (
        blocks.withColumn("of", key)
        .join(plan, "of")
        .select(
            "of",
            F.explode(F.sequence(F.lit(0), F.col("askers") - 1)).alias("asker"),
            F.pmod(F.xxhash64("block"), F.col("shares")).cast("int").alias("share"),
            F.lit(1).alias("kind"),
            "block",
            "label",
            "ids",
            "width",
            "wide",
            "flat",
            *none.values(),
        )
    )
    cells = plan.agg(F.sum(F.col("askers").cast("long") * F.col("shares"))).first()[0] or 1
    cell = ("of", "asker", "share")
    return left.unionByName(right).repartition(min(int(cells), 20_000), *cell).sortWithinPartitions(*cell, "kind", "block")


def in_cells(cells: DataFrame, search: Callable[[list[dict]], object], schema: str, chunk_values: int = BLOCK_VALUES) -> DataFrame:
    """Run a search in each cell.

    ``search(asking)`` gets the asking rows (row, label, id, flat and the extra columns) and returns an object with
    ``meet(blocks)``, which takes a list of blocks, and ``found()``, which yields record batches. Small blocks come
    together, up to a block's size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = None
        cell, asking, finder, waiting, size = None, [], None, [], 0
        for batch in batches:
            names = names or [n for n in batch.schema.names if n not in ("of", "asker", "share", "kind", "block", "label", "ids", "width", "wide", "flat")]
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("of", "asker", "share", "kind")), strict=True))
            for place, (*now, kind) in enumerate(keys):
                if now != cell:
                    if finder is not None:
                        finder.meet(waiting)
                        yield from finder.found()
                    cell, asking, finder, waiting, size = now, [], None, [], 0
                block = Block(batch, place)
                if kind == 0:
                    row = {name: batch.column(name)[place].as_py() for name in names}
                    asking.append(row | {"row": int(block.rows[0]), "label": block.label, "id": int(block.ids[0]), "flat": block.flat[:, 0].copy()})
                    continue
                if finder is None:
                    finder = search(asking)
                if waiting and size + block.flat.size > chunk_values:
                    finder.meet(waiting)
                    waiting, size = [], 0
                block.flat = block.flat.copy()
                waiting.append(block)
                size += block.flat.size
        if finder is not None:
            finder.meet(waiting)
            yield from finder.found()

    return in_tasks(cells, run, schema)


class Chunk:
    """Blocks taken together: ids, rows, labels (numbers) and weights (dimensions by rows)."""

    def __init__(self, blocks: list[Block], scale: int, label_numbers: dict[str, int]):
        width = max((b.flat.shape[0] for b in blocks), default=0)
        parts = [np.pad(b.flat, ((0, width - b.flat.shape[0]), (0, 0))) if b.flat.shape[0] < width else b.flat for b in blocks]
        self.ids = np.concatenate([b.ids for b in blocks])
        self.rows = np.concatenate([b.rows for b in blocks])
        self.labels = np.concatenate([np.full(len(b.ids), label_numbers.get(b.label, -1)) for b in blocks])
        self.weights = scaled(np.concatenate(parts, axis=1), scale)


def padded(weights: np.ndarray, width: int) -> np.ndarray:
    """Rows of weights brought to a width; what is cut off meets only zeros."""
    n = weights.shape[1]
    if n >= width:
        return weights[:, :width]
    return np.concatenate([weights, np.zeros((len(weights), width - n), dtype=weights.dtype)], axis=1)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest scores, ties to smaller ids."""
    places = np.arange(len(scores))
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= edge)
    return places[np.lexsort((ids[places], -scores[places]))][:k]


def asked_weights(asking: list[dict], scale: int) -> np.ndarray:
    """Weights of asking rows, one row each."""
    width = max((len(a["flat"]) for a in asking), default=0)
    table = np.zeros((len(asking), width))
    for place, row in enumerate(asking):
        table[place, : len(row["flat"])] = row["flat"]
    return scaled(table, scale)
