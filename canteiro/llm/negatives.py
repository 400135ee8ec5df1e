"""Hard negatives by a vertical scan in branch-and-bound (BOND).

An anchor's positives are its best rows of the same label; a positive's hard negatives are the best rows of other labels
whose score lies in a window below the positive's. Scores are inner products of whole-number weights.

A task reads a block of rows dimension by dimension, in the order in which the anchor's weights fall in size. After each
step it knows for every row the sum so far, and from the block's least and greatest value of each dimension the least and
the most that the remaining dimensions can add. Rows that these bounds put below the best ones found, or outside of every
window, leave the bitmap of candidates; the others are read to the end, so all scores that count are exact.

The positives are searched first, in blocks of the anchor's label, then the negatives in all blocks; both searches read
every row (``blocks``). A label with most of the rows is spread over many blocks and cells.

Defined cases: rows without id or label, and vectors that are NULL or hold NULL, NaN or infinite components, take no
part; missing components of shorter vectors count as 0; rows that repeat, or share an id, are rows of their own, and an
anchor is left out of its own candidates only as that row; an anchor without positives, or a positive without negatives,
gives no row; a negative positive score has an empty window; a score beyond a long counts as the long's end; an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canteiro.llm.blocks import (
    LEAST,
    Chunk,
    asked_weights,
    asking_rows,
    best,
    blocked,
    dealt,
    exact,
    held,
    in_cells,
    longs,
    padded,
)
from canteiro.llm.common import written

POSITIVES = 5
NEGATIVES = 3
# window of a negative's score in percent of the positive's
LOW_PERCENT = 50
HIGH_PERCENT = 95


def _ends(width: int) -> list[int]:
    """Dimensions read after each step: an eighth, a quarter, a half, all."""
    return sorted({max(1, width // 8), max(1, width // 4), max(1, width // 2), width}) if width else []


class Bounds:
    """Order of dimensions of each asking row, and what the dimensions after each step add at least and at most."""

    def __init__(self, asked: np.ndarray, columns: np.ndarray):
        self.ends = _ends(columns.shape[0])
        self.order = np.argsort(np.array([[-abs(w) for w in row] for row in asked]) if asked.dtype == object else -np.abs(asked), axis=1, kind="stable")
        if not self.ends:
            return
        low, high = columns.min(axis=1), columns.max(axis=1)
        a, b = asked * low, asked * high
        least = np.take_along_axis(np.minimum(a, b), self.order, axis=1)
        most = np.take_along_axis(np.maximum(a, b), self.order, axis=1)
        # sums from each place to the end
        self.least = np.flip(np.cumsum(np.flip(least, axis=1), axis=1), axis=1)
        self.most = np.flip(np.cumsum(np.flip(most, axis=1), axis=1), axis=1)

    def scan(self, query: int, weights: np.ndarray, columns: np.ndarray, places: np.ndarray | None, wanted) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows that are left, and their scores; ``wanted(low, high)`` gives the bitmap of those to keep."""
        n = columns.shape[1] if places is None else len(places)
        scores = np.zeros(n, dtype=columns.dtype)
        begin = 0
        for end in self.ends:
            dims = self.order[query, begin:end]
            part = columns[dims] if places is None else columns[np.ix_(dims, places)]
            scores = scores + weights[dims] @ part
            begin = end
            if end == columns.shape[0] or not len(scores):
                break
            alive = wanted(held(scores + self.least[query, end]), held(scores + self.most[query, end]))
            if not alive.all():
                kept = np.flatnonzero(alive)
                places = kept if places is None else places[kept]
                scores = scores[kept]
        return np.arange(n) if places is None else places, held(scores)


def kth(values: np.ndarray, k: int):
    """The k-th greatest value, or None."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


class Kept:
    """The best of what was found so far."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, dtype=object)
        self.ids = np.empty(0, dtype=np.int64)

    def least(self):
        return self.scores[-1] if len(self.scores) == self.k else LEAST

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(scores):
            return
        first = best(scores, ids, self.k)
        scores = np.concatenate([self.scores, np.array([int(s) for s in scores[first]], dtype=object)])
        ids = np.concatenate([self.ids, ids[first]])
        order = best(scores, ids, self.k)
        self.scores, self.ids = scores[order], ids[order]


class _Search:
    """What both searches share."""

    def __init__(self, asking: list[dict], scale: int):
        self.asking, self.scale = asking, scale
        self.names: dict[str, int] = {}
        self.labels = np.array([self.names.setdefault(a["label"], len(self.names)) for a in asking])
        self.asked = asked_weights(asking, scale)

    def meet(self, blocks: list) -> None:
        if not blocks:
            return
        chunk = Chunk(blocks, self.scale, self.names)
        width = chunk.weights.shape[0]
        asked, columns = exact(padded(self.asked, width), chunk.weights, width)
        bounds = Bounds(asked, columns)
        for query in range(len(self.asking)):
            self.one(query, asked[query], bounds, columns, chunk)


class Positives(_Search):
    """Best rows of the anchor's label."""

    def __init__(self, asking: list[dict], scale: int, k: int):
        super().__init__(asking, scale)
        self.kept = [Kept(k) for _ in asking]

    def one(self, query: int, weights: np.ndarray, bounds: Bounds, columns: np.ndarray, chunk: Chunk) -> None:
        kept = self.kept[query]
        same = (chunk.labels == self.labels[query]) & (chunk.rows != self.asking[query]["row"])
        places = None if same.all() else np.flatnonzero(same)

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            sure = kth(low, kept.k)
            return high >= (kept.least() if sure is None else max(kept.least(), sure))

        places, scores = bounds.scan(query, weights, columns, places, wanted)
        kept.add(scores, chunk.ids[places])

    def found(self) -> Iterator[pa.RecordBatch]:
        sizes = [len(k.ids) for k in self.kept]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([a["row"] for a in self.asking], sizes), type=pa.int64()),
                pa.array(np.concatenate([k.ids for k in self.kept]), type=pa.int64()),
                pa.array(longs(np.concatenate([k.scores for k in self.kept])), type=pa.int64()),
            ],
            names=["row", "id", "score"],
        )


class Negatives(_Search):
    """Best rows of other labels in the window of each of the anchor's positives."""

    def __init__(self, asking: list[dict], scale: int, k: int, low_percent: int, high_percent: int):
        super().__init__(asking, scale)
        self.windows = []
        for row in asking:
            spans = []
            for place, score in enumerate(row["positive_scores"]):
                # whole numbers between the percents of the score
                low, high = -(-low_percent * score // 100), high_percent * score // 100
                if low <= high:
                    spans.append((place, low, high, Kept(k)))
            self.windows.append(spans)

    def one(self, query: int, weights: np.ndarray, bounds: Bounds, columns: np.ndarray, chunk: Chunk) -> None:
        windows = self.windows[query]
        other = chunk.labels != self.labels[query]
        if not windows or not other.any():
            return
        places = None if other.all() else np.flatnonzero(other)

        def wanted(low: np.ndarray, high: np.ndarray) -> np.ndarray:
            alive = np.zeros(len(low), dtype=bool)
            for _, least, most, kept in windows:
                sure = kth(low[(low >= least) & (high <= most)], kept.k)
                least = max(least, kept.least(), least if sure is None else sure)
                alive |= (high >= least) & (low <= most)
            return alive

        places, scores = bounds.scan(query, weights, columns, places, wanted)
        for _, least, most, kept in windows:
            inside = np.flatnonzero((scores >= max(least, kept.least())) & (scores <= most))
            kept.add(scores[inside], chunk.ids[places[inside]])

    def found(self) -> Iterator[pa.RecordBatch]:
        rows = [
            (a["row"], place, a["id"], a["positive_ids"][place], a["positive_scores"][place], int(negative), int(score))
            for a, windows in zip(self.asking, self.windows, strict=True)
            for place, _, _, kept in windows
            for negative, score in zip(kept.ids, kept.scores, strict=True)
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 7
        names = ["row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    label: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low_percent: int = LOW_PERCENT,
    high_percent: int = HIGH_PERCENT,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score for the rows that ``anchors`` picks."""
    blocks = blocked(vectors, id_column, vector_column, label, anchors)
    asking = written(asking_rows(blocks), "anchors")

    found = in_cells(
        dealt(asking, blocks, by_label=True), lambda rows: Positives(rows, scale, positives), "row long, id long, score long"
    )
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    first = written(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= positives), "positives")
    listed = first.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "id", "score"))).alias("found"))
    paired = asking.join(
        listed.select("row", F.col("found.id").alias("positive_ids"), F.col("found.score").alias("positive_scores")), "row"
    )
    extra = {"positive_ids": "array<long>", "positive_scores": "array<long>"}
    schema = "row long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    near = in_cells(
        dealt(written(paired, "anchors"), blocks, by_label=False, extra=extra),
        lambda rows: Negatives(rows, scale, negatives, low_percent, high_percent),
        schema,
    )
    order = Window.partitionBy("row", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
