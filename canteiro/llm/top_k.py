"""Exact top-k by inner product of whole-number weights, term at a time over postings.

Asking rows and blocks of all rows meet in cells (``blocks``). A task turns a block into postings, one list of
(row, weight) per term. Terms are taken one after the other: the asking rows that hold the term scatter their weight times
the posting weights into a dense array of scores. The best k of each asking row are found by partition selection, ties at
the k-th score included, and merged with those of the blocks before; the lists of all cells are merged by rank.

Defined cases: a vector that is NULL, or holds a NULL, NaN or infinite component, takes no part, nor does a row without
id; missing components of shorter vectors count as 0; rows that repeat, or share an id, are rows of their own, and a row
is left out of its own candidates only as that row; a score beyond a long counts as the long's end; fewer than k
candidates give fewer rows; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from canteiro.llm.blocks import (
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

# asking rows that scatter at once, so their scores stay in a core's cache
SCATTER_ROWS = 64


def postings(weights: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows that hold each term, and their weights; ``weights`` is terms by rows."""
    lists = [np.flatnonzero(row) for row in weights]
    return [(rows, weights[term, rows]) for term, rows in enumerate(lists)]


def accumulated(asked: list[tuple[np.ndarray, np.ndarray]], listed: list[tuple[np.ndarray, np.ndarray]], first: int, last: int, n: int, kind) -> np.ndarray:
    """Scores of asking rows first to last - 1 with n rows, from the postings of both."""
    scores = np.zeros((last - first, n), dtype=kind)
    for (askers, weights), (rows, row_weights) in zip(asked, listed, strict=True):
        some = slice(*np.searchsorted(askers, (first, last)))
        if some.start < some.stop and len(rows):
            scores[np.ix_(askers[some] - first, rows)] += np.multiply.outer(weights[some], row_weights)
    return scores


class Search:
    """The best k of each asking row of a cell."""

    def __init__(self, asking: list[dict], scale: int, k: int):
        self.asking, self.scale, self.k = asking, scale, k
        self.asked = asked_weights(asking, scale)
        self.ids = [np.empty(0, dtype=np.int64) for _ in asking]
        self.scores = [np.empty(0, dtype=object) for _ in asking]

    def meet(self, blocks: list) -> None:
        if not blocks:
            return
        chunk = Chunk(blocks, self.scale, {})
        width = chunk.weights.shape[0]
        asked, weights = exact(padded(self.asked, width), chunk.weights, width)
        asked_lists, listed = postings(asked.T), postings(weights)
        own = {int(row): place for place, row in enumerate(chunk.rows)}
        for first in range(0, len(self.asking), SCATTER_ROWS):
            last = min(first + SCATTER_ROWS, len(self.asking))
            scores = accumulated(asked_lists, listed, first, last, len(chunk.ids), weights.dtype)
            for query in range(first, last):
                found, ids = scores[query - first], chunk.ids
                place = own.get(self.asking[query]["row"])
                if place is not None:
                    found, ids = np.delete(found, place), np.delete(ids, place)
                self.add(query, held(found), ids)

    def add(self, query: int, scores: np.ndarray, ids: np.ndarray) -> None:
        places = best(scores, ids, self.k)
        scores = np.concatenate([self.scores[query], np.array([int(s) for s in scores[places]], dtype=object)])
        ids = np.concatenate([self.ids[query], ids[places]])
        order = best(scores, ids, self.k)
        self.scores[query], self.ids[query] = scores[order], ids[order]

    def found(self) -> Iterator[pa.RecordBatch]:
        sizes = [len(ids) for ids in self.ids]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat([a["row"] for a in self.asking], sizes), type=pa.int64()),
                pa.array(np.repeat([a["id"] for a in self.asking], sizes), type=pa.int64()),
                pa.array(np.concatenate(self.ids), type=pa.int64()),
                pa.array(longs(np.concatenate(self.scores)), type=pa.int64()),
            ],
            names=["row", "query_id", "id", "score"],
        )


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """query_id, rank (from 1), id and score of the k best candidates of each row that the condition picks."""
    blocks = blocked(vectors, id_column, vector_column, F.lit(""), queries)
    asking = written(asking_rows(blocks), "asking")
    found = in_cells(dealt(asking, blocks, by_label=False), lambda rows: Search(rows, scale, k), "row long, query_id long, id long, score long")
    order = Window.partitionBy("row").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_column), "score")
