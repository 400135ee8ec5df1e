"""Searches over all vectors: top-k and hard negatives against brute force, on odd vectors and on many rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from canteiro.llm import blocks, negatives, top_k

NAN, INF = float("nan"), float("inf")
VECTORS = {
    0: [0.1, -0.2, 0.3], 1: [0.1, -0.2, 0.3], 2: None, 3: [0.5, None], 4: [NAN], 5: [INF, 1.0], 6: [], 7: [1.0],
    8: [1e30], 9: [0.9, 0.9], 10: [1e9, 1.0], 11: [2.0**45 + 0.0078125, 1.0], 12: [-1e30, 5.0], 13: [1e308, -3.0],
    50: [0.0, 0.0, 0.0], 100: [-1.0, 0.5, 0.25, 8.0], 150: [1e9, 1.0], 200: [3e200, 1.0],
}


def whole(x):
    scaled = 256 * x
    return math.floor(scaled) if math.isfinite(scaled) else int(x) * 256


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def product(a, b):
    return min(max(sum(whole(x) * whole(y) for x, y in zip(a, b, strict=False)), -(2**63)), 2**63 - 1)


def brute_top_k(rows, k):
    rows = [(i, v) for i, v in rows if i is not None and usable(v)]
    out = Counter()
    for place, (q, v) in enumerate(rows):
        if q % 50 == 0:
            scored = sorted((-product(v, w), i) for other, (i, w) in enumerate(rows) if other != place)
            out.update((q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1))
    return out


def test_top_k_of_wide_and_repeated_vectors(spark):
    rows = [*VECTORS.items(), (3, [0.25]), (3, [0.25]), (0, [0.1, -0.2, 0.3]), (None, [1.0])]
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, score int, `rank` string")
    for parts in (1, 4):
        found = top_k.top_k(frame.repartition(parts), F.col("vec_id") % 50 == 0, 4).collect()
        assert Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in found) == brute_top_k(rows, 4)


def brute_negatives(rows, k_positive=5, k_negative=3, low=50, high=95):
    rows = [r for r in rows if r[0] is not None and r[2] is not None and usable(r[1])]
    out = Counter()
    for place, (anchor, v, label) in enumerate(rows):
        if anchor % 50:
            continue
        others = sorted((-product(v, w), i, s == label) for other, (i, w, s) in enumerate(rows) if other != place)
        for ps, positive, _ in [o for o in others if o[2]][:k_positive]:
            inside = [(s, i) for s, i, same in others if not same and low * -ps <= 100 * -s <= high * -ps]
            out.update((anchor, positive, r, i, -ps, -s) for r, (s, i) in enumerate(inside[:k_negative], 1))
    return out


def found_negatives(frame, **options):
    rows = negatives.hard_negatives(frame, F.col("vec_id") % 50 == 0, F.col("label"), **options).collect()
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in rows)


SCHEMA = "vec_id long, embedding array<double>, label int, score int, `row` string, `rank` int, place string"


def test_hard_negatives_of_odd_vectors(spark):
    rows = [(i, v, i % 3) for i, v in VECTORS.items()]
    rows += [(300, [0.5, 0.5], 1), (300, [0.5, 0.5], 1), (301, [0.5, 0.5], 1), (302, [0.45, 0.4], 2), (302, [0.45, 0.4], 2)]
    rows += [(303, [0.5, 0.5], None), (None, [0.5, 0.5], 1), (304, [0.3, 0.3], 0), (350, [0.0], 7), (351, [0.0], 7), (352, [], 8)]
    frame = spark.createDataFrame([(*r, 1, "r", 2, "p") for r in rows], SCHEMA)
    expected = brute_negatives(rows)
    assert len(expected) > 20
    for parts in (1, 5):
        assert found_negatives(frame.repartition(parts)) == expected
    assert not found_negatives(frame.limit(0))


@pytest.mark.parametrize("kind", ["float", "double"])
def test_hard_negatives_with_one_large_label(spark, kind, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(4, 24))
    rows = []
    for i in range(900):
        label = 0 if i % 3 else int(rng.integers(0, 60))
        vector = np.round(centres[i % 4] + rng.normal(size=24) * 0.4, 2).astype("f4")
        rows.append((i, [float(x) for x in vector], label))
    rows += rows[40:60]
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    # small blocks and cells, so that a label and an anchor's windows meet in many of them
    made = blocks.blocked(frame, "vec_id", "embedding", F.col("label"), F.lit(True), 24 * 30)
    assert made.agg(F.max("n")).first()[0] == 30 and made.agg(F.sum("n")).first()[0] == len(rows)
    monkeypatch.setattr(blocks, "CELL_VALUES", 24 * 4)
    monkeypatch.setattr(blocks, "CELL_BLOCKS", 2)
    assert found_negatives(frame) == brute_negatives(rows)


def test_bounds_drop_rows_and_keep_the_best():
    rng = np.random.default_rng(1)
    columns = np.floor(rng.normal(size=(64, 4000)) * 30 * (0.9 ** np.arange(64))[:, None])
    query = np.floor(rng.normal(size=64) * 30 * 0.9 ** np.arange(64))
    bounds = negatives.Bounds(query[None, :], columns)
    sizes = []

    def wanted(low, high):
        alive = high >= negatives.kth(low, 5)
        sizes.append(int(alive.sum()))
        return alive

    places, scores = bounds.scan(0, query, columns, None, wanted)
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] < 100
    truth = query @ columns
    assert np.array_equal(scores, truth[places])
    assert set(np.argsort(-truth)[:5]) <= set(places)
