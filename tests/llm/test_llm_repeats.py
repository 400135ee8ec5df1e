"""Repeated passages against brute force."""

import random
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from canteiro.llm import repeats, windows
from canteiro.llm.queries import QUERIES


def brute(rows, width):
    texts = [(d, (t or "").encode()) for d, t in rows]
    starts = Counter(data[i : i + width] for _, data in texts for i in range(len(data) - width + 1))
    out = Counter()
    for doc, data in texts:
        gone = bytearray(len(data))
        for i in range(len(data) - width + 1):
            if starts[data[i : i + width]] > 1:
                gone[i : i + width] = b"\x01" * width
        n_spans = sum(1 for i, x in enumerate(gone) if x and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out[doc, len(data), sum(gone), n_spans, sha256(kept).hexdigest()] += 1
    return out


def found(frame, width):
    rows = repeats.without_repeats(frame, width=width).collect()
    return Counter((r.doc, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_repeats_in_odd_texts(spark, odd_documents, odd_rows, no_documents):
    rows = [(d, t) for d, t, _ in odd_rows]
    for width in (8, 40):
        assert found(odd_documents, width) == brute(rows, width)
    assert repeats.without_repeats(no_documents).count() == 0


@pytest.mark.parametrize("letters", ["a", "ab", "abcdé "])
def test_passages_that_overlap_and_differ_at_their_edges(spark, letters):
    rng = random.Random(len(letters))
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    passages = [some(n) for n in (19, 20, 21, 30, 60, 200)]
    rows = []
    for i in range(120):
        parts = [some(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            begin = rng.randint(0, 6)
            parts += [passage[begin : len(passage) - rng.randint(0, 6)], some(rng.randint(0, 15))]
        rows.append((i, "".join(parts)))
    rows += [(500, "".join(passages)), (501, some(300) * 3), (502, rows[7][1]), (502, rows[7][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    for width in (20, 33):
        assert found(frame, width) == brute(rows, width)


def test_long_texts_are_read_in_parts(spark, monkeypatch):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    rows = [(1, base), (2, base[1000:3000] + "x" + base[3000:3100]), (3, "y" * 1500), (4, base[4990:] + base[:7])]
    whole = {d: [] for d, _ in rows}
    for chunk in (64, 1 << 20):
        monkeypatch.setattr(windows, "CHUNK", chunk)
        for doc, text in rows:
            items = [x for part in windows.anchors(text.encode(), 40, 10) for x in zip(*(c.tolist() for c in part), strict=True)]
            starts = {s: (h, p) for h, p, first, last in items for s in range(first, last + 1)}
            assert sorted(starts) == list(range(max(0, len(text) - 39)))
            assert all(s <= p <= s + 30 for s, (_, p) in starts.items())
            whole[doc].append(starts)
    assert all(a == b for a, b in whole.values())
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(frame, 40) == brute(rows, 40)


def test_kept_bytes_and_spans(spark):
    rows = [(1, "0123456789é" * 2), (2, "begin 0123456789é end"), (3, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc: r for r in repeats.without_repeats(frame, width=12, with_kept=True).collect()}
    assert got[1].kept == b"" and [tuple(s) for s in got[1].spans] == [(0, 24)]
    assert got[2].kept == b"begin  end" and [tuple(s) for s in got[2].spans] == [(6, 18)]
    assert (got[3].n_bytes, got[3].kept, got[3].spans) == (0, b"", [])


def test_registered_query(spark, data):
    documents = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = QUERIES["op13_repeats"][0](spark, data).collect()
    seen = defaultdict(int)
    for r in got:
        seen[r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256] += 1
    assert seen == brute(rows, 200) and sum(r.n_removed for r in got) > 0
