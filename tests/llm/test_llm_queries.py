"""Registered queries against their SQL or a brute-force version, over whole tables."""

import base64  # noqa: F401
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare, duck
from tokenizers import Tokenizer

import __spark_entry__ as entry_points
from canteiro.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"


@pytest.fixture(scope="module")
def connection(data):
    return duck(data)


@pytest.fixture(scope="module")
def documents(connection):
    return connection.sql("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def ids(documents, vocabulary):
    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    return {d: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for d, t, _ in documents}


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def word_list(text):
    return [w.decode() for w in (text or "").encode().split()]


def test_registered():
    names = set(entry_points.queries())
    assert set(QUERIES) | {"pipeline"} <= names
    assert {n.split("_")[0] for n in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_matches_sql(spark, data, connection, name):
    build, sql = QUERIES[name]
    assert compare(build(spark, data), connection, sql) is None


def targets(sizes):
    """Water filling step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        left = total - sum(full.values())
        share = left / max(1, sum(weight[s] for s in names if s not in full))
        above = [s for s in names if s not in full and share * weight[s] > 3 * sizes[s]]
        if not above:
            return {s: full.get(s, share * weight[s]) for s in names}
        full |= {s: 3 * sizes[s] for s in above}


def test_mixed_sources(spark, data, documents):
    rows = {r.doc_id: r for r in QUERIES["op1_mixed_sources"][0](spark, data).collect()}
    size = {d: len(word_list(t)) for d, t, _ in documents}
    source_size = Counter()
    for d, _, s in documents:
        source_size[s] += size[d]
    target = targets(source_size)
    taken = Counter()
    assert set(rows) == set(size)
    for d, _, s in documents:
        assert (rows[d].size, rows[d].source_size) == (size[d], source_size[s])
        assert rows[d].target == pytest.approx(target[s])
        assert 0 <= rows[d].taken <= 3 * size[d]
        taken[s] += rows[d].taken
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in target)
    again = {r.doc_id: r for r in QUERIES["op1_mixed_sources"][0](spark, data).collect()}
    assert again == rows


def test_id_files(spark, data, ids):
    rows = sorted(QUERIES["op5_id_files"][0](spark, data).collect())
    start = 0
    assert [r.doc_id for r in rows] == sorted(ids)
    for row in rows:
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids[row.doc_id]), crc(ids[row.doc_id]))
        start += row.n_tokens


def best_count(scores, byte_score, pretoken):
    """Forward scores of one pre-token, without a trie."""
    best = [(0.0, 0)]
    for end in range(1, len(pretoken) + 1):
        here = None
        for begin in range(max(0, end - 20), end):
            piece = scores.get(pretoken[begin:end])
            if piece is not None and (here is None or best[begin][0] + piece > here[0]):
                here = (best[begin][0] + piece, best[begin][1] + 1)
        n = len(pretoken[end - 1].encode())
        if here is None or best[end - 1][0] + n * byte_score > here[0]:
            here = (best[end - 1][0] + n * byte_score, best[end - 1][1] + n)
        best.append(here)
    return best[-1][1]


def test_token_counts(spark, data, documents, vocabulary):
    from canteiro.llm.token_counts import BYTE_PENALTY, WORD_MARK, piece_scores

    scores = piece_scores(vocabulary("piece_bpe_32k.model"))
    byte_score = min(scores.values()) - BYTE_PENALTY
    counts = defaultdict(int)
    for text in documents:
        for word in set(word_list(text[1])) - counts.keys():
            counts[word] = best_count(scores, byte_score, WORD_MARK + word)
    rows = {r.doc_id: (r.n_words, r.n_tokens) for r in QUERIES["op6_token_counts"][0](spark, data).collect()}
    assert rows == {d: (len(word_list(t)), sum(counts[w] for w in word_list(t))) for d, t, _ in documents}


def test_shards(spark, data, documents):
    rows = QUERIES["op7_shards"][0](spark, data).collect()
    text = {d: (t or "").encode() for d, t, _ in documents}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows} == {d: (len(t) + 8, zlib.crc32(t)) for d, t in text.items()}
    slots = defaultdict(list)
    for r in rows:
        assert (r.law, r.grown_shard) == ("rows", None)
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(24))
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    order = [(r.slot, r.shard) for r in sorted(rows, key=lambda r: r.doc_id)]
    assert order != sorted(order)


def test_packed(spark, data, ids):
    rows = QUERIES["op10_packed"][0](spark, data).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids)
    for doc, found in pieces.items():
        found.sort(key=lambda r: r.piece)
        assert [r.piece for r in found] == list(range(len(found)))
        lengths = [r.length for r in found]
        assert all(n == 1024 for n in lengths[1:]) and 1 <= lengths[0] <= 1024
        start = 0
        for r in found:
            assert r.start == start
            assert r.ids_crc32 == crc(ids[doc][start : start + r.length])
            start += r.length
        assert start == len(ids[doc])
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 1024
    least = -(-sum(map(len, ids.values())) // 1024)
    assert len(bins) <= 1.05 * least + 1


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def test_pseudonyms(spark, data, documents):
    import re

    rows = {r.doc_id: r for r in QUERIES["op3_pseudonyms"][0](spark, data).collect()}
    private = {
        "mail": r"[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]+",
        "address": r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d])",
        "card": r"(?<!\d)\d{16}(?!\d)",
        "phone": r"\+1 \(\d{3}\) \d{3}-\d{4}",
        "key": r"\bAKIA[0-9A-Z]{16}\b",
    }
    linked = defaultdict(set)
    found = 0
    for d, t, _ in documents:
        new = rows[d].text
        if sum(rows[d][f"n_{k}"] for k in ("mail", "key", "secret", "address", "date", "social", "card", "phone")) == 0:
            assert new == t
        for kind, pattern in private.items():
            old_values = [v for v in re.findall(pattern, t) if kind != "card" or luhn(v)]
            if kind == "address":
                old_values = [v for v in old_values if all(int(p) < 256 for p in v.split("."))]
            for value in old_values:
                assert value not in new, (d, kind, value)
                found += 1
            if kind in ("phone", "key") and old_values:
                for value, pseudonym in zip(old_values, re.findall(pattern, new), strict=True):
                    linked[value].add(pseudonym)
    assert found > 20
    assert all(len(p) == 1 for p in linked.values())
    assert len({next(iter(p)) for p in linked.values()}) == len(linked)
