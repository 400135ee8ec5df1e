"""Spelling variants against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from canteiro.llm import spellings
from canteiro.llm.queries import QUERIES

UPPER = str.maketrans(spellings.UPPER, spellings.LOWER)


def brute_words(rows):
    import re

    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            mark = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if mark % 199 == 0:
                place = mark % len(run)
                run = run[:place] + run[place + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    same = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(b))
    return a != b and len(a) - len(b) <= 1 and a[same + 1 :] == b[same + (len(a) == len(b)) :]


def brute_pairs(words):
    """Pairs of words, each compared with each other when they are few, or long."""
    if len(words) < 200:
        return {(a, b) for a in words for b in words if one_edit(a, b)}
    return shared_holes(words)


def shared_holes(words):
    """Pairs that share a word with a letter left out: at one place, or as one of the two."""
    holes = defaultdict(set)
    pairs = set()
    for w in words:
        for i in range(len(w)):
            holes[i, w[:i] + w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                pairs.add((w, w[:i] + w[i + 1 :]))
    for group in holes.values():
        pairs |= {(a, b) for a in group for b in group if a != b}
    return pairs | {(b, a) for a, b in pairs}


def brute_variants(words):
    near = defaultdict(set)
    for a, b in brute_pairs(words):
        near[a].add(b)
    form = {}
    for w in words:
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = top if top is not None and words[top] >= 5 * words[w] else None
    out = Counter()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None] += 1
    return out


def shape(rows):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows)


def test_words_of_odd_texts(spark, odd_documents, odd_rows, no_documents):
    rows = [(d, t) for d, t, _ in odd_rows]
    rows += [(i, "Ünïcode ünïcode naïveté ×÷×÷×÷× ABCDEFG abcdefg ÀÀÀÀÀÀ àààààà " * 3) for i in (None, 1, 2, 3, -4)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.word: r.n for r in spellings.counted_words(frame).collect()}
    assert got == brute_words(rows) and len(got) > 5
    assert spellings.counted_words(no_documents).count() == 0
    assert spellings.variants(spellings.counted_words(no_documents)).count() == 0
    words = {w: n for w, n in brute_words([(d, t) for d, t, _ in odd_rows] * 5).items()}
    counted = spellings.counted_words(odd_documents.unionAll(odd_documents).unionAll(odd_documents.unionAll(odd_documents)).unionAll(odd_documents))
    assert shape(spellings.variants(counted).collect()) == brute_variants(words)


@pytest.mark.parametrize("letters", ["ab", "abc", "aéÿ", "abcdefgh"])
def test_pairs_of_crowded_words(spark, letters):
    rng = random.Random(len(letters))
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(700)}
    words |= {"a" * n for n in range(6, 40)} | {"ab" * n for n in range(3, 12)} | {"b" + "ab" * n for n in range(3, 12)}
    for word in sorted(words)[:100]:
        place = rng.randrange(len(word))
        words.add(word[:place] + rng.choice(letters) + word[place + rng.randint(0, 1) :])
    words = {w for w in words if len(w) >= 6}
    frame = spark.createDataFrame([(w,) for w in words], "word string").repartition(5)
    got = [(r.a, r.b) for r in spellings.neighbours(frame).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_pairs(words)


def test_long_words_and_chains_of_forms(spark):
    long = "".join(random.Random(1).choice("abcdefgh") for _ in range(200_000))
    words = {long: 5, long[:-1]: 30, "x" + long: 5, long[:100_000] + "z" + long[100_001:]: 5, long[:50_000] + long[50_001:]: 5}
    for k in range(8):
        words["chain" + "m" * k] = 5 ** (k + 1)
    words |= {"cháinm": 25, "chainn": 25, "chainx": 5, "single": 5}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = shape(spellings.variants(frame.where(F.char_length("word") >= 6)).collect())
    assert got == brute_variants({w: n for w, n in words.items() if len(w) >= 6})
    assert max(n for *_, n, _ in got) >= 2


def test_trie_has_no_node_without_a_branch(spark):
    words = ["tracks", "tracky", "trackless", "others"]
    frame = spark.createDataFrame([(i, 0, w) for i, w in enumerate(words)], "wid long, side int, letters string")
    paths, edges = spellings.trie(frame, 3)
    assert sorted((r.letters, r.place) for r in paths.collect()) == [
        ("others", 6), ("trackless", 5), ("trackless", 9), ("tracks", 5), ("tracks", 6), ("tracky", 5), ("tracky", 6),
    ]
    assert sorted((r["first"], r.label) for r in edges.collect()) == [("l", "less"), ("s", "s"), ("y", "y")]


def test_registered_query(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").collect()]
    expected = brute_variants(brute_words(rows))
    assert shape(QUERIES["op12_spellings"][0](spark, data).collect()) == expected and len(expected) > 500
