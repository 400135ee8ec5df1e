import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, size int, shard string, "
    "slot string, findings int, doc string, content string, `row` int, lines string, node string, bucket int, start int"
)


def _row(doc_id, text, source):
    return (doc_id, text, "en", source, len(text or ""), "k", 1, "s", "t", 2, "d", "c", 3, "l", "n", 4, 5)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs, empty and long texts, ties, repeated rows, odd white space, and other alphabets."""
    rng = random.Random(5)
    base = sentence(rng, 120)
    words = base.split(" ")
    near = " ".join(words[:60] + ["changed"] + words[61:])
    long_text = sentence(rng, 30_000) + "\n" + "x" * 70_000
    rows = [
        (1, None, "b"),
        (2, "", "b"),
        (3, " \t\r\n\x0b\x0c ", "a"),
        (4, base, "a"),
        (5, base.upper(), "c"),
        (6, near, None),
        (7, long_text, "a"),
        (8, "one", "b"),
        (9, "one two three", "b"),
        (10, "one two\x1fthree   four\x85 five  six \n seven\n\neight\n", "ünï"),
        (11, "漢字 😀 <|endoftext|> é́ don't 12,345.67", "z"),
        (12, "same same same same same same same same", "z"),
        (13, "A\nB\nA\n B \nb", "a"),
        (14, "short tail \n", "a"),
        (15, "\n\nlead", "a"),
        (None, base, "a"),
        (None, None, None),
        (4, base, "a"),
        (4, base, "a"),
        (16, sentence(rng, 55), "a"),
        (16, sentence(rng, 55), "a"),
        (-7, "minus one", "b"),
    ]
    return [(d, t, s) for d, t, s in rows]


@pytest.fixture(scope="session")
def odd_documents(spark, odd_rows):
    return spark.createDataFrame([_row(*row) for row in odd_rows], SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path
