"""Quality rules: text measures of each document, and lines that many documents of a host share.

A line is hashed in a normal form (A-Z and other capitals lowered, runs of white space as one space, digits as 0). A
line is *frequent* on a host when more than ``max_documents`` different texts of the host hold it. Copies of one text
count once, so they do not make their own lines frequent, nor do they hide that other documents share a line; texts that
differ in anything are different documents. Frequent lines are removed, from copies too; a document that keeps less than
``least_kept_percent`` of its words is depleted and rejected.

Defined cases: NULL and empty texts have no words and no lines and fail the base rules; a NULL host is a host of its
own; rows that repeat get the same verdict; extra columns are kept by ``clean`` and ignored by ``verdicts``; an empty
table gives an empty table. Everything is built-in column code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import let, row_hash, words, written

MAX_DOCUMENTS = 20
LEAST_KEPT_PERCENT = 30
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
# repeated windows of a text up to this many are looked up in an array, more are found by sorting; same result
SHORT_LIST = 48

SYMBOLS = r"[^#*$%&|<>]+"


def normal_line(line: Column) -> Column:
    """Normal form of a line: white space as single spaces, lower case, digits as 0."""
    spaced = F.btrim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " "))
    return F.regexp_replace(F.lower(spaced), "[0-9]", "0")


def _covered(starts: Column) -> Column:
    """Words covered by windows of three that start at these places, in ascending order."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last"))
    step = F.aggregate(
        starts,
        empty,
        lambda acc, at: F.struct(
            (acc["n"] + F.least(F.lit(3), at - acc["last"])).cast("long").alias("n"), at.cast("int").alias("last")
        ),
    )
    return step["n"]


def _by_lookup(hashes: Column, repeated: Column) -> Column:
    places = F.transform(hashes, lambda h, i: F.when(F.array_contains(repeated, h), i))
    return _covered(F.filter(places, lambda place: place.isNotNull()))


def _by_sorting(hashes: Column) -> Column:
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(ordered: Column) -> Column:
        twins = F.filter(
            ordered,
            lambda pair, k: F.coalesce(F.get(ordered, k - 1)["h"] == pair["h"], F.lit(False))
            | F.coalesce(F.get(ordered, k + 1)["h"] == pair["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twins, lambda pair: pair["i"]))

    return _covered(let(pairs, places))


def repeated_words(word_list: Column) -> Column:
    """Words that stand in a window of three words found twice or more in the list."""

    def count(hashes: Column) -> Column:
        def of_repeated(repeated: Column) -> Column:
            return F.when(F.size(repeated) <= SHORT_LIST, _by_lookup(hashes, repeated)).otherwise(_by_sorting(hashes))

        def repeated_hashes(ordered: Column) -> Column:
            again = F.filter(ordered, lambda h, k: F.coalesce(F.get(ordered, k - 1) == h, F.lit(False)))
            return let(F.array_distinct(again), of_repeated)

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(
            let(F.sort_array(hashes), repeated_hashes)
        )

    def windows(listed: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(listed) - 3),
            lambda i: F.xxhash64(F.get(listed, i), F.get(listed, i + 1), F.get(listed, i + 2)),
        )

    return let(
        word_list,
        lambda listed: F.when(F.size(listed) < 4, F.lit(0).cast("long")).otherwise(let(windows(listed), count)),
    )


def measures(text: str | Column) -> Column:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text as one struct of longs."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(listed: Column) -> Column:
        return F.struct(
            F.size(listed).cast("long").alias("n_words"),
            F.char_length(F.concat_ws("", listed)).cast("long").alias("word_chars"),
            F.char_length(F.regexp_replace(text, SYMBOLS, "")).cast("long").alias("n_symbols"),
            let(lines, lambda kept: (F.size(kept) - F.size(F.array_distinct(kept))).cast("long")).alias("n_dup_lines"),
            repeated_words(listed).alias("n_repeat_words"),
        )

    return let(words(text), of)


def _words_in_normal_line(line: Column) -> Column:
    """Words of a normal line: its single spaces and one more."""
    return (F.char_length(line) - F.char_length(F.replace(line, F.lit(" "), F.lit(""))) + 1).cast("long")


def document_lines(documents: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """One row per distinct normal line of each document, with the words that the document has in it.

    A document is its id and a hash of host and text, so rows that repeat count once.
    """
    lines = F.transform(F.split(F.coalesce(F.col(text_column), F.lit("")), "\n"), normal_line)
    listed = documents.select(
        F.col(id_column).alias("doc"),
        row_hash(host_column, text_column).alias("content"),
        row_hash(host_column).alias("host"),
        F.filter(lines, lambda line: line != "").alias("lines"),
    ).where(F.size("lines") > 0)
    rows = listed.select(
        "doc",
        "content",
        "host",
        F.posexplode("lines").alias("place", "text"),
    ).select(
        "doc",
        "content",
        "host",
        "place",
        F.xxhash64("text").alias("line"),
        _words_in_normal_line(F.col("text")).alias("n_words"),
    )
    return rows.groupBy("doc", "content", "host", "line").agg(
        (F.max("n_words") * F.size(F.collect_set("place"))).cast("long").alias("n_words")
    )


def removed_lines(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    max_documents: int = MAX_DOCUMENTS,
) -> DataFrame:
    """The frequent lines of each document that has some: doc, content, lines (hashes), words_removed.

    Copies are collapsed by (host, line, content) first and then counted by (host, line), both with partial aggregates,
    so a line that a third of all documents hold meets as few rows.
    """
    rows = written(document_lines(documents, id_column, text_column, host_column), "lines")
    frequent = (
        rows.select("host", "line", "content")
        .distinct()
        .groupBy("host", "line")
        .agg(F.count("*").alias("n_documents"))
        .where(F.col("n_documents") > max_documents)
        .select("host", "line")
    )
    return (
        rows.join(frequent, ["host", "line"])
        .groupBy("doc", "content")
        .agg(F.collect_list("line").alias("lines"), F.sum("n_words").alias("words_removed"))
    )


def _depleted(n_words: Column, removed: Column, least_kept_percent: int) -> Column:
    return 100 * (n_words - removed) < least_kept_percent * n_words


def verdicts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    least_kept_percent: int = LEAST_KEPT_PERCENT,
) -> DataFrame:
    """One row per document: its measures, words_removed, base_failed, depleted and kept."""
    removed = removed_lines(documents, id_column, text_column, host_column, max_documents)
    measured = documents.select(
        F.col(id_column).alias("doc"),
        row_hash(host_column, text_column).alias("content"),
        measures(text_column).alias("m"),
    )
    joined = measured.join(
        removed.select(F.col("doc").alias("d"), F.col("content").alias("c"), "words_removed"),
        F.col("doc").eqNullSafe(F.col("d")) & (F.col("content") == F.col("c")),
        "left",
    )
    n_words, n_removed = F.col("m.n_words"), F.coalesce("words_removed", F.lit(0)).cast("long")
    base_failed = (n_words < LEAST_WORDS) | (100 * F.col("m.n_repeat_words") > MOST_REPEATED_PERCENT * n_words)
    return joined.select(
        F.col("doc").alias(id_column),
        "m.*",
        n_removed.alias("words_removed"),
        base_failed.alias("base_failed"),
        _depleted(n_words, n_removed, least_kept_percent).alias("depleted"),
        (~base_failed & ~_depleted(n_words, n_removed, least_kept_percent)).alias("kept"),
    )


def clean(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host_column: str = "source",
    max_documents: int = MAX_DOCUMENTS,
    least_kept_percent: int = LEAST_KEPT_PERCENT,
) -> DataFrame:
    """The documents that pass, with all their columns, without the frequent lines in their texts."""
    removed = removed_lines(documents, id_column, text_column, host_column, max_documents)
    rows = documents.select(
        F.struct("*").alias("row"),
        F.col(id_column).alias("doc"),
        row_hash(host_column, text_column).alias("content"),
        measures(text_column).alias("m"),
    )
    n_words = F.col("m.n_words")
    passed = rows.where(
        (n_words >= LEAST_WORDS) & (100 * F.col("m.n_repeat_words") <= MOST_REPEATED_PERCENT * n_words)
    )
    joined = passed.join(
        removed.select(F.col("doc").alias("d"), F.col("content").alias("c"), "lines", "words_removed"),
        F.col("doc").eqNullSafe(F.col("d")) & (F.col("content") == F.col("c")),
        "left",
    ).where(~_depleted(n_words, F.coalesce("words_removed", F.lit(0)), least_kept_percent))
    text = F.col(f"row.`{text_column}`")
    kept_lines = F.filter(
        F.split(text, "\n"),
        lambda line: ~let(
            F.xxhash64(normal_line(line)), lambda h: F.array_contains(F.col("lines"), h)
        ),
    )
    cleaned = F.when(F.col("lines").isNull(), text).otherwise(F.array_join(kept_lines, "\n"))
    return joined.select(
        *[(cleaned if c == text_column else F.col(f"row.`{c}`")).alias(c) for c in documents.columns]
    )
