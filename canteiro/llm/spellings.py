"""Spelling variants: words of one edit apart, found by a frontier of states that walks down a trie kept as a table.

The trie of all words is a table of edges (node, first letter, label, child); a path without a branch is one edge. A state
is a word, a place in it, a node, and the edit made, if any. Two words of one edit apart part for the first time at a node
where the trie branches or a word ends, so a word's states without an edit are the nodes of its own path. From these, a
join with the edges makes the states with one edit: another letter in place of the word's, or the word's letter left out.
Step by step, a join moves these states down the edge that goes on as the word does, until the word is at its end: the
node that is reached there is a neighbour. A letter put in is a letter left out of the other word.

Edits are only made in a word's second half. For those in the first half the same is done with all words read backwards,
so no state ever meets the crowded nodes near the root: a state's node has at least half of the word's letters in common
with it, and no more edges than there are letters. Each step is a table in the shared folder, so a lost executor costs no
more than a step. The number of steps is that of the branches on a path, not that of letters.

Nodes are known by a 64-bit hash of their prefix; neighbours are looked up in the list of words by their letters.

Defined cases: NULL texts hold no words; a NULL id counts as empty where it marks a run; rows that repeat count as often as
they occur; a word without neighbours has none, and is its own root; words of any length take part; an empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, written

LETTERS = r"[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS = 6
LEAST_COUNT = 5
# a word's form occurs at least so many times as often as the word
TIMES = 5
# of the runs of a document, one in so many loses a letter
DAMAGED = 199


def counted_words(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT
) -> DataFrame:
    """word and n of the words that occur often enough."""
    # a run that loses a letter must have one more than the least to count, so shorter runs need not be looked at
    found = F.regexp_extract_all(text_column, F.lit(f"{LETTERS}{{{least_letters},}}"), F.lit(0))
    runs = documents.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    lowered = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    marked = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("mark"))
    words = marked.select(F.when(F.col("mark") % DAMAGED == 0, _without(F.col("run"), F.col("mark"))).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= least_letters).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _without(run: Column, mark: Column) -> Column:
    """The run without the letter at place mark % length."""
    place = (mark % F.char_length(run)).cast("int")
    return F.concat(F.substring(run, F.lit(1), place), F.substring(run, place + 2, F.char_length(run)))


def _prefixes(words: DataFrame, least: int) -> DataFrame:
    """wid, side, place, node (of the prefix of ``place`` letters), next letter's number or -1, for prefixes of ``least`` letters or more."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.spellings import prefix_nodes

        for batch in batches:
            owner, places, nodes, letters = prefix_nodes(batch.column("letters").to_pylist(), least)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("wid").take(pa.array(owner)),
                    batch.column("side").take(pa.array(owner)),
                    pa.array(places, type=pa.int32()),
                    pa.array(nodes.view("int64")),
                    pa.array(letters, type=pa.int32()),
                ],
                names=["wid", "side", "place", "node", "next"],
            )

    return in_tasks(words.select("wid", "side", "letters"), walk, "wid long, side int, place int, node long, next int")


def prefix_nodes(words: list[str], least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word, length, hash and next letter (-1 at the end) of all prefixes of at least so many letters."""
    from canteiro.llm.shingles import mixed

    sizes = np.array([len(w) for w in words], dtype=np.int64)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    starts = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(words)), sizes + 1)
    place = np.arange(len(owner)) - np.repeat(starts + np.arange(len(words)), sizes + 1)
    inside = np.arange(len(letters)) - np.repeat(starts, sizes)
    powers = np.full(int(sizes.max(initial=0)) + 1, 0x9E3779B97F4A7C15 | 1, dtype=np.uint64)
    powers[0] = 1
    sums = np.zeros(len(letters) + 1, dtype=np.uint64)
    np.cumsum(mixed(letters) * np.multiply.accumulate(powers)[inside], out=sums[1:])
    at = np.repeat(starts, sizes + 1) + place
    nodes = mixed(sums[at] - np.repeat(sums[starts], sizes + 1) + place.astype(np.uint64))
    after = np.append(letters.astype(np.int64), -1)[at]
    after[place == sizes[owner]] = -1
    kept = place >= least
    return owner[kept], place[kept], nodes[kept], after[kept]


def _part(text: str, start: Column, length: Column) -> Column:
    """``length`` letters from the place ``start``, counted from 0."""
    return F.substring(F.col(text), start + 1, length)


def trie(words: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(paths, edges), written: wid, letters, side, place, node per node of a word's path, and side, node, first, label, child.

    ``words``: wid, side, letters. Nodes are the prefixes where words part or end; of those, the ones of ``least`` letters or more.
    """
    prefixes = written(_prefixes(words, least), "prefixes")
    met = prefixes.groupBy("side", "node").agg(F.min("next").alias("low"), F.max("next").alias("high"))
    nodes = met.where((F.col("low") != F.col("high")) | (F.col("low") == -1)).select("side", "node")
    stops = (
        prefixes.join(nodes, ["side", "node"])
        .groupBy("side", "wid")
        .agg(F.sort_array(F.collect_list(F.struct("place", "node"))).alias("stops"))
        .join(words, ["side", "wid"])
    )
    path = stops.select("side", "wid", "letters", F.posexplode("stops").alias("k", "stop"), F.get("stops", F.col("k") + 1).alias("after"))
    paths = written(path.select("side", "wid", "letters", F.col("stop.place").alias("place"), F.col("stop.node").alias("node"), "after"), "paths")
    size = F.col("after.place") - F.col("place")
    edges = paths.where("after IS NOT NULL").select(
        "side",
        "node",
        _part("letters", F.col("place"), F.lit(1)).alias("first"),
        _part("letters", F.col("place"), size).alias("label"),
        F.col("after.node").alias("child"),
    )
    return paths, written(edges.distinct(), "edges")


def neighbours(words: DataFrame, least_letters: int = LEAST_LETTERS) -> DataFrame:
    """a and b of all pairs of words of one edit apart, in both directions; ``words``: word, each once."""
    vocabulary = written(words.select("word").withColumn("wid", F.monotonically_increasing_id()), "words")
    sided = vocabulary.select("wid", F.lit(0).alias("side"), F.col("word").alias("letters")).unionByName(
        vocabulary.select("wid", F.lit(1).alias("side"), F.reverse("word").alias("letters"))
    )
    paths, edges = trie(sided, max(1, least_letters // 2))
    n = F.char_length("letters")
    own = _part("letters", F.col("place"), F.lit(1))

    # states without an edit: the nodes of the word's own path in its second half
    whole = paths.where((F.col("place") >= F.floor(n / 2)) & (F.col("place") < n)).select("side", "letters", "place", "node")
    size = F.char_length("label")
    replaced = (
        (F.col("first") > own)
        & (F.col("place") + size <= n)
        & (_part("letters", F.col("place") + 1, size - 1) == F.substring(F.col("label"), F.lit(2), size))
    )
    left_out = (F.col("place") + 1 + size <= n) & (_part("letters", F.col("place") + 1, size) == F.col("label"))
    ways = F.filter(
        F.array(F.when(replaced, F.struct((F.col("place") + size).alias("at"), F.col("first").alias("letter"))),
                F.when(left_out, F.struct((F.col("place") + 1 + size).alias("at"), F.lit("").alias("letter")))),
        lambda way: way.isNotNull(),
    )
    branched = whole.join(edges, ["side", "node"]).where((F.col("first") != own) & (replaced | left_out))
    edited = branched.select("side", "letters", "place", F.col("child").alias("node"), F.explode(ways).alias("way")).select(
        "side", "letters", F.col("place").alias("edit"), "way.letter", F.col("way.at").alias("place"), "node"
    )
    # the last letter left out: the node itself is where the other word ends
    shorter = whole.where(F.col("place") == n - 1).select("side", "letters", F.col("place").alias("edit"), F.lit("").alias("letter"), n.alias("place"), "node")

    frontier = written(edited.unionByName(shorter), "frontier")
    reached = [frontier]
    while True:
        open_states = frontier.where(F.col("place") < n).withColumn("first", own)
        if open_states.isEmpty():
            break
        going = (_part("letters", F.col("place"), size) == F.col("label")) & (F.col("place") + size <= n)
        frontier = written(
            open_states.join(edges, ["side", "node", "first"])
            .where(going)
            .select("side", "letters", "edit", "letter", (F.col("place") + size).alias("place"), F.col("child").alias("node")),
            "frontier",
        )
        reached.append(frontier)

    ended = reached[0]
    for states in reached[1:]:
        ended = ended.unionByName(states)
    other = F.concat(F.substring(F.col("letters"), F.lit(1), F.col("edit")), F.col("letter"), F.substring(F.col("letters"), F.col("edit") + 2, n))
    forth = lambda text: F.when(F.col("side") == 0, text).otherwise(F.reverse(text))
    pairs = ended.where(F.col("place") == n).select(forth(F.col("letters")).alias("a"), forth(other).alias("b"))
    pairs = pairs.join(vocabulary.select(F.col("word").alias("b")), "b", "left_semi").distinct()
    return pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: the last word that the forms lead to; ``forms``: word, form (not NULL)."""
    state = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("ahead"))
        step = written(state.join(ahead, "root", "left").select("word", F.coalesce("ahead", "root").alias("root"), "ahead"), "roots")
        state = step.select("word", "root")
        if step.where("ahead IS NOT NULL").isEmpty():
            return state


def variants(words: DataFrame, least_letters: int = LEAST_LETTERS, times: int = TIMES) -> DataFrame:
    """word, n, form, form_n, n_near and root of each word; ``words``: word, n, each word once, all of ``least_letters`` or more."""
    words = written(words.select("word", "n"), "counts")
    pairs = written(neighbours(words, least_letters), "pairs")
    counts = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    near = (
        pairs.join(counts, "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n_b")).alias("less"), F.col("b").alias("form"))).alias("top"))
    )
    large = -F.col("top.less") >= times * F.col("n")
    judged = written(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(large, F.col("top.form")).alias("form"),
            F.when(large, -F.col("top.less")).alias("form_n"),
        ),
        "forms",
    )
    return judged.join(roots(judged.where("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))
