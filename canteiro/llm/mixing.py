"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Each source is a stream: its documents in a hashed order, one after the other, repeated as often as its target asks.
The stream is cut into blocks of equal words, the same for all sources. Slot t of the schedule lies at the t-th point of a
golden-ratio sequence, the point falls into one source's share of the cumulative weights, and the slot takes that
source's next block, until the source's target is reached with a last block that is cut. Any stretch of the schedule
therefore holds the sources close to their weights, and the mix is read in the order of its slots.

Sources weigh 1, 2, 3, repeating, by the code points of their names, NULL last, and share the words of all sources. A
target stops at ``most_repeats`` times its source's words; the excess goes to the others by weight until none is above.

Defined cases: NULL texts have no words and are never taken; a NULL source is a source of its own; rows that repeat
are taken like any others; a source without words has target 0; an empty table gives an empty mix; other columns only
tell rows apart. Each source's taken words equal its target, rounded; blocks that find no slot follow the others.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canteiro.llm.common import row_hash, whole_part, with_running_total, word_count, written

BLOCK_WORDS = 1024
# slots beyond the number of blocks
MORE_SLOTS = 64
MOST_REPEATS = 3
# points of the schedule are whole numbers below this; it is the period of the sequence
POINTS = 1 << 31
# the odd number nearest to POINTS times the golden ratio's fraction
GOLDEN = 1_327_217_885
# documents of a source, and slots of the schedule, are summed in this many buckets
BUCKET_BITS = 14
CELL_BITS = 14


@dataclass(frozen=True)
class Mix:
    """The parts of a mix; all are tables in the shared folder or cheap plans over them."""

    documents: DataFrame  # row, doc, content, rest, source_id, size
    sources: DataFrame  # source_id, source, source_size, target, n_taken
    pieces: DataFrame  # slot, source_id, block, row, doc, content, rest, epoch, word_start, n_words


def targets(sizes: DataFrame, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """source_id, weight and target of each source, from (source, source_size); one row per source.

    Sources in ascending order of cap / weight are full first. With the caps of the full ones taken away, the others
    share the rest by weight; the first source that its share doesn't fill sets the share of all after it.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    cap = (F.col("source_size") * most_repeats).cast("double")
    weighed = sizes.withColumn("source_id", place.cast("int")).select(
        "source", "source_size", "source_id", (1 + (F.col("source_id") - 1) % 3).cast("double").alias("weight"), cap.alias("cap")
    )
    order = (F.col("cap") / F.col("weight"), F.col("source_id"))
    below = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(below), F.lit(0.0))
    weights = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(below), F.lit(0.0))
    leveled = weighed.withColumn("level", left / weights)
    full = F.col("level") * F.col("weight") > F.col("cap")
    share = F.max(F.when(~full, F.col("level"))).over(whole)
    target = F.least(F.col("cap"), F.coalesce(share * F.col("weight"), F.col("cap")))
    return leveled.withColumn("target", target).withColumn("n_taken", F.round("target").cast("long")).select(
        "source", "source_size", "source_id", "weight", "target", "n_taken"
    )


def _schedule(spark: SparkSession, sources: DataFrame, n_slots: int) -> DataFrame:
    """slot, source_id and block (the slot's rank in its source)."""
    total = F.sum("n_taken").over(Window.partitionBy())
    end = F.sum("n_taken").over(Window.orderBy("source_id").rowsBetween(Window.unboundedPreceding, 0))
    edge = lambda words: F.round(words / total * POINTS).cast("long")
    shares = sources.where("n_taken > 0").select(
        "source_id", edge(end - F.col("n_taken")).alias("low"), edge(end).alias("high")
    )
    shift = POINTS.bit_length() - 1 - CELL_BITS
    cells = shares.where("high > low").select(
        "source_id",
        "low",
        "high",
        F.explode(F.sequence(F.shiftright("low", shift), F.shiftright(F.col("high") - 1, shift))).alias("cell"),
    )
    point = F.pmod(F.pmod("slot", F.lit(POINTS)) * F.lit(GOLDEN), F.lit(POINTS))
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", point)
    placed = slots.withColumn("cell", F.shiftright("point", shift)).join(cells, "cell")
    inside = (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))
    chosen = placed.where(inside).select("slot", "source_id", F.shiftright("slot", BUCKET_BITS).alias("bucket"))
    ranked = with_running_total(written(chosen, "slots"), ["source_id"], "bucket", ["slot"], F.lit(1), "block")
    return ranked.select("slot", "source_id", "block")


def _rest(documents: DataFrame, *known: str) -> Column:
    """64-bit hash of the other columns; maps, which have no hash, as JSON texts."""
    others = [
        F.to_json(F.struct(F.col(f"`{name}`")), {"ignoreNullFields": "false"}) if "map<" in kind else F.col(f"`{name}`")
        for name, kind in documents.dtypes
        if name not in known
    ]
    return row_hash(*others) if others else F.lit(0).cast("long")


def mix(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 0,
    block_words: int = BLOCK_WORDS,
    most_repeats: int = MOST_REPEATS,
) -> Mix:
    spark = documents.sparkSession
    counted = written(
        documents.select(
            F.col(f"`{id_column}`").alias("doc"),
            F.col(f"`{source_column}`").alias("source"),
            row_hash(F.col(f"`{text_column}`")).alias("content"),
            _rest(documents, id_column, text_column, source_column).alias("rest"),
            word_count(F.col(f"`{text_column}`")).alias("size"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    sizes = counted.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sources = written(targets(sizes, most_repeats), "sources")
    n_words = sources.agg(F.coalesce(F.sum("n_taken"), F.lit(0))).first()[0]
    # a source's slots differ from its share by a few, so a few more let each source reach its target
    n_slots = -(-n_words // block_words) + MORE_SLOTS if n_words else 0
    wanted = sources.where("n_taken > 0").select("source_id", F.ceil(F.col("n_taken") / block_words).cast("long").alias("n_blocks"))
    ranked = _schedule(spark, sources, n_slots).join(wanted, "source_id").where("block < n_blocks").drop("n_blocks")
    slots = written(ranked, "schedule")

    # the blocks for which the sequence had no slot come after the others
    given = slots.groupBy("source_id").agg(F.count("*").alias("n_given"))
    missing = wanted.join(given, "source_id", "left").withColumn("n_given", F.coalesce("n_given", F.lit(0)).cast("long"))
    late = missing.where("n_given < n_blocks").select(
        "source_id", F.explode(F.sequence(F.col("n_given"), F.col("n_blocks") - 1)).alias("block")
    )
    width = F.lit(sources.count())
    late = late.select((n_slots + F.col("block") * width + F.col("source_id")).cast("long").alias("slot"), "source_id", "block")
    named = F.col("source").eqNullSafe(F.col("name"))
    ids = sources.select(F.col("source").alias("name"), "source_id")
    rows = counted.join(ids, named).drop("name", "source")
    order = F.xxhash64(F.lit(seed), "doc", "content")
    hashed = rows.withColumn("key", order).withColumn("bucket", F.shiftright("key", 64 - BUCKET_BITS))
    placed = with_running_total(
        hashed.where("size > 0"), ["source_id"], "bucket", ["key", "doc", "content", "rest", "row"], F.col("size"), "at"
    )
    spread = placed.join(
        sources.where("n_taken > 0").select("source_id", "source_size", "n_taken"), "source_id"
    ).where("at < n_taken")
    last_epoch = whole_part(F.col("n_taken") - 1 - F.col("at"), F.col("source_size"))
    epochs = (
        spread.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last_epoch)))
        .withColumn("begin", F.col("at") + F.col("epoch") * F.col("source_size"))
        .withColumn("end", F.least(F.col("begin") + F.col("size"), F.col("n_taken")))
    )
    block = lambda word: whole_part(word, block_words)
    cuts = epochs.withColumn("block", F.explode(F.sequence(block(F.col("begin")), block(F.col("end") - 1))))
    first = F.greatest(F.col("begin"), F.col("block") * block_words)
    after = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    pieces = cuts.select(
        "source_id",
        "block",
        "row",
        "doc",
        "content",
        "rest",
        "epoch",
        (first - F.col("begin")).cast("long").alias("word_start"),
        (after - first).cast("long").alias("n_words"),
    )
    scheduled = pieces.join(slots.unionByName(late), ["source_id", "block"])
    return Mix(rows.drop("key", "bucket"), sources, scheduled)


def mixed_texts(documents: DataFrame, text_column: str = "text", **options: object) -> DataFrame:
    """The mix as documents: a row for each time that a document is taken, cut where its source's target ends.

    A row has the place of its first slot; each partition of the result is in the order of the schedule. All columns are
    kept. Rows that share id, source and text are told apart by a hash of their other columns; rows that
    are equal in all columns stand for each other.
    """
    made = mix(documents, text_column=text_column, **options)
    id_column = options.get("id_column", "doc_id")
    source_column = options.get("source_column", "source")
    taken = made.pieces.groupBy("row", "doc", "content", "rest", "source_id", "epoch").agg(
        F.sum("n_words").alias("__taken"), F.min(F.struct("slot", "word_start")).alias("__slot")
    )
    names = made.sources.select("source_id", F.col("source").alias("__source"))
    taken = taken.join(names, "source_id").select(
        F.col("doc").alias("__doc"),
        F.col("content").alias("__content"),
        F.col("rest").alias("__others"),
        "__source",
        "__taken",
        "__slot",
    )
    # the user's columns travel in a struct, so no name of theirs meets one of ours
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("__row"),
        F.col(f"`{id_column}`").alias("__id"),
        F.col(f"`{source_column}`").alias("__from"),
        row_hash(F.col(f"`{text_column}`")).alias("__hash"),
        _rest(documents, id_column, text_column, source_column).alias("__rest"),
    ).dropDuplicates(["__id", "__from", "__hash", "__rest"])
    same = (
        F.col("__id").eqNullSafe(F.col("__doc"))
        & (F.col("__hash") == F.col("__content"))
        & (F.col("__rest") == F.col("__others"))
        & F.col("__from").eqNullSafe(F.col("__source"))
    )
    joined = rows.join(taken, same).sortWithinPartitions("__slot")
    cells = {c: F.col("__row").getField(c) for c in documents.columns}
    cells[text_column] = first_words(cells[text_column], F.col("__taken"))
    return joined.select(*[cell.alias(c) for c, cell in cells.items()])


def first_words(text: Column, n_words: Column) -> Column:
    """The text up to the end of its n-th word; the whole text when it has no more words."""
    parts = F.regexp_extract_all(text, F.lit(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+"), F.lit(0))
    cut = F.concat_ws("", F.slice(parts, F.lit(1), n_words.cast("int")))
    return F.when(word_count(text) <= n_words, text).otherwise(cut)
