"""Near-duplicate groups: SuperMinHash signatures, banding, verification on full sets, union-find grouping.

Texts are compared as sets of word shingles. Texts with equal sets form a class; only classes are compared, so copies
are never paired. Signatures of classes are cut into bands, and classes that agree on a band share a bucket. In each
bucket every class is compared with the bucket's leader; the confirmed links are grouped, and then classes of one bucket
that are still apart from its largest group are compared with all of it, in blocks. A link is confirmed on the full
sets. No pair of a bucket is left out, and pairs are never rows of a table: a bucket of many versions of one text gives
a row per version, and the blocks that are left give no more links than join them.

Grouping is a union-find in rounds: each class takes the least label among its neighbours', then its label's label,
until nothing changes. Every round is a table in the shared folder.

Defined cases: NULL texts and texts without words have an empty set, no links, and stay as they are; a text with fewer
words than a shingle has one shingle; rows that repeat are one class; a NULL id takes part, and counts as a group's
id only if all of its ids are NULL; an empty table gives an empty table; other columns are ignored by ``groups`` and
kept by ``without_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, row_hash, spread_join, written

WIDTH = 5
PERCENT = 80
BANDS = 30
ROWS_PER_BAND = 5
# classes and shingles of a block whose classes are compared at once
BLOCK_ROWS = 512
BLOCK_SHINGLES = 50_000
# blocks of a bucket's rest that a task holds at once, and blocks of members that it takes one after the other
HELD_BLOCKS = 8
MET_BLOCKS = 64


def _signed(frame: DataFrame, width: int, bands: int, rows_per_band: int) -> DataFrame:
    """doc, content, n_shingles, node (key of the shingle set, NULL if empty) and the keys of the bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.shingles import band_keys, set_key, shingle_sets, signatures

        for batch in batches:
            texts = batch.column("text").to_pylist()
            for first, sets in shingle_sets(texts, width):
                keys = band_keys(signatures(sets, bands * rows_per_band), rows_per_band).view("int64")
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(first, len(sets)),
                        batch.column("content").slice(first, len(sets)),
                        pa.array([len(found) for found in sets], type=pa.int64()),
                        pa.array([set_key(found) if len(found) else None for found in sets], type=pa.binary()),
                        pa.array([k if len(found) else [] for k, found in zip(keys, sets, strict=True)], type=pa.list_(pa.int64())),
                    ],
                    names=["doc", "content", "n_shingles", "node", "bands"],
                )

    kind = frame.schema["doc"].dataType.simpleString()
    return in_tasks(frame, sign, f"doc {kind}, content long, n_shingles long, node binary, bands array<long>")


def _sets(frame: DataFrame, width: int) -> DataFrame:
    """node and its full shingle set, sorted."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.shingles import set_key, shingle_sets

        for batch in batches:
            for _, sets in shingle_sets(batch.column("text").to_pylist(), width):
                sets = [found for found in sets if len(found)]
                if sets:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([set_key(found) for found in sets], type=pa.binary()),
                            pa.array([found.view("int64") for found in sets], type=pa.list_(pa.int64())),
                        ],
                        names=["node", "found"],
                    )

    return in_tasks(frame.select("text"), listed, "node binary, found array<long>")


def _large_enough(a: Column, b: Column, percent: int) -> Column:
    """Sizes that a pair of the similarity can have."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("found").alias("fa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("found").alias("fb")), "b"
    )
    shared = F.size(F.array_intersect("fa", "fb"))
    union = F.size("fa") + F.size("fb") - shared
    return both.where(100 * shared.cast("long") >= percent * union.cast("long")).select("a", "b")


def _across(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between classes of one bucket that have different roots; members: bucket, node, root, size.

    Buckets with the same members are taken once. The members of a bucket that are not of its most frequent root, its
    rest, are compared with all members: two members of different roots are not both of the most frequent one. Rest and
    members are dealt into blocks of bounded size. A task holds a few blocks of the rest, takes one block of members
    after the other, counts the shared shingles of all pairs in an array, and returns no more links than join the roots
    it has seen. So pairs are never rows.
    """
    placed = members.groupBy("bucket", "root").agg(
        F.count("*").alias("n"),
        F.sum("size").alias("shingles"),
        # a key of the member set that doesn't depend on order
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("key_1"),
        F.sum(F.xxhash64(F.lit(1), "node").cast("decimal(38,0)")).alias("key_2"),
    )
    apart = placed.groupBy("bucket").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("roots"),
        F.sum("shingles").alias("shingles"),
        F.max_by("root", F.struct("n", "root")).alias("main"),
        F.max(F.struct("n", "root", "shingles")).alias("most"),
        F.sum("key_1").alias("key_1"),
        F.sum("key_2").alias("key_2"),
    )
    # the leader of a bucket of two was compared with the other one
    wanted = apart.where("n > 2 AND roots > 1").withColumns(
        {"rest": F.col("n") - F.col("most.n"), "rest_shingles": F.col("shingles") - F.col("most.shingles")}
    )
    once = wanted.groupBy("key_1", "key_2", "n").agg(F.min(F.struct("bucket", "main", "shingles", "rest", "rest_shingles")).alias("b"))

    def blocks(shingles: str, n: str) -> Column:
        return F.greatest(F.ceil(F.col(shingles) / BLOCK_SHINGLES), F.ceil(F.col(n) / BLOCK_ROWS)).cast("int")

    buckets = once.select(
        "b.bucket",
        "b.main",
        blocks("b.shingles", "n").alias("blocks"),
        F.ceil(blocks("b.rest_shingles", "b.rest") / HELD_BLOCKS).cast("int").alias("groups"),
    )
    dealt = members.join(buckets, "bucket").withColumn("number", F.pmod(F.xxhash64("node"), F.lit(2**31 - 1)))
    rest = dealt.where("root != main").select(
        "bucket",
        (F.col("number") % F.col("groups")).cast("int").alias("group"),
        F.lit(0).alias("side"),
        F.lit(0).alias("block"),
        "node",
        "root",
        # blocks of members that this group meets, in as many shares
        F.explode(F.sequence(F.lit(0), F.ceil(F.col("blocks") / MET_BLOCKS).cast("int") - 1)).alias("share"),
    )
    block = (F.col("number") % F.col("blocks")).cast("int")
    all_members = dealt.select(
        "bucket",
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"),
        F.lit(1).alias("side"),
        block.alias("block"),
        "node",
        "root",
        F.floor(block / MET_BLOCKS).cast("int").alias("share"),
    )
    cell = ("bucket", "group", "share")
    met = rest.unionByName(all_members).join(sets, "node")
    met = met.repartition(*cell).sortWithinPartitions(*cell, "side", "block")
    return in_tasks(met.select(*cell, "side", "block", "node", "root", "found"), partial(_compared, percent), "a binary, b binary").distinct()


def _compared(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from canteiro.llm.shingles import links_between

    cell, side, kept, block, size = None, None, None, [], 0

    def packed(rows: list) -> tuple:
        found = [r[2] for r in rows]
        return [r[0] for r in rows], [r[1] for r in rows], np.concatenate(found), np.array([len(f) for f in found])

    def links() -> Iterator[pa.RecordBatch]:
        if kept and block:
            for begin in range(0, len(kept), BLOCK_ROWS):
                found = links_between(packed(kept[begin : begin + BLOCK_ROWS]), packed(block), percent)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([a for a, _ in found], type=pa.binary()), pa.array([b for _, b in found], type=pa.binary())],
                        names=["a", "b"],
                    )

    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "group", "share", "side", "block")), strict=True))
        nodes, roots, sets = (batch.column(c) for c in ("node", "root", "found"))
        for place, key in enumerate(keys):
            if key[:3] != cell:
                yield from links()
                cell, kept, block, size = key[:3], [], [], 0
            elif key[3:] != side or size >= BLOCK_SHINGLES or len(block) >= BLOCK_ROWS:
                yield from links()
                block, size = [], 0
            side = key[3:]
            found = sets[place].values.to_numpy(zero_copy_only=False).copy()
            row = (nodes[place].as_py(), roots[place].as_py(), found)
            if key[3] == 0:
                kept.append(row)
            else:
                block.append(row)
                size += len(found)
    yield from links()


def components(links: DataFrame) -> DataFrame:
    """node and root of each node that a link (a, b) names; the root is the least node reachable."""
    edges = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "edges")
    state = written(edges.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("root")), "roots")
    while True:
        near = (
            edges.join(state.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("root").alias("near"))
        )
        heads = state.select("root").distinct()
        above = heads.join(state.select(F.col("node").alias("root"), F.col("root").alias("above")), "root")
        step = spread_join(state.join(near, "node"), above, "root", "node").select(
            "node", F.least("root", "near", "above").alias("root"), F.col("root").alias("old")
        )
        step = written(step, "roots")
        state = step.select("node", "root")
        if step.where("root != old").isEmpty():
            return state


def groups(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows_per_band: int = ROWS_PER_BAND,
) -> DataFrame:
    """One row per document: doc, content (hash of its text), n_shingles, node, root and component.

    ``node`` is the key of the document's set and ``root`` of its group; ``component`` is the least id of the group.
    """
    texts = documents.select(F.col(f"`{id_column}`").alias("doc"), F.col(f"`{text_column}`").alias("text"))
    hashed = texts.select("doc", row_hash("text").alias("content"), "text")
    signed = written(_signed(hashed, width, bands, rows_per_band), "signatures")
    whole = signed.where("node IS NOT NULL")
    classes = whole.groupBy("node").agg(F.min("doc").alias("least"), F.max("n_shingles").alias("size"))

    spots = whole.select("node", F.col("n_shingles").alias("size"), F.explode("bands").alias("bucket"))
    shared = (
        spots.groupBy("bucket").agg(F.min("node").alias("leader"), F.max("node").alias("other")).where("leader != other")
    )
    members = written(spots.join(shared.select("bucket", "leader"), "bucket").distinct(), "members")
    sizes = members.select("node", "size").distinct()
    leaders = sizes.select(F.col("node").alias("leader"), F.col("size").alias("leader_size"))
    starred = members.where("node != leader").select("node", "leader", "size").distinct().join(leaders, "leader")
    pairs = written(
        starred.where(_large_enough(F.col("size"), F.col("leader_size"), percent)).select(
            F.col("leader").alias("a"), F.col("node").alias("b")
        ),
        "pairs",
    )

    # the full set of each class that shares a bucket, from one of its texts
    owners = classes.join(sizes.select("node"), "node", "left_semi").select("node", F.col("least").alias("owner"))
    named = texts.join(owners.select("owner").distinct(), F.col("doc").eqNullSafe(F.col("owner")), "left_semi")
    listed = _sets(named, width).join(sizes.select("node"), "node", "left_semi")
    sets = written(listed.dropDuplicates(["node"]), "sets")
    links = written(_confirmed(pairs, sets, percent), "links")
    roots = components(links)

    # classes of a bucket that are not together yet
    placed = written(
        members.drop("leader").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")), "members"
    )
    more = written(_across(placed, sets, percent), "links")
    if not more.isEmpty():
        # groups that a new link joins: a link between nodes is a link between their roots
        tops = placed.select("node", "root").distinct()
        lifted = more.join(tops.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a").join(
            tops.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b"
        )
        joined = components(lifted.select(F.col("ra").alias("a"), F.col("rb").alias("b")))
        above = joined.select(F.col("node").alias("root"), F.col("root").alias("above"))
        roots = spread_join(tops, above, "root", "node", "left").select("node", F.coalesce("above", "root").alias("root"))

    placed = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = placed.groupBy("root").agg(F.min("least").alias("component"))
    component = spread_join(placed, ids, "root", "node").select("node", "root", "component")
    grouped = whole.join(component, "node")
    alone = signed.where("node IS NULL").withColumn("component", F.col("doc")).withColumn("root", F.col("node"))
    columns = ("doc", "content", "n_shingles", "node", "root", "component")
    return grouped.select(*columns).unionByName(alone.select(*columns))


def without_near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options: int
) -> DataFrame:
    """One document of each group, with all columns: a row with the group's least id. Texts without words all stay."""
    found = written(groups(documents, id_column, text_column, **options).where("node IS NOT NULL"), "groups")
    order = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("content"))
    pairs = found.groupBy("root", "doc", "content").agg(F.count("*").alias("n"))
    chosen = pairs.groupBy("root").agg(F.min(order).alias("first"))
    judged = spread_join(pairs, chosen, "root", "content")
    stays = F.col("doc").eqNullSafe(F.col("first")["doc"]) & (F.col("content") == F.col("first")["content"])
    judged = written(judged.select(F.col("doc").alias("__doc"), F.col("content").alias("__content"), stays.alias("__stays"), "n"), "judged")
    # the user's columns travel in a struct, so no name of theirs meets one of ours
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    rows = documents.select(whole.alias("__row"), F.col(f"`{id_column}`").alias("__id"), row_hash(F.col(f"`{text_column}`")).alias("__hash"))
    same = F.col("__id").eqNullSafe(F.col("__doc")) & (F.col("__hash") == F.col("__content"))
    kept = rows.join(judged.where("NOT __stays"), same, "left_anti")
    repeated = judged.where("__stays AND n > 1")
    if not repeated.isEmpty():
        once = kept.join(repeated, same, "left_semi").dropDuplicates(["__id", "__hash"])
        kept = kept.join(repeated, same, "left_anti").unionByName(once)
    return kept.select(*[F.col("__row").getField(c).alias(c) for c in documents.columns])
