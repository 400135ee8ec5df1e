"""Repeated passages: a radix sort of the suffixes of all texts, to the depth of a window, by its most significant digits.

Every suffix that is long enough begins with a window of ``width`` bytes, and a passage repeats where windows are equal.
Suffixes are sorted into groups digit by digit, the most significant first, and only to the depth of a window: a suffix
alone in its group leaves, and the groups that are left at the end are exactly the repeated windows.

The most significant digit is the window's anchor gram (``windows``), which its bytes alone choose, so equal windows have
equal digits. The following digits are the bytes around it. Neighbouring suffixes with one anchor are one item as long as
they stay together: an item has a range of suffixes, the key of the bytes that all of them share (their digits so far), and
the key of all bytes that they cover. Items that share the second key are equal as a whole: all their windows repeat. Other
items of a group of two or more are cut in parts, whose shared bytes are longer: the next digit. One item stands for all
that are equal as a whole. A range is down to one window after a few passes, for any number of texts.

So the first pass moves one row for some sixty suffixes, and the passes after it only what stands at an edge of a
repetition. A group is only ever counted, never gathered in one task.

Defined cases: NULL texts are empty; texts below the width have no window and stay whole; rows that repeat are texts of
their own, so they repeat each other; a window may overlap its equal; matches never cross texts; texts of any length are
read in parts; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, row_hash, written

WIDTH = 200
# parts of a range in the next pass
WAYS = 4
# rows sent from a task at once
ROWS = 50_000


def _texts(documents: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """doc, data, and a 128-bit key (a, b) of a row's id and text."""
    doc, text = F.col(id_column), F.col(text_column)
    return documents.select(
        doc.alias("doc"),
        row_hash(doc, text).alias("a"),
        F.xxhash64(F.lit("b"), text.isNull(), text, doc.isNull(), doc).alias("b"),
        F.coalesce(text.cast("binary"), F.lit(b"")).alias("data"),
    )


def _grams(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """The anchor gram of each item."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.windows import anchors

        for batch in batches:
            for data in batch.column("data"):
                for hashes, *_ in anchors(data.as_buffer(), width, gram):
                    yield pa.RecordBatch.from_arrays([pa.array(hashes)], names=["common"])

    return in_tasks(texts.select("data"), listed, "common long")


def _items(texts: DataFrame, width: int, gram: int) -> DataFrame:
    """common, whole (the two keys), a, b, spot of each item of the first pass."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.windows import anchors, spot, whole_key

        for batch in batches:
            keys = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True))
            for (a, b), cell in zip(keys, batch.column("data"), strict=True):
                data = cell.as_py()
                for hashes, places, first, last in anchors(data, width, gram):
                    spans = list(zip(places.tolist(), (places - last).tolist(), (places - first + 1).tolist(), strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes),
                            pa.array([whole_key(data, *span, width) for span in spans], type=pa.int64()),
                            pa.array([a] * len(spans), type=pa.int64()),
                            pa.array([b] * len(spans), type=pa.int64()),
                            pa.array([spot(*span) for span in spans], type=pa.int64()),
                        ],
                        names=["common", "whole", "a", "b", "spot"],
                    )

    return in_tasks(texts.select("a", "b", "data"), listed, "common long, whole long, a long, b long, spot long")


PARTS = "common long, whole long, a long, b long, spot long, done boolean, low int, high int, base long, data binary"


def _parts(rows: DataFrame, width: int) -> DataFrame:
    """Items cut for the next pass; rows: a, b, base, data (the bytes from ``base`` on), open (spot, done, low, high)."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.windows import common_key, cut, spot, unspot, whole_key

        schema = pa.schema(
            [(n, t) for n, t in zip("common whole a b spot done low high base data".split(), [pa.int64()] * 5 + [pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.binary()], strict=True)]
        )
        out: list[tuple] = []
        for batch in batches:
            for a, b, base, data, items in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "base", "data", "open")), strict=True):
                for item in items:
                    place, low, high = unspot(item["spot"])
                    for from_lead, to_lead in cut(item["low"], item["high"], WAYS):
                        least, most = max(low, from_lead), min(high, to_lead)
                        if least >= most:
                            continue
                        begin = place - most + 1
                        out.append(
                            (
                                common_key(data, place, from_lead, to_lead, width, base),
                                whole_key(data, place, least, most, width, base),
                                a,
                                b,
                                spot(place, least, most),
                                item["done"],
                                from_lead,
                                to_lead,
                                begin,
                                data[begin - base : place - least + width - base],
                            )
                        )
                    if len(out) >= ROWS:
                        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                        out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return in_tasks(rows.select("a", "b", "base", "data", "open"), cut_up, PARTS)


def _sorted_out(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(spans whose windows repeat, items to cut) of a pass; items: item, common, whole, a, b, spot, done, written."""
    equal = written(
        items.groupBy("common", "whole").agg(F.count("*").alias("n"), F.min("item").alias("item"), F.max("done").alias("done")), "equal"
    )
    twice = equal.where("n > 1").select("common", "whole")
    repeated = items.where("NOT done").join(twice, ["common", "whole"], "left_semi").select("a", "b", "spot")
    settled = F.col("done") | (F.col("n") > 1)
    groups = equal.groupBy("common").agg(F.count("*").alias("kinds"), F.min(settled).alias("settled")).where("kinds > 1 AND NOT settled")
    stays = equal.join(groups.select("common"), "common", "left_semi").select("item", settled.alias("done"))
    return repeated, items.drop("done").join(stays, "item")


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """a, b, spans (begin, end of each item whose windows all repeat) of the texts that have any; ``texts``: a, b, data."""
    gram = max(1, width // 4)
    reach = width - gram + 1
    texts = texts.select("a", "b", "data")
    shared = written(_grams(texts, width, gram).groupBy("common").agg(F.count("*").alias("n")).where("n > 1").select("common"), "grams")
    first = _items(texts, width, gram).join(shared, "common", "left_semi")
    items = written(first.withColumns({"done": F.lit(False), "item": F.monotonically_increasing_id()}), "items")

    low, high = F.lit(0), F.lit(reach)
    repeated, to_cut = _sorted_out(items)
    found = [written(repeated, "repeated")]
    open_items = to_cut.groupBy("a", "b").agg(F.collect_list(F.struct("spot", "done", low.alias("low"), high.alias("high"))).alias("open"))
    rows = texts.join(open_items, ["a", "b"]).withColumn("base", F.lit(0).cast("long"))
    while True:
        items = written(_parts(rows, width).withColumn("item", F.monotonically_increasing_id()), "items")
        if items.isEmpty():
            break
        repeated, to_cut = _sorted_out(items)
        found.append(written(repeated, "repeated"))
        rows = to_cut.select("a", "b", "base", "data", F.array(F.struct("spot", "done", "low", "high")).alias("open"))

    spots = found[0]
    for more in found[1:]:
        spots = spots.unionByName(more)
    place, lead = F.shiftright("spot", 24), 4095
    spans = spots.distinct().select(
        "a",
        "b",
        F.struct(
            (place - F.col("spot").bitwiseAND(lead) + 1).alias("begin"),
            (place - F.shiftright("spot", 12).bitwiseAND(lead) + width).alias("end"),
        ).alias("span"),
    )
    return spans.groupBy("a", "b").agg(F.collect_list("span").alias("spans"))


def without_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH, with_kept: bool = False
) -> DataFrame:
    """doc, n_bytes, n_removed, n_spans, kept_sha256 of each document, and on demand ``spans`` and ``kept`` (the bytes left)."""
    texts = _texts(documents, id_column, text_column)
    kind = documents.schema[id_column].dataType.simpleString()
    more = ", spans array<struct<begin: long, end: long>>, kept binary" if with_kept else ""
    joined = texts.join(repeated_spans(texts, width), ["a", "b"], "left").select("doc", "data", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.windows import merged

        for batch in batches:
            sizes, removed, n_spans, digests, all_spans, kept_bytes = [], [], [], [], [], []
            for cell, found in zip(batch.column("data"), batch.column("spans").to_pylist(), strict=True):
                data = memoryview(cell.as_buffer())
                spans = merged([(s["begin"], s["end"]) for s in found or []])
                digest, at, kept = sha256(), 0, []
                for begin, end in [*spans, (len(data), len(data))]:
                    digest.update(data[at:begin])
                    if with_kept:
                        kept.append(bytes(data[at:begin]))
                    at = end
                sizes.append(len(data))
                removed.append(sum(end - begin for begin, end in spans))
                n_spans.append(len(spans))
                digests.append(digest.hexdigest())
                all_spans.append([{"begin": begin, "end": end} for begin, end in spans])
                kept_bytes.append(b"".join(kept))
            columns = [
                batch.column("doc"),
                pa.array(sizes, type=pa.int64()),
                pa.array(removed, type=pa.int64()),
                pa.array(n_spans, type=pa.int64()),
                pa.array(digests, type=pa.string()),
            ]
            names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_kept:
                columns += [pa.array(all_spans, type=pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))), pa.array(kept_bytes, type=pa.binary())]
                names += ["spans", "kept"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return in_tasks(joined, keep, f"doc {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string{more}")
