"""Best-fit packing of documents into sequences of a fixed number of tokens.

A document is its ids and the end id. Only documents longer than a sequence are cut: into whole sequences, with the
rest as the first piece. Each task packs its pieces online with a bounded number of open bins. The open bins are a
bitset keyed by free space, so the bin with the least space that is enough is the lowest set bit from the piece's
length on. When no bin fits and all are open, the fullest closes. The bins that are open when a task ends are packed
once more, as items, across tasks; there are at most ``open_bins`` of them per task.

Defined cases: NULL and empty texts are a document of the end id alone; NULL ids and rows that repeat are packed like
any others; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, written

SEQUENCE_TOKENS = 1024
OPEN_BINS = 512
# sequences of one task are numbered from its partition times this
TASK_SEQUENCES = 1 << 40
# bins left open by tasks that one task packs again
BINS_PER_TASK = 20_000


class OpenBins:
    """A bounded number of open bins, the fullest of which closes when room is needed for a new one."""

    def __init__(self, size: int, limit: int, first: int):
        self._size, self._limit, self._next = size, limit, first
        self._by_free: list[list[int]] = [[] for _ in range(size + 1)]
        self._bits = self._open = 0

    def _take(self, free: int) -> int:
        bins = self._by_free[free]
        taken = bins.pop()
        if not bins:
            self._bits &= ~(1 << free)
        self._open -= 1
        return taken

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset of an item."""
        enough = self._bits >> length
        if enough:
            free = length + (enough & -enough).bit_length() - 1
            chosen = self._take(free)
        else:
            if self._open == self._limit:
                self._take((self._bits & -self._bits).bit_length() - 1)
            free, chosen = self._size, self._next
            self._next += 1
        left = free - length
        if left:
            self._by_free[left].append(chosen)
            self._bits |= 1 << left
            self._open += 1
        return chosen, self._size - free

    def open(self) -> Iterator[tuple[int, int]]:
        """Bin and used space of the bins that are open."""
        for free, bins in enumerate(self._by_free):
            for chosen in bins:
                yield chosen, self._size - free


def piece_lengths(n_tokens: int, size: int) -> list[int]:
    """Lengths of a document's pieces: a rest first, then whole sequences."""
    rest = n_tokens % size
    return [rest] * (rest > 0) + [size] * (n_tokens // size)


def packed(
    documents: DataFrame,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 2,
    sequence_tokens: int = SEQUENCE_TOKENS,
    open_bins: int = OPEN_BINS,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc, piece, start, length, ids_crc32, sequence_id, offset, and ids if asked for.

    ``ids`` are unsigned 32-bit little-endian numbers; ``sequences`` joins them.
    """
    texts = documents.select(F.col(id_column).alias("doc"), F.col(text_column).alias("text"))
    kind = texts.schema["doc"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from canteiro.llm.tokens import ID_TYPE, encoder

        width = ID_TYPE.itemsize
        end = int(end_id).to_bytes(width, "little")
        encode = encoder(tokenizer).encode
        bins = OpenBins(sequence_tokens, open_bins, TaskContext.get().partitionId() * TASK_SEQUENCES)
        schema = None
        for batch in batches:
            rows: list[tuple] = []
            owners: list[int] = []
            for index, text in enumerate(batch.column("text")):
                ids = encode(text.as_py()) + end
                start = 0
                for piece, length in enumerate(piece_lengths(len(ids) // width, sequence_tokens)):
                    part = ids[start * width : (start + length) * width]
                    owners.append(index)
                    rows.append((piece, start, length, zlib.crc32(part), *bins.place(length), part if with_ids else None))
                    start += length
            made = _piece_batch(batch.column("doc").take(pa.array(owners, type=pa.int64())), rows, False)
            schema = made.schema
            yield made
        left = [(0, 0, used, 0, sequence, 0, None) for sequence, used in bins.open()]
        if left and schema is not None:
            yield _piece_batch(pa.nulls(len(left), schema.field("doc").type), left, True)

    schema = (
        f"doc {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, ids binary, "
        "left_open boolean"
    )
    rows = written(in_tasks(texts, pack, schema), "packed")
    moves = _packed_again(rows.where("left_open").select("sequence_id", "length"), sequence_tokens, open_bins)
    pieces = rows.where("NOT left_open").drop("left_open").join(moves, "sequence_id", "left")
    placed = pieces.withColumn("sequence_id", F.coalesce("new_sequence", "sequence_id")).withColumn(
        "offset", F.col("offset") + F.coalesce("base", F.lit(0))
    )
    columns = ["doc", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] + ["ids"] * with_ids
    return placed.select(*columns)


def _piece_batch(docs: pa.Array, rows: list[tuple], left_open: bool) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(values, type=kind) for values, kind in zip(columns, kinds, strict=True)]
    names = ["doc", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "ids", "left_open"]
    return pa.RecordBatch.from_arrays([docs, *arrays, pa.array([left_open] * len(rows), type=pa.bool_())], names=names)


def _packed_again(bins: DataFrame, sequence_tokens: int, open_bins: int) -> DataFrame:
    """sequence_id, new_sequence and base of the bins that tasks left open, the fullest first."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: OpenBins | None = None
        names: dict[int, int] = {}
        for batch in batches:
            sequences, lengths = batch.column("sequence_id").to_pylist(), batch.column("length").to_pylist()
            merged = merged or OpenBins(sequence_tokens, open_bins, 0)
            places = [merged.place(length) for length in lengths]
            # a merged bin is named after the first bin in it
            for sequence, (chosen, _) in zip(sequences, places, strict=True):
                names.setdefault(chosen, sequence)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(sequences, type=pa.int64()),
                    pa.array([names[chosen] for chosen, _ in places], type=pa.int64()),
                    pa.array([offset for _, offset in places], type=pa.int64()),
                ],
                names=["sequence_id", "new_sequence", "base"],
            )

    tasks = bins.count() // BINS_PER_TASK + 1
    dealt = bins.repartition(tasks, "sequence_id").sortWithinPartitions(F.desc("length"), "sequence_id")
    return written(in_tasks(dealt, pack, "sequence_id long, new_sequence long, base long"), "moves")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence, from pieces with ids; a sequence has few pieces."""
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(F.transform(ordered, lambda p: p["ids"]), F.lit(b""), lambda a, b: F.concat(a, b))
    return pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), joined.alias("ids"))
