"""Token ids of documents in compressed files, in ascending order of the documents' ids.

Each task holds a range of documents, sorted, and writes one file::

    magic | coded blocks | block table | document table | table sizes, checksum, magic

Blocks hold a fixed number of ids (the last one fewer), cut without regard to documents, each coded on its own from a
reset model. The block table has the number of ids, the coded size and the CRC-32 of the ids of each block; the
document table has the id and the number of ids of each document. A reader checks every checksum and raises on damage.

Defined cases: a NULL or empty text has the end id alone; NULL ids come first; rows that share an id are ordered by
their texts; other columns are ignored; an empty table gives no files. Document ids must be whole numbers of 64 bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, row_hash, shared_folder, written

MAGIC = b"IDBLOCK1"
# a block under way takes some 45 KB
BLOCKS_AT_ONCE = 4096
IDS_AT_ONCE = 1 << 23
_BLOCK = np.dtype([("n_ids", "<u4"), ("n_bytes", "<u4"), ("crc", "<u4")])
_DOCUMENT = np.dtype([("doc", "<i8"), ("known", "u1"), ("n_ids", "<u8")])
_TAIL = struct.Struct("<QQI8s")


def _at_once(block_ids: int) -> int:
    """Blocks of one batch; fewer if they are long."""
    return max(1, min(BLOCKS_AT_ONCE, IDS_AT_ONCE // block_ids))


class FileWriter:
    """Writes ids of documents in order; holds one batch of blocks."""

    def __init__(self, sink, block_ids: int):
        self._sink, self._block_ids, self._stride = sink, block_ids, block_ids * _at_once(block_ids)
        self._waiting: list[bytes] = []
        self._size = 0
        self._blocks: list[tuple[int, int, int]] = []
        self._documents: list[tuple[int, int, int]] = []
        self.n_ids = 0
        sink.write(MAGIC)

    def add(self, doc: int | None, ids: bytes) -> None:
        self._documents.append((doc or 0, doc is not None, len(ids) // 4))
        self._waiting.append(ids)
        self._size += len(ids)
        self.n_ids += len(ids) // 4
        if self._size >= 4 * self._stride:
            self._flush(last=False)

    def _flush(self, last: bool) -> None:
        from canteiro.llm.id_codec import IDS, encoded

        data = np.frombuffer(b"".join(self._waiting), dtype=IDS)
        whole = len(data) if last else len(data) // self._block_ids * self._block_ids
        for begin in range(0, whole, self._stride):
            some = data[begin : min(begin + self._stride, whole)]
            for at, coded in enumerate(encoded(some, self._block_ids)):
                block = some[at * self._block_ids : (at + 1) * self._block_ids]
                self._sink.write(coded)
                self._blocks.append((len(block), len(coded), zlib.crc32(block)))
        self._waiting = [data[whole:].tobytes()]
        self._size = 4 * (len(data) - whole)

    def close(self) -> None:
        self._flush(last=True)
        tables = np.array(self._blocks, dtype=_BLOCK).tobytes() + np.array(self._documents, dtype=_DOCUMENT).tobytes()
        self._sink.write(tables)
        self._sink.write(_TAIL.pack(len(self._blocks), len(self._documents), zlib.crc32(tables), MAGIC))


class FileReader:
    """Reads documents' ids in order; holds one batch of blocks."""

    def __init__(self, source):
        self._source = source
        source.seek(source.size() - _TAIL.size)
        n_blocks, n_documents, crc, magic = _TAIL.unpack(source.read(_TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a file of id blocks")
        size = n_blocks * _BLOCK.itemsize + n_documents * _DOCUMENT.itemsize
        source.seek(source.size() - _TAIL.size - size)
        tables = source.read(size)
        if zlib.crc32(tables) != crc:
            raise ValueError("the tables of an id file are damaged")
        self._blocks = np.frombuffer(tables, dtype=_BLOCK, count=n_blocks)
        self._documents = np.frombuffer(tables, dtype=_DOCUMENT, offset=n_blocks * _BLOCK.itemsize)

    def _batches(self) -> Iterator[bytes]:
        from canteiro.llm.id_codec import decoded

        self._source.seek(len(MAGIC))
        # a step costs much the same for few blocks as for many, so all batches are of one size
        n_batches = -(-len(self._blocks) // _at_once(int(self._blocks["n_ids"].max(initial=1))))
        for some in np.array_split(self._blocks, n_batches) if n_batches else ():
            ids = decoded([self._source.read(int(b["n_bytes"])) for b in some], some["n_ids"].tolist())
            for block, entry in zip(ids, some, strict=True):
                if zlib.crc32(block) != entry["crc"]:
                    raise ValueError("a block of an id file is damaged")
            yield b"".join(block.tobytes() for block in ids)

    def documents(self) -> Iterator[tuple[int | None, list[memoryview]]]:
        """Each document's id and its ids in one or more parts."""
        batches, rest, at = self._batches(), memoryview(b""), 0
        for doc, known, n_ids in self._documents.tolist():
            need, parts = 4 * n_ids, []
            while need > len(rest) - at:
                parts.append(rest[at:])
                need -= len(rest) - at
                rest, at = memoryview(next(batches)), 0
            parts.append(rest[at : at + need])
            at += need
            yield doc if known else None, parts


def write_ids(
    documents: DataFrame,
    tokenizer: str,
    folder: str | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 2,
    block_ids: int | None = None,
) -> DataFrame:
    """Write the files; returns their list: part (in order of ids), path, n_documents, n_ids."""
    from canteiro.llm.id_codec import BLOCK_TOKENS

    spark = documents.sparkSession
    target = folder or shared_folder(spark, "ids")
    block = block_ids or BLOCK_TOKENS
    texts = documents.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text"))
    # equal ids are spread by their texts, so one id can't fill a task
    ranged = texts.withColumn("tie", row_hash("text")).repartitionByRange("doc", "tie")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from canteiro.llm.storage import new_file, opened_for_writing
        from canteiro.llm.tokens import ID_TYPE, encoder

        part = TaskContext.get().partitionId()
        end = int(end_id).to_bytes(ID_TYPE.itemsize, "little")
        encode = encoder(tokenizer).encode
        path, writer, sink, n = new_file(target, part, ".ids"), None, None, 0
        for batch in batches:
            for doc, text in zip(batch.column("doc"), batch.column("text"), strict=True):
                if writer is None:
                    sink = opened_for_writing(path)
                    writer = FileWriter(sink, block)
                writer.add(doc.as_py(), encode(text.as_py()) + end)
                n += 1
        if writer is not None:
            writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "path": path, "n_documents": n, "n_ids": writer.n_ids}],
                schema=pa.schema([("part", pa.int32()), ("path", pa.string()), ("n_documents", pa.int64()), ("n_ids", pa.int64())]),
            )

    rows = ranged.sortWithinPartitions("doc", "tie", "text").select("doc", "text")
    return written(in_tasks(rows, write, "part int, path string, n_documents long, n_ids long"), "id-files")


def read_ids(spark: SparkSession, files: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the listed files: doc, start, n_tokens, ids_crc32, and ids if asked for."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = files.withColumn("first", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).cast("long"))
    n_files = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.storage import opened_for_reading

        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("first").to_pylist(), strict=True):
                with opened_for_reading(path) as source:
                    rows, at = [], first
                    for doc, parts in FileReader(source).documents():
                        crc = 0
                        for part in parts:
                            crc = zlib.crc32(part, crc)
                        n = sum(map(len, parts)) // 4
                        rows.append((doc, at, n, crc, b"".join(parts) if with_ids else None))
                        at += n
                        if len(rows) == 5000:
                            yield _document_batch(rows)
                            rows = []
                    if rows:
                        yield _document_batch(rows)

    one_per_task = offsets.select("part", "path", "first").repartitionByRange(n_files, "part").select("path", "first")
    found = in_tasks(one_per_task, read, "doc long, start long, n_tokens long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


def _document_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    arrays = [pa.array(values, type=kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["doc", "start", "n_tokens", "ids_crc32", "ids"])
