"""WARC archives of pages, with a two-level capture index that records are read through.

Writing: each task writes one archive, a gzip member per record. Of the pages with equal payloads the one with the
largest id is a ``response``; the others are ``revisit`` records that refer to it and hold only the HTTP head.

The index: captures (URL key, archive, place) are sorted by key into index files. A file holds compressed blocks of
captures and, behind them, a sparse directory with the first key of each block. URL keys have the host reversed
(``org,example,www)/path``), so captures of a site stand together.

Reading: a list of index files with their first and last keys (one entry per file, so its size is the number of index
tasks) names the files of a key; the directory is searched by halves for the block; one range read brings the block,
and one range read per capture brings the record.

Defined cases: a NULL page has an empty payload; empty payloads are equal payloads like any others unless
``least_bytes`` is more than 0; pages that share the largest id and the payload are all responses; a NULL id is smaller
than any other and refers to nothing if all of its group are NULL; a NULL URL has the key ``-``; other columns are
ignored; an empty table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import json
import re
import struct
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro.llm.common import in_tasks, shared_folder, written

CAPTURE_DATE = "2000-01-01T00:00:00Z"
BLOCK_CAPTURES = 256
_TAIL = struct.Struct("<QI8s")
_MAGIC = b"CAPINDX1"
_CAPTURES = "key string, path string, start long, length long"
_RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def url_key(url: str | None) -> str:
    """Sort key of a URL: reversed host, port, then the rest; the scheme, user and fragment are left out."""
    if not url:
        return "-"
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.\-]*://", "", url.strip()).split("#", 1)[0]
    cut = re.search(r"[/?]", rest)
    place, path = (rest[: cut.start()], rest[cut.start() :]) if cut else (rest, "/")
    host, _, port = place.rpartition("@")[2].lower().partition(":")
    labels = ",".join(reversed(host.split(".")))
    key = f"{labels}{':' + port if port else ''}){path if path.startswith('/') else '/' + path}"
    return re.sub(r"\s", lambda m: f"%{ord(m.group()):02X}", key)


def _header_safe(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def _record_name(page_id: int | None) -> str:
    return f"<urn:page:{'null' if page_id is None else page_id}>"


def _page_of(name: str) -> int | None:
    value = name.strip("<>").rpartition(":")[2]
    return None if value == "null" else int(value)


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_record_name(page_id)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{payload_digest(payload)}",
        f"Content-Length: {len(block)}",
        "Content-Type: application/http; msgtype=response",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {_header_safe(url)}")
    if revisit:
        lines.append(f"WARC-Refers-To: {_record_name(refers_to)}")
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    packer = zlib.compressobj(3, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + packer.flush()


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode().split("\r\n")[1:])
    return {name.lower(): value.strip() for name, _, value in pairs}


def parsed(member: bytes) -> dict:
    """What a record's gzip member holds; the payload is checked against its digest."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = _headers(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields["warc-type"] == "revisit"
    digest = fields["warc-payload-digest"].removeprefix("sha1:")
    if not revisit and payload_digest(payload) != digest:
        raise ValueError(f"damaged payload of {fields['warc-record-id']}")
    return {
        "page_id": _page_of(fields["warc-record-id"]),
        "payload_bytes": int(_headers(http)["content-length"]),
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": _page_of(fields["warc-refers-to"]) if revisit else None,
        "url": fields.get("warc-target-uri"),
        "payload": None if revisit else payload,
    }


def write_archives(
    pages: DataFrame,
    folder: str | None = None,
    id_column: str = "page_id",
    url_column: str = "url",
    payload_column: str = "html",
    least_bytes: int = 0,
    date: str = CAPTURE_DATE,
) -> DataFrame:
    """Write the archives; returns the captures: key, path, start, length."""
    target = folder or shared_folder(pages.sparkSession, "warc")
    payload = F.encode(F.coalesce(F.col(payload_column), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"), payload.alias("payload"))
    hashed = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    # only payloads that repeat are joined; a digest that a third of all pages share is one row here
    owners = (
        hashed.where(F.octet_length("payload") >= least_bytes)
        .groupBy("digest")
        .agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("digest").alias("shared"), "owner")
    )
    joined = hashed.join(owners, (F.col("digest") == F.col("shared")) & (F.octet_length("payload") >= least_bytes), "left")
    revisit = F.col("shared").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("owner"))
    to_write = joined.select("page_id", "url", "payload", F.col("owner").alias("refers_to"), revisit.alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from canteiro.llm.storage import new_file, opened_for_writing

        path, sink, at = new_file(target, TaskContext.get().partitionId(), ".warc.gz"), None, 0
        for batch in batches:
            keys, starts, lengths = [], [], []
            for cells in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "revisit")), strict=True):
                member = record(*(cell.as_py() for cell in cells), date)
                sink = sink or opened_for_writing(path)
                sink.write(member)
                keys.append(url_key(cells[1].as_py()))
                starts.append(at)
                lengths.append(len(member))
                at += len(member)
            yield _capture_batch(keys, [path] * len(keys), starts, lengths)
        if sink is not None:
            sink.close()

    return written(in_tasks(to_write, write, _CAPTURES), "captures")


def _capture_batch(keys: list[str], paths: list[str], starts: list[int], lengths: list[int]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
    arrays = [pa.array(values, type=kind) for values, kind in zip((keys, paths, starts, lengths), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=["key", "path", "start", "length"])


def write_index(captures: DataFrame, folder: str | None = None, block_captures: int = BLOCK_CAPTURES) -> DataFrame:
    """Write the index files; returns their list: index_path, first_key, last_key, n_captures."""
    target = folder or shared_folder(captures.sparkSession, "capture-index")
    ranged = captures.repartitionByRange("key", "path", "start").sortWithinPartitions("key", "path", "start")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from canteiro.llm.storage import new_file, opened_for_writing

        path, sink, at, n = new_file(target, TaskContext.get().partitionId(), ".idx"), None, 0, 0
        waiting: list[tuple] = []
        directory: list[tuple[str, int, int]] = []
        last_key = ""

        def flush(some: list[tuple]) -> None:
            nonlocal at
            block = zlib.compress("\n".join(json.dumps(entry) for entry in some).encode())
            sink.write(block)
            directory.append((some[0][0], at, len(block)))
            at += len(block)

        for batch in batches:
            entries = list(zip(*(batch.column(c).to_pylist() for c in ("key", "path", "start", "length")), strict=True))
            if entries and sink is None:
                sink = opened_for_writing(path)
            waiting += entries
            n += len(entries)
            while len(waiting) >= block_captures:
                flush(waiting[:block_captures])
                last_key, waiting = waiting[block_captures - 1][0], waiting[block_captures:]
        if waiting:
            flush(waiting)
            last_key = waiting[-1][0]
        if sink is not None:
            sink.write(_closing(directory))
            sink.close()
            yield pa.RecordBatch.from_pylist(
                [{"index_path": path, "first_key": directory[0][0], "last_key": last_key, "n_captures": n}]
            )

    return written(in_tasks(ranged, write, "index_path string, first_key string, last_key string, n_captures long"), "index-files")


def _closing(directory: list[tuple[str, int, int]]) -> bytes:
    """The directory and what finds it at the end of an index file."""
    packed = zlib.compress(json.dumps(directory).encode())
    return packed + _TAIL.pack(len(packed), zlib.crc32(packed), _MAGIC)


class IndexFile:
    """Captures of a key by its directory and single blocks; the last block stays at hand for the next key."""

    def __init__(self, source):
        self._source = source
        source.seek(source.size() - _TAIL.size)
        size, crc, magic = _TAIL.unpack(source.read(_TAIL.size))
        source.seek(source.size() - _TAIL.size - size)
        packed = source.read(size)
        if magic != _MAGIC or zlib.crc32(packed) != crc:
            raise ValueError("not a capture index, or a damaged one")
        self._directory = json.loads(zlib.decompress(packed))
        self._first_keys = [entry[0] for entry in self._directory]
        self._at, self._block, self._keys = -1, [], []

    def _load(self, at: int) -> None:
        if at != self._at:
            _, start, length = self._directory[at]
            self._source.seek(start)
            lines = zlib.decompress(self._source.read(length)).decode().split("\n")
            self._block = [json.loads(line) for line in lines]
            self._keys = [entry[0] for entry in self._block]
            self._at = at

    def captures(self, key: str) -> Iterator[list]:
        # the first block that can hold the key is the one before the first block that starts with it
        at = max(0, bisect.bisect_left(self._first_keys, key) - 1)
        while at < len(self._directory) and self._first_keys[at] <= key:
            self._load(at)
            yield from self._block[bisect.bisect_left(self._keys, key) : bisect.bisect_right(self._keys, key)]
            at += 1


def find_captures(keys: DataFrame, index: DataFrame) -> DataFrame:
    """The captures of the distinct keys in column ``key``: key, path, start, length.

    The list of index files is known to every task; it has one entry per index task.
    """
    files = sorted((r["first_key"].encode(), r["last_key"].encode(), r["index_path"]) for r in index.collect())

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, lasts = [f for f, _, _ in files], [last for _, last, _ in files]
        for batch in batches:
            found: list[tuple[str, str]] = []
            for key in batch.column("key").to_pylist():
                data = key.encode()
                for at in range(bisect.bisect_left(lasts, data), bisect.bisect_right(firsts, data)):
                    found.append((files[at][2], key))
            yield pa.RecordBatch.from_arrays(
                [pa.array([p for p, _ in found], type=pa.string()), pa.array([k for _, k in found], type=pa.string())],
                names=["index_path", "key"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.storage import opened_for_reading

        path, index_file = None, None
        for batch in batches:
            for at, key in zip(batch.column("index_path").to_pylist(), batch.column("key").to_pylist(), strict=True):
                if at != path:
                    path, index_file = at, IndexFile(opened_for_reading(at))
                some: list[list] = []
                for capture in index_file.captures(key):
                    some.append(capture)
                    if len(some) == 5000:
                        yield _capture_batch(*map(list, zip(*some, strict=True)))
                        some = []
                if some:
                    yield _capture_batch(*map(list, zip(*some, strict=True)))

    routed = in_tasks(keys.select("key").distinct(), route, "index_path string, key string")
    dealt = routed.repartition("index_path", F.substring("key", -2, 2)).sortWithinPartitions("index_path", "key")
    return in_tasks(dealt, search, _CAPTURES)


def read_records(captures: DataFrame, with_payload: bool = False) -> DataFrame:
    """The records of the captures, read by range: page_id, payload size and digest, type, refers_to, url, payload."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from canteiro.llm.storage import opened_for_reading

        schema = pa.schema(
            [
                ("page_id", pa.int64()),
                ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()),
                ("record_type", pa.string()),
                ("refers_to", pa.int64()),
                ("url", pa.string()),
                ("payload", pa.binary()),
            ]
        )
        path, source = None, None
        for batch in batches:
            rows = []
            for at, start, length in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "length")), strict=True):
                if at != path:
                    path, source = at, opened_for_reading(at)
                source.seek(start)
                found = parsed(source.read(length))
                rows.append(found if with_payload else found | {"payload": None})
                if len(rows) == 500:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # places of a file are dealt in stretches of 64 MB, so a large archive is read by many tasks
    stretch = F.shiftright("start", 26)
    dealt = captures.repartition("path", stretch).sortWithinPartitions("path", "start")
    found = in_tasks(dealt, read, _RECORDS)
    return found if with_payload else found.drop("payload")


def url_keys(frame: DataFrame, url_column: str = "url") -> DataFrame:
    """The distinct keys of a column of URLs."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [url_key(url) for url in batch.column("url").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, type=pa.string())], names=["key"])

    return in_tasks(frame.select(F.col(url_column).alias("url")), keys, "key string").distinct()


def archived(pages: DataFrame, spark: SparkSession | None = None, with_payload: bool = False, **options: object) -> DataFrame:
    """Write the pages, index the captures, look up every page's URL in the index and read the records back."""
    captures = write_archives(pages, **options)
    index = write_index(captures)
    keys = url_keys(pages, options.get("url_column", "url"))
    return read_records(find_captures(keys, index), with_payload)
