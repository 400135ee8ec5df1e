"""Key upsert and versioned tables."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro.operators.dedup import all_present, keep_last, split_null_keys


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target after the batch: keys in the batch are replaced, others stay, new ones are added.

    The batch must be unique by key. A column the batch does not carry keeps its old value; a
    NULL it does carry overwrites. The target is only the probe side of an anti and a semi join,
    so a batch small enough to be broadcast leaves the target unshuffled.
    """
    absent = [key for key in keys if key not in batch.columns]
    if absent:
        raise ValueError(f"batch lacks key columns: {absent}")
    batch_keys = batch.select(*keys)
    untouched = target.join(batch_keys, list(keys), "left_anti")
    kept_columns = [name for name in target.columns if name not in batch.columns]
    if kept_columns:
        previous = target.select(*keys, *kept_columns).join(batch_keys, list(keys), "left_semi")
        batch = batch.join(previous, list(keys), "left")
    return untouched.unionByName(batch.select(*target.columns))


def prepare_batch(
    batch: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Batch unique by key (last row wins) and the rows rejected for a NULL key."""
    known, rejected = split_null_keys(batch, keys)
    return keep_last(known, keys, order), rejected


KEPT, REJECTED = "mantido", "rejeitado"
OUTCOME = "_outcome"


def marked_batch(batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key, marked as kept, and every row without a complete key, marked as rejected.

    One pass makes both: a row without a key gets a number of its own beside it, so it is the only row of its group.
    """
    known = all_present(keys)
    spread = batch.withColumn("__alone", F.when(~known, F.monotonically_increasing_id()))
    last = keep_last(spread, [*keys, "__alone"], order)
    return last.withColumn(OUTCOME, F.when(known, F.lit(KEPT)).otherwise(F.lit(REJECTED))).drop("__alone")


def stamped(df: DataFrame, as_of: Column) -> DataFrame:
    return df.withColumn("atualizado_em", as_of)


BUCKETS = 64
# deltas that a read merges at most, and their rows as a share of the table's, before they are merged into the base
MAX_DELTAS = 8
DELTA_SHARE = 0.1
_MANIFEST = "bucket int, folder string, buckets int, schema string, place int, n bigint, keys string"


class VersionedTable:
    """Parquet table in buckets of its key, with small deltas over them, and a list of folders per version.

    A version counts once Spark has committed its list (the list's ``_SUCCESS`` marker exists), so a
    job that dies halfway leaves the previous version readable. An upsert writes its batch as a delta
    and lists the base again; a read lets the newest delta win. When deltas are many or large they are
    merged into the base, and only the buckets that they have keys in are rewritten. Files are sorted by
    key and hold a Bloom filter of the first one, so a look-up of keys skips what can't have them.

    The number of buckets is fixed when the table is first written; a table of n TB wants some
    thousand times n.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self._new_buckets = spark, path.rstrip("/"), buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Committed versions, oldest first."""
        found = []
        for name in list_names(self.spark, self.path):
            if name.startswith("v") and self._fs.exists(self._path(f"{self.path}/{name}/list/_SUCCESS")):
                found.append(int(name[1:]))
        return sorted(found)

    def _listed(self, version: int) -> list[Row]:
        """The list of a version: a row per folder of a bucket, or one without a folder. Place 0 is the base, the
        deltas count from 1, the newest last."""
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/v{version:08d}/list").collect()

    def _current(self) -> list[Row]:
        return [row for version in self.versions()[-1:] for row in self._listed(version)]

    def folders(self, version: int | None = None, deltas: bool = False) -> dict[int, str]:
        """Folder of each bucket of the base (or each delta, by its place), in the newest or the given version."""
        rows = self._listed(version) if version is not None else self._current()
        return {
            row["place"] if deltas else row["bucket"]: f"{self.path}/{row['folder']}"
            for row in rows
            if row["folder"] and bool(row["place"]) == deltas
        }

    def _frame(self, rows: Sequence[Row], schema: T.StructType) -> DataFrame:
        folders = [f"{self.path}/{row['folder']}" for row in rows if row["folder"]]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, only: Sequence[int] | None = None) -> DataFrame | None:
        """Newest version, or some buckets of it; None before the first write."""
        rows = self._current()
        return self._read(rows, only) if rows else None

    def _read(self, rows: Sequence[Row], only: Sequence[int] | None = None) -> DataFrame:
        """The table of a list."""
        schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
        base = self._frame([r for r in rows if not r["place"] and (only is None or r["bucket"] in only)], schema)
        deltas = sorted((r for r in rows if r["place"]), key=lambda r: r["place"])
        if not deltas:
            return base
        keys, buckets = json.loads(deltas[0]["keys"]), rows[0]["buckets"]
        newest = self._deltas(deltas, schema, keys)
        if only is not None:
            newest = newest.where(_bucket(keys, buckets).isin(list(only)))
        return upsert(base, newest, keys)

    def _deltas(self, deltas: Sequence[Row], schema: T.StructType, keys: Sequence[str]) -> DataFrame:
        """The newest row of each key in the deltas."""
        if len(deltas) == 1:
            return self._frame(deltas, schema)
        parts = [self._frame([row], schema).withColumn("__place", F.lit(row["place"])) for row in deltas]
        merged = parts[0]
        for part in parts[1:]:
            merged = merged.unionByName(part)
        return keep_last(merged, keys, ["__place"]).drop("__place")

    def write(self, df: DataFrame, keys: Sequence[str] = ()) -> int:
        """Write a complete new version and return its number; without keys it is one bucket."""
        return self._write(df, keys, self._new_buckets if keys else 1, [])

    def _write(self, df: DataFrame, keys: Sequence[str], buckets: int, kept: Sequence[Row], most: int = 0) -> int:
        """A new version: the rows as a new base, beside buckets of the old one that stay; with these, the
        number of rows is at most ``most``."""
        base = self._next()
        marked = df.withColumn(_BUCKET, _bucket(keys, buckets))
        # files of one bucket come from few tasks; a bucket that is large is split among tasks
        dealt = marked.hint("rebalance", F.col(_BUCKET)) if buckets > 1 else marked
        seen = Observation()
        self._writer(dealt.observe(seen, F.count(F.lit(1)).alias("n")), keys, _BUCKET).parquet(f"{self.path}/{base}/rows")
        schema = json.dumps(df.schema.jsonValue())
        # the rows of the base are counted as a whole, in its first line
        total = most if kept else seen.get["n"]
        listed = [(row["bucket"], row["folder"], buckets, schema, 0, None, None) for row in kept]
        for name in list_names(self.spark, f"{self.path}/{base}/rows"):
            if name.startswith(f"{_BUCKET}="):
                listed.append((int(name.split("=")[1]), f"{base}/rows/{name}", buckets, schema, 0, None, None))
        listed = listed or [(None, None, buckets, schema, 0, None, None)]
        return self._commit(base, [(*listed[0][:5], total, None), *listed[1:]])

    def _next(self) -> str:
        return f"v{(self.versions() or [0])[-1] + 1:08d}"

    def _writer(self, df: DataFrame, keys: Sequence[str], *by: str) -> DataFrameWriter:
        rows = df.sortWithinPartitions(*by, *[f"`{key}`" for key in keys]) if keys else df
        writer = rows.write.mode("overwrite").option("compression", "zstd").partitionBy(*by)
        return writer.option(f"parquet.bloom.filter.enabled#{keys[0]}", "true") if keys else writer

    def _commit(self, base: str, listed: Sequence[tuple]) -> int:
        self.spark.createDataFrame(listed, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{base}/list")
        return int(base[1:])

    def upsert(self, batch: DataFrame, keys: Sequence[str]) -> int:
        """Upsert a batch; pass a staged one that is unique by key."""
        rows = self._current()
        if not rows:
            return self.write(batch, keys)
        schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
        absent = [key for key in keys if key not in batch.columns]
        if absent:
            raise ValueError(f"batch lacks key columns: {absent}")
        if any(name not in batch.columns for name in schema.names):
            # cells that the batch does not carry keep their old values
            kept = [name for name in schema.names if name not in batch.columns]
            old = self.read().select(*keys, *kept).join(batch.select(*keys), list(keys), "left_semi")
            batch = batch.join(old, list(keys), "left")
        base = self._next()
        seen = Observation()
        counted = batch.select(*schema.names).observe(seen, F.count(F.lit(1)).alias("n"))
        self._writer(counted, keys).parquet(f"{self.path}/{base}/delta")
        place = max(row["place"] for row in rows) + 1
        names = ("bucket", "folder", "buckets", "schema", "place", "n", "keys")
        delta = (None, f"{base}/delta", rows[0]["buckets"], rows[0]["schema"], place, seen.get["n"], json.dumps(list(keys)))
        rows = [*rows, Row(*names)(*delta)]
        sizes = [row["n"] for row in rows if row["place"]]
        total = sum(row["n"] or 0 for row in rows if not row["place"])
        if len(sizes) > MAX_DELTAS or sum(sizes) > DELTA_SHARE * total:
            return self._merged(rows)
        return self._commit(base, [tuple(row) for row in rows])

    def compact(self) -> int:
        """Merge the deltas into the base; buckets in which they have no key stay as they are."""
        rows = self._current()
        return self._merged(rows) if any(row["place"] for row in rows) else self.versions()[-1]

    def _merged(self, rows: Sequence[Row]) -> int:
        """A new version of a list's rows without deltas."""
        deltas = [row for row in rows if row["place"]]
        keys, buckets = json.loads(deltas[0]["keys"]), rows[0]["buckets"]
        schema = T.StructType.fromJson(json.loads(rows[0]["schema"]))
        newest = self._frame(deltas, schema).select(_bucket(keys, buckets).alias(_BUCKET))
        # at most as many rows as there are buckets
        touched = {row[0] for row in newest.distinct().collect()}
        kept = [row for row in rows if not row["place"] and row["folder"] and row["bucket"] not in touched]
        return self._write(self._read(rows, sorted(touched)), keys, buckets, kept, sum(row["n"] or 0 for row in rows))

    def discard(self) -> None:
        self._fs.delete(self._path(self.path), True)

    def drop_older(self, keep: int = 2) -> None:
        """Forget all but the newest versions and delete the folders that none of these lists. No load
        does this by itself: call it when no reader of an older version can be running, for example a
        day after the newest one was written."""
        versions = self.versions()
        used = {row["folder"] for version in versions[-keep:] for row in self._listed(version)}
        for version in versions[:-keep]:
            base = f"v{version:08d}"
            self._fs.delete(self._path(f"{self.path}/{base}/list"), True)
            folders = [f"{base}/rows/{name}" for name in list_names(self.spark, f"{self.path}/{base}/rows")]
            for folder in [*folders, f"{base}/delta"]:
                if folder not in used:
                    self._fs.delete(self._path(f"{self.path}/{folder}"), True)


_BUCKET = "_bucket"


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket of a row by the text form of its key."""
    if buckets == 1:
        return F.lit(0)
    return F.pmod(F.xxhash64(*[F.col(key).cast("string") for key in keys]), F.lit(buckets)).cast("int")


def staging_table(spark: SparkSession, name: str, folder: str) -> VersionedTable:
    """Table for intermediate rows below a folder that all executors share.

    Writing rows there cuts their lineage: a lost executor re-reads them instead of repeating the
    work behind them.
    """
    return VersionedTable(spark, f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")


class StagedRows:
    """Intermediate rows below a folder that all executors share, written once and read as often as needed.

    Writing them cuts their lineage: a lost executor re-reads them instead of repeating the work
    behind them. ``by`` deals the rows to a folder for each of its values, so a reader of one value
    reads no other.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self._schema = spark, folder, None

    def write(self, df: DataFrame, *by: str) -> None:
        self._schema = df.schema
        df.write.partitionBy(*by).parquet(self.folder)

    def read(self) -> DataFrame:
        return self.spark.read.schema(self._schema).parquet(self.folder)

    def discard(self) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def staged_rows(spark: SparkSession, name: str, folder: str) -> StagedRows:
    return StagedRows(spark, f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}")


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system Spark can reach; empty when it does not exist."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def read_sources(spark: SparkSession, table_path: str) -> DataFrame | None:
    """Current versions of all source tables under one folder, as one frame."""
    found = [VersionedTable(spark, f"{table_path}/{child}").read() for child in list_names(spark, table_path)]
    frames = [frame for frame in found if frame is not None]
    if not frames:
        return None
    merged = frames[0]
    for frame in frames[1:]:
        merged = merged.unionByName(frame, allowMissingColumns=True)
    return merged
