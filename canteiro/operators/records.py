"""Records without one schema, kept as VARIANT values.

A record keeps all its keys as they are spelled, whatever other records of its file hold. A field is looked up in each
record among the keys that it has, so reading needs no pass over the data to find a schema.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD = "_record"


def parsed_records(texts: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose text is a JSON object, with the record in ``_record`` instead of the text, and the other rows.

    The other columns are kept in both; a NULL text is in neither.
    """
    parsed = texts.withColumn(RECORD, F.try_parse_json(text))
    is_record = F.coalesce(F.schema_of_variant(RECORD).startswith("OBJECT<"), F.lit(False))
    return parsed.where(is_record).drop(text), parsed.where(F.col(text).isNotNull() & ~is_record).drop(RECORD)


def has_records(df: DataFrame) -> bool:
    return RECORD in df.columns


def record_values(record: str | Column = RECORD) -> Column:
    """Map of a record's keys to its values."""
    return F.try_variant_get(record, "$", "map<string,variant>")


def record_texts(record: str | Column = RECORD) -> Column:
    """Map of a record's keys to texts; a nested value is JSON text, a JSON null is NULL."""
    return F.try_variant_get(record, "$", "map<string,string>")


def record_json(record: str | Column = RECORD) -> Column:
    """The whole record as JSON text, keys in order."""
    return F.to_json(record)


def with_record_maps(df: DataFrame) -> DataFrame:
    """Add a record's texts under its keys, and under its keys in lower case; NULLs left out, so they count as absent.

    Of keys that differ only in case, the last in order of spelling is found under the lower-case one.
    """
    filled = df.withColumn("__texts", F.map_filter(record_texts(), lambda _, value: value.isNotNull()))
    return filled.withColumn("__lowered", F.transform_keys("__texts", lambda key, _: F.lower(key)))


def spelled(*candidates: str) -> Column:
    """Text under the first candidate that a record has: exact spelling before any other case; for frames from
    ``with_record_maps``. An empty text is present and ends the search."""
    found = []
    for candidate in candidates:
        found.append(F.try_element_at("__texts", F.lit(candidate)))
        found.append(F.try_element_at("__lowered", F.lit(candidate.lower())))
    return F.coalesce(*found)


def by_name(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """A frame of records with a text column for each exact name, the record kept; other frames stay as they are."""
    if not has_records(df):
        return df
    texts = df.withColumn("__texts", record_texts())
    return texts.withColumns({name: F.try_element_at("__texts", F.lit(name)) for name in names}).drop("__texts")


def _plain(kind: T.DataType) -> T.DataType:
    """Type of a column for a type that records have."""
    if isinstance(kind, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(kind, T.DecimalType):
        return T.DoubleType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind.fields])
    return kind


def record_schema(records: DataFrame) -> T.StructType:
    """All keys of the records with the types of their values, found in one aggregate; keys may differ only in case."""
    found = records.agg(F.schema_of_variant_agg(RECORD)).first()[0]
    if not found or not found.startswith("OBJECT<"):
        return T.StructType([])
    return T.DataType.fromDDL(found.replace("OBJECT<", "STRUCT<"))


def as_columns(records: DataFrame) -> DataFrame:
    """The keys of the records as columns, in place of the record.

    Keys that differ only in case are one column, named by the first spelling, and a record gives the value of the one
    that it has, exactly spelled ones first. A key with values of several types is a text.
    """
    groups: dict[str, list[T.StructField]] = {}
    for key in record_schema(records).fields:
        groups.setdefault(key.name.lower(), []).append(key)
    others = [F.col(f"`{c}`") for c in records.columns if c != RECORD]
    columns = []
    for keys in groups.values():
        kinds = {_plain(key.dataType) for key in keys if not isinstance(key.dataType, T.NullType)}
        kind = kinds.pop() if len(kinds) == 1 else T.StringType()
        values = [F.try_variant_get(F.try_element_at("__values", F.lit(k.name)), "$", kind.simpleString()) for k in keys]
        columns.append(F.coalesce(*values).alias(keys[0].name))
    return records.withColumn("__values", record_values()).select(*columns, *others)
