"""Record lists inside API payloads kept as JSON text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: keys under which the APIs put their records
RECORD_KEYS = ("data", "content", "items", "Contratos", "Obras", "Convenios")
PANEL_RECORD_KEYS = ("Contratos", "contratos", "data", "results", "content", "items")


def _list_text(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed.startswith("["), trimmed)


def with_record_list(
    df: DataFrame,
    payload: str,
    preferred: Sequence[str] = (),
    generic: Sequence[str] = RECORD_KEYS,
    any_list: bool = True,
) -> DataFrame:
    """Add ``__list``, the JSON text of the record list: the payload itself, a preferred key, a
    generic one, any list."""
    members = df.withColumn("__members", F.from_json(payload, "map<string,string>"))
    choices = [_list_text(F.col(payload))]
    choices += [_list_text(F.try_element_at("__members", F.lit(key))) for key in (*preferred, *generic)]
    if any_list:
        lists = F.filter(F.map_values("__members"), lambda v: F.trim(v).startswith("["))
        choices.append(F.get(lists, F.lit(0)))
    return members.withColumn("__list", F.coalesce(*choices)).drop("__members")


def explode_records(
    df: DataFrame,
    payload: str,
    record_schema: T.StructType | str,
    preferred: Sequence[str] = (),
    generic: Sequence[str] = RECORD_KEYS,
    any_list: bool = True,
) -> DataFrame:
    """One row per record, the other columns of ``df`` kept; list items that are no objects drop."""
    schema = T.StructType.fromDDL(record_schema) if isinstance(record_schema, str) else record_schema
    listed = with_record_list(df, payload, preferred, generic, any_list)
    others = [name for name in df.columns if name != payload]
    # the outer form keeps Spark from parsing the list once more for a filter
    items = listed.select(*others, F.explode_outer(F.from_json("__list", "array<string>")).alias("__item"))
    records = items.where(F.trim("__item").startswith("{"))
    return records.withColumn("__record", F.from_json("__item", schema)).select(*others, "__record.*")
