"""Helpers shared by the source normalisers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.text import is_blank
from canteiro.operators.dedup import SOURCE_POSITION
from canteiro.operators.records import RECORD, has_records, record_json

POSITION = (*SOURCE_POSITION, "_item")
# names of a row's columns whose text gives no date
UNREADABLE = "_ilegiveis"


def record_columns(df: DataFrame) -> list[str]:
    """Column names that come from the record itself."""
    return [name for name in df.columns if name not in (*POSITION, RECORD, UNREADABLE)]


def carried(df: DataFrame) -> list[str]:
    """Source-position columns the frame has; normalisers keep them as the row order."""
    return [name for name in POSITION if name in df.columns]


def payload(df: DataFrame) -> Column:
    """The source record as JSON text, NULLs kept."""
    if has_records(df):
        return record_json()
    names = [F.col(f"`{name}`") for name in record_columns(df)]
    return F.to_json(F.struct(*names), {"ignoreNullFields": "false"})


def with_texts(df: DataFrame, texts: dict[str, Column]) -> DataFrame:
    """Chosen source cells under their target names, the raw record, and the position.

    Parsers then refer to plain columns, so a cell is read and trimmed once per row however often
    a parser looks at it.
    """
    return df.select(
        *[column.alias(name) for name, column in texts.items()], payload(df).alias("__record"), *carried(df)
    )


def project(
    df: DataFrame,
    columns: dict[str, Column],
    as_of: Column,
    source: str | None = None,
    dates: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Normalised record: the given columns, source, collection time, raw record, position.

    ``dates`` are the cells that columns of dates were read from; the names of those that are filled
    and gave no date go along, for the load to count.
    """
    record = F.col("__record") if "__record" in df.columns else payload(df)
    if source is not None:
        columns = {**columns, "fonte": F.lit(source)}
    columns = {**columns, "coletado_em": as_of.cast("timestamp"), "payload_bruto": record}
    lost = [
        F.when(~is_blank(cell.cast("string")) & columns[name].isNull(), F.lit(name)) for name, cell in (dates or {}).items()
    ]
    found = [F.array_compact(F.array(*lost)).alias(UNREADABLE)] if lost else []
    return df.select(*[column.alias(name) for name, column in columns.items()], *carried(df), *found)
