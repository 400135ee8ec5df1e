"""Cleaning of one raw dataset."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro import vocab
from canteiro.functions.dates import epoch, parse_timestamp
from canteiro.functions.geo import in_range
from canteiro.functions.ids import company_tax_id
from canteiro.functions.numbers import money, to_double
from canteiro.functions.text import is_blank
from canteiro.operators.dedup import distinct_rows, keep_first, keep_first_known
from canteiro.operators.fields import with_missing_filled
from canteiro.sources.common import UNREADABLE

_LIMITS = {"latitude": 90.0, "longitude": 180.0}


@dataclass(frozen=True)
class Roles:
    """What each column of a dataset holds."""

    dates: tuple[str, ...] = ()
    money: tuple[str, ...] = ()
    tax_ids: tuple[str, ...] = ()


def _hinted(names: Sequence[str], hints: Sequence[str]) -> tuple[str, ...]:
    return tuple(name for name in names if any(hint in name.lower() for hint in hints))


def roles_by_name(names: Sequence[str]) -> Roles:
    """Roles guessed from fragments of the column names."""
    return Roles(
        dates=_hinted(names, vocab.DATE_HINTS),
        money=_hinted(names, vocab.MONEY_HINTS),
        tax_ids=_hinted(names, ("cnpj",)),
    )


def roles_by_schema(names: Sequence[str], schema: T.StructType, renames: Mapping[str, str]) -> Roles:
    """Roles from the types of the raw table the dataset goes to; other columns keep their text."""
    types = {f.name: f.dataType for f in schema.fields}
    target = {name: types.get(renames.get(name, name)) for name in names}
    return Roles(
        dates=tuple(n for n, kind in target.items() if isinstance(kind, T.TimestampType)),
        money=tuple(n for n, kind in target.items() if isinstance(kind, T.DoubleType) and n.lower() not in _LIMITS),
        tax_ids=tuple(n for n in names if "cnpj" in n.lower()),
    )


def to_timestamp(df: DataFrame, name: str) -> Column:
    """A column of dates in any of the forms sources use, as UTC timestamps."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return column.cast("timestamp")
    if isinstance(kind, T.NumericType):
        return epoch(column)
    return parse_timestamp(column)


def with_dates(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of dates as timestamps, and the names of those whose filled cell gives none, beside those that a
    normaliser found already. Text and date are looked at in one projection, which shares the parsing."""
    parsed = {name: to_timestamp(df, name) for name in names}
    lost = [
        F.when(~is_blank(F.col(f"`{name}`").cast("string")) & date.isNull(), F.lit(name)) for name, date in parsed.items()
    ]
    found = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
    if UNREADABLE in df.columns:
        found = F.concat(UNREADABLE, found)
    return df.withColumns({**parsed, UNREADABLE: found})


def to_money(df: DataFrame, name: str) -> Column:
    numeric = isinstance(df.schema[name].dataType, T.NumericType)
    return F.col(name).cast("double") if numeric else money(name)


def to_coordinate(df: DataFrame, name: str) -> Column:
    return in_range(to_double(F.col(name).cast("string")), _LIMITS[name.lower()])


def clean(
    df: DataFrame,
    as_of: Column,
    roles: Roles | None = None,
    order: Sequence[str] = (),
    parity: bool = False,
) -> DataFrame:
    """Dates, tax ids, duplicates, money, coordinates, defaults, in this order.

    Duplicates are compared before money is parsed, so ``10.500,00`` and ``10500.00`` are
    different rows. ``order`` names the columns that give the source order. Rows without an
    ``id_contrato`` all stay unless ``parity`` asks for the collapsing of NULL ids.
    """
    names = [name for name in df.columns if name not in order]
    roles = roles or roles_by_name(names)
    typed = df.withColumns(
        {
            **{name: to_timestamp(df, name) for name in roles.dates},
            **{name: company_tax_id(F.col(name).cast("string")) for name in roles.tax_ids},
        }
    )
    if "id_contrato" in names:
        unique = distinct_rows(typed, order, ignore=order)
        keep = keep_first if parity else keep_first_known
        unique = keep(unique, ["id_contrato"], order or names)
    else:
        unique = distinct_rows(typed, order, ignore=order)
    measured = unique.withColumns(
        {
            **{name: to_money(unique, name) for name in roles.money if name not in roles.dates},
            **{name: to_coordinate(unique, name) for name in names if name.lower() in _LIMITS},
        }
    )
    filled = with_missing_filled(
        measured, {"municipio": vocab.MUNICIPALITY_DEFAULT, "fonte": "desconhecida"}
    )
    collected = to_timestamp(filled, "coletado_em") if "coletado_em" in filled.columns else F.lit(None)
    return filled.withColumn("coletado_em", F.coalesce(collected, as_of).cast("timestamp"))
