"""Choosing, renaming and defaulting columns. Name resolution uses the schema only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro.functions.text import blank_to_null, fold_name, key_form, key_name, missing_to_null, strip

_STRING_MAP = "map<string,string>"


def field(df: DataFrame, name: str, type_name: str | T.DataType = "string") -> Column:
    """The column, or a typed NULL when the frame has none of that name."""
    return F.col(name) if name in df.columns else F.lit(None).cast(type_name)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, cast to its types; absent ones are NULL."""
    columns = []
    for wanted in schema.fields:
        column = field(df, wanted.name, wanted.dataType)
        columns.append(column.cast(wanted.dataType).alias(wanted.name))
    return df.select(*columns)


def rename_guarded(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename where the source exists and the target does not yet; of several sources for one
    target the first listed is renamed and the others keep their names."""
    taken = set(df.columns)
    chosen: dict[str, str] = {}
    for source, target in renames.items():
        if source in df.columns and target not in taken:
            chosen[source] = target
            taken.add(target)
    return df.select(*[F.col(f"`{name}`").alias(chosen.get(name, name)) for name in df.columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill NULL and blank cells, creating the column when it is absent."""
    columns = {}
    for name, value in defaults.items():
        if name in df.columns:
            current = F.col(name)
            columns[name] = F.when(blank_to_null(current.cast("string")).isNull(), F.lit(value)).otherwise(current)
        else:
            columns[name] = F.lit(value)
    return df.withColumns(columns) if columns else df


def with_missing_filled(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Fill cells the cleaner calls missing (tokens such as ``n/a`` included)."""
    columns = {}
    for name, value in defaults.items():
        columns[name] = (
            F.coalesce(missing_to_null(F.col(name)), F.lit(value)) if name in df.columns else F.lit(value)
        )
    return df.withColumns(columns)


def keep_columns(df: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Allow-list projection in the order of the list."""
    present = set(df.columns)
    return df.select(*[name for name in allowed if name in present])


def absent_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def first_containing(names: Sequence[str], *candidates: str) -> str | None:
    """First column containing a candidate; candidates rank before columns."""
    for candidate in candidates:
        for name in names:
            if candidate.lower() in name.lower():
                return name
    return None


def first_containing_folded(names: Sequence[str], *candidates: str) -> str | None:
    """As ``first_containing``, ignoring accents as well as case."""
    for candidate in candidates:
        for name in names:
            if fold_name(candidate) in fold_name(name):
                return name
    return None


def first_named(names: Sequence[str], *candidates: str) -> str | None:
    """First candidate that is a column: exact spelling before case-insensitive."""
    for candidate in candidates:
        if candidate in names:
            return candidate
        for name in names:
            if name.lower() == candidate.lower():
                return name
    return None


def first_spelling(names: Sequence[str], *candidates: str) -> Column:
    """Text under the first candidate that a record has: exact spelling before case-insensitive.

    Records of one frame may spell a field differently. A cell that is NULL counts as absent; an
    empty text is present and ends the search.
    """
    found: list[str] = []
    for candidate in candidates:
        exact = [name for name in names if name == candidate]
        found += exact + [name for name in names if name.lower() == candidate.lower() and name not in exact]
    cells = [F.col(f"`{name}`").cast("string") for name in dict.fromkeys(found)]
    return F.coalesce(*cells) if cells else F.lit(None).cast("string")


def first_overlapping(names: Sequence[str], *candidates: str) -> str | None:
    """First column whose key form contains a candidate's, or is contained in it."""
    wanted = [key_name(candidate) for candidate in candidates if candidate]
    for name in names:
        key = key_name(name)
        if any(word in key or key in word for word in wanted):
            return name
    return None


def resolved(name: str | None, type_name: str = "string") -> Column:
    """Column of a resolved name, NULL when nothing was found."""
    return F.col(f"`{name}`") if name else F.lit(None).cast(type_name)


def truthy(*columns: Column) -> Column:
    """First value that is neither NULL nor empty text."""
    return F.coalesce(*[F.nullif(column, F.lit("")) for column in columns])


def truthy_number(*columns: Column) -> Column:
    """First value that is neither NULL nor zero."""
    return F.coalesce(*[F.nullif(column, F.lit(0.0)) for column in columns])


def first_filled(*columns: Column) -> Column:
    """First value with something other than blanks; the text is kept as written."""
    return F.coalesce(*[blank_to_null(column) for column in columns])


def first_column_with_values(df: DataFrame, *names: str) -> Column:
    """The first of the columns that holds any value at all, for the whole frame.

    Not a row-level fallback. Presence is a scalar subquery over one column that stops at the
    first value of each task.
    """
    chosen = None
    present = [name for name in names if name in df.columns]
    if not present:
        return F.lit(None).cast("string")
    for name in present[:-1]:
        filled = df.where(F.col(name).isNotNull()).select(F.lit(1).alias("one")).limit(1)
        any_value = filled.agg(F.count("one")).scalar() > 0
        chosen = F.when(any_value, F.col(name)) if chosen is None else chosen.when(any_value, F.col(name))
    last = F.col(present[-1])
    return last if chosen is None else chosen.otherwise(last)


def raw_payload(df: DataFrame) -> Column:
    """The whole row as JSON text, NULLs kept."""
    return F.to_json(F.struct(*[F.col(f"`{name}`") for name in df.columns]), {"ignoreNullFields": "false"})


def with_payload_maps(df: DataFrame, payload: str) -> DataFrame:
    """Add the maps of a record kept as JSON text and of the record nested in its own
    ``payload_bruto``, each also by key form. As columns they are parsed and cleaned once per
    row; values are trimmed, unusable ones left out."""
    raw = F.col(payload) if payload in df.columns else F.lit(None).cast("string")

    def usable(name: str) -> Column:
        trimmed = F.transform_values(name, lambda _, value: strip(value))
        return F.map_filter(trimmed, lambda _, value: ~value.isin("", "nan", "None", "NaT"))

    def by_form(name: str) -> Column:
        return F.transform_keys(name, lambda key, _: key_form(key))

    outer = df.withColumn("__parsed", F.from_json(raw, _STRING_MAP)).withColumn("__outer", usable("__parsed"))
    nested = F.try_element_at("__parsed", F.lit("payload_bruto"))
    inner = outer.withColumn("__nested", F.from_json(nested, _STRING_MAP)).withColumn("__inner", usable("__nested"))
    return inner.withColumns({"__outer_keys": by_form("__outer"), "__inner_keys": by_form("__inner")}).drop(
        "__parsed", "__nested"
    )


def payload_value(*keys: str) -> Column:
    """First filled value under one of the keys: outer record first, exact spelling first.

    For frames from ``with_payload_maps``.
    """
    values = []
    for level in ("outer", "inner"):
        values += [F.try_element_at(f"__{level}", F.lit(key)) for key in keys]
        values += [F.try_element_at(f"__{level}_keys", F.lit(form)) for form in dict.fromkeys(map(key_name, keys))]
    return F.coalesce(*values)
