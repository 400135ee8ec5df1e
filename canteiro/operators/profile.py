"""Counts, coverage and distribution reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.text import is_blank


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table."""
    counts = [
        df.agg(F.count("*").alias("registros")).select(F.lit(name).alias("tabela"), "registros")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def exact_mean(value: str, digits: int) -> Column:
    """Mean of values with two decimals, rounded half up, free of row order."""
    total = F.sum(F.col(value).cast("decimal(38,2)")).cast("double")
    return F.round(total / F.nullif(F.count(value), F.lit(0)), digits)


def coverage(
    df: DataFrame,
    by: Sequence[str],
    checks: Mapping[str, Column],
    means: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per group: rows, rows meeting each check, and means to one decimal."""
    aggregates = [F.count("*").alias("total")]
    aggregates += [F.count_if(check).alias(name) for name, check in checks.items()]
    aggregates += [exact_mean(column, 1).alias(name) for name, column in (means or {}).items()]
    return df.groupBy(*by).agg(*aggregates)


def null_checks(**columns: str) -> dict[str, Column]:
    """Named checks that a column is NULL."""
    return {name: F.col(column).isNull() for name, column in columns.items()}


def null_or_empty(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def distribution(df: DataFrame, by: str, means: Mapping[str, str] | None = None) -> DataFrame:
    """Rows and share of the total per value.

    The total is a scalar subquery, not a window over all groups, so an open set of values never
    meets in one task.
    """
    groups = df.groupBy(by).agg(
        F.count("*").alias("qtd"),
        *[exact_mean(column, 1).alias(name) for name, column in (means or {}).items()],
    )
    total = df.agg(F.count("*")).scalar()
    share = F.round(F.col("qtd") * F.lit(100.0) / total, 1)
    return groups.withColumn("pct", share)


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Non-null cells of each column, one row per column."""
    one = df.agg(*[F.count(name).alias(name) for name in columns])
    return one.unpivot([], list(columns), "campo", "preenchidos")


def text_profile(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = (),
    packed: Mapping[str, str] | None = None,
    min_bytes: int = vocab.PACKED_TEXT_MIN_BYTES,
) -> DataFrame:
    """Bytes of texts long enough to pack, and the saving when packed sizes are supplied.

    ``packed`` maps a text column to the column with its packed size in bytes.
    """
    aggregates = []
    for name in columns:
        size = F.octet_length(name)
        eligible = ~is_blank(name) & (size >= min_bytes)
        before = F.sum(F.when(eligible, size))
        aggregates += [
            F.count_if(eligible).alias(f"{name}_textos"),
            before.alias(f"{name}_bytes"),
        ]
        if packed and name in packed:
            after = F.sum(F.when(eligible, F.col(packed[name])))
            aggregates.append(((1 - after / before) * 100).alias(f"{name}_economia_pct"))
    return df.groupBy(*by).agg(*aggregates) if by else df.agg(*aggregates)


def run_summary(runs: DataFrame) -> DataFrame:
    """Datasets and rows of the run log by outcome."""
    return runs.agg(
        F.count("*").alias("datasets"),
        F.coalesce(F.sum("qtd_registros"), F.lit(0)).alias("registros"),
        F.count_if(F.col("status") == "ok").alias("ok"),
        F.count_if(F.col("status") == "erro").alias("falhas"),
        F.count_if(F.col("status") == "ignorado").alias("ignorados"),
    )


@dataclass(frozen=True)
class Section:
    """A part of a report: groups of rows, and what is measured of each group."""

    name: str
    by: tuple[str, ...]
    measures: Mapping[str, Column]
    # name of a measure with the share of all rows in percent
    share: str | None = None


NO_VALUE = "(nulo)"


def report_sections(df: DataFrame, sections: Sequence[Section]) -> DataFrame:
    """secao, grupo, medida, valor of all sections, from one pass over the rows with a grouping set for each.

    A group is named by its values, NULL as ``(nulo)``. A share is taken of the total, which is the set without columns
    of the same aggregate, so the rows are not read again for it.
    """
    columns = list(dict.fromkeys(name for section in sections for name in section.by))
    sets = [list(by) for by in dict.fromkeys([*(section.by for section in sections), ()])]
    measures = {(section.name, name): f"m{i}_{j}" for i, section in enumerate(sections) for j, name in enumerate(section.measures)}
    aggregates = [section.measures[name].cast("double").alias(measures[section.name, name]) for section in sections for name in section.measures]
    counted = [F.count("*").cast("double").alias("__rows"), *aggregates]
    if columns:
        grouped = df.groupingSets([[F.col(c) for c in by] for by in sets], *[F.col(c) for c in columns])
        groups = grouped.agg(F.grouping_id().alias("__set"), *counted)
    else:
        groups = df.agg(F.lit(0).alias("__set"), *counted)

    def number(by: Sequence[str]) -> int:
        """What ``grouping_id`` gives: a bit for each column that is left out."""
        return sum(1 << place for place, name in enumerate(reversed(columns)) if name not in by)

    total = groups.where(F.col("__set") == number(())).agg(F.max("__rows")).scalar()
    lines = []
    for section in sections:
        cells = [(name, F.col(measures[section.name, name])) for name in section.measures]
        if section.share:
            cells.append((section.share, F.round(F.col("__rows") * 100.0 / total, 1)))
        group = F.concat_ws(" / ", *[F.coalesce(F.col(c).cast("string"), F.lit(NO_VALUE)) for c in section.by])
        made = F.array(*[F.struct(F.lit(section.name).alias("secao"), group.alias("grupo"), F.lit(n).alias("medida"), v.alias("valor")) for n, v in cells])
        lines.append(F.when(F.col("__set") == number(section.by), made).otherwise(F.array().cast(_LINES)))
    return groups.select(F.explode(F.concat(*lines)).alias("line")).select("line.*")


_LINES = "array<struct<secao: string, grupo: string, medida: string, valor: double>>"


def largest_first(df: DataFrame, column: str, *then: str) -> DataFrame:
    return df.orderBy(F.col(column).desc(), *then)


def sample_keys(rejected: DataFrame, key: str, limit: int = 20) -> DataFrame:
    """The first keys of a reject set, for a log line."""
    return rejected.where(F.col(key).isNotNull()).orderBy(key).select(key).limit(limit)
