"""Grouped metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.numbers import exact_sum
from canteiro.operators.dedup import keep_first


def latest_value(df: DataFrame, key: str, value: str, order: Sequence[str], name: str) -> DataFrame:
    """Last non-null value per key in the given order; NULL order values count as earliest.

    A key without a value gives NULL. One row per key and task is sent, and no task sorts by text.
    """
    rows = df.select(key, value, *order)
    latest = [F.col(value).isNull(), *[F.col(column).desc_nulls_last() for column in order]]
    return keep_first(rows, [key], latest).select(key, F.col(value).alias(name))


def supplier_metrics(contracts: DataFrame, amended: Column | None) -> DataFrame:
    """Contract count, value, dates, years and latest name per supplier.

    Two steps: rows are first summed per (supplier, name, year), which runs as a hash aggregate
    with map-side combine, so a supplier with a third of all contracts leaves each task as a
    handful of rows; the second step sees only those. Among names with the same latest date the
    alphabetically last is taken.
    """
    rows = contracts.select(
        F.col("cnpj_fornecedor").alias("cnpj"),
        F.col("nome_fornecedor").alias("nome"),
        F.year("data_assinatura").alias("ano"),
        F.col("data_assinatura").alias("data"),
        F.col("valor_inicial").cast("decimal(38,2)").alias("valor"),
        (F.when(amended, 1).otherwise(0) if amended is not None else F.lit(None).cast("int")).alias("com_aditivo"),
    )
    by_name_and_year = rows.groupBy("cnpj", "nome", "ano").agg(
        F.count("*").alias("n"),
        F.sum("valor").alias("valor"),
        F.min("data").alias("primeira"),
        F.max("data").alias("ultima"),
        F.sum("com_aditivo").alias("com_aditivo"),
    )
    name_order = F.when(F.col("nome").isNotNull(), F.struct("ultima", "nome"))
    return by_name_and_year.groupBy("cnpj").agg(
        F.max_by("nome", name_order).alias("razao_social"),
        F.sum("n").alias("total_contratos"),
        F.coalesce(F.sum("valor"), F.lit(0)).cast("double").alias("valor_total"),
        F.min("primeira").alias("primeiro_contrato"),
        F.max("ultima").alias("ultimo_contrato"),
        F.size(F.collect_set("ano")).cast("bigint").alias("anos_atuacao"),
        F.bround(F.sum("com_aditivo") / F.sum("n") * 100, 2).alias("taxa_aditivo"),
    )


def supplier_profile(contracts: DataFrame) -> DataFrame:
    """Historical profile per supplier.

    Values are counted, summed and averaged over contracts with a value; the amended share is
    over contracts whose flag is known. The name is the one of the earliest year, of several the
    alphabetically first. Two steps as in ``supplier_metrics``, for the same reason.
    """
    flag = F.lower(F.col("possui_aditivo"))
    amended = F.when(flag.isin("sim", "true", "1", "s"), 1).when(flag.isNotNull(), 0)
    known = F.col("cnpj_fornecedor").isNotNull() & (F.col("cnpj_fornecedor") != "")
    by_name_and_year = (
        contracts.where(known)
        .withColumn("com_aditivo", amended)
        .groupBy("cnpj_fornecedor", "nome_fornecedor", "ano")
        .agg(
            F.count("valor_contrato").alias("n"),
            F.sum(F.col("valor_contrato").cast("decimal(38,2)")).alias("valor"),
            F.sum("com_aditivo").alias("com_aditivo"),
            F.count("com_aditivo").alias("com_marca"),
        )
    )
    total = F.sum("valor")
    name_order = F.when(F.col("nome_fornecedor").isNotNull(), F.struct("ano", "nome_fornecedor"))
    return by_name_and_year.groupBy("cnpj_fornecedor").agg(
        F.min_by("nome_fornecedor", name_order).alias("nome_fornecedor"),
        F.sum("n").alias("total_contratos"),
        F.coalesce(total, F.lit(0)).cast("double").alias("valor_total"),
        (total.cast("double") / F.nullif(F.sum("n"), F.lit(0))).alias("valor_medio"),
        F.size(F.collect_set("ano")).cast("bigint").alias("anos_atuacao"),
        F.min("ano").alias("primeiro_ano"),
        F.max("ano").alias("ultimo_ano"),
        (F.sum("com_aditivo") / F.nullif(F.sum("com_marca"), F.lit(0))).alias("taxa_aditivo"),
    )


def amendment_totals(lines: DataFrame, key: str, value: str) -> DataFrame:
    """Sum per agreement; an unreadable value counts as 0, so term-only amendments give 0."""
    return lines.groupBy(key).agg(exact_sum(F.coalesce(F.col(value), F.lit(0.0))).alias("valor_aditivos"))


def statistics_row(
    statistics: DataFrame, key: str, variable: str, value: str, order: str, wanted: Mapping[int, str]
) -> DataFrame:
    """One row per place, one column per wanted statistic: its first value in the given order."""

    def first_of(number: int) -> Column:
        return F.min_by(value, F.when(F.col(variable) == number, F.col(order)))

    return statistics.where(F.col(variable).isin(*wanted)).groupBy(key).agg(
        *[first_of(number).alias(name) for number, name in wanted.items()]
    )
