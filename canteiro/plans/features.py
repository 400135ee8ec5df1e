"""Feature table: one row per work, NULL wherever something is unknown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.dates import days_between
from canteiro.sources.costs import cost_category, reference_cost


def contract_counts(contracts: DataFrame) -> DataFrame:
    """Contracts, amendments and suppliers per work, summed before any join."""
    return contracts.groupBy("id_obra").agg(
        F.count("*").alias("n_contratos"),
        F.sum("qtd_aditivos").cast("bigint").alias("n_aditivos"),
        F.countDistinct("id_fornecedor").alias("n_fornecedores"),
    )


def features(
    works: DataFrame, contracts: DataFrame, as_of: Column, population: Column | None = None
) -> DataFrame:
    """Money, schedule and contracting features, and the reference cost of the work's type.

    ``population`` is the municipality's, when known. Zero never stands for an unknown value.
    """
    total = F.col("valor_contrato") + F.coalesce("valor_aditivos", F.lit(0.0))
    ratio = F.bround(F.col("valor_aditivos") / F.nullif("valor_contrato", F.lit(0.0)) * 100, 4)
    per_head = (
        F.lit(None).cast("double")
        if population is None
        else F.bround(total / F.nullif(population.cast("double"), F.lit(0.0)), 4)
    )
    counts = contract_counts(contracts).withColumnRenamed("id_obra", "_work")
    joined = works.join(counts, works["id"] == counts["_work"], "left")
    unknown = F.lit(None)
    return joined.select(
        F.col("id").alias("id_obra"),
        as_of.cast("timestamp").alias("calculado_em"),
        "situacao",
        "tipo",
        "municipio",
        "uf",
        "percentual_executado",
        "valor_contrato",
        "valor_aditivos",
        total.alias("valor_total"),
        ratio.alias("percentual_aditivo"),
        unknown.cast("double").alias("area_m2"),
        unknown.cast("double").alias("custo_m2"),
        per_head.alias("valor_por_habitante"),
        days_between("data_prevista_fim", "data_inicio").alias("duracao_prevista_dias"),
        days_between("data_conclusao", "data_inicio").alias("duracao_real_dias"),
        F.col("dias_atraso").alias("atraso_dias"),
        (F.col("dias_atraso") > 0).alias("flag_atrasada"),
        "n_contratos",
        "n_aditivos",
        "n_fornecedores",
        F.when(F.col("n_fornecedores") >= 1, F.col("n_fornecedores") == 1).alias("flag_fornecedor_unico"),
        cost_category("tipo").alias("categoria_custo"),
        reference_cost(cost_category("tipo")).alias("custo_m2_referencia"),
    )
