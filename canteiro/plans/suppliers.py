"""Suppliers: one row per tax number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.text import is_blank, strip
from canteiro.operators.aggregates import supplier_metrics
from canteiro.operators.fields import field


def amended_flag(contracts: DataFrame, parity: bool = False) -> Column | None:
    """Whether a contract was amended.

    With the published flag present, ``sim`` counts; so does a text naming an amendment, which
    is what the portal publishes, unless it denies one or ``parity`` is asked for. Without the
    flag the count decides.
    """
    if "possui_aditivo" in contracts.columns:
        flag = strip(F.lower(F.col("possui_aditivo")))
        said = flag == "sim"
        names_one = flag.contains("aditivo") & ~flag.rlike(vocab.DENIED_AMENDMENT)
        return F.coalesce(said if parity else said | names_one, F.lit(False))
    if "qtd_aditivos" in contracts.columns:
        return F.coalesce(F.col("qtd_aditivos").try_cast("double") > 0, F.lit(False))
    return None


def suppliers(contracts: DataFrame, parity: bool = False) -> DataFrame:
    """Metrics and latest name per supplier; a supplier without a name is named by its number."""
    known = contracts.where(~is_blank("cnpj_fornecedor"))
    rows = known.select(
        strip("cnpj_fornecedor").alias("cnpj_fornecedor"),
        field(known, "nome_fornecedor").alias("nome_fornecedor"),
        field(known, "valor_inicial", "double").try_cast("double").alias("valor_inicial"),
        field(known, "data_assinatura", "timestamp").cast("timestamp").alias("data_assinatura"),
        *[F.col(name) for name in ("possui_aditivo", "qtd_aditivos") if name in known.columns],
    )
    metrics = supplier_metrics(rows, amended_flag(rows, parity))
    fallback = F.concat(F.lit("Fornecedor "), F.col("cnpj"))
    return metrics.withColumn(
        "razao_social", F.when(is_blank("razao_social"), fallback).otherwise(F.col("razao_social"))
    ).select(
        "cnpj", "razao_social", "total_contratos", "valor_total", "primeiro_contrato",
        "ultimo_contrato", "anos_atuacao", "taxa_aditivo",
    )
