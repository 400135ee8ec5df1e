"""Contracts linked to works and suppliers, and their amendments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.ids import surrogate_key
from canteiro.functions.status import contract_status
from canteiro.functions.text import strip
from canteiro.operators.dedup import keep_last
from canteiro.operators.fields import field, first_filled
from canteiro.operators.joins import attach, match_or_reject


def contracts(
    raw: DataFrame,
    works: DataFrame,
    suppliers: DataFrame,
    as_of: Column,
    order: Sequence[str] = ("id_contrato",),
) -> tuple[DataFrame, DataFrame]:
    """Contracts that have a work, and the ones without.

    The number is the tender number when filled, else the contract id; the contract id stays
    available as ``id_contrato_origem``. Of several contracts with one number the last by
    ``order`` is kept. The supplier is optional.
    """
    linked = works.select(
        F.col("id").alias("id_obra"), F.col("id_origem").alias("_work"), F.col("fonte_origem").alias("_source")
    )
    typed = raw.withColumn("id_contrato", F.col("id_contrato").cast("string"))
    matched, rejected = match_or_reject(typed, linked, ["id_contrato", "fonte"], ["_work", "_source"])
    keyed = matched.withColumn("_cnpj", strip(field(matched, "cnpj_fornecedor")))
    known = suppliers.select("cnpj", surrogate_key("cnpj").alias("id_fornecedor"))
    supplied = attach(keyed, known, "_cnpj", "cnpj", {"id_fornecedor": "id_fornecedor"})
    end = field(raw, "data_fim_vigencia", "timestamp").cast("timestamp")
    rows = supplied.select(
        "id_obra",
        "id_fornecedor",
        first_filled(field(raw, "num_licitacao"), F.col("id_contrato")).alias("numero"),
        F.col("id_contrato").alias("id_contrato_origem"),
        field(raw, "objeto").alias("objeto"),
        field(raw, "modalidade").alias("modalidade"),
        contract_status(field(raw, "situacao"), end, as_of).alias("situacao"),
        *[
            field(raw, name, "double").try_cast("double").alias(name)
            for name in ("valor_inicial", "valor_global", "valor_aditivos")
        ],
        field(raw, "data_assinatura", "timestamp").cast("timestamp").alias("data_assinatura"),
        field(raw, "data_inicio_vigencia", "timestamp").cast("timestamp").alias("data_inicio"),
        end.alias("data_fim"),
        F.coalesce(field(raw, "qtd_aditivos").try_cast("double"), F.lit(0.0)).alias("qtd_aditivos"),
        F.col("fonte").alias("fonte_origem"),
        *[F.col(name).alias(f"__order_{i}") for i, name in enumerate(order)],
    )
    order_columns = [f"__order_{i}" for i in range(len(order))]
    latest = keep_last(rows, ["numero", "fonte_origem"], order_columns).drop(*order_columns)
    return latest.withColumn("id", surrogate_key("numero", "fonte_origem")), rejected


def amendments(
    raw: DataFrame, contracts_df: DataFrame, parity: bool = False
) -> tuple[DataFrame, DataFrame]:
    """One consolidated amendment per contract with a positive amendment value, and the rows
    whose contract is unknown.

    Contracts are found by their own id. With ``parity`` they are found by their number, which
    misses those known by a tender number.
    """
    value = F.coalesce(field(raw, "valor_aditivos", "double").try_cast("double"), F.lit(0.0))
    positive = raw.withColumn("_value", value).where(F.col("_value") > 0)
    positive = positive.withColumn("id_contrato", F.col("id_contrato").cast("string"))
    key = "numero" if parity else "id_contrato_origem"
    targets = contracts_df.select(
        F.col("id").alias("_contract"), F.col(key).alias("_number"), F.col("fonte_origem").alias("_source")
    )
    matched, rejected = match_or_reject(positive, targets, ["id_contrato", "fonte"], ["_number", "_source"])
    rows = matched.select(
        F.col("_contract").alias("id_contrato"),
        F.lit("Consolidado").alias("tipo"),
        F.lit("Aditivo(s) registrado(s) na fonte original").alias("motivo"),
        F.col("_value").alias("valor"),
        F.lit(None).cast("int").alias("prazo_dias"),
        F.lit(None).cast("date").alias("data_assinatura"),
    )
    return rows, rejected.drop("_value")
