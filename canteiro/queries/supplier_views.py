"""Supplier metrics over customers' orders and suppliers' lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.operators.aggregates import latest_value, supplier_profile as profile_of
from canteiro.plans.suppliers import suppliers
from canteiro.queries.registry import Tables, day, query

_SUPPLIERS_SQL = """
WITH c AS (
  SELECT trim(CAST(o_custkey AS VARCHAR)) AS cnpj, c_name || ' ' || o_orderpriority AS nome, o_totalprice AS valor,
         o_orderdate AS d, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '5-LOW' THEN 1 ELSE 0 END AS adit
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderpriority <> '3-MEDIUM')
SELECT cnpj,
       CASE WHEN max(d) IS NULL THEN 'Fornecedor ' || cnpj ELSE arg_max(nome, strftime(d, '%Y%m%d') || nome) END AS razao_social,
       count(*) AS total_contratos,
       CAST(sum(CAST(valor AS DECIMAL(38,2))) AS DOUBLE) AS valor_total,
       strftime(min(d), '%Y-%m-%d') AS primeiro_contrato,
       strftime(max(d), '%Y-%m-%d') AS ultimo_contrato,
       count(DISTINCT year(d)) AS anos_atuacao,
       round_even(CAST(sum(adit) AS DOUBLE) / count(*) * 100, 2) AS taxa_aditivo
FROM c GROUP BY cnpj
"""


def orders_as_contracts(t: Tables) -> DataFrame:
    """Orders in the columns of the raw contract table; the supplier is the customer."""
    return t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).selectExpr(
        "cast(o_orderkey as string) as id_contrato",
        "case when o_orderpriority <> '3-MEDIUM' then concat(' ', o_custkey, ' ') else ' ' end as cnpj_fornecedor",
        "concat(c_name, ' ', o_orderpriority) as nome_fornecedor",
        "o_totalprice as valor_inicial",
        "o_orderdate as data_assinatura",
        "case o_orderpriority when '1-URGENT' then '1º Aditivo' when '5-LOW' then ' Sim ' when '2-HIGH' then null "
        "else 'Contrato Original' end as possui_aditivo",
    )


@query(_SUPPLIERS_SQL)
def supplier_metrics(t: Tables) -> DataFrame:
    result = suppliers(orders_as_contracts(t))
    return result.withColumns(
        {"primeiro_contrato": day("primeiro_contrato"), "ultimo_contrato": day("ultimo_contrato")}
    )


@query(
    """
SELECT user_id, arg_max(event_type, strftime(ts, '%Y%m%d%H%M%S%f') || lpad(CAST(event_id AS VARCHAR), 15, '0')) AS ultimo_tipo
FROM events GROUP BY user_id
"""
)
def latest_name(t: Tables) -> DataFrame:
    return latest_value(t.events, "user_id", "event_type", ["ts", "event_id"], "ultimo_tipo")


@query(
    """
SELECT CAST(l_suppkey AS VARCHAR) AS cnpj_fornecedor,
       arg_min(l_returnflag || l_linestatus, CAST(year(l_shipdate) AS VARCHAR) || l_returnflag || l_linestatus) AS nome_fornecedor,
       count(*) FILTER (WHERE l_quantity > 5) AS total_contratos,
       CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(38,2))) FILTER (WHERE l_quantity > 5), 0) AS DOUBLE) AS valor_total,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(38,2))) FILTER (WHERE l_quantity > 5) AS DOUBLE)
         / count(*) FILTER (WHERE l_quantity > 5) AS valor_medio,
       count(DISTINCT year(l_shipdate)) AS anos_atuacao,
       min(year(l_shipdate)) AS primeiro_ano, max(year(l_shipdate)) AS ultimo_ano,
       CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) / count(*) FILTER (WHERE l_returnflag IN ('A', 'N')) AS taxa_aditivo
FROM lineitem WHERE l_suppkey <> 0 GROUP BY l_suppkey
"""
)
def supplier_profile(t: Tables) -> DataFrame:
    lines = t.lineitem.selectExpr(
        "case when l_suppkey <> 0 then cast(l_suppkey as string) else '' end as cnpj_fornecedor",
        "concat(l_returnflag, l_linestatus) as nome_fornecedor",
        "case when l_quantity > 5 then l_extendedprice end as valor_contrato",
        "case l_returnflag when 'A' then 'Sim' when 'N' then 'não' end as possui_aditivo",
        "cast(year(l_shipdate) as bigint) as ano",
    )
    return profile_of(lines)
