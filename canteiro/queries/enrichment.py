"""Lookups that enrich works, and federal dumps cut to the works' agreements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.plans import works
from canteiro.queries.registry import Tables, as_of, day, query
from canteiro.sources import federal, geography

_AGREEMENTS_SQL = """
WITH a AS (
  SELECT CAST(c_custkey AS VARCHAR) AS nr, c_acctbal AS va, CAST(c_nationkey AS BIGINT) AS qa,
         c_mktsegment = 'BUILDING' AS quitado, c_mktsegment = 'MACHINERY' AS anulado,
         TIMESTAMP '1996-01-01' + to_days(CAST(c_custkey % 2000 AS INTEGER)) AS fim,
         TIMESTAMP '1995-06-01' + to_days(CAST(c_custkey % 900 AS INTEGER)) AS orig FROM customer),
w AS (
  SELECT o_orderkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS VARCHAR) END AS nr,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS va, CASE WHEN o_orderstatus = 'P' THEN o_orderdate END AS fim,
         o_orderdate AS prazo FROM orders)
"""


def _agreements(t: Tables) -> DataFrame:
    """Customers as agreements: value, count, status, end and original end of the period."""
    return t.customer.selectExpr(
        "cast(c_custkey as string) as nr_convenio", "c_acctbal as valor_aditivos", "cast(c_nationkey as bigint) as qtd_aditivos",
        "case c_mktsegment when 'BUILDING' then 'Prestação de Contas Aprovada' when 'MACHINERY' then 'Anulado' else 'Em execução' end as situacao",
        "cast(date_add(date'1996-01-01', cast(c_custkey % 2000 as int)) as timestamp) as data_fim_vigencia",
        "cast(date_add(date'1995-06-01', cast(c_custkey % 900 as int)) as timestamp) as data_fim_vigencia_original",
    )


def _works(t: Tables) -> DataFrame:
    """Orders as works; a fifth has no agreement number, which is the hot NULL key."""
    return t.orders.selectExpr(
        "o_orderkey", "case when o_orderpriority <> '1-URGENT' then cast(o_custkey as string) end as num_licitacao",
        "case when o_orderstatus = 'F' then o_totalprice end as valor_aditivos", "cast(null as bigint) as qtd_aditivos",
        "cast(case when o_orderstatus = 'P' then o_orderdate end as timestamp) as data_conclusao",
        "cast(o_orderdate as timestamp) as data_prevista_fim",
    )


@query(
    _AGREEMENTS_SQL
    + """
SELECT o_orderkey, coalesce(w.va, a.va) AS valor_aditivos, a.qa AS qtd_aditivos,
  strftime(coalesce(w.fim, CASE WHEN quitado THEN a.fim END), '%Y-%m-%d') AS data_conclusao,
  strftime(CASE WHEN quitado THEN a.orig ELSE w.prazo END, '%Y-%m-%d') AS data_prevista_fim
FROM w LEFT JOIN a ON w.nr = a.nr
"""
)
def federal_amendments(t: Tables) -> DataFrame:
    enriched = works.with_federal_amendments(_works(t), _agreements(t))
    return enriched.select(
        "o_orderkey", "valor_aditivos", "qtd_aditivos", day("data_conclusao").alias("data_conclusao"),
        day("data_prevista_fim").alias("data_prevista_fim"),
    )


@query(
    _AGREEMENTS_SQL
    + """
SELECT o_orderkey, strftime(CASE WHEN NOT anulado AND a.fim <= TIMESTAMP '2000-01-01' THEN a.fim
  ELSE coalesce(w.fim, CASE WHEN quitado THEN a.fim END) END, '%Y-%m-%d') AS data_conclusao
FROM w LEFT JOIN a ON w.nr = a.nr
"""
)
def enrich_precedence(t: Tables) -> DataFrame:
    """The published completion date overrides the stand-in unless future or cancelled."""
    agreements = _agreements(t)
    stand_in = works.with_federal_amendments(_works(t), agreements)
    published = agreements.withColumnRenamed("data_fim_vigencia", "data_conclusao")
    final = works.with_actual_completion(stand_in, published, as_of())
    return final.select("o_orderkey", day("data_conclusao").alias("data_conclusao"))


@query(
    """
WITH w AS (
  SELECT c_custkey, c_nationkey, CASE WHEN c_custkey % 2 = 0 THEN 'Rua ' || c_custkey % 40 END AS rua, c_mktsegment AS bairro FROM customer),
q AS (SELECT c_custkey, rua, CASE WHEN c_nationkey = 0 THEN 1.5 END AS tem, try_cast(replace(rua, 'Rua ', '') AS INTEGER) AS n,
        CASE bairro WHEN 'BUILDING' THEN -22.2 WHEN 'MACHINERY' THEN -22.4 END AS b FROM w),
r AS (SELECT s_suppkey, CASE WHEN s_nationkey > 12 THEN -22.1 - CAST(s_suppkey AS DOUBLE) / 100 END AS lat FROM supplier WHERE s_suppkey < 40)
SELECT c_custkey, CAST(CASE WHEN tem IS NOT NULL THEN 1.5 ELSE coalesce(lat, b) END AS DOUBLE) AS latitude,
       CAST(CASE WHEN tem IS NOT NULL THEN 2.5 WHEN lat IS NOT NULL THEN -41.7 WHEN b IS NOT NULL THEN -41.8 END AS DOUBLE) AS longitude
FROM q LEFT JOIN r ON s_suppkey = n
"""
)
def gazetteer_lookup(t: Tables) -> DataFrame:
    """Points for works that have a place only: full address, then district, negatives skipped."""
    placed = t.customer.selectExpr(
        "c_custkey", "case when c_custkey % 2 = 0 then concat('Rua ', c_custkey % 40) end as endereco", "c_mktsegment as bairro",
        "case when c_nationkey = 0 then 1.5D end as latitude", "case when c_nationkey = 0 then 2.5D end as longitude",
    )
    segments = t.customer.select("c_mktsegment").distinct()
    asked = t.customer.selectExpr("c_custkey % 40 as numero", "c_mktsegment").distinct()
    streets = asked.join(t.supplier, F.col("numero") == F.col("s_suppkey")).selectExpr(
        "concat('Rua ', s_suppkey, ', ', c_mktsegment, ', Macaé, RJ, Brasil') as consulta",
        "case when s_nationkey > 12 then -22.1D - cast(s_suppkey as double) / 100 else 10.0D end as latitude",
        "-41.7D as longitude",
    )
    districts = segments.selectExpr(
        "concat(c_mktsegment, ', Macaé, RJ, Brasil') as consulta",
        "case c_mktsegment when 'BUILDING' then -22.2D when 'MACHINERY' then -22.4D end as latitude", "-41.8D as longitude",
    )
    return works.with_gazetteer(placed, streets.unionByName(districts)).select("c_custkey", "latitude", "longitude")


@query(
    """
WITH k AS (SELECT CAST(c_custkey AS VARCHAR) AS nr FROM customer WHERE c_mktsegment = 'BUILDING'),
a AS (
  SELECT o_custkey, arg_max(o_orderkey, o_orderkey) AS ok, arg_max(o_totalprice, o_orderkey) AS vg, arg_max(o_orderstatus, o_orderkey) AS st,
         arg_max(o_orderdate, o_orderkey) AS d FROM orders GROUP BY o_custkey),
v AS (
  SELECT o_custkey, CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS DECIMAL(38,2))) AS DOUBLE) AS valor
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_custkey)
SELECT CAST(a.o_custkey AS VARCHAR) AS nr_convenio, CAST(ok AS VARCHAR) AS id_proposta, vg AS valor_global,
  CASE WHEN st = 'F' THEN 0 ELSE a.o_custkey % 7 END AS qtd_aditivos, st AS situacao, strftime(d, '%Y-%m-%d') AS fim, valor AS valor_aditivos
FROM a JOIN k ON k.nr = CAST(a.o_custkey AS VARCHAR) LEFT JOIN v ON v.o_custkey = a.o_custkey
"""
)
def dump_amendments(t: Tables) -> DataFrame:
    """National dump texts cut to the wanted agreements, with the total of their terms."""
    wanted = federal.agreement_numbers(
        t.customer.where("c_mktsegment = 'BUILDING'").selectExpr("concat(' ', c_custkey, ' ') as num_licitacao")
    )
    listed = t.orders.selectExpr(
        "concat(o_custkey, ' ') as NR_CONVENIO", "concat(' ', o_orderkey) as ID_PROPOSTA",
        "replace(cast(cast(o_totalprice as decimal(18,2)) as string), '.', ',') as VL_GLOBAL_CONV", "o_orderstatus as SIT_CONVENIO",
        "date_format(o_orderdate, 'dd/MM/yyyy') as DIA_FIM_VIGENC_CONV", "'' as DIA_FIM_VIGENC_ORIGINAL_CONV",
        "case when o_orderstatus = 'F' then 'x' else cast(o_custkey % 7 as string) end as QTD_TA", "o_orderkey as _row",
    )
    terms = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).selectExpr(
        "cast(o_custkey as string) as NR_CONVENIO",
        "case when l_returnflag = 'R' then ' ' else replace(cast(cast(l_extendedprice as decimal(18,2)) as string), '.', ',') end as VL_GLOBAL_TA",
    )
    rows = federal.dump_amendments(listed, terms, wanted, as_of())
    return rows.select(
        "nr_convenio", "id_proposta", "valor_global", "qtd_aditivos", "situacao", day("data_fim_vigencia").alias("fim"), "valor_aditivos"
    )


@query(
    """
WITH s AS (SELECT c_nationkey AS k, c_custkey, c_acctbal, CASE c_mktsegment WHEN 'BUILDING' THEN 93 WHEN 'MACHINERY' THEN 6318 WHEN 'FURNITURE' THEN 37 ELSE 1 END AS v FROM customer),
p AS (
  SELECT k, arg_min(c_custkey, c_custkey) FILTER (WHERE v = 93) AS pop, arg_min(c_acctbal, c_custkey) FILTER (WHERE v = 6318) AS area,
         arg_min(c_custkey, c_custkey) FILTER (WHERE v = 37) AS pib FROM s GROUP BY k)
SELECT CAST(n_nationkey AS VARCHAR) AS municipio_id, n_name AS municipio_nome, r_name AS uf_nome, pop AS populacao_censo_2022,
       area AS area_territorial_km2, CAST(NULL AS DOUBLE) AS pib_per_capita
FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN p ON k = n_nationkey
"""
)
def municipality_profiles(t: Tables) -> DataFrame:
    """Nested place records and a flat list of statistics as one row per place."""
    nested = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).selectExpr(
        "cast(n_nationkey as string) as id", "n_name as nome",
        "named_struct('id', 'm', 'nome', 'micro', 'mesorregiao', named_struct('id', 'x', 'nome', 'meso', 'UF', "
        "named_struct('id', cast(r_regionkey as string), 'sigla', substring(r_name, 1, 2), 'nome', r_name))) as microrregiao",
        "named_struct('id', '1', 'nome', 'imediata', 'regiao-intermediaria', named_struct('id', '2', 'nome', 'inter')) as `regiao-imediata`",
    )
    number = F.expr("case c_mktsegment when 'BUILDING' then 93 when 'MACHINERY' then 6318 when 'FURNITURE' then 37 else 1 end")
    value = F.expr(
        "case c_mktsegment when 'BUILDING' then concat(c_custkey, ',7') when 'MACHINERY' then "
        "replace(cast(cast(c_acctbal as decimal(18,2)) as string), '.', ',') else '...' end"
    )
    statistics = t.customer.select(
        F.col("c_nationkey").cast("string").alias("municipio_id"), number.alias("variavel"), value.alias("valor"), "c_custkey"
    )
    rows = geography.profiles(geography.places(nested), statistics, as_of(), "c_custkey")
    return rows.select(
        "municipio_id", "municipio_nome", "uf_nome", "populacao_censo_2022", "area_territorial_km2", "pib_per_capita"
    )
