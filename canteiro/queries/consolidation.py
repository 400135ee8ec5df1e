"""The structured tables over raw tables that Spark derives from the given ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.operators.staging import written
from canteiro.plans import contracts as contract_plans
from canteiro.plans import features as feature_plans
from canteiro.plans import suppliers as supplier_plans
from canteiro.plans import works as work_plans
from canteiro.plans.incremental import refreshed
from canteiro.plans.structured import structured_tables
from canteiro.queries.registry import Tables, as_of, day, query

# raw contracts: every order; two of five name public works in their object
_CONTRACTS_SQL = """
c AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS id_contrato,
         CASE o_orderstatus WHEN 'O' THEN 'portal_transparencia_macae_contratos' WHEN 'F' THEN 'tce_rj_contratos' ELSE 'tce_rj_compras_diretas' END AS fonte,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) END AS cnpj,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'REFORMA da escola no bairro Novo Centro, Macaé' WHEN '2-HIGH' THEN 'Pavimentação' WHEN '4-NOT SPECIFIED' THEN 'Manobra' ELSE 'Papel' END AS objeto,
         o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED') AS obra,
         CASE WHEN o_custkey % 4 = 0 THEN CAST(o_custkey AS VARCHAR) || '/L' END AS licitacao,
         CASE WHEN o_orderstatus = 'F' THEN 'Vigente' END AS situacao, o_totalprice AS valor,
         CASE WHEN o_custkey % 3 = 0 THEN o_totalprice * 2 WHEN o_custkey % 3 = 1 THEN 0 END AS aditivos,
         o_orderdate AS assinatura, CASE WHEN o_custkey % 5 <> 0 THEN o_orderdate + INTERVAL 400 DAY END AS fim, CAST(o_custkey % 6 AS DOUBLE) AS qtd
  FROM orders)
"""


def raw_contracts(t: Tables) -> DataFrame:
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as id_contrato",
        "case o_orderstatus when 'O' then 'portal_transparencia_macae_contratos' when 'F' then 'tce_rj_contratos' else 'tce_rj_compras_diretas' end as fonte",
        "case when o_orderpriority <> '4-NOT SPECIFIED' then cast(o_custkey as string) end as cnpj_fornecedor",
        "'Empresa' as nome_fornecedor",
        "case o_orderpriority when '1-URGENT' then 'REFORMA da escola no bairro Novo Centro, Macaé' when '2-HIGH' then 'Pavimentação' "
        "when '4-NOT SPECIFIED' then 'Manobra' else 'Papel' end as objeto",
        "case when o_custkey % 4 = 0 then concat(o_custkey, '/L') else ' ' end as num_licitacao",
        "case when o_orderstatus = 'F' then 'Vigente' when o_orderstatus = 'O' then 'none' end as situacao",
        "o_totalprice as valor_inicial",
        "case o_custkey % 3 when 0 then o_totalprice * 2 when 1 then 0D end as valor_aditivos",
        "cast(o_orderdate as timestamp) as data_assinatura", "cast(null as timestamp) as data_inicio_vigencia",
        "case when o_custkey % 5 <> 0 then cast(o_orderdate + interval 400 days as timestamp) end as data_fim_vigencia",
        "cast(o_custkey % 6 as string) as qtd_aditivos",
    )


def raw_current(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "cast(p_partkey as string) as id_obra", "p_name as nome_obra",
        "case p_type when 'ECONOMY' then 'Entregue' when 'SMALL' then 'em obras' when 'PROMO' then 'Cancelado' else 'Em vistoria' end as situacao",
        "case when p_size > 40 then 55D when p_size > 30 then -1D end as percentual_executado", "p_brand as secretaria",
        "p_retailprice as valor_contrato", "cast(date_add(date'1998-01-01', p_size) as timestamp) as data_inicio",
        "cast(date_add(date'2001-01-01', p_size) as timestamp) as data_prevista_fim",
        "case when p_size > 25 then -22.5D end as latitude", "-41.75D as longitude",
    )


def raw_legacy(t: Tables) -> DataFrame:
    return t.supplier.selectExpr(
        "cast(s_suppkey as string) as id_obra", "s_name as nome_obra", "'Finalizada' as situacao", "cast(s_nationkey as string) as num_licitacao",
        "s_acctbal as valor_contrato", "cast(1990 + s_nationkey as bigint) as ano_conclusao", "0D as percentual_executado",
    )


def raw_health(t: Tables) -> DataFrame:
    return t.customer.selectExpr(
        "c_custkey as proposta_id", "case when c_nationkey < 8 then c_name when c_nationkey < 12 then ' ' end as nome_estabelecimento",
        "case when c_nationkey < 16 then c_mktsegment else '' end as tipo_obra", "'Em Funcionamento' as situacao",
        "cast(null as double) as percentual_executado", "c_acctbal as valor_proposta",
        "case when c_nationkey > 3 then timestamp'1999-06-01' end as dt_prevista_conclusao_final", "timestamp'1998-06-01' as dt_prevista_conclusao",
        "cast(date_add(date'1999-01-01', cast(c_custkey % 400 as int)) as timestamp) as dt_conclusao_final",
    )


def raw_map(t: Tables) -> DataFrame:
    return t.part.selectExpr(
        "concat(p_name, ' ', p_partkey) as nome_obra", "p_brand as descricao", "'Projeto' as situacao",
        "concat('R$ ', translate(format_number(p_retailprice, 2), ',.', '.,')) as valor",
        "timestamp'1997-01-01' as data_inicio", "case when p_size > 25 then concat(p_size, ' DIAS') else concat('Março/', 1975 + p_size) end as previsao_termino",
        "-22.25D as latitude", "-41.5D - p_size as longitude",
    )


def raw_stopped(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(
        F.max("l_extendedprice").alias("valor_contrato"), F.min("l_extendedprice").alias("valor_pago_obra"),
        F.max("l_shipdate").cast("timestamp").alias("data_paralisacao"), F.min("l_shipdate").cast("timestamp").alias("data_inicio"),
    ).selectExpr(
        "concat(l_suppkey, '-', l_linenumber) as id_obra", "'Obra parada' as nome_obra", "case when l_linenumber > 3 then 'Creche' end as tipo_obra",
        "case when l_linenumber > 5 then 'SEMED' end as orgao", "'Educação' as funcao_governo", "valor_contrato", "valor_pago_obra",
        "data_paralisacao", "data_inicio", "case when l_linenumber = 7 then 12.5D end as percentual_executado",
    )


@query(
    "WITH "
    + _CONTRACTS_SQL
    + """
SELECT id_contrato AS id_origem, fonte AS fonte_origem, objeto AS nome, 'Obra Municipal' AS tipo,
       CASE WHEN situacao = 'Vigente' THEN 'Em andamento' ELSE 'Indefinido' END AS situacao,
       CASE WHEN objeto LIKE 'REFORMA%' THEN 'Novo Centro' END AS bairro, valor AS valor_contrato,
       strftime(assinatura, '%Y-%m-%d') AS inicio, strftime(fim, '%Y-%m-%d') AS prazo,
       CASE WHEN situacao = 'Vigente' AND fim IS NOT NULL
            THEN least(99.0, round_even(CAST(date_diff('day', assinatura, TIMESTAMP '2000-01-01') AS DOUBLE) / 400 * 100, 1)) ELSE 0.0 END AS percentual_executado,
       CASE WHEN fim IS NOT NULL THEN greatest(0, date_diff('day', fim, TIMESTAMP '2000-01-01')) END AS dias_atraso
FROM c WHERE obra
"""
)
def works_from_contracts(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_contracts(raw_contracts(t)), as_of())
    return done.select(
        "id_origem", "fonte_origem", "nome", "tipo", "situacao", "bairro", "valor_contrato", day("data_inicio").alias("inicio"),
        day("data_prevista_fim").alias("prazo"), "percentual_executado", "dias_atraso",
    )


@query(
    """
SELECT CAST(p_partkey AS VARCHAR) AS id_origem, p_name AS nome,
  CASE p_type WHEN 'ECONOMY' THEN 'Concluída' WHEN 'SMALL' THEN 'Em andamento' WHEN 'PROMO' THEN 'Cancelada' ELSE 'Em vistoria' END AS situacao,
  CASE WHEN p_size > 40 THEN 55.0 WHEN p_type = 'ECONOMY' THEN 100.0 WHEN p_type = 'SMALL' THEN round_even(CAST(730 - p_size AS DOUBLE) / 1096 * 100, 1)
       WHEN p_type <> 'PROMO' AND p_size > 30 THEN -1.0 ELSE 0.0 END AS percentual_executado,
  CASE WHEN p_size > 25 THEN 'POINT(-41.75 -22.5)' END AS geometry, CAST(0 AS BIGINT) AS dias_atraso
FROM part
"""
)
def works_from_current_panel(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_current_panel(raw_current(t)), as_of())
    return done.select("id_origem", "nome", "situacao", "percentual_executado", "geometry", "dias_atraso")


@query(
    """
SELECT CAST(s_suppkey AS VARCHAR) AS id_origem, s_name AS objeto, 'Concluída' AS situacao, 100.0::DOUBLE AS percentual_executado, s_acctbal AS valor_contrato,
       CAST(1990 + s_nationkey AS BIGINT) AS ano_conclusao FROM supplier
"""
)
def works_from_legacy_panel(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_legacy_panel(raw_legacy(t)), as_of())
    return done.select("id_origem", "objeto", "situacao", "percentual_executado", "valor_contrato", "ano_conclusao")


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS id_origem,
  CASE WHEN c_nationkey < 8 THEN c_name WHEN c_nationkey < 16 THEN c_mktsegment ELSE 'Obra SISMOB ' || c_custkey END AS nome,
  100.0::DOUBLE AS percentual_executado,
  greatest(0, date_diff('day', CASE WHEN c_nationkey > 3 THEN TIMESTAMP '1999-06-01' ELSE TIMESTAMP '1998-06-01' END, TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey % 400 AS INTEGER)))) AS dias_atraso
FROM customer
"""
)
def works_from_health(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_health(raw_health(t)), as_of())
    return done.select("id_origem", "nome", "percentual_executado", "dias_atraso")


@query(
    """
SELECT p_name || ' ' || p_partkey AS id_origem, round(p_retailprice, 2) AS valor_contrato,
  strftime(CASE WHEN p_size > 25 THEN TIMESTAMP '1997-01-01' + to_days(p_size) ELSE make_timestamp(1975 + p_size, 3, 1, 0, 0, 0) END, '%Y-%m-%d') AS prazo,
  'POINT(' || CAST(-41.5 - p_size AS DOUBLE) || ' -22.25)' AS geometry, 'Em fase de planejamento' AS situacao, 0.0::DOUBLE AS percentual_executado
FROM part
"""
)
def works_from_map(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_map(raw_map(t)), as_of())
    return done.select(
        "id_origem", "valor_contrato", day("data_prevista_fim").alias("prazo"), "geometry", "situacao", "percentual_executado"
    )


@query(
    """
SELECT l_suppkey || '-' || l_linenumber AS id_origem, CASE WHEN l_linenumber > 3 THEN 'Creche' ELSE 'Obra Paralisada' END AS tipo,
  CASE WHEN l_linenumber > 5 THEN 'SEMED' ELSE 'Educação' END AS secretaria, 'Paralisada' AS situacao,
  CASE WHEN l_linenumber = 7 THEN 12.5 ELSE least(99.0, round_even(min(l_extendedprice) / max(l_extendedprice) * 100, 1)) END AS percentual_executado,
  min(l_extendedprice) AS valor_final, greatest(0, date_diff('day', max(l_shipdate), TIMESTAMP '2000-01-01')) AS dias_atraso
FROM lineitem GROUP BY l_suppkey, l_linenumber
"""
)
def works_from_stopped(t: Tables) -> DataFrame:
    done = work_plans.finished(work_plans.from_stopped(raw_stopped(t)), as_of())
    return done.select("id_origem", "tipo", "secretaria", "situacao", "percentual_executado", "valor_final", "dias_atraso")


def all_raw(t: Tables) -> dict[str, DataFrame]:
    return {
        "raw_contratos": raw_contracts(t),
        "raw_obras_atual": raw_current(t),
        "raw_obras_legado": raw_legacy(t),
        "raw_obras_saude": raw_health(t),
        "raw_obras_georef": raw_map(t),
        "raw_obras_paralisadas": raw_stopped(t),
        "raw_aditivos_federais": t.nation.selectExpr(
            "cast(n_nationkey as string) as nr_convenio", "cast(n_nationkey as double) as valor_aditivos", "cast(n_regionkey as bigint) as qtd_aditivos",
            "case when n_regionkey = 1 then 'Concluído' else 'Em execução' end as situacao", "timestamp'1999-12-31' as data_fim_vigencia",
            "timestamp'1999-01-01' as data_fim_vigencia_original",
        ),
        "raw_convenios_federais": t.nation.selectExpr(
            "cast(n_nationkey as string) as nr_convenio", "case when n_regionkey = 2 then timestamp'1999-02-01' else timestamp'2005-01-01' end as data_conclusao",
            "'Aprovado' as situacao",
        ),
    }


_WORKS_SQL = (
    "WITH "
    + _CONTRACTS_SQL
    + """,
w AS (
  SELECT CASE o_orderstatus WHEN 'O' THEN 'portal_transparencia_macae_contratos' WHEN 'F' THEN 'tce_rj_contratos' ELSE 'tce_rj_compras_diretas' END AS fonte_origem,
         CAST(o_totalprice AS DOUBLE) AS valor, CAST(NULL AS DOUBLE) AS adit, CAST(NULL AS TIMESTAMP) AS fim,
         CASE WHEN o_custkey % 5 <> 0 THEN o_orderdate + INTERVAL 400 DAY END AS prazo, false AS ponto, o_custkey
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH', '4-NOT SPECIFIED')
  UNION ALL SELECT 'painel_obras_atual_macae', p_retailprice, NULL, NULL, TIMESTAMP '2001-01-01' + to_days(p_size), p_size > 25, NULL FROM part
  UNION ALL SELECT 'painel_obras_legado_macae', s_acctbal, CAST(s_nationkey AS DOUBLE),
         CASE WHEN n_regionkey = 2 THEN TIMESTAMP '1999-02-01' WHEN n_regionkey = 1 THEN TIMESTAMP '1999-12-31' END,
         CASE WHEN n_regionkey = 1 THEN TIMESTAMP '1999-01-01' END, false, NULL FROM supplier JOIN nation ON n_nationkey = s_nationkey
  UNION ALL SELECT 'sismob_cidadao', c_acctbal, NULL, TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey % 400 AS INTEGER)),
         CASE WHEN c_nationkey > 3 THEN TIMESTAMP '1999-06-01' ELSE TIMESTAMP '1998-06-01' END, false, NULL FROM customer
  UNION ALL SELECT 'egim_google_mymaps', round(p_retailprice, 2), NULL, NULL,
         CASE WHEN p_size > 25 THEN TIMESTAMP '1997-01-01' + to_days(p_size) ELSE make_timestamp(1975 + p_size, 3, 1, 0, 0, 0) END, true, NULL FROM part
  UNION ALL SELECT 'tce_rj_obras_paralisadas', max(l_extendedprice), NULL, NULL, max(l_shipdate), false, NULL FROM lineitem GROUP BY l_suppkey, l_linenumber),
x AS (
  SELECT w.fonte_origem, w.valor, CASE WHEN fonte_origem LIKE 'p%_contratos' OR fonte_origem LIKE 'tce_rj_con%' OR fonte_origem LIKE 'tce_rj_com%'
           THEN CASE WHEN o_custkey % 3 = 0 THEN w.valor * 2 WHEN o_custkey % 3 = 1 THEN 0 END ELSE adit END AS adit, ponto,
         CASE WHEN prazo IS NOT NULL THEN greatest(0, date_diff('day', prazo, coalesce(w.fim, TIMESTAMP '2000-01-01'))) END AS atraso FROM w)
"""
)


@query(
    _WORKS_SQL
    + """
SELECT fonte_origem, count(*) AS obras, CAST(sum(CAST(valor AS DECIMAL(38,2))) AS DOUBLE) AS valor, CAST(sum(CAST(adit AS DECIMAL(38,2))) AS DOUBLE) AS aditivos,
  CAST(sum(atraso) AS BIGINT) AS dias, count(*) FILTER (WHERE ponto) AS com_ponto, count(atraso) AS com_prazo
FROM x GROUP BY fonte_origem
"""
)
def works_consolidated(t: Tables) -> DataFrame:
    """All six sources consolidated and enriched, summed by source."""
    consolidated, _ = work_plans.works(all_raw(t), as_of())
    return consolidated.groupBy("fonte_origem").agg(
        F.count("*").alias("obras"),
        F.sum(F.col("valor_contrato").cast("decimal(38,2)")).cast("double").alias("valor"),
        F.sum(F.col("valor_aditivos").cast("decimal(38,2)")).cast("double").alias("aditivos"),
        F.sum("dias_atraso").alias("dias"),
        F.count("geometry").alias("com_ponto"),
        F.count("dias_atraso").alias("com_prazo"),
    )


# every column of every work, source by source; what a source does not have is NULL
_WORK_ROWS_SQL = (
    "WITH "
    + _CONTRACTS_SQL
    + """,
e AS (SELECT n_nationkey, n_regionkey, CASE WHEN n_regionkey = 2 THEN TIMESTAMP '1999-02-01' WHEN n_regionkey = 1 THEN TIMESTAMP '1999-12-31' END AS fim,
        CASE WHEN n_regionkey = 1 THEN TIMESTAMP '1999-01-01' END AS prazo FROM nation),
s AS (SELECT l_suppkey, l_linenumber, max(l_extendedprice) AS valor, min(l_extendedprice) AS pago, max(l_shipdate) AS parada, min(l_shipdate) AS ini
      FROM lineitem GROUP BY l_suppkey, l_linenumber),
w AS (
  SELECT 'painel_obras_atual_macae' AS fonte_origem, CAST(p_partkey AS VARCHAR) AS id_origem, p_name AS nome, p_name AS objeto, 'Obra Municipal' AS tipo,
    CASE p_type WHEN 'ECONOMY' THEN 'Concluída' WHEN 'SMALL' THEN 'Em andamento' WHEN 'PROMO' THEN 'Cancelada' ELSE 'Em vistoria' END AS situacao,
    p_brand AS secretaria, CAST(NULL AS VARCHAR) AS bairro,
    CASE WHEN p_size > 40 THEN 55.0 WHEN p_type = 'ECONOMY' THEN 100.0 WHEN p_type = 'SMALL' THEN round_even(CAST(730 - p_size AS DOUBLE) / 1096 * 100, 1)
      WHEN p_type <> 'PROMO' AND p_size > 30 THEN -1.0 ELSE 0.0 END AS percentual_executado,
    p_retailprice AS valor_contrato, CAST(NULL AS DOUBLE) AS valor_aditivos, CAST(NULL AS DOUBLE) AS valor_final, CAST(NULL AS BIGINT) AS qtd_aditivos,
    TIMESTAMP '1998-01-01' + to_days(p_size) AS ini, TIMESTAMP '2001-01-01' + to_days(p_size) AS prazo, CAST(NULL AS TIMESTAMP) AS fim,
    CAST(NULL AS BIGINT) AS ano_conclusao, CASE WHEN p_size > 25 THEN -22.5::DOUBLE END AS latitude, -41.75::DOUBLE AS longitude,
    CASE WHEN p_size > 25 THEN 'POINT(-41.75 -22.5)' END AS geometry, CAST(NULL AS VARCHAR) AS num_licitacao FROM part
  UNION ALL SELECT 'painel_obras_legado_macae', CAST(s_suppkey AS VARCHAR), s_name, s_name, 'Obra Municipal', 'Concluída', NULL, NULL, 100.0, s_acctbal,
    CAST(n_nationkey AS DOUBLE), NULL, CAST(n_regionkey AS BIGINT), NULL, prazo, fim, CAST(1990 + s_nationkey AS BIGINT), NULL, NULL, NULL, CAST(s_nationkey AS VARCHAR)
    FROM supplier JOIN e ON n_nationkey = s_nationkey
  UNION ALL SELECT fonte, id_contrato, objeto, objeto, 'Obra Municipal', CASE WHEN situacao = 'Vigente' THEN 'Em andamento' ELSE 'Indefinido' END, NULL,
    CASE WHEN objeto LIKE 'REFORMA%' THEN 'Novo Centro' END,
    CASE WHEN situacao = 'Vigente' AND fim IS NOT NULL THEN least(99.0, round_even(CAST(date_diff('day', assinatura, TIMESTAMP '2000-01-01') AS DOUBLE) / 400 * 100, 1)) ELSE 0.0 END,
    valor, aditivos, NULL, NULL, assinatura, fim, NULL, NULL, NULL, NULL, NULL, NULL FROM c WHERE obra
  UNION ALL SELECT 'sismob_cidadao', CAST(c_custkey AS VARCHAR), CASE WHEN c_nationkey < 8 THEN c_name WHEN c_nationkey < 16 THEN c_mktsegment ELSE 'Obra SISMOB ' || c_custkey END,
    CASE WHEN c_nationkey < 16 THEN c_mktsegment ELSE '' END, 'Saúde', 'Concluída', 'Saúde', NULL, 100.0, c_acctbal, NULL, NULL, NULL, NULL,
    CASE WHEN c_nationkey > 3 THEN TIMESTAMP '1999-06-01' ELSE TIMESTAMP '1998-06-01' END, TIMESTAMP '1999-01-01' + to_days(CAST(c_custkey % 400 AS INTEGER)), NULL, NULL, NULL, NULL, NULL
    FROM customer
  UNION ALL SELECT 'egim_google_mymaps', p_name || ' ' || p_partkey, p_name || ' ' || p_partkey, p_brand, 'Georreferenciada', 'Em fase de planejamento', NULL, NULL, 0.0,
    round(p_retailprice, 2), NULL, NULL, NULL, TIMESTAMP '1997-01-01',
    CASE WHEN p_size > 25 THEN TIMESTAMP '1997-01-01' + to_days(p_size) ELSE make_timestamp(1975 + p_size, 3, 1, 0, 0, 0) END, NULL, NULL, -22.25, -41.5 - p_size,
    'POINT(' || CAST(-41.5 - p_size AS DOUBLE) || ' -22.25)', NULL FROM part
  UNION ALL SELECT 'tce_rj_obras_paralisadas', l_suppkey || '-' || l_linenumber, 'Obra parada', CASE WHEN l_linenumber > 3 THEN 'Creche' ELSE 'Obra parada' END,
    CASE WHEN l_linenumber > 3 THEN 'Creche' ELSE 'Obra Paralisada' END, 'Paralisada', CASE WHEN l_linenumber > 5 THEN 'SEMED' ELSE 'Educação' END, NULL,
    CASE WHEN l_linenumber = 7 THEN 12.5 ELSE least(99.0, round_even(pago / valor * 100, 1)) END, valor, NULL, pago, NULL, ini, parada, NULL, NULL, NULL, NULL, NULL, NULL FROM s)
"""
)


@query(
    _WORK_ROWS_SQL
    + """
SELECT sha256(fonte_origem || '|' || id_origem) AS id, fonte_origem, id_origem, nome, objeto, tipo, situacao, secretaria, bairro, CAST(NULL AS VARCHAR) AS endereco,
  'Macaé' AS municipio, 'RJ' AS uf, CAST(percentual_executado AS DOUBLE) AS percentual_executado, CAST(NULL AS DOUBLE) AS percentual_executado_financeiro,
  valor_contrato, valor_aditivos, valor_final, qtd_aditivos, strftime(ini, '%Y-%m-%d') AS data_inicio, strftime(prazo, '%Y-%m-%d') AS data_prevista_fim,
  strftime(fim, '%Y-%m-%d') AS data_conclusao, ano_conclusao,
  CASE WHEN prazo IS NOT NULL THEN greatest(0, date_diff('day', prazo, coalesce(fim, TIMESTAMP '2000-01-01'))) END AS dias_atraso,
  latitude, longitude, geometry, CAST(NULL AS VARCHAR) AS cnpj_executora, CAST(NULL AS VARCHAR) AS num_contrato, num_licitacao
FROM w
"""
)
def works_rows(t: Tables) -> DataFrame:
    """Every consolidated and enriched work of all six sources with all its columns."""
    consolidated, _ = work_plans.works(all_raw(t), as_of())
    dates = ("data_inicio", "data_prevista_fim", "data_conclusao")
    return consolidated.withColumns({name: day(name) for name in dates})


_STRUCTURED_SQL = (
    "WITH "
    + _CONTRACTS_SQL
    + """,
k AS (
  SELECT *, coalesce(licitacao, id_contrato) AS numero, row_number() OVER (PARTITION BY coalesce(licitacao, id_contrato), fonte ORDER BY id_contrato DESC) AS rn
  FROM c WHERE obra)
"""
)


@query(
    _STRUCTURED_SQL
    + """
SELECT sha256(fonte || '|' || id_contrato) AS id_obra, sha256(cnpj) AS id_fornecedor, numero, objeto, fonte AS fonte_origem,
  CASE WHEN situacao IS NOT NULL THEN situacao WHEN fim < TIMESTAMP '2000-01-01' THEN 'Expirado' WHEN fim IS NULL THEN 'Indefinido' ELSE 'Vigente' END AS situacao,
  valor AS valor_inicial, aditivos AS valor_aditivos, qtd AS qtd_aditivos, strftime(fim, '%Y-%m-%d') AS data_fim
FROM k WHERE rn = 1
"""
)
def contracts_structured(t: Tables) -> DataFrame:
    """Contracts linked to their work and supplier, the last of each number kept."""
    raw = raw_contracts(t)
    keys = work_plans.work_keys({"raw_contratos": raw})
    rows, _ = contract_plans.contracts(raw, keys, supplier_plans.suppliers(raw), as_of())
    return rows.select(
        "id_obra", "id_fornecedor", "numero", "objeto", "fonte_origem", "situacao", "valor_inicial", "valor_aditivos", "qtd_aditivos",
        day("data_fim").alias("data_fim"),
    )


@query(
    _STRUCTURED_SQL
    + """
SELECT sha256(numero || '|' || fonte) AS id_contrato, 'Consolidado' AS tipo, 'Aditivo(s) registrado(s) na fonte original' AS motivo, aditivos AS valor
FROM k WHERE rn = 1 AND aditivos > 0
"""
)
def amendments_structured(t: Tables) -> DataFrame:
    raw = raw_contracts(t)
    keys = work_plans.work_keys({"raw_contratos": raw})
    rows, _ = contract_plans.contracts(raw, keys, supplier_plans.suppliers(raw), as_of())
    return contract_plans.amendments(raw, rows)[0].select("id_contrato", "tipo", "motivo", "valor")


_STRUCTURED_ROWS_SQL = (
    _STRUCTURED_SQL
    + """
SELECT 'fornecedores' AS tabela, cnpj AS chave, to_json({'razao_social': 'Empresa', 'contratos': count(*), 'valor': CAST(sum(CAST(valor AS DECIMAL(38,2))) AS VARCHAR),
    'primeiro': strftime(min(assinatura), '%Y-%m-%d'), 'ultimo': strftime(max(assinatura), '%Y-%m-%d'), 'anos': count(DISTINCT year(assinatura))}) AS linha
FROM c WHERE cnpj IS NOT NULL GROUP BY cnpj
UNION ALL SELECT 'contratos', numero || '|' || fonte, to_json({'obra': sha256(fonte || '|' || id_contrato), 'fornecedor': sha256(cnpj), 'objeto': objeto,
    'situacao': CASE WHEN situacao IS NOT NULL THEN situacao WHEN fim < TIMESTAMP '2000-01-01' THEN 'Expirado' WHEN fim IS NULL THEN 'Indefinido' ELSE 'Vigente' END,
    'assinatura': strftime(assinatura, '%Y-%m-%d'), 'fim': strftime(fim, '%Y-%m-%d')}) FROM k WHERE rn = 1
UNION ALL SELECT 'aditivos', sha256(numero || '|' || fonte), to_json({'tipo': 'Consolidado', 'motivo': 'Aditivo(s) registrado(s) na fonte original'}) FROM k WHERE rn = 1 AND aditivos > 0
"""
)


def _structured_lines(tables: dict[str, DataFrame]) -> DataFrame:
    """Suppliers, contracts and amendments as lines: table, key, record."""
    options = {"ignoreNullFields": "false"}

    def listed(name: str, key: Column, **cells: Column | str) -> DataFrame:
        record = F.to_json(F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in cells.items()]), options)
        return tables[name].select(F.lit(name).alias("tabela"), key.alias("chave"), record.alias("linha"))

    suppliers = listed(
        "fornecedores", F.col("cnpj"), razao_social="razao_social", contratos="total_contratos",
        valor=F.col("valor_total").cast("decimal(38,2)").cast("string"),
        primeiro=day("primeiro_contrato"), ultimo=day("ultimo_contrato"), anos="anos_atuacao",
    )
    linked = listed(
        "contratos", F.concat("numero", F.lit("|"), "fonte_origem"), obra="id_obra", fornecedor="id_fornecedor", objeto="objeto",
        situacao="situacao", assinatura=day("data_assinatura"), fim=day("data_fim"),
    )
    added = listed("aditivos", F.col("id_contrato"), tipo="tipo", motivo="motivo")
    return suppliers.unionByName(linked).unionByName(added)


@query(_STRUCTURED_ROWS_SQL)
def structured_rows(t: Tables) -> DataFrame:
    """Rows of suppliers, contracts and amendments of one structured run, each as its key and a record."""
    return _structured_lines(structured_tables(all_raw(t), as_of()))


def earlier_contracts(t: Tables) -> DataFrame:
    """The raw contracts as they were: some rows are missing, some had other values, and some are gone since."""
    now = raw_contracts(t)
    order = F.col("id_contrato").cast("long")
    was = now.where(order % 50 != 8).withColumns(
        {
            "valor_inicial": F.when(order % 10 == 3, F.lit(1.0)).otherwise(F.col("valor_inicial")),
            "cnpj_fornecedor": F.when(order % 40 == 5, F.lit("1")).otherwise(F.col("cnpj_fornecedor")),
            "num_licitacao": F.when(order % 60 == 7, F.lit("antes")).otherwise(F.col("num_licitacao")),
            "objeto": F.when(order % 30 == 9, F.lit("Pavimentação")).otherwise(F.col("objeto")),
        }
    )
    gone = now.where(order % 50 == 11).withColumn("id_contrato", F.concat(F.lit("9"), "id_contrato", F.lit("000000000")))
    return was.unionByName(gone)


@query(_STRUCTURED_ROWS_SQL)
def structured_refresh(t: Tables) -> DataFrame:
    """The structured rows of an earlier version of the raw contracts, brought up to date by the rows that changed."""

    def stage(df: DataFrame) -> DataFrame:
        return written(df, "refresh")

    old, new = earlier_contracts(t), raw_contracts(t)
    before = structured_tables({"raw_contratos": old}, as_of(), stage=stage)
    return _structured_lines(refreshed(before, old, new, as_of(), stage))


@query(
    _STRUCTURED_SQL
    + """
SELECT 'fornecedores' AS tabela, count(DISTINCT cnpj) AS linhas FROM c
UNION ALL SELECT 'obras', (SELECT count(*) FROM c WHERE obra) + 2 * (SELECT count(*) FROM part) + (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer)
  + (SELECT count(*) FROM (SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem))
UNION ALL SELECT 'contratos', count(*) FROM k WHERE rn = 1
UNION ALL SELECT 'aditivos', count(*) FROM k WHERE rn = 1 AND aditivos > 0
"""
)
def structured_run(t: Tables) -> DataFrame:
    """Row counts of the four structured tables, all from one lazy plan."""
    tables = structured_tables(all_raw(t), as_of())
    counts = None
    for name, frame in tables.items():
        line = frame.agg(F.count("*").alias("linhas")).select(F.lit(name).alias("tabela"), "linhas")
        counts = line if counts is None else counts.unionByName(line)
    return counts


@query(
    _STRUCTURED_SQL
    + """
SELECT sha256(c.fonte || '|' || c.id_contrato) AS id_obra, c.valor + coalesce(c.aditivos, 0) AS valor_total,
  round_even(c.aditivos / nullif(c.valor, 0) * 100, 4) AS percentual_aditivo, round_even((c.valor + coalesce(c.aditivos, 0)) / (SELECT count(*) FROM customer), 4) AS valor_por_habitante,
  CASE WHEN c.fim IS NOT NULL THEN date_diff('day', c.assinatura, c.fim) END AS duracao_prevista_dias,
  CASE WHEN c.fim IS NULL THEN 'sem prazo' WHEN c.fim < TIMESTAMP '2000-01-01' THEN 'atrasada' ELSE 'em dia' END AS prazo,
  CASE WHEN rn = 1 THEN CAST(1 AS BIGINT) END AS n_contratos, CASE WHEN rn = 1 THEN CAST(k.qtd AS BIGINT) END AS n_aditivos,
  CASE WHEN rn = 1 THEN CAST(CASE WHEN k.cnpj IS NULL THEN 0 ELSE 1 END AS BIGINT) END AS n_fornecedores,
  CASE WHEN rn = 1 AND k.cnpj IS NOT NULL THEN 'sim' ELSE 'desconhecido' END AS unico
FROM c JOIN k ON c.id_contrato = k.id_contrato
"""
)
def features_per_work(t: Tables) -> DataFrame:
    """Feature table; NULL stands for unknown, never zero."""
    raw = raw_contracts(t)
    keys = work_plans.work_keys({"raw_contratos": raw})
    rows, _ = contract_plans.contracts(raw, keys, supplier_plans.suppliers(raw), as_of())
    people = t.customer.agg(F.count("*")).scalar()
    works_df, _ = work_plans.works({"raw_contratos": raw}, as_of())
    table = feature_plans.features(works_df, rows, as_of(), people)
    return table.select(
        "id_obra", "valor_total", "percentual_aditivo", "valor_por_habitante", "duracao_prevista_dias",
        F.when(F.col("flag_atrasada"), "atrasada").when(~F.col("flag_atrasada"), "em dia").otherwise("sem prazo").alias("prazo"),
        "n_contratos", "n_aditivos", "n_fornecedores",
        F.when(F.col("flag_fornecedor_unico"), "sim").otherwise("desconhecido").alias("unico"),
    )
