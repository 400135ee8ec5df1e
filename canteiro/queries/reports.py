"""Counts, coverage, distributions, audits, profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.operators import profile
from canteiro.operators.merge import stamped
from canteiro.plans import quality
from canteiro.queries.registry import Tables, as_of, day, query
from canteiro.sources.snapshots import freshness

_WIDE_SQL = """
WITH w AS (
  SELECT c_mktsegment AS fonte, c_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderpriority <> '5-LOW' THEN
           CASE o_orderstatus WHEN 'O' THEN 'Vigente' WHEN 'F' THEN 'Expirado' ELSE 'Indefinido' END END AS situacao,
         o_totalprice AS valor, o_orderdate AS d, round(o_custkey % 101 + 0.25, 2) AS pct
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey)
"""


def _wide(t: Tables) -> DataFrame:
    """Customers with their orders; customers without orders give the NULLs."""
    joined = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.selectExpr(
        "c_mktsegment as fonte", "c_custkey",
        "case when o_orderpriority = '1-URGENT' then '' when o_orderpriority <> '5-LOW' then "
        "case o_orderstatus when 'O' then 'Vigente' when 'F' then 'Expirado' else 'Indefinido' end end as situacao",
        "o_totalprice as valor_inicial", "o_orderdate as data_assinatura",
        "case when o_orderpriority < '3' then o_orderdate end as data_fim_vigencia",
        "case when o_orderkey is not null then cast(c_custkey as string) end as cnpj_fornecedor",
        "cast(o_custkey % 101 as double) + 0.25D as percentual_executado",
    )


@query(
    """
SELECT 'orders' AS tabela, count(*) AS registros FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'obras (estruturada)', count(*) FROM part
UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'documents', count(*) FROM documents
"""
)
def table_counts(t: Tables) -> DataFrame:
    return quality.counts(
        {"orders": t.orders, "lineitem": t.lineitem, "customer": t.customer, "obras": t.part, "events": t.events, "documents": t.documents}
    )


@query(
    _WIDE_SQL
    + """
SELECT fonte, count(*) AS total, count(*) FILTER (WHERE situacao IS NULL OR situacao = '') AS sem_situacao,
  count(*) FILTER (WHERE valor IS NULL) AS sem_valor, count(*) FILTER (WHERE d IS NULL) AS sem_data_assinatura,
  count(*) - count(*) FILTER (WHERE fim) AS sem_data_fim, count(*) FILTER (WHERE d IS NULL) AS sem_cnpj,
  count(*) FILTER (WHERE situacao = 'Vigente') AS vigentes, count(*) FILTER (WHERE situacao = 'Expirado') AS expirados,
  count(*) FILTER (WHERE situacao = 'Indefinido') AS indefinidos
FROM (SELECT w.*, prio < '3' AS fim FROM (
  SELECT c_mktsegment AS fonte, CASE WHEN o_orderpriority = '1-URGENT' THEN '' WHEN o_orderpriority <> '5-LOW' THEN
           CASE o_orderstatus WHEN 'O' THEN 'Vigente' WHEN 'F' THEN 'Expirado' ELSE 'Indefinido' END END AS situacao,
         o_totalprice AS valor, o_orderdate AS d, o_orderpriority AS prio FROM customer LEFT JOIN orders ON o_custkey = c_custkey) w)
GROUP BY fonte
"""
)
def coverage_by_source(t: Tables) -> DataFrame:
    return quality.raw_contracts(_wide(t))


@query(
    _WIDE_SQL
    + """
SELECT fonte, count(*) AS total, count(*) FILTER (WHERE valor IS NULL) AS sem_valor,
  round(CAST(sum(CAST(pct AS DECIMAL(38,2))) AS DOUBLE) / nullif(count(pct), 0), 1) AS media_percentual
FROM w GROUP BY fonte
"""
)
def coverage_with_means(t: Tables) -> DataFrame:
    checks = profile.null_checks(sem_valor="valor_inicial")
    return profile.coverage(_wide(t), ["fonte"], checks, {"media_percentual": "percentual_executado"})


@query(
    _WIDE_SQL
    + """
SELECT situacao, count(*) AS qtd, round(count(*) * 100.0 / (SELECT count(*) FROM w), 1) AS pct,
  round(CAST(sum(CAST(w.pct AS DECIMAL(38,2))) AS DOUBLE) / nullif(count(w.pct), 0), 1) AS media_percentual
FROM w GROUP BY situacao
"""
)
def status_distribution(t: Tables) -> DataFrame:
    return quality.works_status(_wide(t))


@query(
    """
SELECT l_returnflag AS fonte_origem, l_linestatus AS situacao, count(*) AS qtd FROM lineitem GROUP BY l_returnflag, l_linestatus
"""
)
def status_by_source(t: Tables) -> DataFrame:
    return quality.contract_status_by_source(
        t.lineitem.select(F.col("l_returnflag").alias("fonte_origem"), F.col("l_linestatus").alias("situacao"))
    )


@query(
    """
SELECT c_mktsegment AS fonte_origem, CAST(c_custkey AS VARCHAR) AS id_origem, c_name AS nome, 'x' AS situacao, CAST(NULL AS DOUBLE) AS percentual_executado
FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
"""
)
def must_be_empty(t: Tables) -> DataFrame:
    """The audit for works without a percent, on data that has some."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.max("o_totalprice").alias("p"))
    joined = t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left")
    return quality.works_without_percent(
        joined.selectExpr(
            "c_mktsegment as fonte_origem", "cast(c_custkey as string) as id_origem", "c_name as nome", "'x' as situacao",
            "p as percentual_executado",
        )
    )


@query(
    """
SELECT o_orderstatus AS fonte_origem, CAST(o_orderkey AS VARCHAR) AS numero, substr(o_orderpriority || repeat('x', 80), 1, 60) AS objeto,
       CASE WHEN o_orderpriority = '1-URGENT' THEN '' END AS situacao, strftime(o_orderdate, '%Y-%m-%d') AS data_inicio, CAST(NULL AS VARCHAR) AS data_fim
FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')
"""
)
def contracts_without_status(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr(
        "o_orderstatus as fonte_origem", "cast(o_orderkey as string) as numero",
        "concat(o_orderpriority, repeat('x', 80)) as objeto",
        "case o_orderpriority when '1-URGENT' then '' when '5-LOW' then null else 'ok' end as situacao",
        "date_format(o_orderdate, 'yyyy-MM-dd') as data_inicio", "cast(null as string) as data_fim",
    )
    return quality.contracts_without_status(rows)


@query(
    """
SELECT 'o_orderkey' AS campo, count(o_orderkey) AS preenchidos FROM customer LEFT JOIN orders ON o_custkey = c_custkey
UNION ALL SELECT 'o_totalprice', count(o_totalprice) FROM customer LEFT JOIN orders ON o_custkey = c_custkey
UNION ALL SELECT 'c_name', count(c_name) FROM customer LEFT JOIN orders ON o_custkey = c_custkey
"""
)
def filled_fields(t: Tables) -> DataFrame:
    joined = t.customer.join(t.orders, F.col("o_custkey") == F.col("c_custkey"), "left")
    return profile.filled_counts(joined, ["o_orderkey", "o_totalprice", "c_name"])


@query(
    """
SELECT lang, count(*) FILTER (WHERE b >= 64) AS text_textos, CAST(sum(b) FILTER (WHERE b >= 64) AS BIGINT) AS text_bytes,
  (1 - CAST(sum(length(text)) FILTER (WHERE b >= 64) AS DOUBLE) / CAST(sum(b) FILTER (WHERE b >= 64) AS DOUBLE)) * 100 AS text_economia_pct
FROM (SELECT lang, text, CASE WHEN trim(text, ' ' || chr(10) || chr(9)) <> '' THEN octet_length(encode(text)) END AS b FROM documents) GROUP BY lang
"""
)
def text_profile(t: Tables) -> DataFrame:
    """Bytes of texts worth packing; the character count stands for a packed size."""
    docs = t.documents.withColumn("tamanho", F.length("text"))
    return profile.text_profile(docs, ["text"], by=["lang"], packed={"text": "tamanho"})


@query(
    """
SELECT role, count(*) FILTER (WHERE octet_length(encode(text)) >= 200) AS text_textos,
  CAST(sum(octet_length(encode(text))) FILTER (WHERE octet_length(encode(text)) >= 200) AS BIGINT) AS text_bytes
FROM conversations GROUP BY role
"""
)
def turn_text_profile(t: Tables) -> DataFrame:
    return profile.text_profile(t.conversations, ["text"], by=["role"], min_bytes=200)


@query(
    """
SELECT event_type AS nome, strftime(max(ts), '%Y-%m-%d') AS dia, arg_max(user_id, ts) AS registros,
  round_even(CAST(epoch_us(TIMESTAMP '2024-01-30') - epoch_us(max(ts)) AS DOUBLE) / 3600000000, 1) AS idade_horas,
  epoch_us(TIMESTAMP '2024-01-30') - epoch_us(max(ts)) <= 86400000000 AS valido
FROM events GROUP BY event_type
"""
)
def freshness_report(t: Tables) -> DataFrame:
    """Events as snapshot log lines; age and validity of the newest per type."""
    log = t.events.select(
        F.col("event_type").alias("nome"), F.col("ts").cast("timestamp").alias("salvo_em"),
        F.col("user_id").alias("total_registros"), F.lit("1.0").alias("versao"),
    )
    report = freshness(log, F.lit("2024-01-30 00:00:00").cast("timestamp"))
    return report.select("nome", day("salvo_em").alias("dia"), "registros", "idade_horas", "valido")


@query(
    """
SELECT count(*) AS datasets, CAST(sum(user_id) AS BIGINT) AS registros, count(*) FILTER (WHERE event_type = 'view') AS ok,
  count(*) FILTER (WHERE event_type = 'error') AS falhas, count(*) FILTER (WHERE event_type NOT IN ('view', 'error')) AS ignorados
FROM events
"""
)
def run_summary(t: Tables) -> DataFrame:
    runs = t.events.selectExpr(
        "user_id as qtd_registros", "case event_type when 'view' then 'ok' when 'error' then 'erro' else 'ignorado' end as status"
    )
    return profile.run_summary(runs)


@query(
    """
SELECT c_custkey, strftime(TIMESTAMP '2000-01-01', '%Y-%m-%d') AS atualizado_em FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') ORDER BY c_custkey LIMIT 20
"""
)
def rejected_keys_sample(t: Tables) -> DataFrame:
    """The first twenty keys without an urgent order: a report line, the limit is the feature."""
    urgent = t.orders.where("o_orderpriority = '1-URGENT'")
    lost = t.customer.join(urgent, F.col("o_custkey") == F.col("c_custkey"), "left_anti")
    return stamped(profile.sample_keys(lost, "c_custkey"), day(as_of()))


def _gaps(t: Tables, columns: list[str], source: str = "fonte") -> DataFrame:
    """Lines as raw rows: the n-th column has no value on the lines with number n, counted around."""
    cells = [
        F.when(F.col("l_linenumber") != place % 7 + 1, F.col("l_partkey").cast("double")).alias(name)
        for place, name in enumerate(columns)
    ]
    return t.lineitem.select(F.col("l_returnflag").alias(source), *cells)


def _gaps_sql(names: list[str], source: str = "fonte", more: str = "") -> str:
    counts = "".join(
        f", count(*) FILTER (WHERE l_linenumber = {place % 7 + 1}) AS {name}" for place, name in enumerate(names)
    )
    return f"SELECT l_returnflag AS {source}, count(*) AS total{counts}{more} FROM lineitem GROUP BY l_returnflag"


def _raw_works_section(table: str) -> None:
    """Register the coverage section of one raw works table."""
    checks = quality.RAW_WORKS_CHECKS[table]

    def section(t: Tables) -> DataFrame:
        return quality.raw_works(table, _gaps(t, list(checks.values())))

    section.__name__ = f"coverage_{table}"
    query(_gaps_sql(list(checks)))(section)


for _table in quality.RAW_WORKS_CHECKS:
    _raw_works_section(_table)


@query(
    """
SELECT l_returnflag AS fonte, count(*) AS total, count(*) FILTER (WHERE l_linenumber = 1) AS sem_situacao, count(*) FILTER (WHERE l_linenumber = 2) AS sem_valor,
  count(*) FILTER (WHERE l_linenumber = 3) AS sem_vencedor, count(*) FILTER (WHERE l_linenumber = 4 AND l_linestatus = 'F') AS sem_data
FROM lineitem GROUP BY l_returnflag
"""
)
def coverage_raw_tenders(t: Tables) -> DataFrame:
    """Tenders count as undated only when both dates are missing."""
    rows = t.lineitem.selectExpr(
        "l_returnflag as fonte", "case when l_linenumber <> 1 then l_linestatus end as situacao",
        "case when l_linenumber <> 2 then l_extendedprice end as valor_estimado",
        "case when l_linenumber <> 3 then cast(l_suppkey as string) end as cnpj_vencedor",
        "case when l_linenumber <> 4 then l_shipdate end as data_publicacao",
        "case when l_linestatus <> 'F' then l_shipdate end as data_abertura",
    )
    return quality.raw_tenders(rows)


_WORKS_GAPS = {
    "sem_situacao": "situacao", "sem_percentual": "percentual_executado", "sem_valor": "valor_contrato",
    "sem_lat": "latitude", "sem_data_inicio": "data_inicio", "sem_data_fim": "data_prevista_fim",
}


@query(
    _gaps_sql(
        list(_WORKS_GAPS),
        "fonte_origem",
        ", round(CAST(sum(CASE WHEN l_linenumber <> 2 THEN CAST(l_partkey AS DECIMAL(38,2)) END) AS DOUBLE) / nullif(count(CASE WHEN l_linenumber <> 2 THEN 1 END), 0), 1) AS media_percentual",
    )
)
def coverage_works(t: Tables) -> DataFrame:
    return quality.works_coverage(_gaps(t, list(_WORKS_GAPS.values()), "fonte_origem"))


_LINES_SQL = """
WITH o AS (
  SELECT l_returnflag AS f, CASE WHEN l_linenumber <> 1 THEN l_linestatus END AS s, CASE WHEN l_linenumber <> 2 THEN CAST(l_partkey AS DOUBLE) END AS p, l_linenumber AS n
  FROM lineitem),
k AS (SELECT o_orderstatus AS f, CASE o_orderpriority WHEN '1-URGENT' THEN '' WHEN '5-LOW' THEN NULL ELSE o_orderpriority END AS s FROM orders),
r AS (SELECT c_mktsegment AS f, CASE WHEN c_nationkey % 3 = 0 THEN 'Vigente' WHEN c_nationkey % 3 = 1 THEN 'Expirado' END AS s, c_custkey AS c FROM customer),
m AS (
  SELECT 'contagens' AS secao, '' AS grupo, unnest([{'k': 'obras (estruturada)', 'v': count(*)}]) AS x FROM o
  UNION ALL SELECT 'contagens', '', unnest([{'k': 'contratos (estruturada)', 'v': count(*)}]) FROM k
  UNION ALL SELECT 'contagens', '', unnest([{'k': 'raw_contratos', 'v': count(*)}]) FROM r
  UNION ALL SELECT 'contagens', '', unnest([{'k': 'fornecedores (estruturada)', 'v': count(*)}]) FROM supplier
  UNION ALL SELECT 'cobertura_raw_contratos', f, unnest([{'k': 'total', 'v': count(*)}, {'k': 'sem_situacao', 'v': count(*) - count(s)},
      {'k': 'sem_valor', 'v': count(*) FILTER (WHERE c % 5 = 0)}, {'k': 'sem_data_assinatura', 'v': 0}, {'k': 'sem_data_fim', 'v': count(*)},
      {'k': 'sem_cnpj', 'v': count(*) FILTER (WHERE c % 7 = 0)}, {'k': 'vigentes', 'v': count(*) FILTER (WHERE s = 'Vigente')},
      {'k': 'expirados', 'v': count(*) FILTER (WHERE s = 'Expirado')}, {'k': 'indefinidos', 'v': 0}]) FROM r GROUP BY f
  UNION ALL SELECT 'cobertura_obras', f, unnest([{'k': 'total', 'v': count(*)}, {'k': 'sem_situacao', 'v': count(*) FILTER (WHERE n = 1)},
      {'k': 'sem_percentual', 'v': count(*) FILTER (WHERE n = 2)}, {'k': 'sem_valor', 'v': count(*) FILTER (WHERE n = 3)}, {'k': 'sem_lat', 'v': count(*) FILTER (WHERE n = 4)},
      {'k': 'sem_data_inicio', 'v': count(*) FILTER (WHERE n = 5)}, {'k': 'sem_data_fim', 'v': count(*) FILTER (WHERE n = 6)}]) FROM o GROUP BY f
  UNION ALL SELECT 'situacao_obras', coalesce(s, '(nulo)'), unnest([{'k': 'qtd', 'v': count(*)}]) FROM o GROUP BY s
  UNION ALL SELECT 'obras_sem_percentual', '', unnest([{'k': 'linhas', 'v': count(*) FILTER (WHERE p IS NULL)}]) FROM o
  UNION ALL SELECT 'situacao_contratos', f || ' / ' || coalesce(s, '(nulo)'), unnest([{'k': 'qtd', 'v': count(*)}]) FROM k GROUP BY f, s
  UNION ALL SELECT 'contratos_sem_situacao', '', unnest([{'k': 'linhas', 'v': count(*) FILTER (WHERE s IS NULL OR s = '')}]) FROM k)
SELECT secao, grupo, x.k AS medida, CAST(x.v AS DOUBLE) AS valor FROM m
UNION ALL SELECT 'situacao_obras', coalesce(s, '(nulo)'), 'pct', round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM o), 1) FROM o GROUP BY s
UNION ALL SELECT 'situacao_obras', coalesce(s, '(nulo)'), 'media_percentual', round(CAST(sum(CAST(p AS DECIMAL(38,2))) AS DOUBLE) / nullif(count(p), 0), 1) FROM o GROUP BY s
UNION ALL SELECT 'cobertura_obras', f, 'media_percentual', round(CAST(sum(CAST(p AS DECIMAL(38,2))) AS DOUBLE) / nullif(count(p), 0), 1) FROM o GROUP BY f
"""


@query(_LINES_SQL)
def report_lines(t: Tables) -> DataFrame:
    """All sections of the quality report as lines, each table read once."""
    works = t.lineitem.select(
        F.col("l_returnflag").alias("fonte_origem"),
        F.when(F.col("l_linenumber") != 1, F.col("l_linestatus")).alias("situacao"),
        *[
            F.when(F.col("l_linenumber") != place + 1, F.col("l_partkey").cast("double")).alias(name)
            for place, name in enumerate(_WORKS_GAPS.values())
            if place
        ],
    )
    contracts = t.orders.selectExpr(
        "o_orderstatus as fonte_origem", "case o_orderpriority when '1-URGENT' then '' when '5-LOW' then null else o_orderpriority end as situacao"
    )
    raw = t.customer.selectExpr(
        "c_mktsegment as fonte", "case when c_nationkey % 3 = 0 then 'Vigente' when c_nationkey % 3 = 1 then 'Expirado' end as situacao",
        "case when c_custkey % 5 <> 0 then c_acctbal end as valor_inicial", "timestamp'1999-01-01' as data_assinatura",
        "cast(null as timestamp) as data_fim_vigencia", "case when c_custkey % 7 <> 0 then cast(c_custkey as string) end as cnpj_fornecedor",
    )
    return quality.report_lines({"obras": works, "contratos": contracts, "raw_contratos": raw, "fornecedores": t.supplier})
