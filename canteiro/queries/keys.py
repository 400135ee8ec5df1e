"""One row per key, upserts, unions, and joins on keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.functions.ids import composite_id, surrogate_key
from canteiro.functions.numbers import exact_sum
from canteiro.operators import dedup, joins, merge
from canteiro.operators.aggregates import amendment_totals
from canteiro.operators.fields import (
    first_column_with_values,
    first_containing,
    first_filled,
    raw_payload,
    rename_guarded,
    truthy,
    truthy_number,
    with_defaults,
)
from canteiro.queries.registry import Tables, day, query
from canteiro.sources.health import merge_detail
from canteiro.sources.payloads import explode_records
from canteiro.sources.portal import works_tenders
from canteiro.sources.panels import legacy_localities

# a total order of lines: every column after the key
_LINE_ORDER = (
    "l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag",
    "l_linestatus",
)
_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag, strftime(l_shipdate, '%Y-%m-%d') AS dia"
_RANKED = """
SELECT {columns} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM lineitem) WHERE rn = 1
"""


def _shown(lines: DataFrame) -> DataFrame:
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_returnflag", day("l_shipdate").alias("dia")
    )


@query(_RANKED.format(columns=_LINE_COLUMNS, order=", ".join(_LINE_ORDER)))
def dedup_keep_first(t: Tables) -> DataFrame:
    return _shown(dedup.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], _LINE_ORDER))


@query(_RANKED.format(columns=_LINE_COLUMNS, order=", ".join(f"{c} DESC" for c in _LINE_ORDER)))
def dedup_keep_last(t: Tables) -> DataFrame:
    return _shown(dedup.keep_last(t.lineitem, ["l_orderkey", "l_linenumber"], _LINE_ORDER))


@query("SELECT min(doc_id) AS doc_id, lang, md5(text) AS texto FROM documents GROUP BY text, lang")
def full_row_dedup(t: Tables) -> DataFrame:
    """Exact copies of whole documents; the lowest id stays."""
    rows = t.documents.select("doc_id", "text", "lang")
    unique = dedup.distinct_rows(rows, order=["doc_id"], ignore=["doc_id"])
    return unique.select("doc_id", "lang", F.md5("text").alias("texto"))


@query("SELECT DISTINCT l_partkey, l_suppkey, l_returnflag FROM lineitem")
def row_dedup_without_order(t: Tables) -> DataFrame:
    return dedup.distinct_rows(t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag"))


@query(
    """
SELECT event_id, user_id FROM (
  SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS user_id,
         row_number() OVER (PARTITION BY CASE WHEN event_type <> 'error' THEN user_id END ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1 OR user_id IS NULL
"""
)
def dedup_known_keys(t: Tables) -> DataFrame:
    """First event per user; events without a user all stay."""
    rows = t.events.select("event_id", "ts", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"))
    return dedup.keep_first_known(rows, ["user_id"], ["ts", "event_id"]).select("event_id", "user_id")


_MIXED_SQL = """
WITH m AS (
  SELECT CAST(c_custkey AS VARCHAR) AS id_origem, c_name AS nome, c_acctbal AS valor, 'sismob_cidadao' AS fonte_origem, 6 AS rk FROM customer
  UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, s_acctbal, 'painel_obras_atual_macae', 0 FROM supplier
  UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, p_retailprice, 'outra', 9 FROM part
  UNION ALL SELECT CAST(c_custkey AS VARCHAR), c_mktsegment, NULL, 'sismob_cidadao', 6 FROM customer)
"""


def _mixed(t: Tables) -> DataFrame:
    """Customers, suppliers and parts as works of three sources."""
    people = t.customer.selectExpr("cast(c_custkey as string) as id_origem", "c_name as nome", "c_acctbal as valor")
    again = t.customer.selectExpr("cast(c_custkey as string) as id_origem", "c_mktsegment as nome")
    firms = t.supplier.selectExpr("cast(s_suppkey as string) as id_origem", "s_name as nome", "s_acctbal as valor")
    things = t.part.selectExpr("cast(p_partkey as string) as id_origem", "p_name as nome", "p_retailprice as valor")
    named = [
        (people, "sismob_cidadao"), (firms, "painel_obras_atual_macae"), (things, "outra"), (again, "sismob_cidadao"),
    ]
    parts = [frame.withColumn("fonte_origem", F.lit(source)) for frame, source in named]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


@query(_MIXED_SQL + "SELECT id_origem, nome, valor, fonte_origem, CAST(rk AS INTEGER) AS ordem FROM m")
def union_sources(t: Tables) -> DataFrame:
    return _mixed(t).withColumn("ordem", dedup.source_rank("fonte_origem"))


@query(
    _MIXED_SQL
    + "SELECT id_origem, nome, valor, fonte_origem FROM (SELECT *, row_number() OVER (PARTITION BY fonte_origem, id_origem ORDER BY nome) AS rn FROM m) WHERE rn = 1"
)
def dedup_by_source(t: Tables) -> DataFrame:
    return dedup.one_per_source(_mixed(t), ["nome"])


@query(
    _MIXED_SQL
    + "SELECT id_origem, nome, valor, fonte_origem FROM (SELECT *, row_number() OVER (PARTITION BY id_origem ORDER BY rk, nome) AS rn FROM m) WHERE rn = 1"
)
def dedup_across_sources(t: Tables) -> DataFrame:
    return dedup.best_across_sources(_mixed(t), ["nome"])


@query(
    """
WITH e AS (SELECT doc_id, source, lang FROM documents WHERE text LIKE '%the%' UNION ALL SELECT doc_id, source, lang FROM documents WHERE text LIKE '%ing%'
           UNION ALL SELECT doc_id, source, lang FROM documents WHERE text LIKE '%que%')
SELECT "Número", min(lang) AS "Unidade Gestora", min(source) AS "Objeto" FROM (SELECT doc_id AS "Número", lang, source FROM e) GROUP BY "Número"
"""
)
def tender_extracts(t: Tables) -> DataFrame:
    """Keyword extracts that overlap, as one list by tender number."""
    listed = t.documents.selectExpr("doc_id as `Número`", "lang as `Unidade Gestora`", "source as `Objeto`", "text")
    extracts = [listed.where(F.col("text").contains(word)).drop("text") for word in ("the", "ing", "que")]
    return works_tenders(extracts, ["Unidade Gestora", "Objeto"])


@query(
    """
WITH a AS (SELECT 0 AS part, CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR) END AS id,
             CASE WHEN l_linenumber = 2 THEN 'C' || l_suppkey END AS nr, l_partkey, l_quantity FROM lineitem WHERE l_linestatus = 'F'
           UNION ALL SELECT 1, CASE WHEN l_linenumber = 1 THEN CAST(l_orderkey AS VARCHAR) END,
             CASE WHEN l_linenumber = 2 THEN 'C' || l_suppkey END, l_partkey, l_quantity FROM lineitem WHERE l_linestatus <> 'F'),
r AS (SELECT *, row_number() OVER (PARTITION BY coalesce(id, nr, l_partkey || '/' || l_quantity) ORDER BY part, l_partkey, l_quantity) AS rn FROM a)
SELECT id AS id_obra_obras, nr AS nr_convenio_obras, l_partkey, l_quantity FROM r WHERE rn = 1
"""
)
def two_localities(t: Tables) -> DataFrame:
    """Extracts of two localities; rows are known by id, else agreement, else content."""
    shaped = t.lineitem.selectExpr(
        "l_linestatus", "case when l_linenumber = 1 then cast(l_orderkey as string) end as id_obra_obras",
        "case when l_linenumber = 2 then concat('C', l_suppkey) end as nr_convenio_obras", "l_partkey", "l_quantity",
        "l_partkey as ordem_a", "l_quantity as ordem_b",
    )
    parts = [
        shaped.where(condition).drop("l_linestatus")
        for condition in (F.col("l_linestatus") == "F", F.col("l_linestatus") != "F")
    ]
    return legacy_localities(parts, ["ordem_a", "ordem_b"]).drop("ordem_a", "ordem_b")


@query(
    """
WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'), new AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN CASE WHEN n.o_orderpriority <> '5-LOW' THEN n.o_totalprice * 2 END ELSE o.o_totalprice END AS valor,
       o.o_orderstatus AS situacao, CASE WHEN n.o_orderkey IS NOT NULL THEN 'nova' ELSE 'antiga' END AS carga
FROM old o FULL JOIN new n ON o.o_orderkey = n.o_orderkey
"""
)
def upsert_merge(t: Tables) -> DataFrame:
    """Batch over a target it partly overlaps; the batch lacks one column and carries NULLs."""
    cut_new, cut_old = (F.lit(d).cast("timestamp_ntz") for d in ("1998-01-01", "1999-01-01"))
    target = t.orders.where(F.col("o_orderdate") < cut_old).selectExpr(
        "o_orderkey", "o_totalprice as valor", "o_orderstatus as situacao", "'antiga' as carga"
    )
    batch = t.orders.where(F.col("o_orderdate") >= cut_new).selectExpr(
        "o_orderkey", "case when o_orderpriority <> '5-LOW' then o_totalprice * 2 end as valor", "'nova' as carga"
    )
    ready, _ = merge.prepare_batch(batch, ["o_orderkey"], ["o_orderkey"])
    return merge.upsert(target, ready, ["o_orderkey"])


@query(
    """
SELECT coalesce(CAST(user_id AS VARCHAR), 'sem chave') AS chave, count(*) AS linhas FROM (
  SELECT CASE WHEN event_type <> 'click' THEN user_id END AS user_id FROM events) GROUP BY 1
"""
)
def null_key_rejects(t: Tables) -> DataFrame:
    """Rows by key, and the rejected rows without one: together all rows."""
    rows = t.events.select(F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id"))
    known, rejected = dedup.split_null_keys(rows, ["user_id"])
    counted = known.groupBy(F.col("user_id").cast("string").alias("chave")).agg(F.count("*").alias("linhas"))
    lost = rejected.agg(F.count("*").alias("linhas")).where("linhas > 0").select(F.lit("sem chave").alias("chave"), "linhas")
    return counted.unionByName(lost)


@query(
    """
SELECT l_orderkey, l_linenumber, o_orderstatus, 'com pedido' AS destino FROM lineitem JOIN orders ON l_orderkey = o_orderkey AND o_orderpriority <> '5-LOW'
UNION ALL
SELECT l_orderkey, l_linenumber, NULL, 'sem pedido' FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW')
"""
)
def fk_inner_and_reject(t: Tables) -> DataFrame:
    """Lines with their order, and the lines whose order is not in the set."""
    wanted = t.orders.where(F.col("o_orderpriority") != "5-LOW").select("o_orderkey", "o_orderstatus")
    rows = joins.marked_matches(t.lineitem, wanted, ["l_orderkey"], ["o_orderkey"])
    outcome = F.when(F.col(joins.MATCHED), F.lit("com pedido")).otherwise(F.lit("sem pedido"))
    return rows.select("l_orderkey", "l_linenumber", "o_orderstatus", outcome.alias("destino"))


@query(
    """
SELECT o_orderkey, sha256(CAST(c_custkey AS VARCHAR)) AS id_fornecedor, c_mktsegment
FROM orders LEFT JOIN customer ON c_custkey = CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AND c_mktsegment <> 'BUILDING'
"""
)
def nullable_fk(t: Tables) -> DataFrame:
    """Orders with an optional customer; a third has no key, some keys are unknown."""
    orders = t.orders.select("o_orderkey", F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey")).alias("k"))
    known = t.customer.where(F.col("c_mktsegment") != "BUILDING").select(
        "c_custkey", surrogate_key("c_custkey").alias("id"), "c_mktsegment"
    )
    return joins.attach(orders, known, "k", "c_custkey", {"id": "id_fornecedor", "c_mktsegment": "c_mktsegment"}).drop("k")


@query(
    """
SELECT o_orderkey, CAST(sum(CAST(CASE WHEN l_returnflag = 'R' THEN 0 ELSE l_extendedprice END AS DECIMAL(38,2))) AS DOUBLE) AS valor_aditivos
FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
"""
)
def semi_filter_sum(t: Tables) -> DataFrame:
    """Orders of some customers with the total of their lines; NULL where there is no line."""
    builders = t.customer.where(F.col("c_mktsegment") == "BUILDING")
    listed = joins.within_keys(t.orders, "o_custkey", builders, "c_custkey").select("o_orderkey")
    lines = joins.within_keys(t.lineitem, "l_orderkey", listed, "o_orderkey")
    value = F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice"))
    totals = amendment_totals(lines.select("l_orderkey", value.alias("v")), "l_orderkey", "v")
    return listed.join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left").drop("l_orderkey")


@query(
    """
SELECT l_orderkey || '-' || CASE WHEN l_returnflag <> 'N' THEN CAST(l_linenumber AS VARCHAR) END AS id_aditivo,
       coalesce(CASE WHEN l_returnflag = 'A' THEN l_linestatus END, CAST(l_orderkey AS VARCHAR)) AS numero,
       coalesce(nullif(l_tax, 0.0), nullif(l_discount, 0.0)) AS valor, l_partkey, l_suppkey
FROM lineitem
"""
)
def fallback_values(t: Tables) -> DataFrame:
    """Composite ids with a NULL part, filled-else-id numbers, non-zero fallbacks."""
    part = F.when(F.col("l_returnflag") != "N", F.col("l_linenumber").cast("string"))
    tender = F.when(F.col("l_returnflag") == "A", F.col("l_linestatus")).otherwise("  ")
    return t.lineitem.select(
        composite_id("l_orderkey", part).alias("id_aditivo"),
        first_filled(tender, F.col("l_orderkey").cast("string")).alias("numero"),
        truthy_number(F.col("l_tax"), F.col("l_discount")).alias("valor"),
        "l_partkey",
        "l_suppkey",
    )


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'fechada' END AS secretaria_a, o_orderpriority AS secretaria_b FROM orders
"""
)
def whole_column_fallback(t: Tables) -> DataFrame:
    """The first column with any value wins for all rows, even where it is NULL."""
    some = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", "fechada").alias("secretaria"),
        F.when(F.col("o_orderkey") < 0, "x").alias("vazia"),
        F.col("o_orderpriority").alias("orgao"),
    )
    return some.select(
        "o_orderkey",
        first_column_with_values(some, "secretaria", "orgao").alias("secretaria_a"),
        first_column_with_values(some, "vazia", "orgao").alias("secretaria_b"),
    )


@query(
    """
SELECT c_custkey, c_name AS nome, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders) THEN n.valor ELSE c_acctbal END AS valor, n.n AS pedidos
FROM customer LEFT JOIN (SELECT o_custkey, CASE WHEN count(*) > 10 THEN NULL ELSE max(o_totalprice) END AS valor, count(*) AS n FROM orders GROUP BY o_custkey) n
  ON c_custkey = o_custkey
"""
)
def summary_detail_merge(t: Tables) -> DataFrame:
    """Summary rows with their detail: the detail wins, a NULL in it included."""
    summary = t.customer.selectExpr("c_custkey", "c_name as nome", "c_acctbal as valor")
    detail = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.when(F.count("*") > 10, None).otherwise(F.max("o_totalprice")).alias("valor"), F.count("*").alias("pedidos")
    )
    return merge_detail(summary, detail, "c_custkey")


@query(
    """
SELECT c_custkey, 'Macae' AS municipio, CASE WHEN c_nationkey < 10 THEN '3302403' ELSE CAST(c_nationkey AS VARCHAR) END AS municipio_ibge,
       c_acctbal AS valor_inicial, c_name AS objeto, c_mktsegment AS descricao
FROM customer
"""
)
def guarded_rename_and_defaults(t: Tables) -> DataFrame:
    """Renames that must not overwrite, defaults for blank and absent cells."""
    rows = t.customer.selectExpr(
        "c_custkey", "case when c_nationkey < 10 then ' ' else cast(c_nationkey as string) end as municipio_ibge",
        "c_acctbal as valor", "c_name as objeto", "c_mktsegment as descricao",
    )
    renamed = rename_guarded(rows, {"valor": "valor_inicial", "descricao": "objeto", "nada": "x"})
    found = first_containing(renamed.columns, "assunto", "DESCRI")
    assert found == "descricao"
    return with_defaults(renamed, {"municipio_ibge": "3302403", "municipio": "Macae"})


@query(
    """
SELECT o_orderkey, l_linenumber, l_quantity FROM (
  SELECT l_orderkey AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem)
"""
)
def payload_records(t: Tables) -> DataFrame:
    """Record lists inside payload texts, under a preferred, a generic or an unknown key."""
    record = F.to_json(F.struct("l_linenumber", "l_quantity"))
    key = F.expr("case l_returnflag when 'A' then 'Contratos' when 'N' then 'content' else 'qualquer' end")
    envelope = F.when(
        F.col("l_linestatus") == "F", F.concat(F.lit("["), record, F.lit(', 7, "texto"]'))
    ).otherwise(F.concat(F.lit('{"total": 1, "'), key, F.lit('": ['), record, F.lit("]}")))
    payloads = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), envelope.alias("payload"))
    return explode_records(payloads, "payload", "l_linenumber bigint, l_quantity double", preferred=("Contratos",))


@query(
    """
SELECT p_partkey, '{"p_partkey":' || p_partkey || ',"p_brand":"' || p_brand || '","p_size":' || coalesce(CAST(nullif(p_size, 1) AS VARCHAR), 'null') || '}' AS payload_bruto FROM part
"""
)
def raw_record(t: Tables) -> DataFrame:
    """The whole record kept as JSON text, NULLs included."""
    rows = t.part.select("p_partkey", "p_brand", F.nullif("p_size", F.lit(1)).alias("p_size"))
    return rows.select("p_partkey", raw_payload(rows).alias("payload_bruto"))


@query(
    """
SELECT l_suppkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(38,2))) AS DOUBLE) AS valor, coalesce(nullif(max(l_returnflag), ''), max(l_linestatus)) AS marca
FROM lineitem GROUP BY l_suppkey
"""
)
def exact_money_sum(t: Tables) -> DataFrame:
    grouped = t.lineitem.groupBy("l_suppkey").agg(
        exact_sum("l_extendedprice").alias("valor"), F.max("l_returnflag").alias("a"), F.max("l_linestatus").alias("b")
    )
    return grouped.select("l_suppkey", "valor", truthy(F.col("a"), F.col("b")).alias("marca"))
