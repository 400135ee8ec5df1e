"""Parsers over whole tables: values are written as dirty text by Spark, parsed back by the
library, and compared with the original values by the checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro.functions import dates, geo, ids, markup, numbers, status, text
from canteiro.operators.fields import first_overlapping, payload_value, with_payload_maps
from canteiro.plans.works import place_queries
from canteiro.queries.registry import Tables, as_of, day, query
from canteiro.sources.costs import with_reference_cost
from canteiro.sources.files import csv_cells, json_rows, with_cells
from canteiro.sources.geography import perimeter_size
from canteiro.sources.panels import match_locality
from canteiro.sources.portal import about_works


@query(
    """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'R' THEN CASE WHEN l_linestatus = 'F' THEN l_extendedprice END ELSE l_extendedprice END AS valor,
       CASE WHEN l_returnflag = 'A' THEN l_extendedprice END AS valor_br
FROM lineitem
"""
)
def money_parse(t: Tables) -> DataFrame:
    us = F.format_number("l_extendedprice", 2)
    br = F.translate(us, ",.", ".,")
    written = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit("R$ "), br))
        .when(F.col("l_returnflag") == "N", F.concat(F.lit(" $"), us, F.lit(" ")))
        .when(F.col("l_linestatus") == "F", F.replace(us, F.lit(","), F.lit("")))
        .otherwise(F.lit("sem informação"))
    )
    strict = F.when(F.col("l_returnflag") == "A", written).otherwise(F.lit("texto"))
    texts = t.lineitem.select("l_orderkey", "l_linenumber", written.alias("escrito"), strict.alias("estrito"))
    return texts.select(
        "l_orderkey", "l_linenumber", numbers.money("escrito").alias("valor"), numbers.amount("estrito", "br_strict").alias("valor_br")
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_extendedprice AS ultimo_separador, l_extendedprice AS virgula,
       CASE WHEN l_returnflag = 'R' THEN 0.0 ELSE l_extendedprice END AS carga,
       CAST(round(l_discount * 100) AS DOUBLE) AS percentual, CAST(year(l_shipdate) AS BIGINT) AS ano, l_quantity AS estatistica
FROM lineitem
"""
)
def source_number_styles(t: Tables) -> DataFrame:
    us = F.format_number("l_extendedprice", 2)
    br = F.translate(us, ",.", ".,")
    either = F.when(F.col("l_linestatus") == "F", us).otherwise(F.concat(F.lit("R$"), br))
    comma = F.when(F.col("l_linestatus") == "F", F.replace(us, F.lit(","), F.lit(""))).otherwise(br)
    rate = F.concat(F.format_number(F.col("l_discount") * 100, 2), F.lit("%"))
    texts = t.lineitem.select(
        "l_orderkey", "l_linenumber", either.alias("a"), comma.alias("b"),
        F.when(F.col("l_returnflag") == "R", " ").otherwise(comma).alias("c"),
        F.replace(rate, F.lit("."), F.lit(",")).alias("d"), F.date_format("l_shipdate", "'ano' yyyy").alias("e"),
        F.replace(F.format_number("l_quantity", 1), F.lit("."), F.lit(",")).alias("f"),
    )
    return texts.select(
        "l_orderkey",
        "l_linenumber",
        numbers.amount("a", "last_separator").alias("ultimo_separador"),
        numbers.amount("b", "comma_decimal").alias("virgula"),
        numbers.amount("c", "dump").alias("carga"),
        numbers.percent("d").alias("percentual"),
        numbers.integer("e").alias("ano"),
        numbers.statistic("f").alias("estatistica"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' AND day(l_shipdate) > 12 THEN NULL
            WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN strftime(make_date(year(l_shipdate), day(l_shipdate), month(l_shipdate)), '%Y-%m-%d')
            ELSE strftime(l_shipdate, '%Y-%m-%d') END AS dia,
       strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS mes
FROM lineitem
"""
)
def date_parse(t: Tables) -> DataFrame:
    """Day-first, year-first, epoch and month-first texts; month-first is read day-first or not at all."""
    shipped, flag, line = F.col("l_shipdate").cast("timestamp"), F.col("l_returnflag"), F.col("l_linestatus")
    written = (
        F.when((flag == "A") & (line == "F"), F.date_format(shipped, "dd/MM/yyyy HH:mm:ss"))
        .when(flag == "A", F.date_format(shipped, "d-M-yyyy"))
        .when((flag == "N") & (line == "F"), F.date_format(shipped, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(flag == "N", F.unix_millis(shipped).cast("string"))
        .when(line == "F", F.date_format(shipped, "MM/dd/yyyy"))
        .otherwise(F.unix_seconds(shipped).cast("string"))
    )
    names = F.array(*[F.lit(name) for name in dates.vocab.MONTHS])
    month = F.concat(F.initcap(F.get(names, F.month(shipped) - 1)), F.lit("/"), F.year(shipped))
    texts = t.lineitem.select("l_orderkey", "l_linenumber", written.alias("escrito"), month.alias("mes_escrito"))
    return texts.select(
        "l_orderkey",
        "l_linenumber",
        day(dates.parse_timestamp("escrito")).alias("dia"),
        day(dates.month_and_year("mes_escrito")).alias("mes"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber,
       CAST(l_quantity AS BIGINT) * CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 30 ELSE 365 END AS dias,
       strftime(l_shipdate + to_days(CAST(CAST(l_quantity AS BIGINT) * CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 30 ELSE 365 END AS INTEGER)), '%Y-%m-%d') AS termino
FROM lineitem
"""
)
def duration_days(t: Tables) -> DataFrame:
    unit = F.when(F.col("l_returnflag") == "A", " dias").when(F.col("l_returnflag") == "N", "MESES").otherwise(" Anos")
    written = F.concat(F.lit("prazo: "), F.col("l_quantity").cast("bigint").cast("string"), unit)
    texts = t.lineitem.select(
        "l_orderkey", "l_linenumber", written.alias("prazo"), F.col("l_shipdate").cast("timestamp").alias("inicio")
    )
    return texts.select(
        "l_orderkey", "l_linenumber", dates.duration_days("prazo").alias("dias"),
        day(dates.expected_end("prazo", "inicio")).alias("termino"),
    )


@query(
    """
WITH d AS (
  SELECT DISTINCT l_partkey, l_suppkey, lpad(CAST(l_partkey AS VARCHAR), 8, '7') || lpad(CAST(l_suppkey AS VARCHAR), 4, '0')
         || lpad(CAST((l_partkey * 7 + l_suppkey) % 100 AS VARCHAR), 2, '0') AS n FROM lineitem),
a AS (
  SELECT *, list_transform(range(1, 15), lambda i: CAST(substr(n, i, 1) AS INTEGER)) AS g FROM d),
b AS (
  SELECT *, list_sum(list_transform(range(1, 13), lambda i: g[i] * [5,4,3,2,9,8,7,6,5,4,3,2][i])) % 11 AS r1 FROM a),
c AS (
  SELECT *, CASE WHEN r1 < 2 THEN 0 ELSE 11 - r1 END AS c1 FROM b),
e AS (
  SELECT *, (list_sum(list_transform(range(1, 13), lambda i: g[i] * [6,5,4,3,2,9,8,7,6,5,4,3][i])) + c1 * 2) % 11 AS r2 FROM c)
SELECT l_partkey, l_suppkey,
       CASE WHEN g[13] = c1 AND g[14] = CASE WHEN r2 < 2 THEN 0 ELSE 11 - r2 END THEN n END AS cnpj,
       n AS digitos
FROM e
"""
)
def tax_id_check(t: Tables) -> DataFrame:
    base = F.lpad(F.col("l_partkey").cast("string"), 8, "7")
    branch = F.lpad(F.col("l_suppkey").cast("string"), 4, "0")
    check = F.lpad(((F.col("l_partkey") * 7 + F.col("l_suppkey")) % 100).cast("string"), 2, "0")
    written = F.concat(
        F.substring(base, 1, 2), F.lit("."), F.substring(base, 3, 3), F.lit("."), F.substring(base, 6, 3),
        F.lit("/"), branch, F.lit("-"), check,
    )
    pairs = t.lineitem.select("l_partkey", "l_suppkey").distinct().withColumn("escrito", written)
    return pairs.select(
        "l_partkey", "l_suppkey", ids.company_tax_id("escrito").alias("cnpj"), text.digits_only("escrito").alias("digitos")
    )


@query(
    """
SELECT doc_id, md5(trim(strip_accents(lower(text)), ' ' || chr(9) || chr(10) || chr(13))) AS dobrado,
       lang = 'fr' AS francesa
FROM documents
"""
)
def fold_match(t: Tables) -> DataFrame:
    """Folding of whole texts, and an accent-blind equality."""
    spelled = F.when(F.col("lang") == "fr", " FRANÇÊS ").otherwise(F.col("lang"))
    return t.documents.select(
        "doc_id", F.md5(text.fold("text")).alias("dobrado"), text.same_text(spelled, "frances").alias("francesa")
    )


@query(
    """
SELECT doc_id, lang FROM documents
WHERE lower(text) LIKE '%obra%' OR lower(text) LIKE '%construção%' OR lower(text) LIKE '%reforma%' OR lower(text) LIKE '%ampliação%'
   OR lower(text) LIKE '%pavimentação%' OR lower(text) LIKE '%drenagem%' OR lower(text) LIKE '%saneamento%'
   OR lower(text) LIKE '%urbanização%' OR lower(text) LIKE '%infraestrutura%' OR lower(text) LIKE '%recapeamento%'
   OR lower(text) LIKE '%iluminação%' OR lower(text) LIKE '%edificação%' OR lower(text) LIKE '%galeria%'
   OR lower(text) LIKE '%tion%' OR lower(text) LIKE '%éré%'
"""
)
def keyword_filter(t: Tables) -> DataFrame:
    """Works keywords plus two fragments that occur in the given texts."""
    keywords = (*text.vocab.WORKS_KEYWORDS, "tion", "éré")
    return t.documents.where(text.mentions_works("text", keywords)).select("doc_id", "lang")


_RAW_STATUS = (
    "case o_orderpriority when '1-URGENT' then case o_orderstatus when 'O' then ' Em Execução ' when 'F' then 'CONCLUÍDA' else 'prazo expirado' end "
    "when '2-HIGH' then case o_orderstatus when 'O' then 'Vigente' when 'F' then 'Entregue' else 'Em vistoria' end "
    "when '3-MEDIUM' then case o_orderstatus when 'O' then 'não iniciada' when 'F' then 'N/A' else 'Suspensa/Paralisada' end "
    "when '5-LOW' then case o_orderstatus when 'O' then 'cancelado' when 'F' then 'undefined' else 'concluida ' end end"
)
_STATUS_CASE = """
CASE o_orderpriority
  WHEN '1-URGENT' THEN CASE o_orderstatus WHEN 'O' THEN 'Em andamento' WHEN 'F' THEN 'Concluída' ELSE 'Rescindida' END
  WHEN '2-HIGH' THEN CASE o_orderstatus WHEN 'O' THEN 'Em andamento' WHEN 'F' THEN 'Concluída' ELSE 'Em vistoria' END
  WHEN '3-MEDIUM' THEN CASE o_orderstatus WHEN 'O' THEN 'Em fase de planejamento' WHEN 'F' THEN 'Indefinido' ELSE 'Paralisada' END
  WHEN '5-LOW' THEN CASE o_orderstatus WHEN 'O' THEN 'Cancelada' WHEN 'F' THEN 'Indefinido' ELSE 'Concluída' END
  ELSE 'Indefinido' END"""


@query(f"SELECT o_orderkey, {_STATUS_CASE} AS situacao FROM orders")
def status_normalised(t: Tables) -> DataFrame:
    raw = t.orders.selectExpr("o_orderkey", f"{_RAW_STATUS} as bruto")
    return raw.select("o_orderkey", status.official_status("bruto").alias("situacao"))


@query(
    """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_returnflag = 'A' THEN 'Rescindido pela parte' WHEN l_linestatus = 'F' THEN 'Indefinido'
            WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'Expirado' ELSE 'Vigente' END AS situacao
FROM lineitem
"""
)
def status_by_end_date(t: Tables) -> DataFrame:
    end = F.when(F.col("l_linestatus") != "F", F.col("l_shipdate").cast("timestamp"))
    given = F.when(F.col("l_returnflag") == "A", "Rescindido pela parte").when(F.col("l_returnflag") == "N", "NaN")
    return t.lineitem.select("l_orderkey", "l_linenumber", status.contract_status(given, end, as_of()).alias("situacao"))


@query(
    """
SELECT o_orderkey, coalesce(CASE o_orderstatus WHEN 'F' THEN 'Deserta' END, CASE WHEN o_orderpriority < '3' THEN 'Homologada' ELSE 'Indefinido' END) AS licitacao,
       o_orderpriority IN ('1-URGENT', '5-LOW') AS concluido, o_orderpriority IN ('2-HIGH', '4-NOT SPECIFIED') AS cancelado
FROM orders
"""
)
def published_statuses(t: Tables) -> DataFrame:
    """Tender status with fallback, and the settled and cancelled tests of agreements."""
    agreement = F.expr(
        "case o_orderpriority when '1-URGENT' then 'Prestação de Contas Aprovada' when '2-HIGH' then 'Convênio Anulado' "
        "when '4-NOT SPECIFIED' then 'CANCELADO após aprovado' when '5-LOW' then 'Concluído' end"
    )
    opinion = F.when(F.col("o_orderstatus") == "F", "Deserta")
    approved = F.when(F.col("o_orderpriority") < "3", F.col("o_orderdate"))
    return t.orders.select(
        "o_orderkey",
        status.tender_status(opinion, approved).alias("licitacao"),
        status.agreement_settled(agreement).alias("concluido"),
        status.agreement_cancelled(agreement).alias("cancelado"),
    )


_SPANS_SQL = """
WITH s AS (SELECT l_orderkey, max(l_shipdate) AS fim FROM lineitem GROUP BY l_orderkey),
w AS (
  SELECT o_orderkey, o_orderdate AS ini, o_orderdate + INTERVAL 900 DAY AS prazo,
         CASE WHEN o_orderstatus = 'F' THEN fim END AS fim, o_orderstatus, o_orderpriority
  FROM orders LEFT JOIN s ON l_orderkey = o_orderkey)
"""


def _spans(t: Tables) -> DataFrame:
    """Orders as works: start, deadline, and the last ship date as completion."""
    last = t.lineitem.groupBy("l_orderkey").agg(F.max("l_shipdate").alias("entrega"))
    joined = t.orders.join(last, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.selectExpr(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "cast(o_orderdate as timestamp) as ini",
        "cast(o_orderdate + interval 900 days as timestamp) as prazo",
        "cast(case when o_orderstatus = 'F' then entrega end as timestamp) as fim",
    )


@query(
    _SPANS_SQL
    + """SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW'
  THEN greatest(0, date_diff('day', prazo, coalesce(fim, TIMESTAMP '2000-01-01'))) END AS dias_atraso FROM w"""
)
def delay_days(t: Tables) -> DataFrame:
    deadline = F.when(F.col("o_orderpriority") != "5-LOW", F.col("prazo"))
    return _spans(t).select("o_orderkey", dates.delay_days(deadline, "fim", as_of()).alias("dias_atraso"))


@query(
    _SPANS_SQL
    + """SELECT o_orderkey,
  CASE o_orderstatus
    WHEN 'F' THEN CASE o_orderpriority WHEN '2-HIGH' THEN 35.0 ELSE 100.0 END
    WHEN 'P' THEN CASE o_orderpriority WHEN '2-HIGH' THEN 35.0 WHEN '3-MEDIUM' THEN 0.0 ELSE 0.0 END
    ELSE CASE o_orderpriority WHEN '2-HIGH' THEN 35.0 WHEN '1-URGENT' THEN 0.0
         ELSE least(99.0, round_even(CAST(date_diff('day', ini, TIMESTAMP '2000-01-01') AS DOUBLE) / 900 * 100, 1)) END
  END AS percentual FROM w"""
)
def percent_complete(t: Tables) -> DataFrame:
    given = F.expr("case o_orderpriority when '2-HIGH' then 35.0D when '3-MEDIUM' then -1.0D when '1-URGENT' then 0.0D end")
    state = F.expr("case o_orderstatus when 'F' then 'Concluída' when 'P' then 'Cancelada' else 'Em andamento' end")
    return _spans(t).select(
        "o_orderkey", dates.percent_complete(state, given, "ini", "prazo", as_of()).alias("percentual")
    )


@query(
    _SPANS_SQL
    + """SELECT o_orderkey, o_orderstatus FROM w
WHERE (o_orderstatus = 'O' OR prazo >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY OR ini >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY)
  AND o_orderstatus <> 'F'"""
)
def active_works(t: Tables) -> DataFrame:
    state = F.expr("case o_orderstatus when 'F' then 'Obra CONCLUÍDA' when 'O' then 'Em Execução' end")
    return _spans(t).where(status.is_active_work(state, "prazo", "ini", as_of())).select("o_orderkey", "o_orderstatus")


@query(
    """
SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus FROM lineitem
WHERE l_discount > 0 OR l_returnflag = 'A' OR (l_returnflag = 'N' AND l_linestatus = 'F')
"""
)
def amended_agreements(t: Tables) -> DataFrame:
    count = F.format_number(F.col("l_discount") * 100, 0)
    dated = F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), "2000-01-01").otherwise("null")
    flag = F.when(F.col("l_returnflag") == "A", "Convênio ADITIVÁDO").otherwise("Original")
    texts = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", count.alias("n"), dated.alias("d"), flag.alias("f")
    )
    return texts.where(status.has_amendment("n", F.lit("0,00"), "d", "f")).drop("n", "d", "f")


@query(
    """
SELECT l_orderkey, l_linenumber,
       round_even(l_tax / nullif(l_discount, 0) * 100, 2) AS financeiro,
       CASE WHEN l_returnflag = 'A' THEN 12.5
            WHEN l_discount <> 0 AND l_tax IS NOT NULL THEN least(99.0, round_even(l_tax / l_discount * 100, 1)) END AS paralisada
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, nullif(l_tax, 0) AS l_tax, l_discount FROM lineitem)
"""
)
def derived_percents(t: Tables) -> DataFrame:
    """Executed share of a contract, and the capped paid share of a stopped work."""
    given = F.when(F.col("l_returnflag") == "A", F.lit(12.5))
    paid = F.nullif(F.col("l_tax"), F.lit(0.0))
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        numbers.financial_percent("l_tax", "l_discount").alias("financeiro"),
        numbers.stopped_work_percent(given, paid, "l_discount").alias("paralisada"),
    )


@query(
    """
SELECT c_custkey,
       CASE WHEN c_custkey % 3 = 0 THEN upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || ' Velho' END AS bairro,
       CASE WHEN c_custkey % 3 = 1 THEN 'RUA ' || c_mktsegment END AS endereco,
       CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment || '  velho' END AS trecho
FROM customer
"""
)
def places_in_text(t: Tables) -> DataFrame:
    """District and street named in an object text."""
    written = F.expr(
        "case c_custkey % 3 when 0 then concat('REFORMA NO bairro do ', c_mktsegment, '  velho, MACAÉ/RJ') "
        "when 1 then concat('obra localizada na RUA ', c_mktsegment, ' MACAÉ/RJ') else 'compra de papel' end"
    )
    loose = F.expr("case c_custkey % 3 when 0 then concat('BAIRRO ', c_mktsegment, '  velho Macaé, x') end")
    return t.customer.select(
        "c_custkey",
        text.district_in_text(written).alias("bairro"),
        text.street_in_text(written).alias("endereco"),
        text.district_after_word(loose).alias("trecho"),
    )


@query(
    """
SELECT c_custkey, CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS latitude,
       CASE WHEN c_nationkey <> 0 THEN 'POINT(' || CAST(lon AS VARCHAR) || ' ' || CAST(lat AS VARCHAR) || ')' END AS geometria,
       lat BETWEEN -22.65 AND -22.05 AND lon BETWEEN -42.15 AND -41.55 AS dentro,
       CASE WHEN c_nationkey <> 0 THEN lat END AS lat_texto, CASE WHEN c_nationkey <> 0 THEN lon END AS lon_texto
FROM (SELECT c_custkey, c_nationkey, CAST((c_custkey * 7) % 200 - 100 AS DOUBLE) + 0.75 AS lat,
             CAST((c_custkey * 3) % 200 - 100 AS DOUBLE) + 0.25 AS lon FROM customer)
"""
)
def wkt_point(t: Tables) -> DataFrame:
    points = t.customer.selectExpr(
        "c_custkey", "c_nationkey", "cast((c_custkey * 7) % 200 - 100 as double) + 0.75D as lat",
        "cast((c_custkey * 3) % 200 - 100 as double) + 0.25D as lon",
    )
    known = F.when(F.col("c_nationkey") != 0, F.col("lat"))
    written = F.concat(F.col("lon").cast("string"), F.when(F.col("c_nationkey") != 0, ",").otherwise(";"), F.col("lat").cast("string"))
    latitude, longitude = geo.point_from_text(F.concat(written, F.lit(",0")))
    return points.select(
        "c_custkey",
        geo.latitude_or_null("lat").alias("latitude"),
        geo.wkt_point(known, "lon").alias("geometria"),
        geo.in_bounding_box("lat", "lon").alias("dentro"),
        latitude.alias("lat_texto"),
        longitude.alias("lon_texto"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN -(g + m / 60 + s / 3600) WHEN 'N' THEN g + m / 60 + s / 3600 ELSE -g - 0.5 END AS coordenada
FROM (SELECT l_orderkey, l_linenumber, l_returnflag, CAST(l_partkey % 90 AS DOUBLE) AS g, l_quantity AS m, CAST(l_suppkey % 60 AS DOUBLE) AS s FROM lineitem)
"""
)
def dms_coordinates(t: Tables) -> DataFrame:
    parts = F.concat_ws(
        ".", (F.col("l_partkey") % 90).cast("string"), F.col("l_quantity").cast("int").cast("string"),
        (F.col("l_suppkey") % 60).cast("string"),
    )
    written = (
        F.when(F.col("l_returnflag") == "A", F.concat(parts, F.lit(".s")))
        .when(F.col("l_returnflag") == "N", F.concat(F.replace(parts, F.lit("."), F.lit("° ")), F.lit('" N')))
        .otherwise(F.concat(F.lit("-"), (F.col("l_partkey") % 90).cast("string"), F.lit(",5")))
    )
    texts = t.lineitem.select("l_orderkey", "l_linenumber", written.alias("escrito"))
    return texts.select("l_orderkey", "l_linenumber", geo.coordinate("escrito").alias("coordenada"))


@query(
    """
SELECT page_id, md5(replace(replace(replace(replace(txt, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'), '&amp;', '&')) AS texto
FROM (
  SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html,
     '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<![a-z][^>]*>', ' ', 'g'),
     '(?s)</?[a-zA-Z][^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS txt FROM pages)
"""
)
def page_text(t: Tables) -> DataFrame:
    """Visible text of whole pages, blanks squeezed."""
    return t.pages.select("page_id", F.md5(F.regexp_replace(markup.html_text("html"), r"\s+", " ")).alias("texto"))


@query(
    """
SELECT p_partkey, p_brand AS marca, CAST(p_size AS VARCHAR) AS tamanho, p_type AS linha,
       CASE p_type WHEN 'ECONOMY' THEN 'concluída' WHEN 'SMALL' THEN 'em andamento' WHEN 'PROMO' THEN 'paralisada'
                   WHEN 'STANDARD' THEN 'planejada' ELSE 'em andamento' END AS situacao
FROM part
"""
)
def attribute_map(t: Tables) -> DataFrame:
    """Attribute tables and lines of marker descriptions, and the status drawn from them."""
    state = F.expr(
        "case p_type when 'ECONOMY' then 'Finalizada' when 'SMALL' then 'Em execução' when 'PROMO' then 'Suspensa' "
        "when 'STANDARD' then 'Em projeto' end"
    )
    row = "<tr><td>%s</td><td> %s </td></tr>"
    table = F.concat(
        F.lit("<p>x</p><table>"),
        F.format_string(row, F.lit("Marca <b>do item</b>"), "p_brand"),
        F.format_string(row, F.lit("Tamanho"), F.lit("0")),
        F.format_string(row, F.lit("TAMANHO"), "p_size"),
        F.format_string(row, F.lit("Linha"), "p_type"),
        F.coalesce(F.format_string(row, F.lit("OBRA"), F.nullif(state, F.lit(""))), F.lit("")),
        F.lit("</table>"),
    )
    lines = F.concat_ws(
        "<br>", F.concat(F.lit("Marca do item: "), "p_brand"), F.concat(F.lit("tamanho : "), "p_size"),
        F.concat(F.lit("Linha: "), "p_type"), F.concat(F.lit("obra: "), state),
    )
    html = F.when(F.col("p_size") > 25, table).otherwise(lines)
    described = t.part.select("p_partkey", html.alias("html"))
    parsed = described.select("p_partkey", markup.html_attributes("html").alias("m"))
    layer = F.lit("Obras em curso")
    return parsed.select(
        "p_partkey",
        markup.attribute(F.col("m"), "fabricante", "MARCA").alias("marca"),
        markup.attribute(F.col("m"), "tamanho").alias("tamanho"),
        markup.attribute(F.col("m"), "linha").alias("linha"),
        status.marker_status(F.col("m"), F.lit("icon-gray"), layer).alias("situacao"),
    )


@query(
    """
SELECT event_id, json_extract_string(props, '$.k') AS externo, event_type AS interno, CAST(user_id AS VARCHAR) AS dobrado
FROM events
"""
)
def json_payload(t: Tables) -> DataFrame:
    """Values found in a kept record, and in the record nested inside it."""
    inner = F.to_json(F.struct(F.col("event_type").alias("tipo"), F.col("user_id").alias("Nº Usuário")))
    outer = F.concat(
        F.substring("props", 1, F.length("props") - 1), F.lit(', "payload_bruto": '), F.to_json(F.struct(inner.alias("x"))), F.lit("}")
    )
    nested = F.regexp_replace(outer, r'"payload_bruto": \{"x":(.*)\}\}$', '"payload_bruto": $1}')
    kept = with_payload_maps(t.events.select("event_id", nested.alias("registro")), "registro")
    return kept.select(
        "event_id",
        payload_value("zz", "k").alias("externo"),
        payload_value("tipo").alias("interno"),
        payload_value("nº usuario").alias("dobrado"),
    )


@query(
    """
SELECT p_partkey,
  CASE WHEN t LIKE '%ubs%' THEN 'ubs' WHEN t LIKE '%upa%' THEN 'upa' WHEN t LIKE '%caps%' THEN 'caps' WHEN t LIKE '%hospital%' THEN 'ubs'
       WHEN t LIKE '%creche%' OR t LIKE '%colegio%' OR t LIKE '%escola%' THEN 'escola' WHEN t LIKE '%drenagem%' THEN 'drenagem'
       WHEN t LIKE '%praca%' THEN 'praca_urbanizacao' WHEN t LIKE '%construcao%' THEN 'residencial_normal' ELSE 'padrao' END AS categoria_custo,
  CAST(CASE WHEN t LIKE '%ubs%' THEN 3200 WHEN t LIKE '%upa%' THEN 3500 WHEN t LIKE '%caps%' THEN 3000 WHEN t LIKE '%hospital%' THEN 3200
       WHEN t LIKE '%creche%' OR t LIKE '%colegio%' OR t LIKE '%escola%' THEN 2800 WHEN t LIKE '%drenagem%' THEN 380
       WHEN t LIKE '%praca%' THEN 800 WHEN t LIKE '%construcao%' THEN 2400 ELSE 2000 END AS DOUBLE) AS custo_m2_referencia
FROM (SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'construcao de escola' WHEN 'SMALL' THEN 'praca' WHEN 'PROMO' THEN 'hospital'
                        WHEN 'STANDARD' THEN 'construcao' ELSE lower(p_name) END AS t FROM part)
"""
)
def substring_category(t: Tables) -> DataFrame:
    tipo = F.expr(
        "case p_type when 'ECONOMY' then 'CONSTRUÇÃO de Escola' when 'SMALL' then 'Praça' when 'PROMO' then 'Hospital' "
        "when 'STANDARD' then 'Construção' else p_name end"
    )
    return with_reference_cost(t.part.select("p_partkey", tipo.alias("tipo"))).drop("tipo")


@query(
    """
SELECT c_custkey, CASE WHEN c_nationkey > 5 THEN 'Rua ' || c_name || CASE WHEN c_mktsegment <> 'BUILDING' THEN ', ' || c_mktsegment ELSE '' END || ', Macaé, RJ, Brasil' END AS completa,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment || ', Macaé, RJ, Brasil' END AS bairro
FROM customer
"""
)
def place_query_texts(t: Tables) -> DataFrame:
    """Gazetteer queries of a street and a district, most precise first."""
    street = F.when(F.col("c_nationkey") > 5, F.concat(F.lit("Rua "), "c_name")).otherwise("")
    district = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    full, area = place_queries(street, district)
    return t.customer.select("c_custkey", full.alias("completa"), area.alias("bairro"))


@query(
    """
SELECT max('São ' || c_mktsegment || '/RJ') AS localidade, arg_max(c_custkey, lpad(CAST(-1 * c_custkey + 1000000000 AS VARCHAR), 12, '0')) AS menor
FROM customer WHERE c_mktsegment = 'BUILDING'
"""
)
def locality_match(t: Tables) -> DataFrame:
    """Best spelling of a locality among all candidates: accented before plain."""
    accented = t.customer.groupBy("c_mktsegment").agg(F.min("c_custkey").alias("menor")).select(
        F.concat(F.lit("São "), "c_mktsegment", F.lit("/RJ")).alias("localidade"), "menor"
    )
    plain = accented.select(F.upper(F.translate("localidade", "ã", "a")).alias("localidade"), F.lit(-1).cast("bigint").alias("menor"))
    return match_locality(accented.unionByName(plain), "localidade", "sao building")


@query(
    """
SELECT vec_id, CAST(CASE WHEN label % 2 = 0 THEN 2 * len(embedding) + 1 ELSE 3 * len(embedding) END AS BIGINT) AS pontos FROM embeddings
"""
)
def perimeter_points(t: Tables) -> DataFrame:
    """Ring points of perimeters: one polygon with a hole, or several parts."""
    ring = F.transform("embedding", lambda x: F.array(x, x))
    one = F.array(F.array(F.lit(0.0).cast("float"), F.lit(0.0).cast("float")))
    shapes = t.embeddings.select(
        "vec_id",
        F.when(F.col("label") % 2 == 0, F.array(ring, F.concat(ring, one))).alias("polygon"),
        F.when(F.col("label") % 2 != 0, F.array(F.array(ring), F.array(ring, ring))).alias("multi_polygon"),
    )
    return perimeter_size(shapes)


@query(
    """
SELECT o_orderkey, NULL::VARCHAR AS motivo, CAST(o_orderkey AS VARCHAR) AS a, o_orderpriority || ';' || chr(10) || '"' || o_orderstatus || '"' AS b, CASE WHEN o_custkey % 5 <> 0 THEN CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR END AS c
FROM orders WHERE o_custkey % 5 <> 1
UNION ALL SELECT o_orderkey, 'células demais', o_orderkey || ';"' || o_orderpriority || ';' || chr(10) || '""' || o_orderstatus || repeat('"', 3) || ';' || CAST(o_totalprice AS DECIMAL(18,2)) || ';extra', NULL, NULL
FROM orders WHERE o_custkey % 5 = 1
"""
)
def csv_records(t: Tables) -> DataFrame:
    """CSV records with quoted separators, quotes and line breaks; short ones are padded, long ones rejected."""
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    record = F.concat(
        F.col("o_orderkey").cast("string"),
        F.lit(';"'),
        "o_orderpriority",
        F.lit(';\n""'),
        "o_orderstatus",
        F.lit('"""'),
        F.when(F.col("o_custkey") % 5 == 0, "").otherwise(F.concat(F.lit(";"), price)),
        F.when(F.col("o_custkey") % 5 == 1, ";extra").otherwise(""),
    )
    records = t.orders.select("o_orderkey", record.alias("registro"))
    rows, rejects = with_cells(records.withColumn("cells", csv_cells("registro", ";")), "cells", ["a", "b", "c"])
    nothing = F.lit(None).cast("string")
    return rows.select("o_orderkey", nothing.alias("motivo"), "a", "b", "c").unionByName(
        rejects.select(
            "o_orderkey", F.lit("células demais").alias("motivo"), F.col("registro").alias("a"), nothing.alias("b"), nothing.alias("c")
        )
    )


@query(
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN '{broken ' || event_id END AS motivo, CASE WHEN event_type <> 'error' THEN user_id END AS usuario,
  CASE WHEN event_type NOT IN ('error', 'view') THEN event_type END AS tipo FROM events
"""
)
def json_records(t: Tables) -> DataFrame:
    """JSON records of a text column; a text that is no record is rejected with its text."""
    texts = t.events.selectExpr(
        "event_id",
        "case event_type when 'error' then concat('{broken ', event_id) when 'view' then to_json(named_struct('usuario', user_id)) "
        "else to_json(named_struct('usuario', user_id, 'tipo', event_type)) end as texto",
    )
    rows, rejects = json_rows(texts, "texto", T.StructType.fromDDL("usuario long, tipo string"))
    lost = rejects.select("event_id", F.col("texto").alias("motivo"))
    return rows.withColumn("motivo", F.lit(None).cast("string")).unionByName(lost, allowMissingColumns=True)


@query(
    """
SELECT c_custkey, 'ACAO ' || c_mktsegment || ' X' AS maiusculas, CAST(c_nationkey AS DOUBLE) + 0.5 AS numero, CAST(c_custkey AS BIGINT) AS inteiro,
  CASE WHEN c_nationkey * 10 + 0.5 <= 180 THEN -(c_nationkey * 10 + 0.5) END::DOUBLE AS longitude, 'DRENAGEM ' || c_name AS objeto
FROM customer WHERE c_nationkey % 3 = 0
"""
)
def loose_texts(t: Tables) -> DataFrame:
    """Column found by an overlapping name, works keywords, squeezed capitals, and numbers among other signs."""
    rows = t.customer.selectExpr(
        "c_custkey",
        "concat('  Ação ', c_mktsegment, '   x ') as titulo",
        "concat('R$ ', c_nationkey, ',5 mil') as valor",
        "concat(' ', c_custkey, '.75') as codigo",
        "-(c_nationkey * 10D + 0.5D) as lon",
        "case when c_nationkey % 3 = 0 then concat('DRENAGEM ', c_name) else concat('Compra ', c_custkey) end as `Objeto da Compra`",
    )
    found = first_overlapping(rows.columns, "Objeto")
    works = about_works(rows.withColumnRenamed(found, "objeto"))
    return works.select(
        "c_custkey",
        text.fold_upper("titulo").alias("maiusculas"),
        numbers.loose_number("valor").alias("numero"),
        numbers.to_long("codigo").alias("inteiro"),
        geo.longitude_or_null("lon").alias("longitude"),
        "objeto",
    )
