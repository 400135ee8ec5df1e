"""Source records derived from the given tables, through the normaliser of each source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canteiro.functions.text import slug
from canteiro.operators.dedup import with_source_position
from canteiro.operators.records import parsed_records
from canteiro.plans.cleaning import clean
from canteiro.plans.ingest import raw_rows
from canteiro.queries.registry import Tables, as_of, day, query
from canteiro.routes import ROUTES
from canteiro.sources import court, federal, georef, health, panels, portal
from canteiro.sources.files import matrix_records, placemarks_in


def _br(column: str) -> str:
    """SQL for an amount in Brazilian notation."""
    return f"translate(format_number({column}, 2), ',.', '.,')"


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id_contrato, o_orderpriority AS objeto, o_totalprice AS valor,
  CASE WHEN o_custkey % 4 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS cnpj_fornecedor, strftime(o_orderdate, '%Y-%m-%d') AS inicio,
  CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate + INTERVAL 300 DAY, '%Y-%m-%d') END AS fim,
  CASE WHEN o_custkey % 2 <> 0 THEN 'Indefinido' WHEN o_orderdate + INTERVAL 300 DAY < TIMESTAMP '2000-01-01' THEN 'Expirado' ELSE 'Vigente' END AS situacao,
  300 AS prazo_dias, 'portal_transparencia_macae_contratos' AS fonte, 'L' || o_custkey AS num_licitacao, 'Pregão' AS modalidade_licitacao
FROM orders
"""
)
def portal_contracts(t: Tables) -> DataFrame:
    export = t.orders.selectExpr(
        "cast(o_orderkey as string) as Contrato", "concat('  ', o_orderpriority) as Objeto", "date_format(o_orderdate, 'dd/MM/yyyy') as `Início`",
        "case when o_custkey % 2 = 0 then date_format(o_orderdate + interval 300 days, 'dd/MM/yyyy') end as Fim", "'SEMOB' as `Unidade Gestora`",
        "'1º Aditivo' as Aditivo", "case when o_custkey % 4 <> 0 then cast(o_custkey as string) else 'nan' end as CNPJ", "'Pregão' as `Modalidade de Licitação`",
        "concat('L', o_custkey) as `Nº Licitacao`", "'10 MESES' as Prazo", f"concat('R$ ', {_br('o_totalprice')}) as Valor",
    )
    rows = portal.contracts(export, as_of())
    return rows.select(
        "id_contrato", "objeto", "valor", "cnpj_fornecedor", day("data_assinatura").alias("inicio"), day("data_vigencia_fim").alias("fim"),
        "situacao", F.col("prazo_dias").cast("int").alias("prazo_dias"), "fonte", "num_licitacao", "modalidade_licitacao",
    )


@query(
    """
SELECT CAST(doc_id AS VARCHAR) AS id_licitacao, lang AS modalidade, CAST(n_chars AS DOUBLE) AS valor_estimado, source AS status, md5(trim(text, ' ' || chr(10))) AS objeto
FROM documents
"""
)
def portal_tenders(t: Tables) -> DataFrame:
    export = t.documents.selectExpr(
        "cast(doc_id as string) as `Número`", "text as Objeto", "lang as Modalidade", "concat(source, ' ') as `Situação`",
        f"concat('R$ ', {_br('n_chars')}) as `Valor Estimado`",
    )
    rows = portal.tenders(export, as_of())
    return rows.select("id_licitacao", "modalidade", "valor_estimado", "status", F.md5("objeto").alias("objeto"))


@query(
    """
SELECT coalesce(CASE WHEN o_orderstatus <> 'F' THEN CAST(o_orderkey AS VARCHAR) END, 'P' || o_orderkey) AS id_contrato, o_totalprice AS valor_contrato,
  CAST(o_custkey AS VARCHAR) AS cnpj_cpf_contratado, strftime(o_orderdate, '%Y-%m-%d') AS assinatura,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'Indefinido' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'Expirado' ELSE 'Vigente' END AS situacao
FROM orders WHERE o_orderstatus <> 'P'
"""
)
def court_contracts(t: Tables) -> DataFrame:
    records = t.orders.selectExpr(
        "case when o_orderstatus <> 'P' then ' MACAÉ' else 'Rio das Ostras' end as Ente",
        "case when o_orderstatus <> 'F' then cast(o_orderkey as string) else '' end as NumeroContrato", "concat('P', o_orderkey) as ProcessoLicitatorio",
        f"{_br('o_totalprice')} as ValorContrato", "cast(o_custkey as string) as CNPJCPFContratado",
        "cast(unix_millis(cast(o_orderdate as timestamp)) as string) as DataAssinaturaContrato",
        "case when o_orderpriority <> '5-LOW' then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") end as DataVencimentoContrato",
    )
    rows = court.contracts(court.of_municipality(records, "Ente"), as_of())
    return rows.select(
        "id_contrato", "valor_contrato", "cnpj_cpf_contratado", day("data_assinatura").alias("assinatura"), "situacao"
    )


@query(
    """
SELECT CASE WHEN l_linestatus = 'F' THEN l_orderkey || '-' || year(l_shipdate) END AS id_aditivo, l_extendedprice AS valor_convenio,
  CAST(CASE WHEN l_returnflag = 'A' THEN 2 ELSE 0 END AS DOUBLE) AS quantidade_aditivos, strftime(l_shipdate, '%Y-%m-%d') AS assinatura
FROM lineitem WHERE l_returnflag IN ('A', 'N')
"""
)
def court_amendments(t: Tables) -> DataFrame:
    records = t.lineitem.selectExpr(
        "cast(l_orderkey as string) as NumeroConvenio", "case when l_linestatus = 'F' then cast(year(l_shipdate) as string) end as AnoConvenio",
        "case when l_returnflag = 'A' then '2' else '0' end as QuantidadeAditivos", "case when l_returnflag = 'N' then 'Aditivo' else 'Convênio' end as ComvenioAditivo",
        f"{_br('l_extendedprice')} as Valor", "date_format(l_shipdate, 'dd/MM/yyyy') as DataAssinatura",
    )
    rows = court.amendments(court.amended_agreements(records), as_of())
    return rows.select("id_aditivo", "valor_convenio", "quantidade_aditivos", day("data_assinatura").alias("assinatura"))


@query(
    """
SELECT o_orderkey || '-' || strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' AS id_obra, o_totalprice AS valor_total_contrato, o_orderpriority AS classificacao_obra
FROM orders
"""
)
def court_stopped_works(t: Tables) -> DataFrame:
    records = t.orders.selectExpr(
        "cast(o_orderkey as string) as NumeroContrato", "date_format(o_orderdate, 'yyyy-MM-dd') as DataParalisacao",
        "cast(cast(o_totalprice as decimal(18,2)) as string) as ValorTotalContrato", "o_orderpriority as ClassificacaoObra",
    )
    return court.stopped_works(records, as_of()).select("id_obra", "valor_total_contrato", "classificacao_obra")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id_licitacao, o_totalprice AS valor_estimado, o_orderpriority AS tipo,
  CASE WHEN o_orderstatus = 'F' THEN 'Fracassada' WHEN o_custkey % 2 = 0 THEN 'Homologada' ELSE 'Indefinido' END AS situacao,
  CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS homologacao, 'U' || o_custkey AS orgao
FROM orders
"""
)
def court_tenders(t: Tables) -> DataFrame:
    records = t.orders.selectExpr(
        "case when o_custkey % 3 = 0 then cast(o_orderkey as string) end as NumeroEdital",
        "case when o_custkey % 3 = 1 then cast(o_orderkey as string) end as processo_licitatorio",
        "case when o_custkey % 3 = 2 then cast(o_orderkey as string) end as ProcessoLicitatorio", "case when o_orderstatus = 'F' then 'Fracassada' else 'None' end as Parecer",
        f"concat('R$ ', {_br('o_totalprice')}) as valorestimado", "o_orderpriority as Tipo", "concat('U', o_custkey) as Unidade",
        "case when o_custkey % 2 = 0 then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") end as DataHomologacao",
    )
    rows = court.tenders(records, as_of())
    return rows.select(
        "id_licitacao", "valor_estimado", "tipo", "situacao", day("data_homologacao").alias("homologacao"), "orgao"
    )


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id_contrato, o_totalprice AS valor_contrato, CAST(o_custkey AS VARCHAR) AS cnpj_fornecedor,
  CASE WHEN o_orderstatus = 'F' THEN 'Rescindido' WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'Expirado' ELSE 'Vigente' END AS situacao
FROM orders
"""
)
def court_purchases(t: Tables) -> DataFrame:
    records = t.orders.selectExpr(
        "case when o_custkey % 2 = 0 then cast(o_orderkey as string) end as numeroContrato",
        "case when o_custkey % 2 = 1 then cast(o_orderkey as string) end as CODIGO", "case when o_orderstatus = 'F' then 'Rescindido' else '' end as Situacao",
        "format_number(o_totalprice, 2) as ValorContrato", "cast(o_custkey as string) as CNPJCPFContratado",
        "date_format(o_orderdate, 'dd-MM-yyyy') as DataVencimentoContrato",
    )
    return court.purchases(records, as_of()).select("id_contrato", "valor_contrato", "cnpj_fornecedor", "situacao")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS id_licitacao, CASE WHEN o_custkey % 5 <> 4 THEN o_totalprice END AS valor_estimado, o_orderpriority AS tipo,
  CASE WHEN o_orderstatus = 'F' THEN 'Fracassada' WHEN o_custkey % 2 = 0 THEN 'Homologada' ELSE 'Indefinido' END AS situacao,
  CASE WHEN o_custkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS homologacao,
  CASE WHEN o_custkey % 2 = 1 AND o_custkey % 3 = 0 THEN 1 ELSE 0 END AS datas_ilegiveis, CAST(o_custkey AS VARCHAR) AS extra
FROM orders WHERE o_custkey % 11 <> 0
"""
)
def court_tender_records(t: Tables) -> DataFrame:
    """Tenders from JSON texts whose records spell a key in several ways and give values of several types; no schema is looked for."""
    key = "element_at(array('ProcessoLicitatorio', 'processoLicitatorio', 'NumeroEdital', 'numero_edital'), 1 + cast(o_custkey % 4 as int))"
    number = "case when o_custkey % 2 = 0 then cast(o_orderkey as string) else concat('\"', o_orderkey, '\"') end"
    amount = (
        f"case o_custkey % 5 when 0 then concat(', \"ValorEstimado\": ', cast(o_totalprice as decimal(18,2))) when 1 then concat(', \"valorestimado\": \"R$ ', {_br('o_totalprice')}, '\"') "
        "when 2 then concat(', \"valor_estimado\": \"', cast(o_totalprice as decimal(18,2)), '\"') when 3 then concat(', \"ValorEstimado\": null, \"valorTotal\": ', cast(o_totalprice as decimal(18,2))) else '' end"
    )
    date = (
        "case when o_custkey % 2 = 0 then concat(', \"DataHomologacao\": \"', date_format(o_orderdate, 'yyyy-MM-dd'), '\"') "
        "when o_custkey % 3 = 0 then ', \"dataHomologacao\": \"em breve\"' else '' end"
    )
    texts = t.orders.selectExpr(
        f"case when o_custkey % 11 <> 0 then concat('{{\"', {key}, '\": ', {number}, {amount}, {date}, ', \"TIPO\": \"', o_orderpriority, '\"', "
        "case when o_orderstatus = 'F' then ', \"parecer\": \"Fracassada\"' else ', \"Parecer\": null' end, ', \"n\": {\"k\": [', o_custkey, ']}}') else '{cut' end as texto",
    )
    records, _ = parsed_records(texts, "texto")
    rows = court.tenders(records, as_of())
    extra = F.get_json_object("payload_bruto", "$.n.k[0]")
    return rows.select(
        "id_licitacao", "valor_estimado", "tipo", "situacao", day("data_homologacao").alias("homologacao"),
        F.size("_ilegiveis").alias("datas_ilegiveis"), extra.alias("extra"),
    )


@query(
    """
SELECT s_name AS nome, CASE WHEN s_suppkey % 5 = 0 THEN r_name WHEN n_nationkey % 4 = 0 THEN 'sem_camada' ELSE n_name || ' & cia' END AS camada,
  (-40 - n_nationkey) || ',-22.5' AS coords_kml
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
)
def map_layers(t: Tables) -> DataFrame:
    """Placemarks of one map a region, each under the folder that holds it: folders nest, and may have no name."""
    mark = "concat('<Placemark><name>', s_name, '</name><Point><coordinates>', -40 - n_nationkey, ',-22.5</coordinates></Point></Placemark>')"
    known = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "n_regionkey", "n_nationkey", "n_name", f"case when s_suppkey % 5 <> 0 then {mark} end as inside", f"case when s_suppkey % 5 = 0 then {mark} end as beside",
    )
    folders = known.groupBy("n_regionkey", "n_nationkey", "n_name").agg(
        F.array_join(F.collect_list("inside"), "").alias("inside"), F.array_join(F.collect_list("beside"), "\n").alias("beside")
    )
    named = "case when n_nationkey % 4 <> 0 then concat('<name>', n_name, ' &amp; cia</name>') else '' end"
    folder = F.expr(f"concat('<Folder>', {named}, inside, '<Folder><name>vazia</name></Folder>', '</Folder>', beside)")
    maps = folders.groupBy("n_regionkey").agg(F.array_join(F.collect_list(folder), "").alias("folders")).join(
        t.region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    texts = maps.selectExpr("concat('<kml><Document><name>', r_name, '</name>', folders, '</Document></kml>') as texto")
    return placemarks_in(texts, "texto").select("nome", "camada", "coords_kml")


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS proposta_id, CASE WHEN c_nationkey % 2 = 0 THEN 'Em funcionamento' ELSE 'Em ação preparatória' END AS situacao,
  CAST(CASE WHEN c_nationkey = 3 THEN 42.5 WHEN c_nationkey % 2 = 0 THEN 100.0 ELSE 0.0 END AS DOUBLE) AS percentual_executado,
  coalesce(nullif(CASE WHEN c_nationkey > 10 THEN c_acctbal ELSE 0 END, 0.0), c_acctbal + 1000) AS valor_total_contrato,
  strftime(DATE '1999-01-01' + CAST(c_custkey % 500 AS INTEGER), '%Y-%m-%d') AS inicio,
  CASE WHEN c_custkey % 3 = 0 THEN '[]' ELSE '[{"grupo":"Frente","foto_id":"' || c_custkey || '","dt_atualizacao":null},{"grupo":"","foto_id":"b","dt_atualizacao":"2020"}]' END AS fotos_grupos,
  CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 3 END AS qtd_fotos, CASE WHEN c_nationkey > 4 THEN 2 ELSE 0 END AS qtd_empresas
FROM customer
"""
)
def health_works(t: Tables) -> DataFrame:
    """Health records with fallbacks, photo groups and company lists."""
    records = t.customer.selectExpr(
        "c_custkey as propostaId", "'' as situacaoObra", "case when c_nationkey % 2 = 0 then 'Em funcionamento' else 'Em ação preparatória' end as dsSituacaoObra",
        "case when c_nationkey = 3 then '42.5' end as vlPercentualExecutado",
        "case when c_nationkey > 10 then c_acctbal else 0D end as vlTotalContrato", "c_acctbal + 1000 as vlProposta",
        "date_format(date_add(date'1999-01-01', cast(c_custkey % 500 as int)), \"yyyy-MM-dd'T'HH:mm:ss.SSS'+0000'\") as dtOrdemServico",
        "case when c_nationkey > 4 then array('a', 'b') end as empresas",
        "case when c_custkey % 3 <> 0 then array("
        "named_struct('noGrupo', 'Frente', 'fotos', array(named_struct('id', cast(c_custkey as string), 'dtAtualizacao', cast(null as string)), "
        "named_struct('id', '', 'dtAtualizacao', '2019'))), "
        "named_struct('noGrupo', cast(null as string), 'fotos', array(named_struct('id', 'b', 'dtAtualizacao', '2020')))) end as gruposFotografias",
    )
    rows = health.works(records, as_of())
    return rows.select(
        "proposta_id", "situacao", "percentual_executado", "valor_total_contrato", day("dt_inicio_obra").alias("inicio"), "fotos_grupos",
        "qtd_fotos", "qtd_empresas",
    )


@query(
    """
SELECT CAST(o_custkey AS VARCHAR) AS nr_convenio, arg_min(o_totalprice, o_orderkey) AS valor, arg_min(strftime(o_orderdate, '%Y-%m-%d'), o_orderkey) AS conclusao,
  arg_min(CAST(o_orderkey AS VARCHAR), o_orderkey) AS cnpj_proponente
FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_custkey
"""
)
def federal_agreements(t: Tables) -> DataFrame:
    """Nested agreement records, the first of each number; records without a number drop."""
    records = t.orders.selectExpr(
        "'Aprovado' as situacao", "date_format(o_orderdate, 'yyyy-MM-dd') as dataConclusao", "cast(null as string) as dataInicioVigencia",
        "cast(null as string) as dataFinalVigencia", "cast(null as string) as dataPublicacao", "cast(cast(o_totalprice as decimal(18,2)) as string) as valor",
        "'x' as valorLiberado", "cast(null as string) as valorContrapartida",
        "named_struct('codigo', case when o_orderstatus <> 'P' then concat(' ', o_custkey) else ' ' end, 'numero', 'n', 'objeto', 'o') as dimConvenio",
        "named_struct('cnpjFormatado', concat('x.', o_orderkey, '/'), 'nome', 'y') as convenente", "named_struct('nome', 'z') as orgao", "o_orderkey as _row",
    )
    rows = federal.agreements(records, as_of(), ["_row"])
    return rows.select("nr_convenio", "valor", day("data_conclusao").alias("conclusao"), "cnpj_proponente")


_PANEL_SQL = """
SELECT CAST(o_orderkey AS VARCHAR) AS id_obra, 'C' || o_custkey AS num_contrato, 'L' || o_custkey AS num_licitacao, o_totalprice AS valor_contrato,
  strftime(o_orderdate, '%Y-%m-%d') AS inicio, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Novo Centro' ELSE o_orderpriority END AS bairro,
  CASE WHEN o_orderpriority = '2-HIGH' THEN 12.5 WHEN o_orderstatus = 'F' THEN 100.0 WHEN o_orderstatus = 'P' THEN 0.0
       ELSE least(99.0, round_even(CAST(date_diff('day', o_orderdate, TIMESTAMP '2000-01-01') AS DOUBLE) / 900 * 100, 1)) END AS percentual_executado
FROM orders
"""


def _panel_rows(t: Tables) -> DataFrame:
    nested = (
        "to_json(named_struct('contrato', concat('C', o_custkey), 'payload_bruto', to_json(named_struct('Nº Licitação', concat('L', o_custkey), "
        "'assinatura', date_format(o_orderdate, 'yyyy-MM-dd'), 'objeto', 'Reforma no BAIRRO Novo Centro Macaé RJ'))))"
    )
    return t.orders.selectExpr(
        "cast(o_orderkey as string) as Identificador", "'Escola' as `Nome da Obra`",
        "case o_orderstatus when 'F' then 'Obra concluída' when 'P' then 'Cadastrada' else 'Em execução' end as `Situação`",
        "case when o_orderpriority = '2-HIGH' then '12,5' end as `Percentual`", f"concat('R$ ', {_br('o_totalprice')}) as `Valor do Contrato (R$)`",
        "case when o_custkey % 2 = 0 then date_format(o_orderdate, 'dd/MM/yyyy') else 'nan' end as `Data Início`",
        "date_format(o_orderdate + interval 900 days, 'dd/MM/yyyy') as `Data Fim`", "case when o_orderpriority <> '1-URGENT' then o_orderpriority end as Bairro",
        "'Macaé - RJ' as `Município`", f"{nested} as payload_bruto",
    )


@query(_PANEL_SQL)
def current_panel(t: Tables) -> DataFrame:
    """Panel rows whose gaps are filled from the nested record."""
    rows = panels.current_works(panels.of_municipality(_panel_rows(t)), as_of())
    return rows.select(
        "id_obra", "num_contrato", "num_licitacao", "valor_contrato", day("data_inicio").alias("inicio"), "bairro", "percentual_executado"
    )


@query(
    """
SELECT count(*) AS obras, count(DISTINCT CAST(o_orderkey AS VARCHAR)) AS distintas FROM orders
WHERE o_orderstatus <> 'F' AND (o_orderstatus = 'O' OR o_orderdate + INTERVAL 900 DAY >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY
  OR o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY)
"""
)
def collection_strategies(t: Tables) -> DataFrame:
    """The export gives nothing, so the fallback counts, cut to active works."""
    rows = panels.best_strategy(
        lambda: _panel_rows(t).where(F.col("Identificador") == ""), [lambda: None, lambda: _panel_rows(t)], lambda: None, as_of()
    )
    return rows.agg(F.count("*").alias("obras"), F.countDistinct("id_obra").alias("distintas"))


@query(
    _PANEL_SQL
    + """
WHERE o_orderstatus <> 'F' AND (o_orderstatus = 'O' OR o_orderdate + INTERVAL 900 DAY >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY
  OR o_orderdate >= TIMESTAMP '2000-01-01' - INTERVAL 730 DAY)
"""
)
def collected_works(t: Tables) -> DataFrame:
    """The rows of the first strategy that gives any, in one plan: the export is empty, so the fallback's active works."""
    rows = panels.best_strategy(
        lambda: _panel_rows(t).where(F.col("Identificador") == ""), [lambda: None, lambda: _panel_rows(t)], lambda: None, as_of()
    )
    return rows.select(
        "id_obra", "num_contrato", "num_licitacao", "valor_contrato", day("data_inicio").alias("inicio"), "bairro", "percentual_executado"
    )


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS id_obra, CASE WHEN l_returnflag = 'A' THEN l_linenumber || ' — CONSTRUCAO' ELSE 'OBRA' END AS nome_obra,
  CASE WHEN l_returnflag <> 'R' THEN l_extendedprice END AS valor_contrato, CAST(round(l_discount * 100) AS DOUBLE) AS percentual_executado,
  CASE WHEN l_returnflag <> 'R' THEN round_even(l_quantity / l_extendedprice * 100, 2) END AS percentual_executado_financeiro,
  strftime(l_shipdate, '%Y-%m-%d') AS inicio, CAST(year(l_shipdate) AS BIGINT) AS ano_conclusao, -(CAST(l_linenumber AS DOUBLE) + 30.0 / 60 + 0.0) AS latitude
FROM lineitem
"""
)
def legacy_panel(t: Tables) -> DataFrame:
    """Legacy rows from a matrix of cells under a header, typed and renamed."""
    header = [
        "ID Obra Obras", "Titulo Obras", "Objeto Proposta Obras", "Nome Tipo Obras", "Nome Modalidade Obras", "Data Criação Obras",
        "Dia Inic Vigenc Conv Obras", "Ano Conclusao Obras", "Latitude Obras",
    ]
    cells = (
        "array(array(cast(l_orderkey as string), case when l_returnflag = 'A' then 'CONSTRUCAO' else 'OBRA' end, cast(l_linenumber as string), "
        f"case when l_returnflag <> 'R' then concat('R$', {_br('l_extendedprice')}) else 'NaT' end, "
        "concat(translate(format_number(l_discount * 100, 2), '.', ','), '%'), "
        f"concat('R$', {_br('l_quantity')}), date_format(l_shipdate, 'dd/MM/yyyy'), cast(year(l_shipdate) as string), concat(l_linenumber, '.30.00.S'))) as rows"
    )
    records = matrix_records(t.lineitem.selectExpr(cells), header)
    rows = panels.legacy_works(records, as_of())
    return rows.select(
        "id_obra", "nome_obra", "valor_contrato", "percentual_executado", "percentual_executado_financeiro", day("data_inicio").alias("inicio"),
        "ano_conclusao", "latitude",
    )


@query(
    """
SELECT CAST(p_partkey AS VARCHAR) AS nome_obra, -22.5::DOUBLE AS latitude, CAST(-41 - p_size AS DOUBLE) AS longitude,
  CASE WHEN p_size > 30 THEN 'concluída' ELSE 'em andamento' END AS status, 'SEMOB' AS secretaria, 'R$ ' || p_size AS valor,
  CASE WHEN p_size > 30 THEN 100.0 WHEN p_size > 20 THEN least(99.0, round_even(CAST(365 AS DOUBLE) / (p_size * 30) * 100, 1)) END AS percentual,
  CASE WHEN p_size > 20 THEN '1999-01-01' END AS inicio
FROM part WHERE p_brand <> 'Brand#1'
"""
)
def map_markers(t: Tables) -> DataFrame:
    """Markers with attribute tables; markers without a point are context and drop."""
    start = "case when p_size > 20 then 'Janeiro/1999' else 'logo' end"
    described = t.part.selectExpr(
        "concat('<table><tr><td>Obra</td><td>', case when p_size > 30 then 'CONCLUÍDA' else 'Em andamento' end, '</td></tr><tr><td>Início</td><td>', "
        f"{start}, '</td></tr><tr><td>Fim</td><td>', p_size, ' meses</td></tr><tr><td>Órgão responsável</td><td>SEMOB</td></tr>"
        "<tr><td>Valor</td><td>R$ ', p_size, '</td></tr></table>') as descricao_raw",
        "cast(p_partkey as string) as nome", "'Obras' as camada", "'#icon-red' as icone",
        "case when p_brand <> 'Brand#1' then concat(-41 - p_size, ',-22.5,0') else 'poligono' end as coords_kml",
    )
    rows = georef.works(georef.parse_placemarks(described), as_of())
    return rows.select(
        "nome_obra", "latitude", "longitude", "status", "secretaria", "valor", "percentual", day("data_inicio").alias("inicio")
    )


@query(
    """
WITH d AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
SELECT CAST(o_custkey AS VARCHAR) AS id_contrato, min(o_orderstatus) AS situacao, 'Macae' AS municipio, 'desconhecida' AS fonte, CAST(o_custkey AS DOUBLE) + 0.5 AS valor,
  strftime(DATE '1999-01-01' + CAST(o_custkey % 300 AS INTEGER), '%Y-%m-%d') AS assinatura, CASE WHEN o_custkey % 200 - 100 BETWEEN -90 AND 90 THEN CAST(o_custkey % 200 - 100 AS DOUBLE) END AS latitude
FROM d GROUP BY o_custkey
"""
)
def clean_contracts(t: Tables) -> DataFrame:
    """The whole cleaning pass: dates, duplicates, money, coordinates, defaults."""
    dirty = t.orders.selectExpr(
        "cast(o_custkey as string) as id_contrato", "o_orderstatus as situacao", "concat('R$ ', o_custkey, ',50') as valor",
        "date_format(date_add(date'1999-01-01', cast(o_custkey % 300 as int)), 'dd/MM/yyyy') as data_assinatura",
        "cast(o_custkey % 200 - 100 as string) as latitude", "'n/a' as municipio", "o_orderstatus as ordem_a", "o_orderkey as ordem_b",
    )
    rows = clean(dirty, as_of(), order=["ordem_a", "ordem_b"])
    return rows.select(
        "id_contrato", "situacao", "municipio", "fonte", "valor", day("data_assinatura").alias("assinatura"), "latitude"
    )


@query(
    """
SELECT CAST(l_orderkey AS VARCHAR) AS id_contrato, 'tce_rj_compras_diretas' AS fonte, '3302403' AS municipio_ibge,
  arg_min(l_extendedprice, lpad(CAST(l_linenumber AS VARCHAR), 3, '0') || strftime(l_shipdate, '%Y%m%d') || lpad(CAST(l_partkey AS VARCHAR), 9, '0') || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') || lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) AS VARCHAR), 12, '0')) AS valor_inicial,
  count(*) > 0 AS tem_registro
FROM lineitem WHERE l_returnflag <> 'R' GROUP BY l_orderkey
"""
)
def routed_raw_rows(t: Tables) -> DataFrame:
    """Clean, route, keep the record, one row per key; rows without a key are rejected."""
    landed = t.lineitem.selectExpr(
        "case when l_returnflag <> 'R' then cast(l_orderkey as string) end as id_contrato",
        f"{_br('l_extendedprice')} as valor_contrato", "date_format(l_shipdate, 'dd/MM/yyyy') as data_inicio", "' ' as municipio_ibge",
        "l_linenumber as pos_a", "l_shipdate as pos_b", "l_partkey as pos_c", "l_suppkey as pos_d", "l_extendedprice as pos_e",
    )
    order = ("pos_a", "pos_b", "pos_c", "pos_d", "pos_e")
    batch, _ = raw_rows(landed, ROUTES["tce_contratos"], as_of(), order)
    kept = F.from_json("payload_bruto", "map<string,string>")
    return batch.select(
        "id_contrato", "fonte", "municipio_ibge", "valor_inicial",
        (F.try_element_at(kept, F.lit("id_contrato")) == F.col("id_contrato")).alias("tem_registro"),
    )


@query(
    """
SELECT p_partkey, lower(replace(p_name, ' ', '_')) || '_' || lower(replace(p_brand, '#', '_')) AS nome FROM part
"""
)
def slugs(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", slug(F.concat(F.initcap("p_name"), F.lit("  -- "), "p_brand")).alias("nome"))


@query("SELECT count(*) AS linhas, count(*) AS posicoes FROM lineitem")
def source_positions(t: Tables) -> DataFrame:
    """Every row of a file has its own place in the source order."""
    placed = with_source_position(t.lineitem.select("l_orderkey", "_metadata"))
    return placed.agg(F.count("*").alias("linhas"), F.countDistinct("_file", "_block", "_row").alias("posicoes"))
