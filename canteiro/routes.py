"""Raw tables and the routes that fill them."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

from canteiro import vocab

# fixed values: columns of each raw table
RAW_TABLES = {
    "raw_contratos": (
        "id string, id_contrato string, fonte string, municipio_ibge string, objeto string, "
        "modalidade string, situacao string, tipo_contrato string, num_licitacao string, "
        "num_processo string, ano string, cnpj_fornecedor string, nome_fornecedor string, "
        "valor_inicial double, valor_global double, valor_aditivos double, valor_final double, "
        "prazo_dias bigint, data_assinatura timestamp, data_inicio_vigencia timestamp, "
        "data_fim_vigencia timestamp, data_rescisao timestamp, orgao string, secretaria string, "
        "unidade_gestora string, qtd_aditivos string, possui_aditivo string, "
        "coletado_em timestamp, payload_bruto string"
    ),
    "raw_licitacoes": (
        "id string, id_licitacao string, fonte string, municipio_ibge string, ano string, "
        "objeto string, modalidade string, situacao string, tipo string, numero string, "
        "num_processo string, valor_estimado double, valor_homologado double, "
        "data_abertura timestamp, data_publicacao timestamp, data_homologacao timestamp, "
        "cnpj_vencedor string, nome_vencedor string, orgao string, secretaria string, "
        "unidade_gestora string, coletado_em timestamp, payload_bruto string"
    ),
    "raw_obras_paralisadas": (
        "id string, id_obra string, fonte string, municipio string, ano string, nome_obra string, "
        "tipo_obra string, situacao string, motivo_paralisacao string, orgao string, "
        "cnpj_executora string, nome_executora string, valor_contrato double, "
        "valor_pago_obra double, funcao_governo string, percentual_executado double, "
        "data_inicio timestamp, data_paralisacao timestamp, coletado_em timestamp, "
        "payload_bruto string"
    ),
    "raw_obras_saude": (
        "id string, proposta_id string, numero_proposta string, fonte string, "
        "municipio_ibge string, uf string, municipio string, cnpj_fundo string, entidade string, "
        "esfera_administrativa string, situacao string, co_situacao_obra string, "
        "tipo_obra string, co_tipo_obra string, tipo_recurso string, programa string, "
        "rede_programa string, fase_projeto string, etapa_proposta string, portaria string, "
        "dt_portaria timestamp, ano_referencia string, nome_estabelecimento string, "
        "nome_estabelecimento_proposta string, cnes string, co_unidade string, bairro string, "
        "logradouro string, numero string, complemento string, cep string, latitude double, "
        "longitude double, valor_proposta double, valor_total_contrato double, "
        "percentual_executado double, valor_1a_parcela double, valor_2a_parcela double, "
        "valor_3a_parcela double, valor_4a_parcela double, dt_cadastro timestamp, "
        "dt_inicio_projeto timestamp, dt_prevista_inicio timestamp, "
        "dt_prevista_conclusao timestamp, dt_conclusao_projeto timestamp, "
        "dt_ordem_servico timestamp, dt_inicio_obra timestamp, dt_execucao timestamp, "
        "dt_conclusao_final timestamp, dt_prevista_conclusao_final timestamp, "
        "dt_1a_parcela timestamp, dt_2a_parcela timestamp, dt_3a_parcela timestamp, "
        "dt_4a_parcela timestamp, dt_atualizacao timestamp, dt_inauguracao timestamp, "
        "dt_inicio_funcionamento timestamp, possui_aditivo_contratual string, qtd_fotos int, "
        "qtd_empresas int, justificativa string, coletado_em timestamp, payload_bruto string"
    ),
    "raw_obras_georef": (
        "id string, nome_obra string, camada_mapa string, fonte string, map_id string, "
        "latitude double, longitude double, situacao string, secretaria string, valor string, "
        "previsao_termino string, percentual double, programa string, bairro string, "
        "endereco string, descricao string, data_inicio timestamp, setor_administrativo string, "
        "objectid string, coletado_em timestamp, payload_bruto string"
    ),
    "raw_obras_atual": (
        "id string, id_obra string, fonte string, nome_obra string, situacao string, "
        "percentual_executado double, secretaria string, bairro string, endereco string, "
        "num_contrato string, num_licitacao string, cnpj_executora string, "
        "nome_executora string, valor_contrato double, valor_aditivos double, "
        "data_inicio timestamp, data_prevista_fim timestamp, latitude double, longitude double, "
        "coletado_em timestamp, payload_bruto string"
    ),
    "raw_obras_legado": (
        "id string, id_obra string, fonte string, nome_obra string, situacao string, "
        "percentual_executado double, percentual_executado_financeiro double, secretaria string, "
        "bairro string, endereco string, ano_referencia bigint, ano_conclusao bigint, "
        "num_contrato string, num_licitacao string, cnpj_executora string, nome_executora string, "
        "valor_contrato double, valor_aditivos double, valor_final double, "
        "data_inicio timestamp, data_prevista_fim timestamp, data_conclusao timestamp, "
        "dias_atraso bigint, percentual_aditivo double, latitude double, longitude double, "
        "coletado_em timestamp, payload_bruto string"
    ),
    "raw_geodados": (
        "id string, municipio_id string, municipio_nome string, uf_sigla string, uf_nome string, "
        "mesorregiao_nome string, microrregiao_nome string, regiao_imediata_nome string, "
        "regiao_intermediaria_nome string, populacao_censo_2022 bigint, "
        "populacao_estimada bigint, area_territorial_km2 double, densidade_demografica double, "
        "pib_per_capita double, idhm double, geojson string, fonte string, "
        "coletado_em timestamp, payload_bruto string"
    ),
    "raw_convenios": (
        "id string, id_aditivo string, fonte string, municipio string, unidade_gestora string, "
        "numero_convenio string, ano_convenio string, mes_convenio string, tipo_registro string, "
        "objeto string, quantidade_aditivos double, valor_aditivos double, valor_convenio double, "
        "ultima_data_aditivo timestamp, data_assinatura timestamp, data_publicacao timestamp, "
        "coletado_em timestamp, payload_bruto string"
    ),
    "raw_sinapi": (
        "id string, uf string, competencia string, tipo_obra string, custo_m2 double, "
        "fonte string, coletado_em timestamp"
    ),
    "raw_aditivos_federais": (
        "id string, nr_convenio string, id_proposta string, cnpj_proponente string, "
        "nome_proponente string, valor_global double, valor_aditivos double, "
        "qtd_aditivos bigint, situacao string, data_fim_vigencia timestamp, "
        "data_fim_vigencia_original timestamp, fonte string, coletado_em timestamp, "
        "payload_bruto string"
    ),
    "raw_convenios_federais": (
        "id string, nr_convenio string, numero string, objeto string, situacao string, "
        "data_conclusao timestamp, data_inicio_vigencia timestamp, data_fim_vigencia timestamp, "
        "data_publicacao timestamp, valor double, valor_liberado double, "
        "valor_contrapartida double, cnpj_proponente string, nome_proponente string, "
        "orgao string, municipio_ibge string, fonte string, coletado_em timestamp, "
        "payload_bruto string"
    ),
}


@dataclass(frozen=True)
class Route:
    """Where a dataset goes and how its columns get there."""

    table: str
    source: str
    keys: tuple[str, ...]
    required: tuple[str, ...]
    renames: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)


_MUNICIPALITY = {"municipio_ibge": vocab.MUNICIPALITY_CODE}

# fixed values: renames per dataset family
_CONTRACT_RENAMES = {
    "valor_contrato": "valor_inicial",
    "data_inicio": "data_inicio_vigencia",
    "data_fim": "data_fim_vigencia",
}
# the court's own spellings of supplier and end date, without which they would be lost
_COURT_CONTRACT_RENAMES = {
    **_CONTRACT_RENAMES,
    "cnpj_cpf_contratado": "cnpj_fornecedor",
    "contratado": "nome_fornecedor",
    "data_vencimento": "data_fim_vigencia",
}
_HEALTH_RENAMES = {
    "propostaId": "proposta_id",
    "numeroProposta": "numero_proposta",
    "situacao_obra": "situacao",
    "dsSituacaoObra": "situacao",
    "coSituacaoObra": "co_situacao_obra",
    "dsTipoObra": "tipo_obra",
    "coTipoObra": "co_tipo_obra",
    "dsTipoRecurso": "tipo_recurso",
    "dsPrograma": "programa",
    "dsRedePrograma": "rede_programa",
    "dsFaseProjeto": "fase_projeto",
    "dsEtapaProposta": "etapa_proposta",
    "nuPortaria": "portaria",
    "dtPortaria": "dt_portaria",
    "nuAnoReferencia": "ano_referencia",
    "noEstabelecimentoCnes": "nome_estabelecimento",
    "noEstabelecimentoProposta": "nome_estabelecimento_proposta",
    "coCnes": "cnes",
    "coUnidade": "co_unidade",
    "noBairro": "bairro",
    "dsLogradouro": "logradouro",
    "nuEndereco": "numero",
    "dsComplemento": "complemento",
    "nuCep": "cep",
    "nuLatitude": "latitude",
    "nuLongitude": "longitude",
    "vlProposta": "valor_proposta",
    "vlTotalContrato": "valor_total_contrato",
    "vlPercentualExecutado": "percentual_executado",
    "vlPrimeraParcela": "valor_1a_parcela",
    "vlSegundaParcela": "valor_2a_parcela",
    "vlTerceiraParcela": "valor_3a_parcela",
    "vlQuartaParcela": "valor_4a_parcela",
    "dtPrimeiraParcela": "dt_1a_parcela",
    "dtSegundaParcela": "dt_2a_parcela",
    "dtTerceiraParcela": "dt_3a_parcela",
    "dtQuartaParcela": "dt_4a_parcela",
    "dtCadastro": "dt_cadastro",
    "dtInicioProjeto": "dt_inicio_projeto",
    "dtPrevistaInicioProjeto": "dt_prevista_inicio",
    "dtPrevistaConclusaoProjeto": "dt_prevista_conclusao",
    "dtConclusaoProjeto": "dt_conclusao_projeto",
    "dtOrdemServico": "dt_ordem_servico",
    "dtInicioObra": "dt_inicio_obra",
    "dtExecucao": "dt_execucao",
    "dtConclusaoFinal": "dt_conclusao_final",
    "dtProvavelConclusaoFinal": "dt_prevista_conclusao_final",
    "dtAtualizacao": "dt_atualizacao",
    "dtInauguracao": "dt_inauguracao",
    "dtInicioFuncionamento": "dt_inicio_funcionamento",
    "dsEsferaAdministrativa": "esfera_administrativa",
    "nuCnpj": "cnpj_fundo",
    "noPadronizadoEntidade": "entidade",
    "stAditivoContratual": "possui_aditivo_contratual",
    "dsJustificativa": "justificativa",
    "sgUf": "uf",
    "noMunicipioAcentuado": "municipio",
}

# fixed values: dataset name -> route
ROUTES = {
    "tce_rj_contratos": Route(
        "raw_contratos", "tce_rj_contratos", ("id_contrato", "fonte"), ("id_contrato", "fonte"),
        _COURT_CONTRACT_RENAMES, _MUNICIPALITY,
    ),
    "tce_rj_obras": Route(
        "raw_obras_paralisadas", "tce_rj_obras_paralisadas", ("id_obra", "fonte"), ("id_obra", "fonte"),
        {
            "cnpj_contratada": "cnpj_executora",
            "nome_contratada": "nome_executora",
            "status_contrato": "situacao",
            "classificacao_obra": "tipo_obra",
            "valor_total_contrato": "valor_contrato",
            "data_inicio_obra": "data_inicio",
        },
    ),
    "tce_rj_aditivos": Route(
        "raw_convenios", "tce_rj_convenios_municipio", ("id_aditivo", "fonte"), ("id_aditivo", "fonte"),
    ),
    "tce_contratos": Route(
        "raw_contratos", "tce_rj_compras_diretas", ("id_contrato", "fonte"), ("id_contrato", "fonte"),
        _CONTRACT_RENAMES, _MUNICIPALITY,
    ),
    "tce_licitacoes": Route(
        "raw_licitacoes", "tce_rj_licitacoes", ("id_licitacao", "fonte"), ("id_licitacao", "fonte"),
        {"data_publicacao_edital": "data_publicacao", "unidade": "unidade_gestora"}, _MUNICIPALITY,
    ),
    "portal_macae_contratos": Route(
        "raw_contratos", "portal_transparencia_macae_contratos", ("id_contrato", "fonte"),
        ("id_contrato", "fonte"),
        {
            "valor": "valor_inicial",
            "fornecedor": "nome_fornecedor",
            "data_vigencia_fim": "data_fim_vigencia",
            "modalidade_licitacao": "modalidade",
        },
        _MUNICIPALITY,
    ),
    "portal_macae_licitacoes": Route(
        "raw_licitacoes", "portal_transparencia_macae_licitacoes", ("id_licitacao", "fonte"),
        ("id_licitacao", "fonte"), {"status": "situacao"}, _MUNICIPALITY,
    ),
    "transparencia_contratos": Route(
        "raw_contratos", "portal_transparencia_federal", ("id_contrato", "fonte"),
        ("id_contrato", "fonte"), {}, _MUNICIPALITY,
    ),
    "transparencia_licitacoes": Route(
        "raw_licitacoes", "portal_transparencia_federal", ("id_licitacao", "fonte"),
        ("id_licitacao", "fonte"), {}, _MUNICIPALITY,
    ),
    "sismob": Route(
        "raw_obras_saude", "sismob_cidadao", ("proposta_id",), ("proposta_id", "fonte"),
        _HEALTH_RENAMES, _MUNICIPALITY,
    ),
    "egim": Route(
        "raw_obras_georef", "egim_google_mymaps", ("nome_obra", "latitude", "longitude"),
        ("nome_obra", "fonte", "latitude", "longitude"), {"status": "situacao"},
    ),
    "painel_atual": Route(
        "raw_obras_atual", "painel_obras_atual_macae", ("id_obra",), ("id_obra", "fonte"),
    ),
    "painel_legado_obras": Route(
        "raw_obras_legado", "painel_obras_legado_macae", ("id_obra",), ("id_obra", "fonte"),
        {
            "titulo": "nome_obra",
            "situacao_atual": "situacao",
            "data_inicio_obra": "data_inicio",
            "data_fim_obra": "data_prevista_fim",
            "ano_conclusao_obra": "ano_referencia",
            "cnpj_executor": "cnpj_executora",
        },
    ),
    "ibge_metadados": Route(
        "raw_geodados", "ibge", ("municipio_id",), ("municipio_id", "fonte"),
    ),
    "sinapi": Route(
        "raw_sinapi", "sinapi_embutida", ("uf", "competencia", "tipo_obra"),
        ("uf", "competencia", "tipo_obra", "custo_m2"),
    ),
    "transferegov_aditivos": Route(
        "raw_aditivos_federais", "transferegov", ("nr_convenio", "fonte"), ("nr_convenio", "fonte"),
    ),
    "transparencia_convenios": Route(
        "raw_convenios_federais", "portal_transparencia_convenios", ("nr_convenio", "fonte"),
        ("nr_convenio", "fonte"),
    ),
}


def table_schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(RAW_TABLES[table])


def column_names(table: str) -> tuple[str, ...]:
    return tuple(part.split()[0] for part in RAW_TABLES[table].split(", "))


def check_routes(routes: Mapping[str, Route] = ROUTES) -> list[str]:
    """Problems of the registry; empty when every route is consistent."""
    problems = []
    for name, route in routes.items():
        if route.table not in RAW_TABLES:
            problems.append(f"{name}: unknown table {route.table}")
            continue
        columns = set(column_names(route.table))
        if not route.source:
            problems.append(f"{name}: no source")
        if not route.keys:
            problems.append(f"{name}: no key")
        for column in (*route.keys, *route.required, *route.renames.values(), *route.defaults):
            if column not in columns:
                problems.append(f"{name}: {column} is not in {route.table}")
        for column in set(route.keys) - set(route.required):
            problems.append(f"{name}: key {column} is not required")
    by_target: dict[tuple[str, str], str] = {}
    for name, route in routes.items():
        other = by_target.setdefault((route.table, route.source), name)
        if other != name:
            problems.append(f"{name}: shares table and source with {other}")
    return problems
