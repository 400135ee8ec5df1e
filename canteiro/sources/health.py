"""Federal health works: summary list plus one detail record per work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.dates import parse_timestamp
from canteiro.functions.numbers import to_double
from canteiro.functions.status import health_percent
from canteiro.operators.fields import field, truthy, truthy_number
from canteiro.sources.common import project, with_texts

# fixed values: target -> source fields, the first filled one counts
TEXT_FIELDS = {
    "proposta_id": ("propostaId", "coSeqProposta"),
    "numero_proposta": ("numeroProposta", "nuProposta"),
    "uf": ("uf", "sgUf"),
    "municipio": ("municipio", "noMunicipioAcentuado"),
    "cnpj_fundo": ("nuCnpj",),
    "entidade": ("noPadronizadoEntidade",),
    "esfera_administrativa": ("dsEsferaAdministrativa",),
    "situacao": ("situacaoObra", "dsSituacaoObra"),
    "co_situacao_obra": ("coSituacaoObra",),
    "tipo_obra": ("tipoObra", "dsTipoObra"),
    "co_tipo_obra": ("coTipoObra",),
    "tipo_recurso": ("tipoRecurso", "dsTipoRecurso"),
    "programa": ("programa", "dsPrograma"),
    "rede_programa": ("redePrograma", "dsRedePrograma"),
    "fase_projeto": ("dsFaseProjeto",),
    "etapa_proposta": ("dsEtapaProposta",),
    "portaria": ("nuPortaria",),
    "ano_referencia": ("nuAnoReferencia",),
    "nome_estabelecimento": ("nomeEstabelecimento", "noEstabelecimentoCnes"),
    "nome_estabelecimento_proposta": ("noEstabelecimentoProposta",),
    "cnes": ("cnes", "nuCnes", "coCnes"),
    "co_unidade": ("coUnidade",),
    "bairro": ("novoBairro", "bairro", "noBairro"),
    "logradouro": ("dsLogradouro",),
    "numero": ("nuEndereco",),
    "complemento": ("dsComplemento",),
    "cep": ("nuCep",),
    "possui_aditivo_contratual": ("stAditivoContratual",),
    "tipo_recurso_filtro": ("dsTipoRecursoFiltro",),
    "porte_programa": ("dsPortePrograma",),
    "possui_etapa_funcionamento": ("stPossuiEtapaFuncionamento",),
    "forma_execucao_projeto": ("dsTipoFormaExecucaoProjeto",),
    "justificativa": ("dsJustificativa",),
}
NUMBER_FIELDS = {
    "latitude": ("nuLatitude",),
    "longitude": ("nuLongitude",),
    "valor_proposta": ("vlProposta",),
    "valor_total_contrato": ("vlTotalContrato", "vlProposta"),
    "valor_1a_parcela": ("vlPrimeraParcela",),
    "valor_2a_parcela": ("vlSegundaParcela",),
    "valor_3a_parcela": ("vlTerceiraParcela",),
    "valor_4a_parcela": ("vlQuartaParcela",),
}
DATE_FIELDS = {
    "dt_portaria": ("dtPortaria",),
    "dt_cadastro": ("dtCadastro",),
    "dt_inicio_projeto": ("dtInicioProjeto",),
    "dt_prevista_inicio": ("dtPrevistaInicioProjeto",),
    "dt_prevista_conclusao": ("dtPrevistaConclusaoProjeto",),
    "dt_conclusao_projeto": ("dtConclusaoProjeto",),
    "dt_ordem_servico": ("dtOrdemServico",),
    "dt_inicio_obra": ("dtInicioObra", "dtOrdemServico"),
    "dt_execucao": ("dtExecucao",),
    "dt_conclusao_final": ("dtConclusaoFinal",),
    "dt_prevista_conclusao_final": ("dtProvavelConclusaoFinal",),
    "dt_1a_parcela": ("dtPrimeiraParcela",),
    "dt_2a_parcela": ("dtSegundaParcela",),
    "dt_3a_parcela": ("dtTerceiraParcela",),
    "dt_4a_parcela": ("dtQuartaParcela",),
    "dt_atualizacao": ("dtAtualizacao", "dtMudancaSituacao"),
    "dt_inauguracao": ("dtInauguracao",),
    "dt_inicio_funcionamento": ("dtInicioFuncionamento",),
    "dt_prevista_inauguracao": ("dtPrevistaInauguracao",),
}
PHOTO_GROUPS = "array<struct<noGrupo:string,fotos:array<struct<id:string,dtAtualizacao:string>>>>"


def merge_detail(summary: DataFrame, detail: DataFrame, key: str = "propostaId") -> DataFrame:
    """Summary with its detail record: detail columns win where a detail exists.

    The detail must be unique by key. Rows without a key are dropped.
    """
    found = detail.withColumn("__found", F.lit(True))
    joined = summary.where(F.col(key).isNotNull()).alias("s").join(found.alias("d"), key, "left")
    columns = []
    for name in summary.columns:
        own = F.col(f"s.{name}") if name != key else F.col(key)
        if name != key and name in detail.columns:
            own = F.when(F.col("d.__found"), F.col(f"d.{name}")).otherwise(own)
        columns.append(own.alias(name))
    extra = [F.col(f"d.{name}") for name in detail.columns if name not in summary.columns]
    return joined.select(*columns, *extra)


def photo_list(groups: Column) -> Column:
    """Photos of all groups as one JSON list; photos without an id are left out."""

    def of_group(group: Column) -> Column:
        kept = F.filter(group["fotos"], lambda photo: F.coalesce(photo["id"] != "", F.lit(False)))
        return F.transform(
            kept,
            lambda photo: F.struct(
                F.coalesce(group["noGrupo"], F.lit("")).alias("grupo"),
                photo["id"].alias("foto_id"),
                photo["dtAtualizacao"].alias("dt_atualizacao"),
            ),
        )

    nested = F.transform(groups, lambda group: F.coalesce(of_group(group), F.array()))
    photos = F.flatten(nested)
    return F.coalesce(F.to_json(photos, {"ignoreNullFields": "false"}), F.lit("[]"))


def photo_count(groups: Column) -> Column:
    """Photos of all groups, those without an id included."""

    def in_group(group: Column) -> Column:
        return F.coalesce(F.nullif(F.size(group["fotos"]), F.lit(-1)), F.lit(0))

    return F.coalesce(F.aggregate(groups, F.lit(0), lambda total, g: total + in_group(g)), F.lit(0))


def works(df: DataFrame, as_of: Column) -> DataFrame:
    def text(name: str) -> Column:
        return field(df, name).cast("string")

    cells = {target: truthy(*map(text, sources)) for target, sources in {**TEXT_FIELDS, **DATE_FIELDS}.items()}
    for target, sources in NUMBER_FIELDS.items():
        numbers = [to_double(text(name)) for name in sources]
        cells[target] = truthy_number(*numbers) if len(numbers) > 1 else numbers[0]
    cells["__percent"] = to_double(text("vlPercentualExecutado"))
    cells["__photos"] = field(df, "gruposFotografias", PHOTO_GROUPS)
    companies = field(df, "empresas", "array<string>")
    cells["qtd_empresas"] = F.when(companies.isNotNull(), F.size(companies)).otherwise(F.lit(0))
    rows = with_texts(df, cells)
    columns = {
        **{name: F.col(name) for name in (*TEXT_FIELDS, *NUMBER_FIELDS, "qtd_empresas")},
        **{name: parse_timestamp(name, digits_as_epoch=False) for name in DATE_FIELDS},
        "percentual_executado": health_percent(F.col("__percent"), F.col("situacao")),
        "municipio_ibge": F.lit(vocab.MUNICIPALITY_CODE_HEALTH),
        "fotos_grupos": photo_list(F.col("__photos")),
        "qtd_fotos": photo_count(F.col("__photos")),
    }
    return project(rows, columns, as_of, "sismob_cidadao")
