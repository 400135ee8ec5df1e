"""Municipal transparency portal: contract and tender exports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.dates import duration_days, parse_timestamp
from canteiro.functions.numbers import amount
from canteiro.functions.status import contract_status
from canteiro.functions.text import mentions_works, text_or_null
from canteiro.operators.dedup import merge_extracts
from canteiro.operators.fields import first_containing, resolved
from canteiro.sources.common import project, record_columns, with_texts

# fixed values: contract type of the export form, source names
WORKS_CONTRACT_TYPE = "Obras e Serviços de Engenharia"
CONTRACTS_SOURCE = "portal_transparencia_macae_contratos"
TENDERS_SOURCE = "portal_transparencia_macae_licitacoes"

# fixed values: words that find each export column, most telling first
CONTRACT_COLUMNS = {
    "id_contrato": ("número", "numero", "contrato", "id"),
    "objeto": ("objeto", "descrição", "descricao", "assunto"),
    "valor": ("valor", "montante", "total"),
    "fornecedor": ("empresa", "fornecedor", "contratado", "razão social"),
    "cnpj_fornecedor": ("cnpj", "cpf"),
    "data_assinatura": ("assinatura", "início", "inicio", "data contrato", "data inicio"),
    "data_vigencia_fim": ("vigência", "vigencia", "término", "termino", "fim"),
    "secretaria": ("secretaria", "órgão", "orgao", "unidade gestora"),
    "modalidade_licitacao": ("modalidade", "licitação", "licitacao", "tipo lic"),
    "num_licitacao": ("número licitação", "numero licitacao", "num lic", "licitacao"),
    "situacao": ("situação", "situacao", "status"),
    "possui_aditivo": ("aditivo", "acréscimo"),
    "num_processo": ("nº processo", "num processo", "processo"),
    "prazo_dias": ("prazo",),
}
TENDER_COLUMNS = {
    "id_licitacao": ("número", "numero", "licitação", "licitacao", "id"),
    "objeto": ("objeto", "descrição", "descricao", "assunto"),
    "modalidade": ("modalidade", "tipo", "espécie"),
    "status": ("status", "situação", "situacao"),
    "valor_estimado": ("valor", "estimado", "montante", "total"),
    "data_abertura": ("abertura", "data abertura", "data sessão", "data"),
    "data_publicacao": ("publicação", "publicacao", "homolog"),
    "secretaria": ("secretaria", "órgão", "orgao", "unidade"),
    "ano": ("ano", "exercício", "exercicio"),
    "num_processo": ("processo",),
}


def _texts(df: DataFrame, columns: dict[str, Sequence[str]]) -> DataFrame:
    names = record_columns(df)
    return with_texts(
        df,
        {
            target: text_or_null(resolved(first_containing(names, *words)), vocab.NULL_TEXTS_PORTAL)
            for target, words in columns.items()
        },
    )


def _date(name: str) -> Column:
    return parse_timestamp(name, digits_as_epoch=False)


def _dates(columns: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Text cells of the columns of dates."""
    return {name: F.col(name) for name in columns if name.startswith("data_")}


def contracts(df: DataFrame, as_of: Column) -> DataFrame:
    texts = _texts(df, CONTRACT_COLUMNS)
    columns = {
        **{name: F.col(name) for name in CONTRACT_COLUMNS},
        "valor": amount("valor", "br_strict"),
        "data_assinatura": _date("data_assinatura"),
        "data_vigencia_fim": _date("data_vigencia_fim"),
        "prazo_dias": duration_days("prazo_dias"),
        "tipo_contrato": F.lit(WORKS_CONTRACT_TYPE),
    }
    typed = project(texts, columns, as_of, CONTRACTS_SOURCE, _dates(CONTRACT_COLUMNS))
    return typed.withColumn("situacao", contract_status("situacao", "data_vigencia_fim", as_of))


def tenders(df: DataFrame, as_of: Column) -> DataFrame:
    columns = {
        **{name: F.col(name) for name in TENDER_COLUMNS},
        "valor_estimado": amount("valor_estimado", "br_strict"),
        "data_abertura": _date("data_abertura"),
        "data_publicacao": _date("data_publicacao"),
    }
    return project(_texts(df, TENDER_COLUMNS), columns, as_of, TENDERS_SOURCE, _dates(TENDER_COLUMNS))


def works_tenders(extracts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Keyword extracts of the tender list as one list without repeats."""
    return merge_extracts(extracts, order)


def about_works(df: DataFrame, column: str = "objeto") -> DataFrame:
    return df.where(mentions_works(column, vocab.TENDER_KEYWORDS))
