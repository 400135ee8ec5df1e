"""Works panels: the current one and the legacy one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.dates import parse_timestamp
from canteiro.functions.geo import coordinate
from canteiro.functions.numbers import amount, financial_percent, integer, percent
from canteiro.functions.status import is_active_work, panel_percent
from canteiro.functions.text import (
    district_after_word,
    fold,
    strip,
    text_or_null,
)
from canteiro.operators.dedup import merge_localities
from canteiro.operators.fields import (
    field,
    first_containing_folded,
    payload_value,
    resolved,
    with_payload_maps,
)
from canteiro.sources.common import project, record_columns, with_texts
from canteiro.sources.snapshots import first_with_rows

CURRENT_SOURCE = "painel_obras_atual_macae"
LEGACY_SOURCE = "painel_obras_legado_macae"

# fixed values: words that find each column of the current panel, most telling first
CURRENT_COLUMNS = {
    "id_obra": ("id_obra", "identificador unico", "identificador", "id_contrato", "numero contrato", "número", "id"),
    "nome_obra": ("nome_obra", "nome da obra", "objeto", "descricao", "descrição"),
    "situacao": ("situacao", "situação", "status"),
    "percentual_executado": ("percentual_executado", "percentual", "execucao", "execução"),
    "valor_contrato": ("valor_contrato", "investimento previsto", "valor", "montante"),
    "data_inicio": ("data_inicio", "data inicial prevista", "inicio", "início", "inicial", "assinatura", "cadastro"),
    "data_prevista_fim": (
        "data_prevista_fim", "data final prevista", "previsao", "previsão", "vigencia", "vigência", "fim",
        "final", "vencimento",
    ),
    "secretaria": ("secretaria", "orgao", "órgão", "unidade", "repassador"),
    "bairro": ("bairro", "local", "distrito", "endereco", "endereço"),
    "latitude": ("latitude", "lat"),
    "longitude": ("longitude", "lon", "lng"),
    "cnpj_executora": ("cnpj_executora", "cnpj_fornecedor", "cnpjcpfcontratado", "cnpj"),
    "nome_executora": ("nome_executora", "executor da obra", "fornecedor", "contratado", "empresa", "nome_fornecedor"),
    "valor_aditivos": ("valor_aditivos", "aditivo"),
    "num_contrato": ("num_contrato", "numero contrato", "numerocontrato"),
    "num_licitacao": ("num_licitacao", "processo licitatorio", "licitacao", "edital"),
}
CURRENT_NUMBERS = ("percentual_executado", "valor_contrato", "valor_aditivos", "latitude", "longitude")
# fixed values: keys under which the nested record may hold what the row lacks
NESTED_CONTRACT_KEYS = ("id_contrato", "contrato", "num_contrato", "numero contrato", "nº contrato")
NESTED_TENDER_KEYS = ("num_licitacao", "numero_licitacao", "nº licitacao", "nº licitação", "numero licitacao")
NESTED_START_KEYS = ("data_inicio", "inicio", "início", "data_assinatura", "assinatura")
NESTED_PLACE_KEYS = ("objeto", "endereco", "endereço", "logradouro")

# fixed values: legacy panel field -> column; several source labels say something else than
# the field holds (money under a date label), the target names what is in it
LEGACY_FIELDS = {
    "id_obra_obras": "id_obra",
    "codigo_transacao_obras": "num_contrato",
    "nr_convenio_obras": "num_licitacao",
    "titulo_obras": "nome_obra",
    "objeto_proposta_obras": "objeto",
    "situacao_agrupada_obras": "situacao",
    "desc_orgao_obras": "secretaria",
    "desc_orgao_sup_obras": "orgao_superior",
    "endereco_obras": "endereco",
    "latitude_obras": "latitude",
    "longitude_obras": "longitude",
    "munic_proponente_obras": "municipio",
    "uf_proponente_obras": "uf",
    "nome_tipo_obras": "valor_contrato_str",
    "execucao_fisica": "execucao_fisica_str",
    "nome_modalidade_obras": "percentual_executado_str",
    "dia_inic_vigenc_conv_obras": "data_inicio_str",
    "dia_fim_vigenc_conv_obras": "data_prevista_fim_str",
    "ano_obras": "ano_referencia",
    "ano_conclusao_obras": "ano_conclusao",
    "sistema_obras": "sistema_origem",
    "data_atualizacao_obras": "valor_repasse_str",
    "data_previsao_retomada_tratativa_obras": "valor_contrapartida_str",
    "data_criacao_obras": "valor_executado_financeiro_str",
}


def _date(text: Column | str) -> Column:
    return parse_timestamp(text, digits_as_epoch=False)


def current_works(df: DataFrame, as_of: Column) -> DataFrame:
    """Current panel rows; a row without an id gets one derived from its content."""
    names = record_columns(df)
    texts = {
        target: text_or_null(resolved(first_containing_folded(names, *words)).cast("string"))
        for target, words in CURRENT_COLUMNS.items()
    }
    texts["__payload"] = field(df, "payload_bruto")
    # the nested record is parsed only where a wanted cell is missing
    gap = F.col("num_contrato").isNull() | F.col("num_licitacao").isNull() | F.col("bairro").isNull()
    gap = gap | _date("data_inicio").isNull()
    sparse = with_texts(df, texts).withColumn("__payload", F.when(gap, F.col("__payload")))
    rows = with_payload_maps(sparse, "__payload")
    found = rows.withColumns(
        {
            "id_obra": F.coalesce(
                "id_obra", F.concat(F.lit("obra_"), F.sha2("__record", 256))
            ),
            "num_contrato": F.coalesce("num_contrato", payload_value(*NESTED_CONTRACT_KEYS)),
            "num_licitacao": F.coalesce("num_licitacao", payload_value(*NESTED_TENDER_KEYS)),
            "__place": F.when(F.col("bairro").isNull(), payload_value(*NESTED_PLACE_KEYS)),
            "data_inicio": F.coalesce(_date("data_inicio"), _date(payload_value(*NESTED_START_KEYS))),
            "data_prevista_fim": _date("data_prevista_fim"),
            **{name: amount(name, "last_separator") for name in CURRENT_NUMBERS},
        }
    )
    columns = {
        **{name: F.col(name) for name in CURRENT_COLUMNS},
        "num_contrato": F.coalesce("num_contrato", "id_obra"),
        "bairro": F.coalesce("bairro", district_after_word("__place")),
        "percentual_executado": panel_percent(
            F.col("situacao"), F.col("percentual_executado"), F.col("data_inicio"), F.col("data_prevista_fim"), as_of
        ),
    }
    return project(found, columns, as_of, CURRENT_SOURCE)


def of_municipality(df: DataFrame, word: str = vocab.MUNICIPALITY_KEY) -> DataFrame:
    """Rows whose municipality holds the word; all rows when there is no such column."""
    name = first_containing_folded(record_columns(df), "municipio")
    if name is None:
        return df
    return df.where(F.coalesce(fold(F.col(f"`{name}`")).contains(word), F.lit(False)))


def active_works(df: DataFrame, as_of: Column) -> DataFrame:
    return df.where(is_active_work("situacao", "data_prevista_fim", "data_inicio", as_of))


def best_strategy(
    export: Callable[[], DataFrame | None],
    fallbacks: Sequence[Callable[[], DataFrame | None]],
    last_snapshot: Callable[[], DataFrame | None],
    as_of: Column,
) -> DataFrame | None:
    """First collection strategy that leaves rows after its filters.

    The full export keeps every work of the municipality; the fallbacks keep active works only;
    the last snapshot is taken as it is.
    """

    def attempt(load: Callable[[], DataFrame | None], only_active: bool) -> Callable[[], DataFrame | None]:
        def run() -> DataFrame | None:
            raw = load()
            if raw is None:
                return None
            works = current_works(of_municipality(raw), as_of)
            return active_works(works, as_of) if only_active else works

        return run

    return first_with_rows(
        [attempt(export, False), *[attempt(load, True) for load in fallbacks], last_snapshot]
    )


def _legacy_cell(df: DataFrame, source: str, target: str) -> Column:
    cell = field(df, source).cast("string")
    if target.startswith("valor_") or target == "execucao_fisica_str":
        return amount(text_or_null(cell, vocab.NULL_TEXTS_LEGACY_CELL), "br_strict")
    return cell


def legacy_works(df: DataFrame, as_of: Column) -> DataFrame:
    """Legacy panel rows with typed amounts, percents, dates and coordinates."""
    rows = with_texts(df, {target: _legacy_cell(df, source, target) for source, target in LEGACY_FIELDS.items()})
    generic_name = (F.col("nome_obra") == "CONSTRUCAO") & F.col("objeto").isNotNull()
    columns = {
        **{
            name: F.col(name)
            for name in (
                "id_obra", "num_contrato", "num_licitacao", "objeto", "situacao", "secretaria", "orgao_superior",
                "endereco",
            )
        },
        "nome_obra": F.when(generic_name, F.concat_ws(" — ", "objeto", "nome_obra")).otherwise(F.col("nome_obra")),
        "latitude": coordinate("latitude"),
        "longitude": coordinate("longitude"),
        "municipio": F.lit(vocab.MUNICIPALITY),
        "uf": F.lit(vocab.STATE),
        "valor_contrato": F.col("valor_contrato_str"),
        "valor_final": F.col("execucao_fisica_str"),
        "percentual_executado": percent("percentual_executado_str"),
        "percentual_executado_financeiro": financial_percent("valor_executado_financeiro_str", "valor_contrato_str"),
        "data_inicio": _date("data_inicio_str"),
        "data_prevista_fim": _date("data_prevista_fim_str"),
        "ano_referencia": integer("ano_referencia"),
        "ano_conclusao": integer("ano_conclusao"),
        "sistema_origem": text_or_null("sistema_origem", vocab.NULL_TEXTS_LEGACY, ignore_case=True),
        "valor_repasse": F.col("valor_repasse_str"),
        "valor_contrapartida": F.col("valor_contrapartida_str"),
        "valor_executado_financeiro": F.col("valor_executado_financeiro_str"),
    }
    return project(rows, columns, as_of, LEGACY_SOURCE)


def legacy_localities(parts: Sequence[DataFrame], order: Sequence[str]) -> DataFrame:
    """Extracts of the municipality's two spellings as one list without repeats."""
    return merge_localities(parts, ["id_obra_obras", "nr_convenio_obras"], order)


def _locality(text: Column, accents: bool) -> Column:
    plain = strip(text) if accents else fold(text)
    key = F.upper(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(key.contains("/"), key).otherwise(F.concat(key, F.lit(f"/{vocab.STATE}")))


def match_locality(
    candidates: DataFrame, column: str, locality: str, prefer_exact: bool = False
) -> DataFrame:
    """The candidate that names the locality: the exact spelling when preferred, else an
    accented one, else the longest, else the alphabetically first."""
    text = F.col(column)
    wanted = F.lit(locality)
    matches = candidates.where(_locality(text, False) == _locality(wanted, False))
    exact = _locality(text, True) == _locality(wanted, True)
    accented = text.rlike(r"[^\x00-\x7F]")
    rank = F.struct(
        (F.when(exact, 0).otherwise(1) if prefer_exact else F.lit(0)).alias("exact"),
        F.when(accented, 0).otherwise(1).alias("plain"),
        (-F.length(strip(text))).alias("short"),
        text.alias("text"),
    )
    best = matches.agg(F.min_by(F.struct(*candidates.columns), rank).alias("best"))
    return best.where(F.col("best").isNotNull()).select("best.*")
