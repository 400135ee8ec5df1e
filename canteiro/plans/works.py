"""Works: six sources in one schema, enriched from federal data, placed and measured."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canteiro import vocab
from canteiro.functions.dates import delay_days, expected_end, percent_complete
from canteiro.functions.geo import in_bounding_box, wkt_point
from canteiro.functions.ids import surrogate_key
from canteiro.functions.numbers import amount, stopped_work_percent
from canteiro.functions.status import agreement_cancelled, agreement_settled, official_status
from canteiro.functions.text import district_in_text, mentions_works, street_in_text
from canteiro.operators.dedup import keep_first, one_per_source
from canteiro.operators.fields import conform, field, first_column_with_values, first_filled
from canteiro.operators.joins import attach

WORKS_SCHEMA = (
    "nome string, objeto string, tipo string, situacao string, secretaria string, bairro string, "
    "endereco string, municipio string, uf string, percentual_executado double, "
    "percentual_executado_financeiro double, valor_contrato double, valor_aditivos double, "
    "valor_final double, qtd_aditivos bigint, data_inicio timestamp, data_prevista_fim timestamp, "
    "data_conclusao timestamp, ano_conclusao bigint, latitude double, longitude double, "
    "cnpj_executora string, num_contrato string, num_licitacao string, fonte_origem string, "
    "id_origem string"
)
# columns that settle which of two rows with the same source and id is kept
TIE_BREAK = ("nome", "objeto", "data_inicio", "valor_contrato", "latitude", "longitude")


def _works(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    fixed = {"municipio": F.lit(vocab.MUNICIPALITY), "uf": F.lit(vocab.STATE)}
    selected = df.select(*[column.alias(name) for name, column in {**columns, **fixed}.items()])
    return conform(selected, T.StructType.fromDDL(WORKS_SCHEMA))


def _same(df: DataFrame, *names: str) -> dict[str, Column]:
    return {name: field(df, name) for name in names}


def from_current_panel(df: DataFrame) -> DataFrame:
    return _works(
        df,
        {
            "nome": field(df, "nome_obra"),
            "objeto": field(df, "nome_obra"),
            "tipo": F.lit("Obra Municipal"),
            "situacao": official_status(field(df, "situacao")),
            **_same(
                df, "secretaria", "bairro", "endereco", "percentual_executado", "valor_contrato", "valor_aditivos",
                "data_inicio", "data_prevista_fim", "latitude", "longitude", "cnpj_executora", "num_contrato",
                "num_licitacao",
            ),
            "fonte_origem": F.lit("painel_obras_atual_macae"),
            "id_origem": field(df, "id_obra"),
        },
    )


def from_legacy_panel(df: DataFrame) -> DataFrame:
    return _works(
        df,
        {
            "nome": field(df, "nome_obra"),
            "objeto": F.coalesce(field(df, "objeto"), field(df, "nome_obra")),
            "tipo": F.lit("Obra Municipal"),
            "situacao": official_status(field(df, "situacao")),
            **_same(
                df, "secretaria", "bairro", "percentual_executado", "percentual_executado_financeiro",
                "valor_contrato", "valor_aditivos", "valor_final", "data_inicio", "data_prevista_fim",
                "data_conclusao", "ano_conclusao", "latitude", "longitude", "cnpj_executora", "num_contrato",
                "num_licitacao",
            ),
            "fonte_origem": F.lit("painel_obras_legado_macae"),
            "id_origem": field(df, "id_obra"),
        },
    )


def from_contracts(df: DataFrame) -> DataFrame:
    """Contracts whose object names public works; place and street come from the object text.

    The secretariat column is used when any of the selected contracts has one, else the body,
    else the managing unit: a choice for the whole frame, not per row.
    """
    chosen = df.where(mentions_works(field(df, "objeto")))
    return _works(
        chosen,
        {
            "nome": F.substring(F.col("objeto"), 1, 200),
            "objeto": F.col("objeto"),
            "tipo": F.coalesce(field(chosen, "tipo_contrato"), F.lit("Obra Municipal")),
            "situacao": official_status(field(chosen, "situacao")),
            "secretaria": first_column_with_values(chosen, "secretaria", "orgao", "unidade_gestora"),
            "bairro": district_in_text("objeto"),
            "endereco": street_in_text("objeto"),
            "valor_contrato": field(chosen, "valor_inicial", "double"),
            "valor_aditivos": field(chosen, "valor_aditivos", "double"),
            "data_inicio": F.coalesce(
                field(chosen, "data_inicio_vigencia", "timestamp").cast("timestamp"),
                field(chosen, "data_assinatura", "timestamp").cast("timestamp"),
            ),
            "data_prevista_fim": field(chosen, "data_fim_vigencia", "timestamp"),
            "fonte_origem": field(chosen, "fonte"),
            "id_origem": field(chosen, "id_contrato"),
        },
    )


def from_health(df: DataFrame) -> DataFrame:
    proposal = field(df, "proposta_id").cast("string")
    return _works(
        df,
        {
            "nome": first_filled(
                field(df, "nome_estabelecimento"),
                field(df, "tipo_obra"),
                F.concat(F.lit("Obra SISMOB "), proposal),
            ),
            "objeto": field(df, "tipo_obra"),
            "tipo": F.lit("Saúde"),
            "situacao": official_status(field(df, "situacao")),
            "secretaria": F.lit("Saúde"),
            "bairro": field(df, "bairro"),
            "endereco": field(df, "logradouro"),
            "percentual_executado": field(df, "percentual_executado", "double"),
            "valor_contrato": field(df, "valor_proposta", "double"),
            "data_prevista_fim": F.coalesce(
                field(df, "dt_prevista_conclusao_final", "timestamp").cast("timestamp"),
                field(df, "dt_prevista_conclusao", "timestamp").cast("timestamp"),
            ),
            "data_conclusao": field(df, "dt_conclusao_final", "timestamp"),
            "latitude": field(df, "latitude", "double"),
            "longitude": field(df, "longitude", "double"),
            "fonte_origem": F.lit("sismob_cidadao"),
            "id_origem": proposal,
        },
    )


def from_map(df: DataFrame) -> DataFrame:
    start = field(df, "data_inicio", "timestamp").cast("timestamp")
    return _works(
        df,
        {
            "nome": field(df, "nome_obra"),
            "objeto": field(df, "descricao"),
            "tipo": F.lit("Georreferenciada"),
            "situacao": official_status(field(df, "situacao")),
            "secretaria": field(df, "secretaria"),
            "bairro": field(df, "bairro"),
            "endereco": field(df, "endereco"),
            "percentual_executado": field(df, "percentual", "double"),
            "valor_contrato": amount(field(df, "valor"), "br_strict"),
            "data_inicio": start,
            "data_prevista_fim": expected_end(field(df, "previsao_termino"), start),
            "latitude": field(df, "latitude", "double"),
            "longitude": field(df, "longitude", "double"),
            "fonte_origem": F.lit("egim_google_mymaps"),
            "id_origem": field(df, "nome_obra"),
        },
    )


def from_stopped(df: DataFrame) -> DataFrame:
    kind, name = field(df, "tipo_obra"), field(df, "nome_obra")
    paid = field(df, "valor_pago_obra", "double").cast("double")
    value = field(df, "valor_contrato", "double").cast("double")
    return _works(
        df,
        {
            "nome": name,
            "objeto": F.coalesce(kind, name),
            "tipo": F.coalesce(kind, F.lit("Obra Paralisada")),
            "situacao": F.lit("Paralisada"),
            "secretaria": F.coalesce(field(df, "orgao"), field(df, "funcao_governo"), name),
            "percentual_executado": stopped_work_percent(
                field(df, "percentual_executado", "double"), paid, value
            ),
            "valor_contrato": value,
            "valor_final": paid,
            "data_inicio": field(df, "data_inicio", "timestamp"),
            "data_prevista_fim": field(df, "data_paralisacao", "timestamp"),
            "fonte_origem": F.lit("tce_rj_obras_paralisadas"),
            "id_origem": field(df, "id_obra"),
        },
    )


# raw table -> projection, in the order of the union
PROJECTIONS = {
    "raw_obras_atual": from_current_panel,
    "raw_obras_legado": from_legacy_panel,
    "raw_contratos": from_contracts,
    "raw_obras_saude": from_health,
    "raw_obras_georef": from_map,
    "raw_obras_paralisadas": from_stopped,
}


def union_of_sources(raw: Mapping[str, DataFrame]) -> DataFrame:
    """All given sources in the common schema."""
    parts = [project(raw[name]) for name, project in PROJECTIONS.items() if raw.get(name) is not None]
    if not parts:
        raise ValueError("no source of works given")
    return reduce(DataFrame.unionByName, parts)


def _one_per_agreement(df: DataFrame) -> DataFrame:
    return keep_first(
        df.where(F.col("nr_convenio").isNotNull()), ["nr_convenio"], [n for n in df.columns if n != "nr_convenio"]
    )


def with_federal_amendments(works: DataFrame, amendments: DataFrame) -> DataFrame:
    """Amendment value and count of the work's agreement.

    The value fills only where the source has none. For settled agreements the end of the
    period stands in for an unknown completion date, and its original end is the deadline.
    """
    names = ("valor_aditivos", "qtd_aditivos", "situacao", "data_fim_vigencia", "data_fim_vigencia_original")
    kinds = dict(zip(names, ("double", "bigint", "string", "timestamp", "timestamp"), strict=True))
    typed = amendments.select(
        F.col("nr_convenio").cast("string").alias("nr_convenio"),
        *[field(amendments, name, kind).cast(kind).alias(name) for name, kind in kinds.items()],
    )
    joined = attach(
        works, _one_per_agreement(typed), "num_licitacao", "nr_convenio", {name: f"_f_{name}" for name in names}
    )
    settled = agreement_settled("_f_situacao")
    return joined.withColumns(
        {
            "valor_aditivos": F.coalesce("valor_aditivos", "_f_valor_aditivos"),
            "qtd_aditivos": F.coalesce("qtd_aditivos", "_f_qtd_aditivos"),
            "data_conclusao": F.coalesce("data_conclusao", F.when(settled, F.col("_f_data_fim_vigencia"))),
            "data_prevista_fim": F.coalesce(
                F.when(settled, F.col("_f_data_fim_vigencia_original")), F.col("data_prevista_fim")
            ),
        }
    ).drop(*[f"_f_{name}" for name in names])


def with_actual_completion(works: DataFrame, agreements: DataFrame, as_of: Column) -> DataFrame:
    """Published completion date of the work's agreement; it overrides any stand-in.

    Used only when it lies in the past and the agreement was not cancelled.
    """
    typed = agreements.select(
        F.col("nr_convenio").cast("string").alias("nr_convenio"),
        field(agreements, "data_conclusao", "timestamp").cast("timestamp").alias("data"),
        field(agreements, "situacao").alias("situacao"),
    )
    joined = attach(
        works, _one_per_agreement(typed), "num_licitacao", "nr_convenio", {"data": "_c_data", "situacao": "_c_situacao"}
    )
    usable = (F.col("_c_data") <= as_of) & ~agreement_cancelled("_c_situacao")
    return joined.withColumn(
        "data_conclusao", F.coalesce(F.when(usable, F.col("_c_data")), F.col("data_conclusao"))
    ).drop("_c_data", "_c_situacao")


def place_queries(street: Column, district: Column) -> tuple[Column, Column]:
    """Texts under which the gazetteer knows a place: full address, then district only."""
    tail = [F.lit(vocab.MUNICIPALITY), F.lit(vocab.STATE), F.lit(vocab.COUNTRY)]
    street, district = F.nullif(street, F.lit("")), F.nullif(district, F.lit(""))
    full = F.when(street.isNotNull(), F.concat_ws(", ", street, district, *tail))
    area = F.when(district.isNotNull(), F.concat_ws(", ", district, *tail))
    return full, area


def with_gazetteer(works: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Coordinates of works that have a place but no point.

    The gazetteer has consulta, latitude, longitude; an entry without coordinates, or with ones
    outside the municipality, counts as not found and the next query is tried.
    """
    places = keep_first(
        gazetteer.where(in_bounding_box("latitude", "longitude")), ["consulta"], ["latitude", "longitude"]
    )
    full, area = place_queries(F.col("endereco"), F.col("bairro"))
    unplaced = F.col("latitude").isNull() | F.col("longitude").isNull()
    asked = works.withColumns({"_q_full": F.when(unplaced, full), "_q_area": F.when(unplaced, area)})
    for level in ("full", "area"):
        asked = attach(
            asked, places, f"_q_{level}", "consulta", {"latitude": f"_{level}_lat", "longitude": f"_{level}_lon"}
        )
    by_full = F.col("_full_lat").isNotNull()
    found_lat = F.when(by_full, F.col("_full_lat")).otherwise(F.col("_area_lat"))
    found_lon = F.when(by_full, F.col("_full_lon")).otherwise(F.col("_area_lon"))
    return asked.withColumns(
        {
            "latitude": F.when(unplaced & found_lat.isNotNull(), found_lat).otherwise(F.col("latitude")),
            "longitude": F.when(unplaced & found_lat.isNotNull(), found_lon).otherwise(F.col("longitude")),
        }
    ).drop("_q_full", "_q_area", "_full_lat", "_full_lon", "_area_lat", "_area_lon")


def finished(works: DataFrame, as_of: Column) -> DataFrame:
    """Geometry, fallbacks for required columns, percent complete and delay."""
    named = works.withColumns(
        {
            "geometry": wkt_point("latitude", "longitude"),
            "municipio": F.coalesce("municipio", F.lit(vocab.MUNICIPALITY)),
            "uf": F.coalesce("uf", F.lit(vocab.STATE)),
            "nome": F.coalesce("nome", "objeto", "id_origem"),
            "situacao": F.coalesce("situacao", F.lit(vocab.UNDEFINED_STATUS)),
        }
    )
    return named.withColumns(
        {
            "percentual_executado": percent_complete(
                "situacao", "percentual_executado", "data_inicio", "data_prevista_fim", as_of
            ),
            "dias_atraso": delay_days("data_prevista_fim", "data_conclusao", as_of),
            "id": surrogate_key("fonte_origem", "id_origem"),
        }
    )


def work_keys(raw: Mapping[str, DataFrame]) -> DataFrame:
    """id, source and source id of every work, without anything else of it.

    What refers to works needs only these: no enrichment, no choice among rows of one key.
    """
    known = union_of_sources(raw).select("fonte_origem", "id_origem").dropna().distinct()
    return known.withColumn("id", surrogate_key("fonte_origem", "id_origem"))


def works(
    raw: Mapping[str, DataFrame], as_of: Column, gazetteer: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Consolidated works and the rows rejected for having no id."""
    merged = union_of_sources(raw)
    rejected = merged.where(F.col("id_origem").isNull() | F.col("fonte_origem").isNull())
    unique = one_per_source(
        merged.where(F.col("id_origem").isNotNull() & F.col("fonte_origem").isNotNull()), TIE_BREAK
    )
    if raw.get("raw_aditivos_federais") is not None:
        unique = with_federal_amendments(unique, raw["raw_aditivos_federais"])
    if raw.get("raw_convenios_federais") is not None:
        unique = with_actual_completion(unique, raw["raw_convenios_federais"], as_of)
    if gazetteer is not None:
        unique = with_gazetteer(unique, gazetteer)
    return finished(unique, as_of), rejected
