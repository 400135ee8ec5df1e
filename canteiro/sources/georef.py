"""Georeferenced works: map markers with free-form attributes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.dates import month_and_year
from canteiro.functions.geo import point_from_text
from canteiro.functions.markup import attribute, html_attributes, html_text
from canteiro.functions.status import marker_percent, marker_status
from canteiro.sources.common import project

# fixed values: words that find each attribute
ATTRIBUTE_WORDS = {
    "secretaria": ("secretaria", "órgão", "responsavel"),
    "valor": ("valor", "investimento", "custo"),
    "previsao_termino": ("fim", "previsão", "termino", "conclusão", "prazo"),
    "programa": ("programa", "fonte", "recurso"),
    "bairro": ("bairro", "localidade", "região"),
    "endereco": ("endereço", "logradouro", "local"),
    "data_inicio": ("início", "inicio", "data inicio"),
    "setor_administrativo": ("setor administrativo", "setor"),
    "objectid": ("objectid",),
}


def parse_placemarks(placemarks: DataFrame) -> DataFrame:
    """Placemarks with coordinates, plain description, attribute map and status."""
    latitude, longitude = point_from_text("coords_kml")
    return (
        placemarks.withColumn("campos_extras", html_attributes("descricao_raw"))
        .withColumns(
            {
                "descricao": html_text("descricao_raw"),
                "latitude": latitude,
                "longitude": longitude,
                "status_icone": marker_status(F.col("campos_extras"), F.col("icone"), F.col("camada")),
            }
        )
    )


def works(placemarks: DataFrame, as_of: Column, map_id: str | None = None) -> DataFrame:
    """Works from parsed placemarks of the configured map; areas without a point are context, not works."""
    extras = F.col("campos_extras")
    columns = {
        "nome_obra": F.col("nome"),
        "camada_mapa": F.col("camada"),
        "map_id": F.lit(map_id).cast("string"),
        "latitude": F.col("latitude"),
        "longitude": F.col("longitude"),
        "status": F.col("status_icone"),
        "percentual": marker_percent(extras, as_of),
        "descricao": F.col("descricao"),
    }
    for target, words in ATTRIBUTE_WORDS.items():
        columns[target] = attribute(extras, *words)
    columns["data_inicio"] = month_and_year(columns["data_inicio"])
    located = placemarks.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return project(located, columns, as_of, "egim_google_mymaps")
