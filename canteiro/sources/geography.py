"""Municipality profile from the statistics office."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro.functions.geo import perimeter_points
from canteiro.functions.numbers import statistic
from canteiro.operators.aggregates import statistics_row

PLACE_RECORD = (
    "id string, nome string, microrregiao struct<id:string,nome:string,mesorregiao:"
    "struct<id:string,nome:string,UF:struct<id:string,sigla:string,nome:string>>>, "
    "`regiao-imediata` struct<id:string,nome:string,`regiao-intermediaria`:struct<id:string,nome:string>>"
)

# fixed values: statistic number -> column
STATISTICS = {
    93: "populacao_censo_2022",
    9324: "populacao_estimada",
    6318: "area_territorial_km2",
    614: "densidade_demografica",
    37: "pib_per_capita",
    30255: "idhm",
}
WHOLE_NUMBERS = ("populacao_censo_2022", "populacao_estimada")


def places(df: DataFrame) -> DataFrame:
    """Nested place records as one flat row each."""
    region = F.col("`regiao-imediata`")
    state = F.col("microrregiao.mesorregiao.UF")
    return df.select(
        F.col("id").cast("string").alias("municipio_id"),
        F.col("nome").alias("municipio_nome"),
        state["sigla"].alias("uf_sigla"),
        state["nome"].alias("uf_nome"),
        F.col("microrregiao.mesorregiao.nome").alias("mesorregiao_nome"),
        F.col("microrregiao.nome").alias("microrregiao_nome"),
        region["nome"].alias("regiao_imediata_nome"),
        region["regiao-intermediaria"]["nome"].alias("regiao_intermediaria_nome"),
    )


def profiles(places_df: DataFrame, statistics: DataFrame, as_of: Column, order: str) -> DataFrame:
    """One row per municipality: place names and its statistics.

    ``statistics`` has municipio_id, variavel (number), valor (text) and the order column.
    """
    row = statistics_row(statistics, "municipio_id", "variavel", "valor", order, STATISTICS)
    typed = {name: statistic(F.col(name)) for name in STATISTICS.values()}
    for name in WHOLE_NUMBERS:
        typed[name] = typed[name].try_cast("bigint")
    return places_df.join(row, "municipio_id", "left").withColumns(
        {**typed, "fonte": F.lit("ibge"), "coletado_em": as_of.cast("timestamp")}
    )


def perimeter_size(geojson: DataFrame) -> DataFrame:
    """Ring points per perimeter; ``polygon`` or ``multi_polygon`` holds the coordinates."""
    points = perimeter_points(F.col("polygon"), F.col("multi_polygon"))
    return geojson.withColumn("pontos", points).drop("polygon", "multi_polygon")
