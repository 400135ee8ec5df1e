"""Federal agreements and the national dump of agreements and amendment terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.dates import parse_timestamp
from canteiro.functions.numbers import amount, to_double
from canteiro.functions.text import digits_only, strip
from canteiro.operators.aggregates import amendment_totals
from canteiro.operators.dedup import keep_first
from canteiro.operators.joins import within_keys
from canteiro.sources.common import carried, project

AGREEMENT_RECORD = (
    "situacao string, dataConclusao string, dataInicioVigencia string, dataFinalVigencia string, "
    "dataPublicacao string, valor string, valorLiberado string, valorContrapartida string, "
    "dimConvenio struct<codigo:string,numero:string,objeto:string>, "
    "convenente struct<cnpjFormatado:string,nome:string>, orgao struct<nome:string>"
)


def _date(text: Column) -> Column:
    return parse_timestamp(text, digits_as_epoch=False)


def agreements(df: DataFrame, as_of: Column, order: list[str]) -> DataFrame:
    """One row per agreement number; records without a number are dropped."""
    code = strip(F.col("dimConvenio.codigo").cast("string"))
    columns = {
        "nr_convenio": F.nullif(code, F.lit("")),
        "numero": F.col("dimConvenio.numero"),
        "objeto": F.col("dimConvenio.objeto"),
        "situacao": F.col("situacao"),
        "data_conclusao": _date(F.col("dataConclusao")),
        "data_inicio_vigencia": _date(F.col("dataInicioVigencia")),
        "data_fim_vigencia": _date(F.col("dataFinalVigencia")),
        "data_publicacao": _date(F.col("dataPublicacao")),
        "valor": to_double(F.col("valor")),
        "valor_liberado": to_double(F.col("valorLiberado")),
        "valor_contrapartida": to_double(F.col("valorContrapartida")),
        "cnpj_proponente": digits_only(F.col("convenente.cnpjFormatado")),
        "nome_proponente": F.col("convenente.nome"),
        "orgao": F.col("orgao.nome"),
        "municipio_ibge": F.lit(vocab.MUNICIPALITY_CODE),
    }
    rows = project(df, columns, as_of).where(F.col("nr_convenio").isNotNull())
    return keep_first(rows, ["nr_convenio"], order)


def agreement_numbers(legacy_works: DataFrame) -> DataFrame:
    """Agreement numbers the legacy works refer to, without repeats."""
    number = strip(F.col("num_licitacao").cast("string"))
    return (
        legacy_works.select(number.alias("nr_convenio"))
        .where(F.col("nr_convenio").isNotNull() & ~F.col("nr_convenio").isin("", "None"))
        .distinct()
    )


def dump_amendments(
    agreements_dump: DataFrame, terms_dump: DataFrame, wanted: DataFrame, as_of: Column
) -> DataFrame:
    """Agreements of interest with the total of their amendment terms.

    Terms are cut to the wanted numbers and summed before the join, so an agreement with very
    many terms reaches the join as one row. The total is NULL without any term and 0 when every
    term only extends the period. The dump's last line per number counts.
    """
    number = strip(F.col("NR_CONVENIO"))
    listed = within_keys(agreements_dump.withColumn("nr_convenio", number), "nr_convenio", wanted, "nr_convenio")
    count = strip(F.col("QTD_TA"))
    order = carried(agreements_dump)
    typed = listed.select(
        "nr_convenio",
        F.nullif(strip(F.col("ID_PROPOSTA")), F.lit("")).alias("id_proposta"),
        F.bround(amount("VL_GLOBAL_CONV", "dump"), 2).alias("valor_global"),
        F.coalesce(F.when(count.rlike(r"^\d+$"), count.try_cast("bigint")), F.lit(0)).alias("qtd_aditivos"),
        F.col("SIT_CONVENIO").alias("situacao"),
        _date(F.col("DIA_FIM_VIGENC_CONV")).alias("data_fim_vigencia"),
        _date(F.col("DIA_FIM_VIGENC_ORIGINAL_CONV")).alias("data_fim_vigencia_original"),
        *order,
    )
    if order:
        typed = keep_first(typed, ["nr_convenio"], [F.col(name).desc() for name in order]).drop(*order)
    terms = within_keys(terms_dump.withColumn("nr_convenio", number), "nr_convenio", wanted, "nr_convenio")
    totals = amendment_totals(
        terms.select("nr_convenio", amount("VL_GLOBAL_TA", "dump").alias("valor")), "nr_convenio", "valor"
    )
    return typed.join(totals, "nr_convenio", "left").withColumns(
        {
            "cnpj_proponente": F.lit(None).cast("string"),
            "nome_proponente": F.lit(None).cast("string"),
            "coletado_em": as_of.cast("timestamp"),
        }
    )
