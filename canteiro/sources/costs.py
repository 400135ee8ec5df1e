"""Reference construction costs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro import vocab
from canteiro.functions.text import first_listed, fold


def cost_category(work_type: Column | str) -> Column:
    """Cost category of a work type: the first listed word it holds, else the default."""

    return first_listed(fold(work_type, trim=False), list(vocab.COST_CATEGORY_BY_WORD), F.lit(vocab.DEFAULT_COST_CATEGORY))


def reference_cost(category: Column) -> Column:
    """R$ per square metre of a category."""
    table = F.create_map(*[F.lit(cell) for entry in vocab.COST_PER_M2.items() for cell in entry])
    return F.try_element_at(table, category)


def with_reference_cost(works: DataFrame, work_type: str = "tipo") -> DataFrame:
    """Works with their cost category and reference cost; no join, the table has 16 rows."""
    return works.withColumn("categoria_custo", cost_category(work_type)).withColumn(
        "custo_m2_referencia", reference_cost(F.col("categoria_custo"))
    )


def reference_table(spark: SparkSession, as_of: Column) -> DataFrame:
    """The cost references of one month as a table."""
    rows = spark.createDataFrame(list(vocab.COST_PER_M2.items()), "tipo_obra string, custo_m2 double")
    return rows.select(
        F.lit(vocab.STATE).alias("uf"),
        F.date_format(as_of, "yyyy-MM").alias("competencia"),
        "tipo_obra",
        "custo_m2",
        as_of.cast("timestamp").alias("coletado_em"),
    )
