"""From raw documents to packed training sequences: quality rules, near-duplicates, pseudonyms, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro.llm.common import shared_folder
from canteiro.llm.line_quality import clean
from canteiro.llm.mixing import mixed_texts
from canteiro.llm.near_dups import without_near_duplicates
from canteiro.llm.packing import packed
from canteiro.llm.pseudonyms import pseudonymized

SEED = 20_240_501
SAMPLE_KEY = "sample key"


def _sized(documents: DataFrame) -> DataFrame:
    """n_chars after a change of texts."""
    return documents.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in documents.columns else documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; lines that many documents of a host share go from the others."""
    return _sized(clean(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return without_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms."""
    return _sized(pseudonymized(docs, SAMPLE_KEY).select(*docs.columns))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time that the mix takes a document, cut where its source's target ends."""
    return _sized(mixed_texts(docs, seed=SEED))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences."""
    import public_tokenizers

    return packed(docs, public_tokenizers.path("byte_bpe_50k.json")).withColumnRenamed("doc", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicates),
    ("personal data", personal_data),
    ("mixed sources", mixed_sources),
    ("packed sequences", packed_sequences),
]

# hashed orders and token ids are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for place, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{place}")
        docs = spark.read.parquet(f"{folder}/{place}")
    return docs
