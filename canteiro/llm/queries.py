"""The registered queries of the subpackage, with production parameters, and their checking SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canteiro.llm import checks
from canteiro.llm.common import row_hash

SEED = 20_240_501
# pseudonyms of the registered query; a real run passes a key of its own
SAMPLE_KEY = "sample key"
SHARDS = 24
TOP = 5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.mixing import mix

    made = mix(_table(spark, folder, "documents"), seed=SEED)
    taken = made.pieces.groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("slot"))
    rows = made.documents.join(taken, "row", "left").join(
        made.sources.select("source_id", "source_size", "target"), "source_id"
    )
    return rows.select(
        F.col("doc").alias("doc_id"),
        "size",
        "source_size",
        "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        "slot",
    )


def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.near_dups import groups

    found = groups(_table(spark, folder, "documents"), width=4, percent=80)
    kept = F.coalesce(F.col("doc") == F.col("component"), F.lit(False))
    return found.select(
        F.col("doc").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), kept.alias("kept")
    )


def op3_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.pseudonyms import KINDS, pseudonymized

    made = pseudonymized(_table(spark, folder, "documents"), SAMPLE_KEY)
    counts = [F.coalesce(F.try_element_at("findings", F.lit(k)), F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS]
    return made.select("doc_id", "text", *counts)


def op4_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.line_quality import verdicts

    return verdicts(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "words_removed",
    )


def op5_id_files(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.id_files import read_ids, write_ids

    files = write_ids(_table(spark, folder, "documents"), _vocabulary("byte_bpe_50k.json"))
    return read_ids(spark, files).withColumnRenamed("doc", "doc_id")


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.token_counts import counted

    return counted(_table(spark, folder, "documents"), _vocabulary("piece_bpe_32k.model"))


def op7_shards(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.sharding import sharded

    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    digests = _table(spark, folder, "documents").select(
        "doc_id",
        (F.octet_length(data) + 8).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"),
        row_hash("text").alias("content"),
    )
    return sharded(digests, ["doc_id", "content"], SHARDS, SEED).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_top_k(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.top_k import top_k

    return top_k(_table(spark, folder, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0, TOP)


def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.warc import archived

    return archived(_table(spark, folder, "pages"), least_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_packed(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.packing import packed

    made = packed(_table(spark, folder, "documents"), _vocabulary("byte_bpe_50k.json"))
    return made.withColumnRenamed("doc", "doc_id")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.negatives import hard_negatives

    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, moved)


def op12_spellings(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.spellings import counted_words, variants

    words = counted_words(_table(spark, folder, "documents"))
    return variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def op13_repeats(spark: SparkSession, folder: str) -> DataFrame:
    from canteiro.llm.repeats import without_repeats

    return without_repeats(_table(spark, folder, "documents"), width=200).withColumnRenamed("doc", "doc_id")


# name -> (query, checking SQL or None)
QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_mixed_sources": (op1_mixed_sources, None),
    "op2_near_duplicates": (op2_near_duplicates, checks.NEAR_DUPLICATES),
    "op3_pseudonyms": (op3_pseudonyms, None),
    "op4_line_quality": (op4_line_quality, checks.LINE_QUALITY),
    "op5_id_files": (op5_id_files, None),
    "op6_token_counts": (op6_token_counts, None),
    "op7_shards": (op7_shards, None),
    "op8_top_k": (op8_top_k, checks.TOP_K),
    "op9_warc": (op9_warc, checks.WARC),
    "op10_packed": (op10_packed, None),
    "op11_hard_negatives": (op11_hard_negatives, checks.HARD_NEGATIVES),
    "op12_spellings": (op12_spellings, checks.SPELLINGS),
    "op13_repeats": (op13_repeats, None),
}
