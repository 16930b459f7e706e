"""The corpus pipeline: documents through stages, each written and read again by the next.

run(spark, sf_dir) -> DataFrame; each stage takes (spark, docs, sf_dir), works on whatever
documents table it is given and, but for the last, returns the same columns. Null and empty texts
have no language and go in the first stage. Rows with a null doc_id are judged where that needs no
name (language, certain secrets) and stay where it does. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burgage.llm import decontamination, langid, mixing, secret_scan, simhash
from burgage.llm.runs import crc_mod
from burgage.session import written

MIN_LANGUAGE_SCORE = 0.5  # below that no language is likelier than all others together


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from those that are not held out."""
    learn = F.coalesce(crc_mod("doc_id", 3) != 1, F.lit(True))
    return langid.identified(docs, learn, MIN_LANGUAGE_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each group of SimHash near-duplicates."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_benchmark(docs, items)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without secrets, be they certain or linked."""
    return secret_scan.without_secrets(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight draws it, with the keys of the order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("secret_scans", drop_secrets),
    ("source_mixing", mix_sources),
]

# Language ID and SimHash have no SQL form; tests/llm compares with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
