"""The training-data pipeline: documents to packed sequences.

Each stage works on all its predecessor kept, written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import mixing, packing, queries, simhash, suffix_dedup
from keelson.llm.common import staged, table, unused

#: A repeated passage of this many bytes goes. Fifty words of prose are 250 to 330 bytes (on sf0.1 the shortest
#: fifty-word window of a repeated run has a median of 288, and 7 % of them are shorter than this); far shorter strings
#: would take set phrases out of clean texts.
PASSAGE_BYTES = 240


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the evidence does not tell go."""
    return queries.identified_documents(docs).filter("lang_kept").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.one_of_each(docs)


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go; a document that was nothing else goes with them."""
    size = unused(docs.columns, "__bytes")
    left = suffix_dedup.without_repeats(docs.withColumn(size, F.octet_length("text")), length=PASSAGE_BYTES)
    emptied = (F.col("text") == "") & (F.col(size) > 0)
    return (
        left.filter(~F.coalesce(emptied, F.lit(False)))
        .withColumn("n_chars", F.when(F.octet_length("text") != F.col(size), F.length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    return packing.pack(docs, public_tokenizers.path(queries.PACKING_TOKENIZER))


STAGES = [
    ("language_id", language),
    ("simhash", near_duplicates),
    ("suffix_dedup", repeats),
    ("mixing", mix),
    ("packing", pack),
]

#: Hashes, tokenizers and the text model are beyond SQL; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
