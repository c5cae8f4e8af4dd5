"""Training-data pipeline over ``documents``: five stages, each written and read back."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histoframe.llm.bpe import bpe_encode, digests
from histoframe.llm.decontaminate import without_benchmark
from histoframe.llm.language import train, training_rows, with_known_language
from histoframe.llm.near_dedup import without_copies
from histoframe.llm.surrogates import replace_personal_data
from histoframe.session import materialize

#: Secret of the surrogates; a deployment sets its own.
SURROGATE_KEY = "corpus pipeline"
#: Vocabulary file, under the same path on every executor.
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and a language the model is at least half sure of."""
    return with_known_language(docs, train(training_rows(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return without_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with surrogates for personal data and its length brought up to date."""
    replaced = replace_personal_data(docs, SURROGATE_KEY)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return replaced.withColumn("n_chars", length).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, ids) of every document."""
    encoded = bpe_encode(docs, VOCABULARY)
    return digests(encoded, "ids")


STAGES = [
    ("language_id", known_language),
    ("minhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminate),
    ("pii_surrogates", private),
    ("bpe_encode_decode", tokenize),
]

#: The language model and keyed replacements can't be put in SQL; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the ``documents`` of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
