"""A training corpus from ``documents``: quality, near duplicates, leaks, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and reads nothing but its predecessor's rows, besides the
labels and the benchmark.  All but the last return the columns of documents.  Between stages the
rows are written as Parquet and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from saleslane.llm import decontaminate, mixing, quality, simhash, token_codes
from saleslane.plans.durable import durable


def keep_good_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep(docs, quality.train(docs, labels))


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within four bits over four-word shingles: the smallest id."""
    return simhash.keep_first(docs, shingle=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item leaks."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled so that source, language and topic have their target shares of tokens."""
    return mixing.mix(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document, read back from the written codes: doc_id, start, n_tokens, ids_crc32."""
    return token_codes.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("quality", keep_good_texts),
    ("near_dedup", keep_one_of_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_to_targets),
    ("token_ids", write_token_ids),
]

#: Classifier, components and sampling have no SQL; tests compare the run with its operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
