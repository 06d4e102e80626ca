"""A training-data pipeline over ``documents``: STAGES in order, each written as Parquet and reread.

A stage is (name, function); the function takes (spark, docs, sf_dir) and returns a DataFrame with
the columns of ``documents``, the last one the encoded texts.

1. toxicity: documents that score 0.7 or more go.
2. near_duplicates: one document of each SimHash group stays, the one with the smallest doc_id (null last),
   of several texts under it the one with the smallest hash.
3. secrets: every span that the scan finds is replaced by a mark; no document goes.
4. mixing: every document stays as often as the mix by source weights takes it.
5. encoding: ids of every text, and digests of the ids and of the bytes that they decode to.

Repeated rows: stage 2 leaves one of them. Empty tables give empty results.
"""

from __future__ import annotations

import os
import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lacuna.llm import bpe, mixing, secrets, simhash, toxicity
from lacuna.session import shared_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.representatives(docs.select(COLUMNS), shingle=3, max_bits=2)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs.select(COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs.select(COLUMNS))


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN, keep=("source",))
    return bpe.digests(coded, "source", "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
]

#: Learned scores and connected components have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = shared_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for k, (name, stage) in enumerate(STAGES):
        at = os.path.join(base, f"{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
