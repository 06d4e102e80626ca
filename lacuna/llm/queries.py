"""Registered queries of the corpus operators and, where SQL expresses them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lacuna.llm import bpe, chat, licenses, mixing, quality, secrets, sharding, simhash, spelling, topk, toxicity, urlfilter, whitening
from lacuna.llm.oracle import ORACLE  # noqa: F401

QUERIES = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_simhash_neardup(spark, sf_dir):
    """SimHash groups of all documents: 3-word shingles, two differing bits."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op8_secret_scan(spark, sf_dir):
    """Secrets of all documents, in every layer of encoding."""
    found = secrets.secret_spans(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.depth == 0)
    count = lambda kind: F.size(F.filter("spans", lambda s: (s.depth == 0) & (s.kind == kind))).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS],
                        F.sha2(secrets.digest(base), 256).alias("base_sha256"),
                        secrets.digest(F.col("spans")).alias("spans"))


@_query
def op10_toxicity(spark, sf_dir):
    """Toxicity of all documents; fitted on the labelled rows that are not held out."""
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_byte_bpe(spark, sf_dir):
    """Byte-level BPE round trip of all documents."""
    coded = bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                           public_tokenizers.PATTERN)
    return bpe.digests(coded)


@_query
def op1_quality_rules(spark, sf_dir):
    """Quality rules of all documents; cutoffs certified for each language on the labelled rows."""
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op9_source_mixing(spark, sf_dir):
    """Words that a mix of all documents takes, by source weights 5, 2, 1, at most three copies."""
    return mixing.mixture(_table(spark, sf_dir, "documents"))


@_query
def op5_sharding(spark, sf_dir):
    """Uniform shuffle of all documents into 16 shards whose row counts are at most one apart."""
    found = sharding.shards(_table(spark, sf_dir, "documents"), 16)
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@_query
def op4_url_filter(spark, sf_dir):
    """Verdicts on the URLs of all pages."""
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


@_query
def op7_topk_search(spark, sf_dir):
    """The 20 best inner products among all vectors, for those whose id is divisible by 20."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=20, every=20)


@_query
def op6_chat_perspectives(spark, sf_dir):
    """All conversations from the perspective of each participant."""
    found = chat.perspectives(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("mask", lambda m: F.concat_ws(":", m.start.cast("string"), m.end.cast("string"))), ",")
    part = F.concat_ws(":", F.col("part.turn").cast("string"), F.col("part.deal").cast("string"))
    return found.select("conv_id", "speaker", "block", F.coalesce(part, F.lit("")).alias("part"), "n_turns", "n_rows", "text", mask.alias("mask"))


@_query
def op13_spelling_variants(spark, sf_dir):
    """Words of all documents, their near words and the form that each is a variant of."""
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), least=7, every=31, twice=2, ratio=10)


@_query
def op12_embedding_whitening(spark, sf_dir):
    """All vectors on the four leading components of the distinct ones, scaled to unit variance."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"), components=4, scale=256)


@_query
def op11_license_scan(spark, sf_dir):
    """License phrases of all documents, and the templates that blocks of them contain."""
    return licenses.digests(licenses.scan(_table(spark, sf_dir, "documents")))
