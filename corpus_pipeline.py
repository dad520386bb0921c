"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens. Each stage's result is written and reread as the next one's documents."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import compression, icws, line_dedup, mixing, sentencepiece_codec
from tidepool.llm.common import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and base rules keep."""
    return compression.reject_low_quality(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line equals or nearly equals. All rows stay; n_chars follows the text."""
    found = line_dedup.dedup_lines(docs)
    return found.select(*[F.col("kept_text").alias("text") if c == "text" else F.length("kept_text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return icws.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it."""
    return mixing.apply_mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, with parity and the round trip checked on each."""
    own = docs.select("doc_id", "lang", "source", "text")
    return sentencepiece_codec.encode(own, public_tokenizers.path("piece_bpe_32k.model"), verify_every=1).drop("text")


STAGES = [("quality rules", quality), ("line dedup", lines), ("minhash near-dedup", near), ("mixing", mix), ("sentencepiece", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{n}")
        docs = spark.read.parquet(f"{folder}/{n}")
    return docs


#: zstandard ratios, edit distances and token ids have no SQL form here; the tests compare with brute force.
ORACLE_SQL = None
