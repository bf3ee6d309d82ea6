"""Corpus cleaning: documents without toxic ones and near copies, without repeated
passages and live secrets, packed into training sequences.

Every stage takes all rows its predecessor kept; its rows are written as Parquet
and read again as the next one's documents. All stages but the last return the
columns of ``documents``; the last returns the packed pieces with
their token ids.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapmart.llm import jaccard, packing, secrets, suffixes, toxicity
from snapmart.llm.common import stored, table, tidy

REMEMBERED = 100_000  # the packing's words: executors have grown by the stages before it


def tidied(stage: Callable) -> Callable:
    """A stage begins without the heaps that the one before it has filled."""
    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        tidy(spark)
        return stage(spark, docs, sf_dir)
    return begun


@tidied
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return toxicity.keep_clean(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@tidied
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five words, 0.8)."""
    return jaccard.keep_one(docs, n=5, num=8, den=10)


@tidied
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes or more that occur twice go; every document stays."""
    return suffixes.clean(docs, length=200)


@tidied
def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked; every document stays."""
    return secrets.redact(docs)


@tidied
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 2048 tokens and their places in the sequences."""
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"),
                          keep=[F.col("ids"), F.crc32("ids").alias("ids_crc32")], remembered=REMEMBERED)
    return packed.select("doc_id", "piece", "start", "length", "ids", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_copies),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", hide_secrets),
    ("best-fit packing", pack),
]

#: No SQL says the trained filter or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
