"""From raw documents to packed training sequences: each stage works on all that the one before kept.

Edge cases: a row is a document, also where ids repeat or are null. Documents without a text, with an empty one or with fewer than ten
words go at the first stage; of rows equal in id and text one stays at the second; very long texts pass through every stage
whole and are cut into pieces at the last; a null language or source is a node of its own in the mix; an empty table gives no rows.
Columns that the documents have besides those named are carried along.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from noisefield.llm import mixing, near, packing, quality, suffix
from noisefield.llm._store import shared_dir

#: Tokens of the mix as a share of what is left, and target weights of domains.
MIX_SHARE = 0.9
MIX_WEIGHTS = {("domain0",): 2.0}


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.keep_good(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the smallest id stays."""
    return near.keep_first(docs, words_each=5, percent=80)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id also has are cut out."""
    return suffix.cut_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the sources' budgets go; a document that the budget cuts stays whole. Each is used once at most."""
    levels = {"domain": mixing.source_domain(F.col("source")), "lang": F.col("lang"), "source": F.col("source")}
    return mixing.keep_mixed(docs, MIX_SHARE, MIX_WEIGHTS, levels=levels)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 4096 tokens."""
    return packing.best_two_fit(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", filter_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a Parquet table in the shared folder, read again by the next."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
