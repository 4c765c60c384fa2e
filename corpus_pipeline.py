"""A training corpus from ``documents``: rules, line and near dedup, mixing, packing.

Every stage works on all that its predecessor kept. ``run`` stores what a stage returns before
the next one reads it, so a lost executor costs tasks of one stage only. Shuffles get as many
partitions as the size of the documents asks for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.llm import line_dedup, minhash, mixing, packing, quality
from strandline.session import keep, sized_for

#: Expected tokens wanted of each domain, as a multiple of those at hand; no document is repeated.
DOMAIN_MULTIPLES = {"good": 1.0, "plain": 1.0, "toxic": 0.2}


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose source is not rejected."""
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that nearly equal an earlier line; n_chars follows the text.

    A document of which no word is left goes: all its lines stand in earlier ones.
    """
    slim = line_dedup.dedup_lines(docs).where("n_removed = 0 OR text RLIKE '[^ \\\\t-\\\\r]'")
    return slim.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the smallest id."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at rates that bring the domains to their targets."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mixed(docs, labels, mixing.label_domain(), DOMAIN_MULTIPLES, max_rate=1.0)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of equal length."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_stage),
    ("near dedup", near_dedup),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: SQL can express neither the classifier's rates nor tokens.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/documents.parquet"
    docs = spark.read.parquet(path)
    # the shuffles of all stages grow with the documents
    with sized_for(spark, path):
        for number, (name, stage) in enumerate(STAGES):
            docs = stage(spark, docs, sf_dir)
            if number < len(STAGES) - 1:
                docs = keep(docs, name.replace(" ", "-"))
    return docs
