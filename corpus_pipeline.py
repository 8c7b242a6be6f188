"""A corpus pipeline of five stages over ``documents``.

Quality rules, line deduplication, near-duplicate removal, decontamination,
packing.  Each stage takes (spark, docs, sf_dir) and works on all that its
predecessor kept; all but the last return the columns of documents.  ``run``
writes each stage's result to the shared folder and reads it back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsengine.llm import compression, decontam, packing, probminhash, queries, winnow
from obsengine.llm.common import documents, staged
from obsengine.session import configure

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def configured(stage: Stage) -> Stage:
    """A stage is also called by itself, so each sees to the session's settings."""

    @wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(configure(spark), docs, sf_dir)

    return call


@configured
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return compression.keep_quality(docs)


@configured
def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; a document of which nothing is left
    goes with them.  ``n_chars`` follows the text."""
    cut = winnow.dedup_lines(docs)
    n_cut = cut.columns[-1]
    cut = cut.where((F.col(n_cut) == 0) | F.col("text").rlike(winnow.WORD))
    own = [F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in docs.columns]
    return cut.select(*own)


@configured
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    return probminhash.keep_one(docs)


@configured
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark window go."""
    return decontam.keep_clean(docs, documents(spark, sf_dir, "benchmark"))


@configured
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, with their ids, packed into sequences."""
    return packing.pack_documents(docs, queries.tokenizer_file(queries.WORD_BPE))


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Compression ratios, exponential races and tokenizers are beyond SQL; tests
# hold each stage against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
