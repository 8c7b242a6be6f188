"""Queries of the operators on whole tables, and their SQL where it can say
the same."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    alignment, collocations, compression, decontam, licenses, lm, packing, probminhash, secrets, tokenids, viterbi, warc, winnow,
)
from .common import documents

# The tokenizer files, by name; a folder may be given instead.
BYTE_BPE, WORD_BPE, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def tokenizer_file(name: str) -> str:
    folder = os.environ.get("TOKENIZER_FOLDER")
    return f"{folder}/{name}" if folder else public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_digest(documents(spark, sf_dir))


def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenids.token_id_digest(documents(spark, sf_dir), tokenizer_file(BYTE_BPE))


def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_texts(documents(spark, sf_dir))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(documents(spark, sf_dir))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks_digest(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression.quality_digest(documents(spark, sf_dir))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return viterbi.token_counts(documents(spark, sf_dir), tokenizer_file(PIECES))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return probminhash.near_duplicates(documents(spark, sf_dir)).select("doc_id", "class_id", "representative")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = winnow.dedup_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", F.col("n_lines"), F.col("n_cut"), "text")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_digest(documents(spark, sf_dir), tokenizer_file(WORD_BPE))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_digest(documents(spark, sf_dir, "pages"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_tokens(documents(spark, sf_dir), tokenizer_file(BYTE_BPE), tokenizer_file(PIECES))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_token_ids, op3_lm_scoring, op4_license_scan, op5_decontamination,
        op6_quality_rules, op7_token_counts, op8_near_duplicates, op9_line_dedup, op10_packing,
        op11_collocations, op12_warc, op13_alignment,
    )
}

ORACLE: dict[str, str] = {
    "op9_line_dedup": winnow.ORACLE, "op11_collocations": collocations.ORACLE, "op12_warc": warc.ORACLE,
}
