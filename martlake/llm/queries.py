"""The registered queries opN_<name>: each operator over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlake.llm import (alignment, decontam, dedup_exact, dedup_suffix, fim, langid, lm, near_dart, packing,
                          sentencepieces, token_counts, toxicity, warc)
from martlake.sources.tables import read_table

BYTE_BPE = "byte_bpe_50k.json"
BYTE_BPE_END = 50256
PIECE_MODEL = "piece_bpe_32k.model"


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_suffix.repeat_report(read_table(spark, sf_dir, "documents"))


def op2_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dart.near_classes(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.encoding_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(PIECE_MODEL))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op7_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), BYTE_BPE_END)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score_report(read_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_exact.dedup_report(read_table(spark, sf_dir, "documents"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fim_report(read_table(spark, sf_dir, "documents"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_report(read_table(spark, sf_dir, "pages"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_report(read_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                      public_tokenizers.path(PIECE_MODEL))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_dart_minhash, op3_toxicity, op4_language_id, op5_sentencepiece, op6_token_counts,
    op7_token_packing, op8_lm_scoring, op9_decontamination, op10_exact_dedup, op11_fill_in_middle, op12_warc,
    op13_alignment)}
