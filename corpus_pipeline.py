"""Documents to token ids in five stages, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next one's
``docs``. All but the last return the columns of ``documents``; the last returns the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from martlake.llm import decontam, dedup_exact, near_dart, sentencepieces, toxicity
from martlake.llm.columns import crc_mod, scratch_table
from martlake.llm.queries import PIECE_MODEL
from martlake.session import configure
from martlake.sources.tables import read_table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels that are not held out, does not reject."""
    configure(spark)
    labels = read_table(spark, sf_dir, "labels").filter(crc_mod("doc_id", toxicity.FOLDS) != toxicity.HELD_OUT)
    return toxicity.drop_toxic(docs, toxicity.fit(docs, labels))


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    configure(spark)
    return dedup_exact.drop_exact_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the least doc_id."""
    configure(spark)
    return near_dart.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    configure(spark)
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every document left."""
    configure(spark)
    return sentencepieces.encode(docs, public_tokenizers.path(PIECE_MODEL)).select("doc_id", "ids", "n_tokens")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_duplicates),
    ("MinHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

#: SQL can express neither the fitted model nor the signatures; the tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what one keeps is written to the shared folder for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch_table(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
