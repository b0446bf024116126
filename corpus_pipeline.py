"""Corpus pipeline over ``documents``: each stage works on all that the one before kept.

quality rules -> MinHash near-dedup -> suffix-array dedup -> benchmark
decontamination -> SentencePiece encoding. All stages but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orbitgrain.llm import decontamination, near_dedup, quality_rules, sentence_pieces, suffix_dedup
from orbitgrain.llm.common import discard, materialize, table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and whose lines are mostly content."""
    field = quality_rules.train_field(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.keep_content(docs, field)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the least id, of each class of near duplicates."""
    return near_dedup.without_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 100-byte strings that start earlier in the corpus."""
    return suffix_dedup.without_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a test item."""
    return decontamination.without_leaks(docs, decontamination.test_sets(table(spark, sf_dir, "benchmark")))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_pieces, pieces and lossless of each document."""
    return sentence_pieces.encode(docs, sentence_pieces.model_path())


STAGES = [
    ("quality rules", keep_quality),
    ("near dedup", drop_near_duplicates),
    ("suffix dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("sentence pieces", encode_pieces),
]

#: Learned labels, samples and classes of links have no SQL form; the tests hold each stage against a brute-force version of it, on what it was given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each but the last written and read again; what a stage has read is deleted once its output is set down."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, "stage")
            if before is not None:
                discard(before)
            before = docs
    return docs
