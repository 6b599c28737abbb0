"""The corpus pipeline: stages over documents, each written before the next one reads it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from snapdiff.llm import bpe, line_dedup, mixing, quality_rules, simhash
from snapdiff.llm.common import documents, shipping, staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, unchanged."""
    return quality_rules.kept_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line matches; those left without a word go.

    `n_chars` counts the code points of a text that lost lines. A document without
    words that lost no line stays.
    """
    freed = line_dedup.dedup_lines(docs.select(F.struct("*").alias("_row"), "doc_id", "text"))
    changed = F.col("n_removed") > 0
    stays = freed.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    n_chars = F.when(changed, F.length("text")).otherwise(F.col("_row.n_chars")).cast("long")
    return stays.select(*[{"text": F.col("text"), "n_chars": n_chars}.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest doc_id."""
    return simhash.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weight of its source draws it."""
    return mixing.mix_sources(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, and digests of ids and decoded text."""
    return bpe.encode_documents(docs).drop("decoded")


STAGES = [(name, shipping(stage)) for name, stage in (
    ("quality_rules", quality), ("line_dedup", lines), ("simhash", near_duplicates), ("mix_sources", mix), ("bpe", encode))]

#: SQL expresses neither the fingerprints nor the token ids.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage but the last is staged in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
