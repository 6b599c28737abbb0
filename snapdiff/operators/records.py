"""Record frames: canonical CSV lines, fingerprints and distinct records.

A record frame has one string column `record`. Everything else known about a
record - fields, fingerprint, quality - is a function of that text, so it can
be derived at whichever point of a plan handles the fewest rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import ascii_fold, canonical_join, split_fields


def canonical_records(df: DataFrame, delimiter: str) -> DataFrame:
    """One delimited ASCII line per row of an all-string frame, columns by position."""
    columns = [df[f"`{name.replace('`', '``')}`"] for name in df.columns]
    return df.select(canonical_join(columns, delimiter).alias("record")).select(
        ascii_fold(F.col("record")).alias("record"))


def with_fields(df: DataFrame, delimiter: str) -> DataFrame:
    return df.withColumn("fields", split_fields(F.col("record"), delimiter))


def fingerprint(record: Column) -> Column:
    """Identity of a record: MD5 of its UTF-8 bytes as lower-case hex."""
    return F.md5(record)


def with_fingerprint(df: DataFrame) -> DataFrame:
    return df.withColumn("hash", fingerprint(F.col("record")))


def distinct_records(df: DataFrame) -> DataFrame:
    """Each record once. Copies collapse before the shuffle, however many there are."""
    return df.select("record").distinct()


def preview(df: DataFrame, n: int = 3) -> DataFrame:
    return df.limit(n)
