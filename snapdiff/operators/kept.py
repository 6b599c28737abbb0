"""Fingerprints of a snapshot, kept in buckets for the next day's comparison.

A kept table holds one row per different record: its 16-byte fingerprint, how often
it occurs, whether it is bad, the rules it breaks and its number of fields. Two kept tables are joined bucket to bucket, so a
comparison shuffles nothing, and reads no text of the snapshot that was kept before.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import path_exists
from .delta import JUDGED, keyed, op_of
from .validation import Quality

SCHEMA = "key binary, rows bigint, is_bad boolean, failed array<string>, n_fields int"


def fingerprints(df: DataFrame, quality: Quality, delimiter: str) -> DataFrame:
    """`key, rows` and what its text says of every different record; copies collapse in the task that reads them."""
    return keyed(quality.profile(df.select("record"), delimiter), *map(F.col, JUDGED)).groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"), *[F.max(c).alias(c) for c in JUDGED])


def _table(path: str) -> str:
    return f"snapdiff_kept_{hashlib.md5(path.encode()).hexdigest()}"


def keep(found: DataFrame, path: str, buckets: int) -> None:
    """Write fingerprints to `path` in buckets, one file each, replacing what is there.

    The session's catalog learns of the table; the files alone are enough for
    `kept` in another session.
    """
    writer = found.repartition(buckets, "key").write.format("parquet").bucketBy(buckets, "key").sortBy("key")
    writer.option("path", path).mode("overwrite").saveAsTable(_table(path))


def kept(spark: SparkSession, path: str, buckets: int) -> DataFrame | None:
    """The fingerprints kept at `path`; null if no finished table is there."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        return None
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(path)} ({SCHEMA}) USING parquet OPTIONS (path '{path}') "
              f"CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS")
    return spark.table(_table(path))


def compare_kept(previous: DataFrame, current: DataFrame) -> DataFrame:
    """The comparison of two kept tables: (key, previous_rows, current_rows, is_bad, failed, n_fields, op)."""
    p = previous.select("key", F.col("rows").alias("previous_rows"), *[F.col(j).alias(f"_{j}") for j in JUDGED])
    c = current.select("key", F.col("rows").alias("current_rows"), *JUDGED)
    none = F.lit(0).cast("bigint")
    return p.join(c, "key", "full").select(
        "key", F.coalesce("previous_rows", none).alias("previous_rows"), F.coalesce("current_rows", none).alias("current_rows"),
        *[F.coalesce(j, f"_{j}").alias(j) for j in JUDGED]).withColumn("op", op_of())
