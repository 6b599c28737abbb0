"""Snapshot readers. Each returns a record frame: one string column `record`."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import RECORD_SCHEMA, FeedSpec
from ..operators.records import canonical_records
from .csv_records import Dialect, read_csv_split


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One record per line; header lines are data."""
    return spark.read.text(path).withColumnRenamed("value", "record")


def read_csv(spark: SparkSession, path: str, header: bool, multi_line: bool = True,
             options: Mapping[str, str] | None = None) -> DataFrame:
    """All-string CSV columns, by position.

    With `multi_line` a quoted cell may hold newlines. Spark reads such a file in
    one task, so files larger than a split of a scan are cut into records by
    `read_csv_split` instead, unless the options are such that only Spark's reader
    can tell where a record ends.
    """
    given = dict(options or {})
    reader = spark.read.options(header=header, encoding="UTF-8", multiLine=multi_line, inferSchema=False).options(**given)
    rows = reader.csv(path)
    dialect = Dialect.of(given)
    if not multi_line or dialect is None or not rows.columns or not _large(spark, path):
        return rows
    split = read_csv_split(spark, path, header, dialect, rows.columns, given)
    return rows if split is None else split


def _large(spark: SparkSession, path: str) -> bool:
    """Whether a file below `path` has more bytes than a scan gives a task."""
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    most = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
    return most > spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def empty_snapshot(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RECORD_SCHEMA)


def read_snapshot(spark: SparkSession, path: str, spec: FeedSpec) -> DataFrame:
    """A snapshot of the feed's source type, as records."""
    if not spec.is_csv:
        return read_text(spark, path)
    rows = read_csv(spark, path, spec.csv_header, spec.multi_line, spec.csv_options)
    return canonical_records(rows, spec.output_char)


def read_pair(spark: SparkSession, spec: FeedSpec) -> tuple[DataFrame, DataFrame]:
    """The (previous, current) snapshots; a reseed compares against nothing."""
    previous = empty_snapshot(spark) if spec.reseed else read_snapshot(spark, spec.previous_path, spec)
    return previous, read_snapshot(spark, spec.current_path, spec)
