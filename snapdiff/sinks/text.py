"""Delimited text sinks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..model import FeedSpec
from ..session import remove_path, scratch_path, write_bytes

FILE_BYTES = 1 << 28  # of text that one task writes, where the feed asks for no number of files
DELTA_COLUMNS = ("record", "hash", "bad", "op", "run_ts", "additional")
BAD_COLUMNS = ("record", "hash", "bad")


def line(columns: tuple[str, ...], delimiter: str) -> Column:
    """One output line; a null column is an empty one, so positions never shift."""
    return F.concat_ws(delimiter, *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def text_bytes(column: Column | str) -> Column:
    """The bytes of a text column, as an aggregate."""
    return F.coalesce(F.sum(F.octet_length(column)), F.lit(0)).cast("bigint")


def write_lines(lines: DataFrame, path: str, spec: FeedSpec, size: int | None = None) -> None:
    """Write a one-column string frame as text, in as many files as the feed asks for.

    A feed that asks for no number gets one file, and of larger outputs one for every
    `FILE_BYTES`. `size` tells about how many bytes there are; where it is not known, the lines
    are staged and counted on the way, so that nothing is computed twice.
    The redistribution comes last, so everything before it stays parallel.
    """
    if spec.output_files is not None or size is not None:
        files = math.ceil(size / FILE_BYTES) or 1 if spec.output_files is None else spec.output_files
        lines = lines.repartition(files) if files else lines
        writer = lines.write.mode("overwrite" if spec.delete_before_write else "errorifexists")
        writer.option("maxRecordsPerFile", spec.rows_per_file).text(path)
        return
    spark, seen = lines.sparkSession, Observation()
    staged = scratch_path(spark, "lines")
    lines = lines.toDF("value")
    try:
        lines.observe(seen, text_bytes("value").alias("bytes")).write.parquet(staged)
        write_lines(spark.read.schema("value string").parquet(staged), path, spec, seen.get["bytes"])
    finally:
        remove_path(spark, staged)


def write_delta(rows: DataFrame, path: str, spec: FeedSpec, size: int | None = None) -> None:
    write_lines(rows.select(line(DELTA_COLUMNS, spec.output_char).alias("value")), path, spec, size)


def write_bad(rows: DataFrame, path: str, spec: FeedSpec, size: int | None = None) -> None:
    write_lines(rows.select(line(BAD_COLUMNS, spec.output_char).alias("value")), path, spec, size)


def append_audit(lines: DataFrame, path: str) -> None:
    lines.coalesce(1).write.mode("append").text(path)  # one row


def put_audit(lines: DataFrame, path: str, key: str) -> None:
    """The audit line of one run in a file named after it: written again, it takes its own place."""
    line = lines.first()["value"]
    write_bytes(lines.sparkSession, f"{path.rstrip('/')}/audit-{key}.txt", (line + "\n").encode(), overwrite=True)
