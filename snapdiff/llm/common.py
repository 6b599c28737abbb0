"""Helpers shared by the operators: word patterns, staged tables, size-checked joins."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, write_bytes

_PACKAGE = Path(__file__).resolve().parent.parent
_shipped: set[str] = set()

SPACE = r"[\x20\x09-\x0D]"  # the white space that separates words
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of a few fixed-width columns that may be broadcast; beyond it both sides are shuffled.
BROADCAST_ROWS = 1_000_000


def ship(spark: SparkSession) -> None:
    """Give the package to the Python workers of all executors, once per application.

    They need it where it is neither installed nor given by `--py-files`.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped or not _PACKAGE.is_dir():  # a package inside an archive was shipped as such
        return
    content = io.BytesIO()
    with zipfile.ZipFile(content, "w") as archive:
        for file in sorted(_PACKAGE.rglob("*.py")):
            archive.write(file, Path(_PACKAGE.name) / file.relative_to(_PACKAGE))
    path = f"{scratch_path(spark, 'code')}/{_PACKAGE.name}.zip"
    write_bytes(spark, path, content.getvalue())
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def shipping(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """`run(spark, ...)` after `ship(spark)`."""
    @wraps(run)
    def call(spark: SparkSession, *args) -> DataFrame:
        ship(spark)
        return run(spark, *args)

    return call


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often `body` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that no later step recomputes it."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a staged side for broadcast only if its counted rows are within the bound."""
    return F.broadcast(df) if df.count() <= rows else df


def most_frequent(counted: DataFrame, size: int) -> DataFrame:
    """The rows of `counted` with the largest `n`, at most `size`, cut where a class of counts ends.

    Counts fall into classes of a sixteenth of a power of two. A histogram of these
    classes, a thousand rows at most, gives the cut, so no task sends its own
    largest rows to the driver.
    """
    table = staged(counted.withColumn("_class", F.floor(F.log2("n") * 16).cast("int")), "counted")
    cut, held = None, 0
    for row in sorted(table.groupBy("_class").agg(F.count(F.lit(1)).alias("rows")).collect(), reverse=True):
        held += row.rows
        if held > size:
            break
        cut = row["_class"]
    return table.where(F.lit(False) if cut is None else F.col("_class") >= cut).drop("_class")
