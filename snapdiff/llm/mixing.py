"""Mixing sources to target weights: rates per source, then whole and hash-drawn copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, small, staged

WEIGHTS = (5, 2, 1)   # fixed by the contract: repeating, in the order of the sources
MOST = 3              # fixed by the contract: a target's limit in sizes of its source
SEED = "mix-1"
_DRAW = 13            # hexadecimal digits of a draw, all exact in a double


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def _ranked(sources: DataFrame) -> DataFrame:
    """`rank` from 0 by code point, null last: ranges are sorted apart, then shifted."""
    split = staged(
        sources.withColumn("_null", F.col("source").isNull()).repartitionByRange("_null", "source")
        .withColumn("_part", F.spark_partition_id()), "mix-ranges")
    sizes = split.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    own = Window.partitionBy("_part").orderBy("_null", "source")
    return (split.withColumn("_row", F.row_number().over(own)).join(small(shift), "_part")
            .select("source", "source_size", (F.col("_shift") + F.col("_row") - 1).alias("rank")))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """`source, source_size` with `target`: shares of all sizes by weight, none above `most` sizes.

    The excess of limited sources is shared again by weight until none is above.
    Each turn is one aggregation over the sources; only two sums reach the driver.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = staged(_ranked(sources).select(
        "source", "source_size", weight.alias("weight"), (F.col("source_size") * most).cast("double").alias("limit")),
        "mix-sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, turn = 0.0, None
    while turn != level:
        turn = level
        over = F.col("weight") * level > F.col("limit")
        held, open_weight = table.agg(F.sum(F.when(over, F.col("limit"))), F.sum(F.when(~over, F.col("weight")))).first()
        if open_weight:
            level = max(level, (total - (held or 0.0)) / open_weight)
    return table.select("source", "source_size", F.least(F.col("limit"), F.col("weight") * F.lit(level)).alias("target"))


def copies(target: Column, source_size: Column, identity: Column, seed: str = SEED) -> Column:
    """floor(rate) copies, and one more with the fraction as its probability."""
    rate = F.coalesce(F.try_divide(target, source_size.cast("double")), F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), identity)), 1, _DRAW), 16, 10).cast("double") / 16.0**_DRAW
    return (F.floor(rate) + F.when(draw < rate - F.floor(rate), 1).otherwise(0)).cast("long")


def _identity(doc_id: Column, text_md5: Column) -> Column:
    """What a document draws by: rows without an id, or that share one, draw apart if their texts differ."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text_md5)


def _text_md5(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def mix_plan(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """`doc_id, source, size, source_size, target, copies, taken` of every document.

    A null source is a source of its own, sorted last; null and empty texts have
    size 0; a source of size 0 has target 0 and no copies. The draw depends on the
    seed, doc_id and text alone, so reruns agree and rows equal in both are drawn alike.
    """
    sized = staged(docs.select("doc_id", "source", word_count(docs["text"]).alias("size"),
                               _text_md5(docs["text"]).alias("text_md5")), "mix-sizes")
    by_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    rates = staged(by_source.withColumnRenamed("source", "_source"), "mix-rates")
    joined = sized.join(small(rates), F.col("source").eqNullSafe(F.col("_source")))
    n = copies(F.col("target"), F.col("source_size"), _identity(F.col("doc_id"), F.col("text_md5")), seed)
    return (joined.withColumn("copies", n)
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("copies") * F.col("size")).alias("taken")))


def mix_sources(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED) -> DataFrame:
    """The mix itself: every row of `docs`, all columns, as often as its source's rate draws."""
    size = docs.select("source", word_count(docs["text"]).alias("size"))
    rates = staged(targets(size.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
                   .toDF("_source", "_source_size", "_target"), "mix-rates")
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"))
    joined = rows.join(small(rates), F.col("_row.source").eqNullSafe(F.col("_source")))
    identity = _identity(F.col("_row.doc_id"), _text_md5(F.col("_row.text")))
    n = copies(F.col("_target"), F.col("_source_size"), identity, seed).cast("int")
    repeated = joined.withColumn("_copy", F.explode(F.when(n > 0, F.sequence(F.lit(1), n))))
    return repeated.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns])
