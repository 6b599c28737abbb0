"""A Bloom filter over staged keys, tested where a snapshot is scanned.

The filter is Spark's own aggregate and predicate, which have no function name
in SQL; the expressions are made through the session's gateway.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.classic.column import _to_java_column

FALSE_POSITIVES = 0.01
MOST_BITS = 1 << 26   # 8 MB, the largest filter that Spark's aggregate makes
LEAST_BITS_A_KEY = 2  # with fewer, more than a third of all keys would pass
_TASKS = 8            # tasks that hold a partial filter; the keys are a few bytes each


def filter_bits(rows: int, false_positives: float = FALSE_POSITIVES) -> int | None:
    """Bits of a filter for so many keys; null if the largest would let through most of what it should not."""
    bits = max(64, math.ceil(-rows * math.log(false_positives) / math.log(2) ** 2))
    if bits <= MOST_BITS:
        return bits
    return MOST_BITS if MOST_BITS >= LEAST_BITS_A_KEY * rows else None


def _expressions(df: DataFrame):
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.org.apache.spark.sql.catalyst.expressions, jvm.org.apache.spark.sql.classic.ExpressionUtils


def bloom_filter(keys: DataFrame, rows: int, false_positives: float = FALSE_POSITIVES) -> Column | None:
    """The filter over the column `key` of counted, staged rows: a scalar subquery of at most 8 MB."""
    bits = filter_bits(rows, false_positives)
    if bits is None:
        return None
    made, utils = _expressions(keys)
    parts = [utils.expression(_to_java_column(c)) for c in (
        F.xxhash64("key"), F.lit(max(rows, 1)).cast("bigint"), F.lit(bits).cast("bigint"))]
    aggregate = made.aggregate.BloomFilterAggregate(*parts).toAggregateExpression()
    return keys.coalesce(_TASKS).agg(Column(utils.column(aggregate)).alias("filter")).scalar()


def might_hold(df: DataFrame, key: Column, found: Column) -> Column:
    """False only where `key` is none of the filter's keys."""
    made, utils = _expressions(df)
    parts = [utils.expression(_to_java_column(c)) for c in (found, F.xxhash64(key))]
    return Column(utils.column(made.BloomFilterMightContain(*parts)))
