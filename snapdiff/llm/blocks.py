"""Groups of bounded size: a larger group becomes blocks, and every pair of blocks a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, staged

BLOCK_ROWS = 1024


def block_pairs(member: str) -> Column:
    """The pairs of blocks that a row takes part in; `_b` holds its key's blocks, null for one."""
    own = F.pmod(F.xxhash64(member), F.col("_b")).cast("int")
    return F.when(F.col("_b").isNull(), F.array(F.struct(F.lit(0).alias("lo"), F.lit(0).alias("hi")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("_b") - 1), lambda j: F.struct(F.least(own, j).alias("lo"), F.greatest(own, j).alias("hi"))))


def grouped(rows: DataFrame, keys: Sequence[str], member: str, bound: int = BLOCK_ROWS) -> DataFrame:
    """Rows `keys, lo, hi, members`: any two members of a key meet in one of its groups.

    Keys with one member give none. A key of more than `bound` members is dealt
    by hash into blocks of about that size; each pair of blocks is a group, so the
    group stays bounded and the pairs complete. Such keys number at most the rows
    over `bound`.
    """
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = staged(counts.where(F.col("_n") > bound).select(*keys, F.ceil(F.col("_n") / bound).cast("int").alias("_b")), "hot-keys")
    dealt = rows.join(small(hot), list(keys), "left").select(*keys, member, F.inline(block_pairs(member)))
    return (dealt.groupBy(*keys, "lo", "hi").agg(F.collect_list(member).alias("members"))
            .where(F.size("members") > 1))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.Table]:
    """Tables that end where a group ends; rows arrive sorted by integer keys without nulls."""
    held: list[pa.RecordBatch] = []
    open_key: list[int] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch[k][-1].as_py() for k in keys]
        same = np.all([batch[k].to_numpy() == v for k, v in zip(keys, last)], axis=0)
        cut = int(np.argmax(same))  # rows before `cut` belong to groups that are whole
        if held and (cut or open_key != last):
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = []
        elif cut:
            yield pa.Table.from_batches([batch.slice(0, cut)])
        held.append(batch.slice(cut))
        open_key = last
    if held:
        yield pa.Table.from_batches(held)
