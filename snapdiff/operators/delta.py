"""Snapshot comparison.

* `compare` answers everything at once (inserts, deletes, bad records, counts).
* `snapshot_delta` answers one question: what is in A but not in B.
* `compare_wide` and `snapshot_delta_wide` answer the same for wide records.

The first two are one hash aggregation over both snapshots. Each snapshot is
scanned once, a record crosses the network once per map task that holds it
however many copies there are, and nothing is joined, sorted or broadcast.
The wide forms aggregate 16-byte fingerprints instead, again once per map task,
stage the wanted ones, and read the text of the records that are written in a
second scan. A Bloom filter over the wanted fingerprints is tested in that scan, so
that no more than their text, and that of a hundredth of the others, is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import scratch_path
from .membership import bloom_filter, might_hold
from .records import fingerprint, with_fingerprint
from .validation import Quality, status

INSERT, DELETE, BAD = "insert", "delete", "bad"
JUDGED = ("is_bad", "failed", "n_fields")  # what a record's text says of it; a plan that needs less computes less


def _of_quality(df: DataFrame, quality: Quality, delimiter: str, bad: bool) -> DataFrame:
    is_bad = F.col("is_bad")
    return quality.mark(df, delimiter).where(is_bad if bad else ~is_bad)


def snapshot_delta(left: DataFrame, right: DataFrame, quality: Quality, delimiter: str,
                   bad: bool = False) -> DataFrame:
    """Distinct records of `left`, of the given quality, that `right` lacks.

    Quality is a function of the record, so it is judged last, on the few
    records only one side holds.
    """
    both = left.select("record", F.lit(False).alias("known")).unionAll(
        right.select("record", F.lit(True).alias("known")))
    only_left = both.groupBy("record").agg(F.max("known").alias("known")).where(~F.col("known"))
    return with_fingerprint(_of_quality(only_left.select("record"), quality, delimiter, bad)).select(
        "record", "hash", F.lit(str(bad)).alias("bad"))


def keyed(df: DataFrame, *more: Column) -> DataFrame:
    """16-byte fingerprints, never null: a test for null would be pushed down and make each record a second time."""
    return df.select(F.coalesce(F.unhex(fingerprint(F.col("record"))), F.lit(b"")).alias("key"), *more)


def staged_keys(keys: DataFrame) -> DataFrame:
    """Wanted keys written to the shared folder, so that counting and reading them compares nothing again."""
    path = scratch_path(keys.sparkSession, "wanted")
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


def texts_of(df: DataFrame, keys: DataFrame) -> DataFrame:
    """`key, record`, once each, for the given staged keys, by a second scan.

    Records outside the keys' Bloom filter end in the task that reads them. More
    than some 33 million keys, for which no filter is made, are joined without.
    """
    rows = keys.count()
    if not rows:
        return keyed(df, F.col("record")).where(F.lit(False))
    wanted = bloom_filter(keys, rows)
    found = keyed(df, F.col("record"))
    if wanted is not None:  # as in Quality.is_bad, the partition id keeps the test above the projection that makes the record
        found = found.withColumn("maybe", might_hold(df, F.col("key"), wanted) & (F.spark_partition_id() >= 0)).where("maybe").drop("maybe")
    return found.join(keys, "key", "left_semi").groupBy("key").agg(F.first("record").alias("record"))


def keys_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """Fingerprints of the records of `left` that `right` lacks."""
    both = keyed(left, F.lit(False).alias("known")).unionAll(keyed(right, F.lit(True).alias("known")))
    present = both.groupBy("key").agg(F.max("known").alias("known"))
    return present.where(~F.col("known")).select("key")


def snapshot_delta_wide(left: DataFrame, right: DataFrame, quality: Quality, delimiter: str,
                        bad: bool = False) -> DataFrame:
    """`snapshot_delta` by fingerprints; compares when it is called, and stages the wanted fingerprints.

    Copies collapse to one row per fingerprint and task below the only exchange
    of the comparison, whatever the other side's size. Of the text only that of the
    result crosses the network, and of a hundredth of the other records. Quality is judged last.
    """
    records = texts_of(left, staged_keys(keys_only_in(left, right))).select("record")
    return with_fingerprint(_of_quality(records, quality, delimiter, bad)).select(
        "record", "hash", F.lit(str(bad)).alias("bad"))


def compare_wide(previous: DataFrame, current: DataFrame, quality: Quality, delimiter: str) -> DataFrame:
    """`compare` by fingerprints, with `key` in place of `record`.

    A record is judged where it is read, since its text goes no further.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")

    def side(df: DataFrame, p: Column, c: Column) -> DataFrame:
        return keyed(quality.profile(df.select("record"), delimiter), p.alias("p"), c.alias("c"), *map(F.col, JUDGED))

    both = side(previous, one, none).unionAll(side(current, none, one))
    present = both.groupBy("key").agg(
        F.sum("p").alias("previous_rows"), F.sum("c").alias("current_rows"), *[F.max(c).alias(c) for c in JUDGED])
    return present.withColumn("op", op_of())


def wanted_of(compared: DataFrame) -> DataFrame:
    """The fingerprints of a comparison whose records are written somewhere."""
    return compared.where(F.col("op").isNotNull()).select("key", "op", "is_bad")


def changes_wide(compared: DataFrame, previous: DataFrame, current: DataFrame) -> DataFrame:
    """`changes` of a comparison by fingerprints, which runs when this is called."""
    return changed_texts(staged_keys(wanted_of(compared)), previous, current)


def changed_texts(wanted: DataFrame, previous: DataFrame, current: DataFrame) -> DataFrame:
    """The changed rows of staged, wanted fingerprints, whose texts are read again."""
    of_previous = F.col("op") == DELETE
    gone, here = wanted.where(of_previous), wanted.where(~of_previous)
    found = [w.join(texts_of(df, w.select("key")), "key") for w, df in ((gone, previous), (here, current))]
    return found[0].unionAll(found[1]).select(
        "op", "record", F.lower(F.hex("key")).alias("hash"), status(F.col("is_bad")).alias("bad"))


def op_of() -> Column:
    in_previous, in_current = F.col("previous_rows") > 0, F.col("current_rows") > 0
    return (
        F.when(F.col("is_bad"), F.when(in_current, BAD))
        .when(~in_previous, INSERT)
        .when(~in_current, DELETE)
    )


def compare(previous: DataFrame, current: DataFrame, quality: Quality, delimiter: str) -> DataFrame:
    """One row per distinct record: (record, previous_rows, current_rows, is_bad, failed, n_fields, op).

    `op` is `insert`, `delete`, `bad` or null (unchanged, or a bad record that
    only the previous snapshot holds). Grouping by the record itself keeps the
    aggregation hash-based with map-side combine, and puts fingerprinting and
    validation after it, once per distinct record.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    both = previous.select("record", one.alias("p"), none.alias("c")).unionAll(
        current.select("record", none.alias("p"), one.alias("c")))
    present = both.groupBy("record").agg(
        F.sum("p").alias("previous_rows"), F.sum("c").alias("current_rows"))
    return quality.profile(present, delimiter).withColumn("op", op_of())


def changes(compared: DataFrame) -> DataFrame:
    """The rows of a comparison that are written somewhere: (op, record, hash, bad)."""
    return with_fingerprint(compared.where(F.col("op").isNotNull())).select(
        "op", "record", "hash", status(F.col("is_bad")).alias("bad"))


def of_kind(changed: DataFrame, op: str) -> DataFrame:
    return changed.where(F.col("op") == op).drop("op")
