"""Counts of a delta run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from ..model import FeedSpec
from .delta import BAD, DELETE, INSERT
from .validation import Quality

COUNTS = (
    "raw_previous", "raw_current", "distinct_previous", "distinct_current",
    "inserted", "deleted", "bad",
)


def count_columns() -> list[Column]:
    """Aggregates over a comparison; they need no second look at the snapshots."""
    def rows(name: str, cond: Column) -> Column:
        return F.count_if(cond).alias(name)

    return [
        F.coalesce(F.sum("previous_rows"), F.lit(0)).cast("bigint").alias("raw_previous"),
        F.coalesce(F.sum("current_rows"), F.lit(0)).cast("bigint").alias("raw_current"),
        rows("distinct_previous", F.col("previous_rows") > 0),
        rows("distinct_current", F.col("current_rows") > 0),
        rows("inserted", F.col("op") == INSERT),
        rows("deleted", F.col("op") == DELETE),
        rows("bad", F.col("op") == BAD),
    ]


#: Least and largest number of fields of a record, by snapshot: a new column shows here on its first day.
FIELDS = ("least_fields_previous", "most_fields_previous", "least_fields_current", "most_fields_current")


def profile_columns(quality: Quality) -> list[Column]:
    """Aggregates of what the records look like, for the same pass as the counts.

    `rule_failures` counts the distinct records of the current snapshot that break
    each rule; a record may break several.
    """
    in_previous, in_current = F.col("previous_rows") > 0, F.col("current_rows") > 0
    sides = [F.when(side, F.col("n_fields")) for side in (in_previous, in_current)]
    fields = [of(side).alias(name) for name, (side, of) in zip(FIELDS, [(s, of) for s in sides for of in (F.min, F.max)])]
    each = [x for rule in quality.rule_ids() for x in (
        F.lit(rule), F.count_if(in_current & F.coalesce(F.array_contains("failed", rule), F.lit(False))))]
    failures = F.create_map(*each) if each else F.create_map().cast("map<string,bigint>")
    return [*fields, failures.alias("rule_failures")]


def audit_counts(compared: DataFrame, quality: Quality | None = None) -> DataFrame:
    """One row with every count of a run and the total change; with the feed's rules, its profile too."""
    profile = profile_columns(quality) if quality is not None else []
    return compared.agg(*count_columns(), *profile).withColumn(
        "changed", F.col("inserted") + F.col("deleted"))


def with_context(counts: DataFrame, spec: FeedSpec, run_ts: str) -> DataFrame:
    """Counts with the paths and the time they belong to."""
    context = {
        "feed": spec.feed, "current_path": spec.current_path, "inserts_path": spec.inserts_path,
        "deletes_path": spec.deletes_path, "bad_path": spec.bad_path, "run_ts": run_ts,
    }
    return counts.withColumn("validated", F.lit(spec.validate)).withColumns(
        {name: F.lit(value) for name, value in context.items()})


def audit_line(audit: DataFrame) -> DataFrame:
    """The audit row as one pipe-joined line."""
    flag = F.when(F.col("validated"), "True").otherwise("False")
    counts = ("distinct_current", "inserted", "deleted", "bad", "changed")
    paths = ("current_path", "inserts_path", "deletes_path", "bad_path", "run_ts")
    return audit.select(F.concat_ws(
        "|", flag, *[F.col(c).cast("string") for c in counts], *paths).alias("value"))


def counts_frame(spark, counts: Mapping[str, int]) -> DataFrame:
    """Known counts, and the profile if it is among them, as the frame `audit_counts` would give."""
    row = {name: int(counts[name]) for name in COUNTS}
    schema = ", ".join(f"{name} bigint" for name in COUNTS)
    if "rule_failures" in counts:
        row |= {name: counts[name] for name in (*FIELDS, "rule_failures")}
        schema += "".join(f", {name} int" for name in FIELDS) + ", rule_failures map<string,bigint>"
    return spark.createDataFrame([tuple(row.values())], schema).withColumn(
        "changed", F.col("inserted") + F.col("deleted"))
