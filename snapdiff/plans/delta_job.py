"""The delta job: compare two snapshots of a feed, clean, write, count."""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import run_timestamp
from ..model import ConfigError, FeedSpec
from ..operators import audit as au, delta as dl, kept as kp
from ..operators.formatting import Cleaning
from ..operators.validation import Quality
from ..session import remove_path, scratch_path
from ..sinks import text as sink
from ..sources.config import resolve_rules
from ..sources.snapshots import read_pair
from . import publish as pb


@dataclass(frozen=True)
class DeltaResult:
    """Frames of one run, lazy over one plan: each action compares the snapshots again.

    `run_job` stages the comparison instead and reads it for every output.
    """

    rows: DataFrame     # every written row: op, record, hash, bad, run_ts, additional, format_errors
    inserts: DataFrame  # the rows of one op
    deletes: DataFrame
    bad: DataFrame      # untouched records: record, hash, bad
    audit: DataFrame    # one row: counts, and the profile of both snapshots


def results(changed: DataFrame, counts: DataFrame, spec: FeedSpec, run_ts: str) -> DeltaResult:
    """Result frames over the changed rows and the counts of a comparison.

    Bad records are written as they came, so cleaning is undone for them.
    """
    is_bad = F.col("op") == dl.BAD
    cleaned = Cleaning.of(spec).apply(changed.withColumn("raw", F.col("record")))
    rows = cleaned.select(
        "op",
        F.when(is_bad, F.col("raw")).otherwise(F.col("record")).alias("record"),
        "hash",
        "bad",
        F.when(is_bad, "").otherwise(run_ts).alias("run_ts"),
        F.when(is_bad, "").otherwise(spec.additional_output).alias("additional"),
        F.when(~is_bad, F.col("format_errors")).alias("format_errors"),
    )
    return DeltaResult(
        rows,
        rows.where(F.col("op") == dl.INSERT),
        rows.where(F.col("op") == dl.DELETE),
        dl.of_kind(changed, dl.BAD),
        au.with_context(counts, spec, run_ts),
    )


def delta_of(previous: DataFrame, current: DataFrame, spec: FeedSpec, run_ts: str | None = None) -> DeltaResult:
    """The delta between two record frames; rules must already be in the spec."""
    compared = compared_by(spec, previous, current)
    return results(changed_by(spec, compared, previous, current), au.audit_counts(compared, Quality.of(spec)), spec, run_ts or run_timestamp())


def compared_by(spec: FeedSpec, previous: DataFrame, current: DataFrame) -> DataFrame:
    """The comparison a feed asks for."""
    compare = dl.compare_wide if spec.comparison == "fingerprint" else dl.compare
    return compare(previous, current, Quality.of(spec), spec.record_char)


def changed_by(spec: FeedSpec, compared: DataFrame, previous: DataFrame, current: DataFrame) -> DataFrame:
    """The changed rows of that comparison."""
    return dl.changes_wide(compared, previous, current) if spec.comparison == "fingerprint" else dl.changes(compared)


def run_delta(spark: SparkSession, spec: FeedSpec, run_ts: str | None = None) -> DeltaResult:
    """Read a feed's snapshots and describe their delta, without writing anything."""
    spec = resolve_rules(spark, spec)
    return delta_of(*read_pair(spark, spec), spec, run_ts)


def _plain(path: str) -> str:
    """A folder's path without what may be written in several ways."""
    return re.sub(r"/+", "/", re.sub(r"^file:/*", "/", path.strip())).rstrip("/") + "/"


def _check_paths(spec: FeedSpec) -> None:
    """No output may hold, or lie in, another output or an input."""
    outputs = [spec.inserts_path, spec.deletes_path, spec.bad_path]
    if not all(outputs):
        raise ConfigError("inserts, deletes and bad paths are required")
    paths = [_plain(p) for p in (*outputs, spec.audit_path, spec.kept_path, spec.manifest_path) if p]
    inputs = [_plain(p) for p in (spec.previous_path, spec.current_path, spec.config_path) if p]
    for i, out in enumerate(paths):
        others = inputs + paths[:i] + paths[i + 1:]
        clash = next((o for o in others if o.startswith(out) or out.startswith(o)), None)
        if clash:
            raise ConfigError(f"output path {out} overlaps {clash}")


def kept_folder(spec: FeedSpec, snapshot: str) -> str:
    """Where a snapshot's fingerprints are kept; another reading or other rules give another folder."""
    read = (snapshot, spec.source_type, spec.csv_header, sorted(spec.csv_options.items()), spec.record_char, spec.output_char,
            repr(Quality.of(spec)), spec.kept_buckets)
    return f"{spec.kept_path.rstrip('/')}/{hashlib.md5(repr(read).encode()).hexdigest()}"


def compared_with_kept(spark: SparkSession, spec: FeedSpec, previous: DataFrame, current: DataFrame) -> DataFrame:
    """The comparison of two kept tables; the current snapshot's is always made, the previous one's if it is not there."""
    quality = Quality.of(spec)

    def fingerprints(snapshot: DataFrame, path: str, again: bool) -> DataFrame:
        folder = kept_folder(spec, path)
        found = None if again else kp.kept(spark, folder, spec.kept_buckets)
        if found is None:
            kp.keep(kp.fingerprints(snapshot, quality, spec.record_char), folder, spec.kept_buckets)
        return kp.kept(spark, folder, spec.kept_buckets)

    here = fingerprints(current, spec.current_path, True)
    if spec.reseed:
        return kp.compare_kept(here.where(F.lit(False)), here)
    return kp.compare_kept(fingerprints(previous, spec.previous_path, False), here)


def stage(spec: FeedSpec, previous: DataFrame, current: DataFrame, path: str) -> dict[str, Any]:
    """Write the changed rows below `path`, one folder per op, and return the counts, the profile and `<op>_bytes`, the records' bytes by op.

    Compared by record, this one job is the only pass over the snapshots. The
    counts are observed in its last stage, whose tasks each count once however
    often they are retried, and the sinks read the staged rows, so a lost
    executor never brings the comparison back. Compared by fingerprint, the
    wanted fingerprints are staged first, and the texts of the changes are read after.
    """
    seen, spark = Observation(), previous.sparkSession
    keeping = spec.comparison == "fingerprint" and spec.kept_path
    compared = compared_with_kept(spark, spec, previous, current) if keeping else compared_by(spec, previous, current)
    observed = compared.observe(seen, *au.count_columns(), *au.profile_columns(Quality.of(spec)))
    if spec.comparison == "fingerprint":
        wanted = dl.wanted_of(observed)
        wanted.write.parquet(f"{path}/wanted")
        changed = dl.changed_texts(spark.read.schema(wanted.schema).parquet(f"{path}/wanted"), previous, current)
    else:
        changed = changed_by(spec, observed, previous, current)
    sizes = Observation()
    changed.observe(sizes, *[sink.text_bytes(F.when(F.col("op") == op, F.col("record"))).alias(f"{op}_bytes") for op in (dl.INSERT, dl.DELETE, dl.BAD)]
                    ).write.partitionBy("op").parquet(f"{path}/changed")
    return seen.get | sizes.get


STAGED = "record string, hash string, bad string, op string"
_BESIDE = 50  # bytes of a line besides its record, time and additional output: hash, flag, op and delimiters


def run_job(spark: SparkSession, spec: FeedSpec, run_ts: str | None = None, run_key: str | None = None) -> dict[str, int]:
    """Run a feed end to end and return its counts.

    Outputs are written only after the comparison has succeeded, so a failed
    run leaves the previous outputs in place. With a manifest path they go to new
    folders, and become the current ones together, when all are written. `format_failures`
    counts the written rows that kept a field which no format could be applied to.
    A run with a `run_key` that is repeated replaces its audit line.
    """
    _check_paths(spec)
    feed, spec = spec, resolve_rules(spark, spec)
    run_ts = run_ts or run_timestamp()
    previous, current = read_pair(spark, spec)
    staged = scratch_path(spark, "changes")
    version = pb.new_version(spark, spec.manifest_path) if spec.manifest_path else None
    out = pb.versioned(spec, version) if version else spec
    failures, written = [], {"inserts", "deletes"}

    def counted(rows: DataFrame) -> DataFrame:
        failures.append(Observation())
        return rows.observe(failures[-1], F.count_if(F.size("format_errors") > 0).alias("rows"))

    try:
        counts = stage(spec, previous, current, staged)
        changed = spark.read.schema(STAGED).parquet(f"{staged}/changed")
        result = results(changed, au.counts_frame(spark, counts), out, run_ts)
        beside = len(f"{run_ts}{out.additional_output}".encode()) + _BESIDE  # the record, in bytes of a line
        sink.write_delta(counted(result.inserts), out.inserts_path, out, counts["insert_bytes"] + counts["inserted"] * beside)
        sink.write_delta(counted(result.deletes), out.deletes_path, out, counts["delete_bytes"] + counts["deleted"] * beside)
        if counts["bad"]:
            sink.write_bad(result.bad, out.bad_path, out, counts["bad_bytes"] + counts["bad"] * _BESIDE)
            written.add("bad")
        elif out.delete_before_write:
            remove_path(spark, out.bad_path)
        if out.audit_path:
            line = au.audit_line(result.audit)
            sink.put_audit(line, out.audit_path, run_key) if run_key else sink.append_audit(line, out.audit_path)
            written.add("audit")
        found = {name: counts[name] for name in au.COUNTS}
        found |= {"changed": counts["inserted"] + counts["deleted"], "format_failures": sum(f.get["rows"] for f in failures)}
        if version:
            profile = {name: counts[name] for name in (*au.FIELDS, "rule_failures")}
            pb.publish(spark, feed, version, run_ts, found, profile, written)
    finally:
        remove_path(spark, staged)
    return found
