"""Runs over several feeds."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import FeedSpec
from ..sources.properties import feed_specs
from .delta_job import DeltaResult, run_job
from .ledger import Ledger


@dataclass(frozen=True)
class FeedRun:
    """What became of one feed: its counts, its error, or neither if it was not started."""

    spec: FeedSpec
    counts: dict[str, int] | None = None
    error: Exception | None = None
    earlier: bool = False  # finished by an earlier run, and not done again


def run_feeds(spark: SparkSession, specs: Iterable[FeedSpec], run_ts: str | None = None,
              parallel: int = 1, ledger_path: str | None = None) -> list[FeedRun]:
    """One delta job per feed, and one result per feed in the same order.

    A feed that fails is reported and the others go on, unless its `on_failure`
    is anything but CONTINUE: then feeds that have not started are left out. Up to
    `parallel` feeds share the session at a time. With a ledger, feeds that an earlier
    run finished are not done again, and one that it left half way replaces what it wrote.
    """
    stopped, ledger = False, Ledger(spark, ledger_path) if ledger_path else None

    def run(spec: FeedSpec) -> FeedRun:
        nonlocal stopped
        if stopped:
            return FeedRun(spec)
        try:
            if ledger is None:
                return FeedRun(spec, run_job(spark, spec, run_ts))
            done = ledger.counts(spec)
            if done is not None:
                return FeedRun(spec, done, earlier=True)
            again = ledger.begin(spec)
            counts = run_job(spark, replace(spec, delete_before_write=True) if again else spec, run_ts, ledger.key(spec))
            ledger.finish(spec, run_ts, counts)
            return FeedRun(spec, counts)
        except Exception as error:  # reported with its feed
            stopped = stopped or spec.on_failure.upper() != "CONTINUE"
            return FeedRun(spec, error=error)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return list(pool.map(run, specs))


def run_workflow(spark: SparkSession, properties: DataFrame, workflow: str, business_property: str,
                 run_date: date, current_days: int = 0, previous_days: int = 1,
                 run_ts: str | None = None, parallel: int = 1, ledger_path: str | None = None) -> list[FeedRun]:
    """Run every feed the property table lists for a workflow on a date; with a ledger, those not finished before."""
    specs = feed_specs(properties, workflow, business_property, run_date, current_days, previous_days)
    return run_feeds(spark, specs, run_ts, parallel, ledger_path)


def combined(results: Mapping[str, DeltaResult]) -> DataFrame:
    """The written rows of several feeds in one frame with a `feed` column."""
    frames = [r.rows.withColumn("feed", F.lit(feed)) for feed, r in results.items()]
    return reduce(DataFrame.unionAll, frames)
