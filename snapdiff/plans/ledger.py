"""A ledger of the feeds a workflow has run, so that a second run does only what is left."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import SparkSession

from ..model import FeedSpec
from ..session import path_exists, publish_bytes, read_bytes


class Ledger:
    """One entry per feed and pair of snapshots below a folder: begun, and finished with its counts."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @staticmethod
    def key(spec: FeedSpec) -> str:
        """Names the run of a feed: another day, input or output is another run."""
        own = (spec.feed, spec.app_name, spec.previous_path, spec.current_path, spec.inserts_path, spec.deletes_path, spec.bad_path)
        return hashlib.md5(json.dumps(own).encode()).hexdigest()

    def _entry(self, spec: FeedSpec, state: str) -> str:
        return f"{self.path}/{self.key(spec)}.{state}.json"

    def counts(self, spec: FeedSpec) -> dict[str, int] | None:
        """The counts of a finished run, else null."""
        path = self._entry(spec, "finished")
        return json.loads(read_bytes(self.spark, path))["counts"] if path_exists(self.spark, path) else None

    def begin(self, spec: FeedSpec) -> bool:
        """Note that a feed is begun; true if it was begun before, and so may have left outputs."""
        path = self._entry(spec, "begun")
        again = path_exists(self.spark, path)
        if not again:
            publish_bytes(self.spark, path, json.dumps({"feed": spec.feed, "current_path": spec.current_path}).encode())
        return again

    def finish(self, spec: FeedSpec, run_ts: str | None, counts: dict[str, int]) -> None:
        entry = {"feed": spec.feed, "current_path": spec.current_path, "run_ts": run_ts, "counts": counts}
        publish_bytes(self.spark, self._entry(spec, "finished"), json.dumps(entry).encode())
