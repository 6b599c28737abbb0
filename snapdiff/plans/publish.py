"""Outputs of a run in folders of their own, made visible together by one manifest.

A run writes its inserts, deletes, bad records and audit line below new folders.
Its manifest, one small file put in place by a rename, comes last, so a reader sees
all of a run or nothing of it, and a run that stops half way changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import asdict, dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..model import FeedSpec
from ..session import list_names, publish_bytes, read_bytes, remove_path

OUTPUTS = ("inserts", "deletes", "bad", "audit")
_VERSION = re.compile(r"(\d{10})-[0-9a-f]{32}")


@dataclass(frozen=True)
class Manifest:
    """What one run has published; an output it did not write has no folder."""

    version: str
    feed: str
    run_ts: str
    current_path: str
    outputs: dict[str, str] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=dict)
    profile: dict[str, Any] = field(default_factory=dict)  # numbers of fields by snapshot, failures by rule


def _number(version: str) -> int:
    return int(version.split("-")[0])


def published_versions(spark: SparkSession, manifest_path: str) -> list[str]:
    """Versions with a manifest, oldest first."""
    return sorted(n[:-len(".json")] for n in list_names(spark, manifest_path) if n.endswith(".json") and _VERSION.fullmatch(n[:-len(".json")]))


def published(spark: SparkSession, manifest_path: str) -> Manifest | None:
    """The manifest of the last run that finished."""
    versions = published_versions(spark, manifest_path)
    if not versions:
        return None
    return Manifest(**json.loads(read_bytes(spark, f"{manifest_path.rstrip('/')}/{versions[-1]}.json")))


def read_published(spark: SparkSession, manifest_path: str) -> dict[str, DataFrame]:
    """The text outputs of the last run that finished, by name; those it did not write are left out."""
    manifest = published(spark, manifest_path)
    return {name: spark.read.text(path) for name, path in manifest.outputs.items()} if manifest else {}


def new_version(spark: SparkSession, manifest_path: str) -> str:
    versions = published_versions(spark, manifest_path)
    return f"{_number(versions[-1]) + 1 if versions else 1:010d}-{uuid.uuid4().hex}"


def _paths(spec: FeedSpec) -> dict[str, str]:
    return {name: getattr(spec, f"{name}_path") for name in OUTPUTS if getattr(spec, f"{name}_path")}


def versioned(spec: FeedSpec, version: str) -> FeedSpec:
    """The feed with the outputs of one version."""
    return replace(spec, **{f"{name}_path": f"{path.rstrip('/')}/{version}" for name, path in _paths(spec).items()})


def publish(spark: SparkSession, spec: FeedSpec, version: str, run_ts: str, counts: dict[str, int], profile: dict[str, Any],
            written: set[str]) -> Manifest:
    """Put the manifest in place, then drop all versions but the last `keep_versions`."""
    outputs = {name: path for name, path in _paths(versioned(spec, version)).items() if name in written}
    manifest = Manifest(version, spec.feed, run_ts, spec.current_path, outputs, counts, profile)
    publish_bytes(spark, f"{spec.manifest_path.rstrip('/')}/{version}.json", json.dumps(asdict(manifest), indent=1).encode())
    _prune(spark, spec)
    return manifest


def _prune(spark: SparkSession, spec: FeedSpec) -> None:
    """Remove older versions, and what stopped runs before the last published one left."""
    versions = published_versions(spark, spec.manifest_path)
    kept, last = set(versions[-spec.keep_versions:]), _number(versions[-1])
    for version in versions:
        if version not in kept:
            remove_path(spark, f"{spec.manifest_path.rstrip('/')}/{version}.json")
    for path in _paths(spec).values():
        for name in list_names(spark, path):
            if _VERSION.fullmatch(name) and name not in kept and _number(name) < last:
                remove_path(spark, f"{path.rstrip('/')}/{name}")
