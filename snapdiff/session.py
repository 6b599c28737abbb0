"""Session settings the engine expects, and the shared folder for staged data."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import SparkSession

from .model import ConfigError

# Settings that decide results (time zone, parser policy) or plan shape (AQE).
# Sizes such as executor memory belong to the submit command, not here.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app_name: str = "snapdiff", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_made: list[tuple] = []  # file systems and paths of this process's staged data


@atexit.register
def _remove_made() -> None:
    """Staged data serves one process; what was not removed before goes when it ends."""
    for fs, target in _made:
        try:
            fs.delete(target, True)
        except Exception:  # the session's JVM is gone, or the folder
            pass


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder named by `spark.checkpoint.dir`.

    Staged data must outlive any one executor, so a cluster has to name the
    folder. What is left of it is removed when the process ends. Only a local session (one process, not `local-cluster`) may fall
    back to the warehouse folder, which every session has.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ConfigError("spark.checkpoint.dir must name a shared folder on a cluster")
        base = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/snapdiff-{label}-{uuid.uuid4().hex}"
    _made.append(_file_system(spark, path))
    return path


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def write_bytes(spark: SparkSession, path: str, content: bytes, overwrite: bool = False) -> None:
    """Write one file, new unless `overwrite`, on whatever file system `path` names."""
    fs, target = _file_system(spark, path)
    out = fs.create(target, overwrite)
    try:
        out.write(content)
    finally:
        out.close()


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete `path` on whatever file system it names; False if it was not there."""
    fs, target = _file_system(spark, path)
    return fs.delete(target, True) if fs.exists(target) else False


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below `path`, as the file system lists them; none if it is not there."""
    fs, target = _file_system(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def publish_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    """A file that is there whole or not at all: written beside its place, then renamed."""
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/_{name}-{uuid.uuid4().hex}"
    write_bytes(spark, draft, content)
    fs, source = _file_system(spark, draft)
    if not fs.rename(source, _file_system(spark, path)[1]):
        fs.delete(source, True)
        raise OSError(f"{path} could not be put in place")


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """The content of one small file."""
    fs, target = _file_system(spark, path)
    source = fs.open(target)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is not there."""
    fs, target = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
