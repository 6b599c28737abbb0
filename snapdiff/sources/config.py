"""Rule lookup: JSON-lines config files, one object per feed."""

from __future__ import annotations

import json
from dataclasses import replace

from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T

from ..functions.typed import build_schema
from ..model import (FORMAT_CONFIG, SCHEMA_CONFIG, VALIDATION_CONFIG, ConfigError, FeedSpec, rules_of)


def read_config(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def find_feed(config: DataFrame, feed: str, member: str) -> DataFrame:
    """Config rows of one feed that carry the wanted member."""
    return config.where((F.col("filename") == feed) & F.col(member).isNotNull())


def _only(config: DataFrame, feed: str, member: str) -> Row:
    rows = find_feed(config, feed, member).select(member).limit(2).collect()
    if not rows:
        raise ConfigError(f"no '{member}' configured for feed {feed!r}")
    if len(rows) > 1:
        raise ConfigError(f"'{member}' configured more than once for feed {feed!r}")
    return rows[0][member]


def _document(rows: list[Row], key: str) -> str:
    return json.dumps({key: rules_of(rows)})


def lookup_validations(spark: SparkSession, path: str, feed: str) -> str:
    """Validation rules of a feed, as a rule document."""
    return _document(_only(read_config(spark, path, VALIDATION_CONFIG), feed, "validates"), "validates")


def lookup_formats(spark: SparkSession, path: str, feed: str) -> str:
    """Format rules of a feed, as a rule document."""
    return _document(_only(read_config(spark, path, FORMAT_CONFIG), feed, "formats"), "formats")


def lookup_schema(spark: SparkSession, path: str, feed: str) -> T.StructType:
    """Field names and types of a feed."""
    return build_schema(rules_of(_only(read_config(spark, path, SCHEMA_CONFIG), feed, "schema")["fields"]))


def resolve_rules(spark: SparkSession, spec: FeedSpec) -> FeedSpec:
    """The spec with its rule documents filled in from the config files.

    Rule validation always takes its rules from the files; formats come from
    them unless the spec says its own text is to be used.
    """
    if spec.validate and not spec.regex_validation:
        spec = replace(spec, validations_json=lookup_validations(spark, spec.config_path, spec.feed))
    if spec.format_data and not spec.formats_from_argument:
        spec = replace(spec, formats_json=lookup_formats(spark, spec.config_path, spec.feed))
    return spec
