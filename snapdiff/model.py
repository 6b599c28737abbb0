"""Feed description, rule records and the schemas of config and result frames."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field, fields
from typing import Any

from pyspark.sql import types as T


class ConfigError(ValueError):
    """A feed description or rule that cannot be compiled."""


# Delimiter keywords and the character each stands for.
DELIMITERS = {
    "PIPE": "|",
    "TAB": "\t",
    "COMMA": ",",
    "COLON": ":",
    "SEMICOLON": ";",
    "TILDE": "~",
    "CARET": "^",
}
DEFAULT_DELIMITER = "|"


def delimiter_char(keyword: str) -> str:
    """Character for a delimiter keyword in any case; unknown keywords mean `|`."""
    return DELIMITERS.get(keyword.upper(), DEFAULT_DELIMITER)


def _required(rule: Mapping[str, Any], key: str, kind: str) -> Any:
    value = rule.get(key)
    if value is None:
        raise ConfigError(f"{kind} rule needs '{key}': {dict(rule)}")
    return value


def _integer(rule: Mapping[str, Any], key: str, kind: str) -> int:
    value = _required(rule, key, kind)
    try:
        return int(value)
    except (TypeError, ValueError) as err:
        raise ConfigError(f"{kind} rule has a non-integer '{key}': {value!r}") from err


@dataclass(frozen=True)
class ValidationRule:
    """One quality rule: the record's arity, or a test of one field."""

    kind: str  # "record" or "field"
    data_type: str = ""
    column_index: int = 0
    expression: str = ""
    length: int = 0
    column_count: int = 0

    @classmethod
    def of(cls, rule: Mapping[str, Any]) -> "ValidationRule":
        if str(_required(rule, "validation_type", "validation")).lower() == "record":
            return cls("record", column_count=_integer(rule, "column_count", "record"))
        data_type = str(_required(rule, "data_type", "field")).lower()
        return cls(
            "field",
            data_type,
            _integer(rule, "column_index", data_type),
            str(_required(rule, "expression", data_type)) if data_type in ("date", "regex") else "",
            _integer(rule, "length", data_type) if data_type == "string" else 0,
        )

    @property
    def rule_id(self) -> str:
        return "record" if self.kind == "record" else f"{self.column_index}:{self.data_type}"


@dataclass(frozen=True)
class FormatRule:
    """How one field is re-written in emitted delta rows."""

    column_index: int
    format_type: str
    parse: bool = False
    in_expression: str = ""
    out_expression: str = ""

    @classmethod
    def of(cls, rule: Mapping[str, Any]) -> "FormatRule":
        kind = str(_required(rule, "format_type", "format")).lower()
        numeric = kind in ("decimal", "number")
        return cls(
            _integer(rule, "column_index", kind),
            kind,
            numeric and str(_required(rule, "function", kind)).lower() == "parse",
            str(_required(rule, "in_expression", kind)) if kind == "date" else "",
            str(_required(rule, "out_expression", kind)) if kind == "date" else "",
        )


@dataclass(frozen=True)
class Replacement:
    """One literal find/replace over the whole record."""

    find: str
    replace: str

    @classmethod
    def of(cls, rule: Mapping[str, Any]) -> "Replacement":
        find = str(_required(rule, "find", "replacement"))
        if not find:
            raise ConfigError("a replacement rule needs a non-empty 'find'")
        return cls(find, str(_required(rule, "replace", "replacement")))


def parse_rules(text: str, key: str) -> list[dict[str, Any]]:
    """The list stored under `key` of a JSON rule document."""
    try:
        rules = json.loads(text)[key]
    except (ValueError, KeyError, TypeError) as err:
        raise ConfigError(f"not a rule document with a '{key}' list: {text!r}") from err
    if not isinstance(rules, list):
        raise ConfigError(f"'{key}' must be a list")
    return rules


def validation_rules(text: str) -> list[ValidationRule]:
    return [ValidationRule.of(r) for r in parse_rules(text, "validates")]


def format_rules(text: str) -> list[FormatRule]:
    return [FormatRule.of(r) for r in parse_rules(text, "formats")]


def replacements(text: str) -> list[Replacement]:
    return [Replacement.of(r) for r in parse_rules(text, "replacements")]


def _struct(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# JSON-lines config files: one object per feed. Numbers in them read as strings.
VALIDATION_CONFIG = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("validates", T.ArrayType(_struct(
        "validation_type", "column_index", "data_type", "expression", "length", "column_count"))),
])
FORMAT_CONFIG = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("formats", T.ArrayType(_struct(
        "column_index", "format_type", "function", "in_expression", "out_expression"))),
])
SCHEMA_CONFIG = T.StructType([
    T.StructField("filename", T.StringType()),
    T.StructField("schema", T.StructType([
        T.StructField("fields", T.ArrayType(_struct("name", "type"))),
    ])),
])

RECORD_SCHEMA = T.StructType([T.StructField("record", T.StringType())])

# The job arguments in submit order.
ARGUMENTS = (
    "app_name", "previous_path", "current_path", "inserts_path", "deletes_path", "bad_path",
    "audit_path", "config_path", "output_delimiter", "source_delimiter", "additional_output",
    "feed", "reseed", "format_data", "formats_from_argument", "validate", "regex_validation",
    "replace_data", "record_regex", "replacements_json", "formats_json", "validations_json",
    "source_type", "csv_header", "year", "month", "day", "file_name", "input_folder",
    "delete_before_write", "delta_prefix", "bad_prefix", "output_bucket", "bad_bucket",
)
_INT_FLAGS = {"reseed", "format_data", "formats_from_argument", "validate", "regex_validation",
              "replace_data"}
_TEXT_FLAGS = {"csv_header", "delete_before_write"}  # on only when exactly "1"


COMPARISONS = ("record", "fingerprint")


@dataclass(frozen=True)
class FeedSpec:
    """Everything one delta run needs; the first 34 fields are the job arguments."""

    app_name: str = "delta"
    previous_path: str = ""
    current_path: str = ""
    inserts_path: str = ""
    deletes_path: str = ""
    bad_path: str = ""
    audit_path: str = ""
    config_path: str = ""
    output_delimiter: str = "PIPE"
    source_delimiter: str = "PIPE"
    additional_output: str = ""
    feed: str = ""
    reseed: bool = False
    format_data: bool = False
    formats_from_argument: bool = False
    validate: bool = False
    regex_validation: bool = False
    replace_data: bool = False
    record_regex: str = ""
    replacements_json: str = ""
    formats_json: str = ""
    validations_json: str = ""
    source_type: str = "TEXT"
    csv_header: bool = False
    year: str = ""
    month: str = ""
    day: str = ""
    file_name: str = ""
    input_folder: str = ""
    delete_before_write: bool = False
    delta_prefix: str = ""
    bad_prefix: str = ""
    output_bucket: str = ""
    bad_bucket: str = ""
    # Beyond the argument list.
    multi_line: bool = True
    csv_options: Mapping[str, str] = field(default_factory=dict)
    output_files: int | None = None  # files per output; 0: as many as tasks write; null: one, and one for every 256 MB of a larger one
    rows_per_file: int = 0      # most rows in a file; 0: no limit
    comparison: str = "record"  # or "fingerprint", for records much wider than one
    kept_path: str = ""         # folder of kept fingerprints, for comparison by fingerprint
    kept_buckets: int = 200     # best as many as shuffle partitions; the same every day
    manifest_path: str = ""     # folder of manifests; with one, outputs are versions published together
    keep_versions: int = 2      # published versions that stay
    on_failure: str = "CONTINUE"  # what a run over several feeds does after this one fails

    def __post_init__(self) -> None:
        if self.comparison not in COMPARISONS:
            raise ConfigError(f"comparison must be one of {COMPARISONS}: {self.comparison!r}")
        if (self.output_files or 0) < 0 or self.rows_per_file < 0:
            raise ConfigError("numbers of files and rows must not be negative")
        if self.keep_versions < 1:
            raise ConfigError("a published version at least must stay")
        if self.kept_buckets < 1:
            raise ConfigError("kept fingerprints need a bucket at least")
        if self.kept_path and self.comparison != "fingerprint":
            raise ConfigError("only a comparison by fingerprint keeps fingerprints")

    @classmethod
    def from_args(cls, args: Sequence[str]) -> "FeedSpec":
        """Build from the positional argument list (without the script name)."""
        if len(args) != len(ARGUMENTS):
            raise ConfigError(f"expected {len(ARGUMENTS)} arguments, got {len(args)}")
        values: dict[str, Any] = dict(zip(ARGUMENTS, args))
        for name in _INT_FLAGS:
            try:
                values[name] = bool(int(values[name]))
            except ValueError as err:
                raise ConfigError(f"flag '{name}' must be an integer: {values[name]!r}") from err
        for name in _TEXT_FLAGS:
            values[name] = values[name] == "1"
        return cls(**values)

    def to_args(self) -> list[str]:
        """The positional argument list this spec came from."""
        flags = _INT_FLAGS | _TEXT_FLAGS
        return [str(int(getattr(self, n))) if n in flags else str(getattr(self, n)) for n in ARGUMENTS]

    @property
    def is_csv(self) -> bool:
        return self.source_type == "CSV"

    @property
    def output_char(self) -> str:
        return delimiter_char(self.output_delimiter)

    @property
    def record_char(self) -> str:
        """Delimiter the record text is built with: CSV rows are re-joined, text is not."""
        return self.output_char if self.is_csv else delimiter_char(self.source_delimiter)


assert tuple(f.name for f in fields(FeedSpec))[:len(ARGUMENTS)] == ARGUMENTS


def rules_of(rows: Iterable[Any]) -> list[dict[str, Any]]:
    """Config rows as plain dictionaries without their empty members."""
    return [{k: v for k, v in row.asDict().items() if v is not None} for row in rows]
