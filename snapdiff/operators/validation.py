"""Record quality: rules compiled to one boolean column.

Rules fail closed. A record is bad when any rule fails, when a rule's field is
missing, and when a test comes out null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as tx
from ..functions.dates import is_date
from ..functions.patterns import anchored, java_regex
from ..model import ConfigError, FeedSpec, ValidationRule, validation_rules
from .records import with_fields, with_fingerprint

SENTINEL = "?"  # the feeds' own null mark, exempt from every field rule

_FIELD_TESTS = {
    "date": lambda f, rule: ~is_date(f, rule.expression),
    "decimal": lambda f, rule: ~tx.is_decimal(tx.without_commas(f)),
    "integer": lambda f, rule: ~tx.is_integer(tx.without_commas(f)),
    "string": lambda f, rule: F.length(f) > rule.length,
    "regex": lambda f, rule: ~f.rlike(anchored(rule.expression)),
}


def rule_fails(fields: Column, rule: ValidationRule) -> Column:
    """True where the record breaks the rule; never null."""
    if rule.kind == "record":
        return F.size(fields) != rule.column_count
    value = tx.field_at(fields, rule.column_index)
    test = _FIELD_TESTS.get(rule.data_type)
    if test is None:  # unknown types pass, but their field must exist
        return value.isNull()
    # The test comes first: few records fail it, and only those need the exemptions.
    fails = test(value, rule) & (value != SENTINEL) & ~tx.is_blank(value)
    return F.coalesce(value.isNull() | fails, F.lit(True))


def record_regex_fails(record: Column, expression: str) -> Column:
    """True where a whole-record expression matches nowhere in the record."""
    return F.coalesce(~record.rlike(java_regex(expression)), F.lit(True))


@dataclass(frozen=True)
class Quality:
    """Compiled validation of one feed: off, one record pattern, or a rule list."""

    rules: Sequence[ValidationRule] = ()
    record_regex: str | None = None

    def __post_init__(self) -> None:
        if self.record_regex is not None and self.rules:
            raise ConfigError("a feed is validated by a record pattern or by rules, not both")

    @classmethod
    def of(cls, spec: FeedSpec) -> "Quality":
        """Validation a feed asks for; rule text must already be in the spec."""
        if not spec.validate:
            return cls()
        if spec.regex_validation:
            return cls(record_regex=spec.record_regex)
        return cls(rules=tuple(validation_rules(spec.validations_json)))

    def _failures(self) -> list[tuple[str, Column]]:
        if self.record_regex is not None:
            return [("record_regex", record_regex_fails(F.col("record"), self.record_regex))]
        return [(rule.rule_id, rule_fails(F.col("fields"), rule)) for rule in self.rules]

    def is_bad(self) -> Column:
        """Over the columns `record` and `fields`.

        A filter on this flag would be pushed below the projection that splits
        the record, and there split it again for every use of a field. Tying
        the flag to the partition id, which is never negative, keeps the
        filter above, so each record is split and judged once.
        """
        failures = [fails for _, fails in self._failures()]
        if not failures:
            return F.lit(False)
        return reduce(Column.__or__, failures) & (F.spark_partition_id() >= 0)

    def failed_rules(self) -> Column:
        """Names of the rules a record breaks, over `record` and `fields`."""
        names = [F.when(fails, F.lit(name)) for name, fails in self._failures()]
        return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")

    def mark(self, df: DataFrame, delimiter: str) -> DataFrame:
        """Add the boolean `is_bad`. Records are split once, only if a rule needs fields."""
        if self.rules:
            return with_fields(df, delimiter).withColumn("is_bad", self.is_bad()).drop("fields")
        return df.withColumn("is_bad", self.is_bad())

    def rule_ids(self) -> list[str]:
        """Names of the rules, each once."""
        return list(dict.fromkeys(["record_regex"] if self.record_regex is not None else [r.rule_id for r in self.rules]))

    def profile(self, df: DataFrame, delimiter: str) -> DataFrame:
        """As `mark`, with `n_fields` and, for bad records, `failed`: the rules they break."""
        size = F.length("record") - F.length(F.replace(F.col("record"), F.lit(delimiter), F.lit(""))) + 1
        marked = (with_fields(df, delimiter) if self.rules else df).withColumn("is_bad", self.is_bad())
        marked = marked.withColumn("failed", F.when(F.col("is_bad"), F.array_distinct(self.failed_rules()))).withColumn("n_fields", size)
        return marked.drop("fields")

    def explain_bad(self, df: DataFrame, delimiter: str) -> DataFrame:
        """Add `failed_rules`."""
        return with_fields(df, delimiter).withColumn("failed_rules", self.failed_rules()).drop("fields")


def status(is_bad: Column) -> Column:
    """The quality flag's text form."""
    return F.when(is_bad, "True").otherwise("False")


def tag(df: DataFrame, quality: Quality, delimiter: str) -> DataFrame:
    """Records with fingerprint and quality flag: (record, hash, bad)."""
    return with_fingerprint(quality.mark(df.select("record"), delimiter)).select(
        "record", "hash", status(F.col("is_bad")).alias("bad"))


def quarantine(df: DataFrame, quality: Quality, delimiter: str) -> DataFrame:
    """The bad records of a frame: (record, hash, bad)."""
    return tag(df, quality, delimiter).where(F.col("bad") == "True")
