"""Cleaning and re-formatting of emitted delta records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import numbers as nm
from ..functions.dates import reformat_date
from ..functions.text import ascii_fold, field_at, is_blank, replace_literals, split_fields, strip_backslashes
from ..model import FeedSpec, FormatRule, Replacement, format_rules, replacements
from .validation import SENTINEL

_FORMATS = {
    "date": lambda c, rule: reformat_date(c, rule.in_expression, rule.out_expression),
    "decimal": lambda c, rule: nm.parse_decimal(c) if rule.parse else nm.format_decimal(c),
    "number": lambda c, rule: nm.parse_number(c) if rule.parse else nm.format_number(c),
    "currency": lambda c, rule: nm.format_currency(c),
}


def _formatted(cell: Column, rule: FormatRule) -> Column:
    """The re-formatted cell; null where it is empty, marked missing or no such value."""
    return F.when((cell != SENTINEL) & (cell != ""), _FORMATS[rule.format_type](cell, rule))


def _failed(cell: Column, formatted: Column, rule: FormatRule) -> Column:
    """The rule's position if it could not be applied. Blank dates are let through."""
    failed = formatted.isNull() & (cell != SENTINEL) & (cell != "")
    if rule.format_type == "date":
        failed = failed & ~is_blank(cell)
    return F.when(failed, F.lit(rule.column_index))


def format_records(df: DataFrame, rules: Sequence[FormatRule], delimiter: str) -> DataFrame:
    """Re-format fields of `record` in rule order and add `format_errors`.

    `format_errors` lists the positions whose text could not be re-formatted;
    they keep it. Formatted cells are columns of their own, so that the record
    and its errors share them. Positions past the end of a short record come
    out null, and `concat_ws` leaves nulls out, so ragged records re-join to
    what they were.
    """
    df = df.withColumn("fields", split_fields(F.col("record"), delimiter))
    fields, helpers, errors, cells = F.col("fields"), [], [], {}
    from_end = any(rule.column_index < 0 for rule in rules)
    for n, rule in enumerate(rules):
        if rule.format_type not in _FORMATS:
            continue
        k, name = rule.column_index, f"_formatted{n}"
        cell = cells.get(k, field_at(fields, k))
        df = df.withColumn(name, _formatted(cell, rule))
        helpers.append(name)
        errors.append((_failed(cell, F.col(name), rule), f"_failed{n}"))
        if from_end:
            # Two positions can name one field, so each rule updates the fields.
            df = df.withColumn(errors[-1][1], errors[-1][0]).withColumn("fields", _with_field(fields, k, F.col(name)))
        else:
            cells[k] = F.coalesce(F.col(name), cell)
    failures = [F.col(name) if from_end else failed for failed, name in errors]
    width = max(cells, default=-1) + 1
    head = [cells.get(i, F.get(fields, F.lit(i))) for i in range(width)]
    rest = F.slice(fields, width + 1, F.greatest(F.size(fields) - width, F.lit(0))) if width else fields
    return df.withColumns({
        "record": F.concat_ws(delimiter, *head, rest),
        "format_errors": F.array_distinct(F.array_compact(F.array(*failures).cast("array<int>"))),
    }).drop("fields", *helpers, *(name for _, name in errors))


def _with_field(fields: Column, index: int, value: Column) -> Column:
    """Fields with one of them replaced, unless the new value is null."""
    at = F.lit(index) if index >= 0 else F.size(fields) + index
    return F.transform(fields, lambda x, i: F.when(i == at, F.coalesce(value, x)).otherwise(x))


@dataclass(frozen=True)
class Cleaning:
    """What happens to a record between the delta and the sink."""

    delimiter: str = "|"
    replace: Sequence[Replacement] = ()
    format: Sequence[FormatRule] | None = None  # None: formatting is off

    @classmethod
    def of(cls, spec: FeedSpec) -> "Cleaning":
        """Cleaning a feed asks for; rule text must already be in the spec."""
        return cls(
            spec.record_char,
            tuple(replacements(spec.replacements_json)) if spec.replace_data else (),
            tuple(format_rules(spec.formats_json)) if spec.format_data else None,
        )

    def apply(self, df: DataFrame) -> DataFrame:
        """Clean `record` in place and add `format_errors`.

        Formatting splits the replaced text again: a replacement may have
        added or removed delimiters.
        """
        steps = [strip_backslashes]
        if self.replace:
            steps.append(lambda c: replace_literals(c, self.replace, fold_last=self.format is not None))
        if self.format is not None:
            steps.append(ascii_fold)
        # One projection per step keeps each intermediate text computed once.
        df = reduce(lambda acc, step: acc.withColumn("record", step(F.col("record"))), steps, df)
        if not self.format:
            return df.withColumn("format_errors", F.array().cast("array<int>"))
        return format_records(df, self.format, self.delimiter)
