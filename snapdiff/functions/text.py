"""String column functions: folding, canonical cells, splitting, regex operators."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, functions as F

from ..model import DEFAULT_DELIMITER, DELIMITERS, Replacement
from .patterns import WHITESPACE, WS_CLASS, can_be_empty, java_regex, java_replacement

_NON_ASCII = r"[^\x00-\x7F]"


def _replace(text: Column, find: str, replacement: str) -> Column:
    return F.replace(text, F.lit(find), F.lit(replacement))


def is_blank(text: Column) -> Column:
    """True when nothing is left after stripping white space."""
    return F.trim(text, F.lit(WHITESPACE)) == ""


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def ascii_fold(text: Column) -> Column:
    """Drop every character outside ASCII.

    Text with as many bytes as characters is ASCII already; comparing the two
    lengths is far cheaper than running the pattern. Pass a plain column, since
    the argument is read more than once.
    """
    return F.when(F.octet_length(text) == F.length(text), text).otherwise(
        F.regexp_replace(text, _NON_ASCII, ""))


def canonical_cell(cell: Column, delimiter: str) -> Column:
    """A CSV cell that cannot break the joined record: null is empty, delimiter is `;`."""
    filled = F.coalesce(cell, F.lit(""))
    return filled if delimiter == ";" else _replace(filled, delimiter, ";")


def canonical_join(cells: Sequence[Column], delimiter: str) -> Column:
    """Cells joined into one line: no newlines, and tabs only as the delimiter.

    ASCII folding is left to the caller, who can apply it once per record.
    """
    joined = _replace(F.concat_ws(delimiter, *[canonical_cell(c, delimiter) for c in cells]), "\n", "")
    return joined if delimiter == "\t" else _replace(joined, "\t", " ")


def strip_backslashes(text: Column) -> Column:
    return _replace(text, "\\", "")


def replace_literals(text: Column, rules: Sequence[Replacement], fold_last: bool = False) -> Column:
    """Ordered literal find/replace over ASCII-folded text.

    Every rule folds before it replaces, so only the text put in by the last
    rule can keep non-ASCII characters, and only if nothing folds after it.
    """
    if not rules:
        return text
    last = rules[-1]

    def put(rule: Replacement) -> str:
        keep = rule is last and not fold_last
        return rule.replace if keep else rule.replace.encode("ascii", "ignore").decode("ascii")

    return reduce(lambda acc, rule: _replace(acc, rule.find, put(rule)), rules, ascii_fold(text))


def split_fields(record: Column, delimiter: str) -> Column:
    """Positional fields of a record; trailing empty fields are kept."""
    return F.split(record, re.escape(delimiter), -1)


def field_at(fields: Column, index: int) -> Column:
    """Field at a position, counted from the end when negative; null if there is none."""
    return F.get(fields, F.lit(index)) if index >= 0 else F.try_element_at(fields, F.lit(index))


def delimiter_of(keyword: Column) -> Column:
    """Delimiter character for a keyword column; unknown keywords mean `|`."""
    upper = F.upper(keyword)
    pick = reduce(lambda acc, kv: acc.when(upper == kv[0], kv[1]), DELIMITERS.items(),
                  F.when(upper.isNull(), DEFAULT_DELIMITER))
    return pick.otherwise(DEFAULT_DELIMITER)


def _by_python(text: Column, expression: str, replacement: str | None) -> Column:
    """Replace or join the matches of a pattern that can match empty text, in Arrow batches.

    Java goes on one character after an empty match; Python first looks for a longer match
    at the same place. No built-in function starts a search at a place with the text before it in view.
    """
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        found = re.compile(expression, re.ASCII)
        if replacement is not None:
            return texts.map(lambda t: found.sub(replacement, t), na_action="ignore")
        return texts.map(lambda t: "".join(m.group() for m in found.finditer(t)), na_action="ignore")

    return run(text)


def regex_replace(text: Column, expression: str, replacement: str) -> Column:
    """Replace every match after dropping trailing white space."""
    translated, template = java_regex(expression), java_replacement(replacement, expression)
    if can_be_empty(expression):
        return _by_python(rstrip(text), expression, replacement)
    return F.regexp_replace(rstrip(text), F.lit(translated), F.lit(template))


def regex_extract(text: Column, expression: str) -> Column:
    """All matches, joined without a separator."""
    translated = java_regex(expression)
    if can_be_empty(expression):
        return _by_python(text, expression, None)
    return F.array_join(F.regexp_extract_all(text, F.lit(translated), F.lit(0)), "")


def regex_search(text: Column, expression: str) -> Column:
    """True when the expression matches anywhere in the text."""
    return text.rlike(java_regex(expression))


# Number grammar of Python's int() and float(): no suffixes, no hexadecimal. The
# plain ASCII form comes first, because nearly every value has it.
_INTEGER = rf"\A(?:[+-]?[0-9]+|{WS_CLASS}*[+-]?\p{{Nd}}+{WS_CLASS}*)\z"
_DECIMAL = (
    rf"\A(?:[+-]?[0-9]+(?:\.[0-9]*)?"
    rf"|{WS_CLASS}*[+-]?(?:(?:\p{{Nd}}+(?:\.\p{{Nd}}*)?|\.\p{{Nd}}+)(?:[eE][+-]?\p{{Nd}}+)?"
    rf"|(?i:inf(?:inity)?|nan)){WS_CLASS}*)\z")


def is_integer(text: Column) -> Column:
    """True for text int() accepts, of any size."""
    return text.rlike(_INTEGER)


def is_decimal(text: Column) -> Column:
    """True for text float() accepts."""
    return text.rlike(_DECIMAL)


def without_commas(text: Column) -> Column:
    return _replace(text, ",", "")
