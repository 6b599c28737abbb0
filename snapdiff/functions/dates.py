"""Date text: strptime-style parsing and strftime-style formatting as columns."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, functions as F

from ..model import ConfigError

_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august",
           "september", "october", "november", "december")
_DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

# Text each parse directive accepts. A one-digit day may be padded with a blank.
_PARSE = {
    "Y": r"((?!0000)\d{4})",
    "y": r"(\d{2})",
    "m": r"(1[0-2]|0?[1-9])",
    "d": r"(?: (?=[1-9](?:\D|\z)))?(3[01]|[12]\d|0?[1-9])",
    "H": r"(2[0-3]|[01]?\d)",
    "I": r"(1[0-2]|0?[1-9])",
    "M": r"([0-5]?\d)",
    "S": r"([0-5]?\d)",
    "f": r"(\d{1,6})",
    "p": r"((?i:am|pm))",
    "b": "((?i:" + "|".join(m[:3] for m in _MONTHS) + "))",
    "B": "((?i:" + "|".join(_MONTHS) + "))",
    "a": "((?i:" + "|".join(d[:3] for d in _DAYS) + "))",
    "A": "((?i:" + "|".join(_DAYS) + "))",
    "j": r"(36[0-6]|3[0-5]\d|[12]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9])",
    "w": "([0-6])",
    "U": r"(5[0-3]|[0-4]\d|\d)",
    "W": r"(5[0-3]|[0-4]\d|\d)",
    "z": (r"([+-](?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:\.\d{1,6})?)?"
          r"|[0-5]\d(?:[0-5]\d(?:\.\d{1,6})?)?)|(?-i:Z))"),
}
_WEEKDAYS, _WEEKS = ("w", "a", "A"), ("U", "W")
# What the composed directives stand for.
_COMPOSED = {"x": "%m/%d/%y", "X": "%H:%M:%S", "c": "%a %b %e %H:%M:%S %Y"}

# Spark pattern for each format directive.
_FORMAT = {
    "Y": "yyyy", "y": "yy", "m": "MM", "d": "dd", "H": "HH", "I": "hh", "M": "mm", "S": "ss",
    "f": "SSSSSS", "p": "a", "b": "MMM", "B": "MMMM", "a": "EEE", "A": "EEEE", "j": "DDD",
}


def _tokens(expression: str):
    """(is_directive, text) pairs of a strptime / strftime expression."""
    i = 0
    while i < len(expression):
        if expression[i] == "%":
            if i + 1 == len(expression):
                raise ConfigError(f"stray % at the end of date expression {expression!r}")
            if expression[i + 1] in _COMPOSED:
                yield from _tokens(_COMPOSED[expression[i + 1]])
            else:
                yield True, expression[i + 1]
            i += 2
        else:
            end = expression.find("%", i)
            end = len(expression) if end < 0 else end
            yield False, expression[i:end]
            i = end


def _pattern(expression: str, **override: str) -> tuple[str, dict[str, int]]:
    """Regular expression of a strptime expression, and the group of each directive."""
    pattern, groups = [], {}
    for is_directive, token in _tokens(expression):
        if not is_directive:
            parts = re.split(r"(\s+)", token)
            pattern.append("".join(r"\s+" if p.isspace() else re.escape(p) for p in parts if p))
            continue
        token = "d" if token == "e" else token
        if token == "%":
            pattern.append("%")
            continue
        if token not in _PARSE:
            raise ConfigError(f"date directive %{token} is not supported: {expression!r}")
        if token in groups:
            raise ConfigError(f"date directive %{token} is repeated: {expression!r}")
        pattern.append(override.get(token, _PARSE[token]))
        groups[token] = len(groups) + 1
    return "".join(pattern), groups


def parse_date(text: Column, expression: str) -> Column:
    """`text` read with a strptime expression, as a zone-free timestamp; null if it fails.

    One pattern both checks the text and rewrites it to ISO form, whose cast
    rejects impossible days. Text that does not match takes the catch-all
    branch, leaves every group empty and so fails the cast.

    Two-digit years: 69-99 are 19yy and the rest 20yy, except that `%m/%d/%y`
    reads 50-68 as 19yy too. A day of the year decides alone; a week and a weekday
    decide against month and day; the last of several weeks or weekdays counts.
    """
    pattern, groups = _pattern(expression)

    def part(default: str, *names: str) -> str:
        return next((f"${groups[n]}" for n in names if n in groups), default)

    year = part("20" + part("", "y") if "y" in groups else "1900", "Y")
    of_year = "j" in groups  # goes before a week, month or day
    week = None if of_year else next((n for n in reversed(groups) if n in _WEEKS), None)
    weekday = week and next((n for n in reversed(groups) if n in _WEEKDAYS), None)
    shifted = of_year or weekday
    month_day = "1-1" if shifted else f"{part('1', 'm', 'b', 'B')}-{part('1', 'd')}"
    template = (f"{year}-{month_day} "
                f"{part('0', 'H', 'I')}:{part('0', 'M')}:{part('0', 'S')}.{part('0', 'f')}")
    clock12 = "I" in groups and "H" not in groups
    if clock12:
        template += f"|{part('am', 'p')}"
    if shifted:
        template += f"#{part('1', 'j')}" if of_year else f"#${groups[weekday]}#${groups[week]}"
    iso = F.regexp_replace(text, rf"\A(?:{pattern})\z|\A(?s:.*)\z", template)
    if "y" in groups and "Y" not in groups:
        late = r"[5-9]\d" if expression == "%m/%d/%y" else r"69|[7-9]\d"
        iso = F.regexp_replace(iso, rf"\A20({late})-", "19$1-")
    if "m" not in groups and ("b" in groups or "B" in groups):
        iso = reduce(lambda acc, m: F.regexp_replace(acc, f"(?i)-{m[1][:3]}[a-z]*-", f"-{m[0]}-"),
                     enumerate(_MONTHS, 1), iso)
    last = F.substring_index(iso, "#", -1).try_cast("int")  # day of the year, or week
    named = F.substring_index(F.substring_index(iso, "#", 2), "#", -1)
    iso = F.substring_index(iso, "#", 1) if shifted else iso
    moment = (F.substring_index(iso, "|", 1) if clock12 else iso).try_cast("timestamp_ntz")
    if shifted:
        days = F.coalesce(last, F.lit(1)) - 1 if of_year else _days_of_week(moment, named, last, week == "W")
        moment = moment + F.make_dt_interval(days)
        moment = F.when(F.year(moment).between(1, 9999), moment)
    if clock12:
        half_day = F.expr("interval '12' hour")
        moment = F.when(F.hour(moment) == 12, moment - half_day).otherwise(moment)
        moment = F.when(F.lower(F.substring_index(iso, "|", -1)) == "pm", moment + half_day).otherwise(moment)
    return moment


def _days_of_week(new_year: Column, weekday: Column, week: Column, from_monday: bool) -> Column:
    """Days from January 1 to a weekday (a digit from Sunday, or a name) of a week of the year.

    Week 1 begins with the year's first Sunday or Monday; week 0 may begin in the year before.
    """
    names = "".join(d[:3] for d in _DAYS[-1:] + _DAYS[:-1])
    day = F.when(weekday.rlike(r"\A\d\z"), weekday.try_cast("int")).otherwise(
        F.floor((F.instr(F.lit(names), F.lower(F.substring(weekday, 1, 3))) - 1) / 3))
    first = F.dayofweek(new_year) - 1
    if from_monday:
        day, first = F.pmod(day + 6, F.lit(7)), F.pmod(first + 6, F.lit(7))
    whole = F.pmod(7 - first, F.lit(7)) + 7 * (week - 1) + day
    return F.when(week == 0, day - first).otherwise(whole).cast("int")


def _week(moment: Column, first: int) -> Column:
    """Week of the year, counted from its first Sunday (0) or Monday (1)."""
    weekday = F.pmod(F.dayofweek(moment) - 1 - first, F.lit(7))
    return F.lpad(F.floor((F.dayofyear(moment) + 6 - weekday) / 7).cast("string"), 2, "0")


# Directives without a pattern.
_COMPUTED = {
    "w": lambda m: (F.dayofweek(m) - 1).cast("string"),
    "U": lambda m: _week(m, 0),
    "W": lambda m: _week(m, 1),
    "e": lambda m: F.lpad(F.dayofmonth(m).cast("string"), 2, " "),
    "z": lambda m: F.when(m.isNotNull(), ""),  # the timestamps have no zone
}


def format_moment(moment: Column, expression: str, zone: Column | None = None) -> Column:
    """A timestamp printed with a strftime expression; `zone` is what %z prints."""
    parts: list[Column] = []
    pattern = ""
    for is_directive, token in _tokens(expression):
        piece = ("%" + token) if is_directive else token.replace("%", "%%")
        if is_directive and token in _COMPUTED:
            parts += [F.date_format(moment, spark_date_pattern(pattern))] if pattern else []
            parts.append(zone if token == "z" and zone is not None else _COMPUTED[token](moment))
            pattern = ""
        else:
            pattern += piece
    parts += [F.date_format(moment, spark_date_pattern(pattern))] if pattern else []
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _joined(parts: list[str]) -> str:
    """Pattern parts in a row; quoted neighbours become one, since '' is a quote itself."""
    out = ""
    for part in parts:
        out = out[:-1] + part[1:] if out.endswith("'") and part.startswith("'") else out + part
    return out


def spark_date_pattern(expression: str) -> str:
    """The `date_format` pattern that prints what a strftime expression prints."""
    out = []
    for is_directive, token in _tokens(expression):
        if is_directive and token != "%":
            if token not in _FORMAT:
                raise ConfigError(f"date directive %{token} is not supported: {expression!r}")
            out.append(_FORMAT[token])
        else:
            out.append("'" + token.replace("'", "''") + "'")
    return _joined(out)


def is_date(text: Column, expression: str) -> Column:
    """True when the text parses with the expression.

    Every month has 28 days, so up to there the pattern alone decides, unless the
    day is counted from the start of the year.
    """
    early, groups = _pattern(expression, d=r"(?: (?=[1-9](?:\D|\z)))?(2[0-8]|1\d|0?[1-9])")
    read = parse_date(text, expression).isNotNull()
    counted = "j" in groups or (groups.keys() & set(_WEEKS) and groups.keys() & set(_WEEKDAYS))
    return read if counted else text.rlike(rf"\A(?:{early})\z") | read


def _zone_text(text: Column, expression: str) -> Column | None:
    """The zone that %z of the expression reads, as strftime prints it; None without %z."""
    pattern, groups = _pattern(expression)
    if "z" not in groups:
        return None
    read = F.nullif(F.regexp_replace(text, rf"\A(?:{pattern})\z|\A(?s:.*)\z", f"${groups['z']}"), F.lit(""))
    plain = F.regexp_replace(F.regexp_replace(read, r"\AZ\z", "+0000"), ":", "")
    padded = F.when(plain.contains("."), F.rpad(plain, 14, "0")).otherwise(plain)
    short = F.regexp_replace(F.regexp_replace(padded, r"\.0+\z", ""), r"\A(.\d{4})00\z", "$1")
    return F.when(short == "-0000", "+0000").otherwise(short)


def reformat_date(text: Column, in_expression: str, out_expression: str) -> Column:
    """Date text from one expression to another, with its zone; null if the text does not parse."""
    return format_moment(parse_date(text, in_expression), out_expression, _zone_text(text, in_expression))


RUN_TIMESTAMP = "%Y-%m-%d %H:%M:%S"


def run_timestamp(moment: datetime | None = None) -> str:
    """Timestamp text stamped on every emitted row of a run."""
    return (moment or datetime.now()).strftime(RUN_TIMESTAMP)


def timestamp_text(moment: Column) -> Column:
    """The run timestamp's form for a timestamp column."""
    return F.date_format(moment, spark_date_pattern(RUN_TIMESTAMP))


def days_ago(day: Column, days: int) -> Column:
    return F.date_sub(day, days)


def dated_path(base: str, sub: str, day: Column) -> Column:
    """`base + sub + yyyy/MM/dd/` for a date column."""
    return F.concat(F.lit(base + sub), F.date_format(day, "yyyy/MM/dd"), F.lit("/"))


def dated_text(template: str, day: Column) -> Column:
    """A template with its {0} year, {1} month and {2} day slots filled from a date column."""
    slots = {"{0}": "yyyy", "{1}": "MM", "{2}": "dd"}
    parts = [p for p in re.split(r"(\{[012]\})", template) if p]
    return F.concat(*[F.date_format(day, slots[p]) if p in slots else F.lit(p) for p in parts])


def snapshot_path(base: str, sub: str, day: date) -> str:
    """`base + sub + yyyy/mm/dd/` for one date."""
    return f"{base}{sub}{day:%Y/%m/%d}/"


def snapshot_days(run_date: date, current_days: int, previous_days: int) -> tuple[date, date]:
    """The (current, previous) dates that many days before the run date."""
    return run_date - timedelta(days=current_days), run_date - timedelta(days=previous_days)
