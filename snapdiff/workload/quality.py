"""Validation rules, over all orders with injected faults."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import ValidationRule
from ..operators import validation as va
from . import fixtures as fx
from .registry import query


def _judged(spark: SparkSession, sf: str, *rules: dict, record_regex: str | None = None) -> DataFrame:
    quality = va.Quality(tuple(ValidationRule.of(r) for r in rules), record_regex)
    return quality.mark(fx.faulty_orders(spark, sf), "|")


def _field(index: int, data_type: str, **more) -> dict:
    return {"validation_type": "field", "column_index": index, "data_type": data_type, **more}


def _sql(fails: str) -> str:
    return f"with {fx.SQL_FAULTY} select record, {fails} as is_bad from faulty_fields"


def _sql_exempt(i: int, fails: str) -> str:
    return f"(f[{i}] <> '?' and trim(f[{i}]) <> '' and ({fails}))"


_SQL_FLOAT = r"'^[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?$'"
ARITY = {"validation_type": "record", "column_count": "6"}
CUSTKEY = _field(1, "integer")
PRICE = _field(3, "decimal")
DATE = _field(4, "date", expression="%m/%d/%y")
LENGTH = _field(5, "string", length="20")
PRIORITY = _field(5, "regex", expression="[1-5]-")
RECORD_REGEX = r"^\d+\|\d+\|[OFP]\|"

SQL_ARITY = "len(f) <> 6"
SQL_CUSTKEY = _sql_exempt(2, r"not regexp_full_match(replace(f[2], ',', ''), '[+-]?\d+')")
SQL_PRICE = _sql_exempt(4, f"not regexp_matches(replace(f[4], ',', ''), {_SQL_FLOAT})")
SQL_DATE = _sql_exempt(5, "try_strptime(f[5], '%m/%d/%y') is null")
SQL_LENGTH = _sql_exempt(6, "length(f[6]) > 20")
SQL_PRIORITY = _sql_exempt(6, "not regexp_matches(f[6], '^[1-5]-')")


@query(_sql(SQL_ARITY))
def validate_arity(spark, sf):
    return _judged(spark, sf, ARITY)


@query(_sql(SQL_DATE))
def validate_date(spark, sf):
    return _judged(spark, sf, DATE)


@query(_sql(SQL_PRICE))
def validate_decimal(spark, sf):
    return _judged(spark, sf, PRICE)


@query(_sql(SQL_CUSTKEY))
def validate_integer(spark, sf):
    return _judged(spark, sf, CUSTKEY)


@query(_sql(SQL_LENGTH))
def validate_length(spark, sf):
    return _judged(spark, sf, LENGTH)


@query(_sql(SQL_PRIORITY))
def validate_field_regex(spark, sf):
    return _judged(spark, sf, PRIORITY)


@query(_sql(r"not regexp_matches(record, '^\d+\|\d+\|[OFP]\|')"))
def validate_record_regex(spark, sf):
    return _judged(spark, sf, record_regex=RECORD_REGEX)


@query(_sql(_sql_exempt(4, r"not regexp_matches(f[4], '^(n/a|\d)')")))
def validate_sentinel(spark, sf):
    """`?` passes a pattern it does not match."""
    return _judged(spark, sf, _field(3, "regex", expression=r"n/a|\d"))


@query(_sql(_sql_exempt(4, "length(f[4]) > 1")))
def validate_blank(spark, sf):
    """Blank text passes a length it exceeds."""
    return _judged(spark, sf, _field(3, "string", length=1))


@query(_sql("len(f) < 6"))
def validate_unknown_type(spark, sf):
    return _judged(spark, sf, _field(5, "postcode"))


@query(_sql("len(f) < 7"))
def validate_missing_field(spark, sf):
    """A rule on the seventh field condemns every record that has only six."""
    return _judged(spark, sf, _field(6, "string", length=20))


@query(_sql(r"f[len(f)] <> '?' and trim(f[len(f)]) <> '' and not regexp_matches(f[len(f)], '^[1-5]-')"))
def validate_last_field(spark, sf):
    """Positions count from the end when negative."""
    return _judged(spark, sf, _field(-1, "regex", expression="[1-5]-"))


@query(_sql("false"))
def validate_off(spark, sf):
    return _judged(spark, sf)


FIELD_RULES = (ARITY, CUSTKEY, PRICE, DATE, LENGTH, PRIORITY)
SQL_ANY = " or ".join((SQL_ARITY, SQL_CUSTKEY, SQL_PRICE, SQL_DATE, SQL_LENGTH, SQL_PRIORITY))


@query(f"with {fx.SQL_FAULTY} select record, md5(record) as hash, 'True' as bad from faulty_fields where {SQL_ANY}")
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    quality = va.Quality(tuple(ValidationRule.of(r) for r in FIELD_RULES))
    return va.quarantine(fx.faulty_orders(spark, sf), quality, "|")


@query(f"""with {fx.SQL_FAULTY}
select record, concat_ws(',', case when {SQL_ARITY} then 'record' end,
    case when {SQL_CUSTKEY} then '1:integer' end, case when {SQL_PRICE} then '3:decimal' end,
    case when {SQL_DATE} then '4:date' end, case when {SQL_LENGTH} then '5:string' end,
    case when {SQL_PRIORITY} then '5:regex' end) as failed_rules
from faulty_fields""")
def failed_rules(spark: SparkSession, sf: str) -> DataFrame:
    quality = va.Quality(tuple(ValidationRule.of(r) for r in FIELD_RULES))
    return quality.explain_bad(fx.faulty_orders(spark, sf), "|").withColumn(
        "failed_rules", F.array_join("failed_rules", ","))
