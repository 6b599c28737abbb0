"""Canonical CSV lines, record cleaning and the rows that reach the sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as tx
from ..model import format_rules, replacements
from ..operators import formatting, records
from ..operators.validation import Quality, quarantine
from ..plans.delta_job import delta_of
from ..sinks.text import BAD_COLUMNS, DELTA_COLUMNS, line
from . import fixtures as fx
from .registry import query


@query(f"select {fx.sql_canonical()} as record, md5({fx.sql_canonical()}) as hash from documents")
def canonicalize(spark: SparkSession, sf: str) -> DataFrame:
    return records.with_fingerprint(records.canonical_records(fx.document_cells(spark, sf), "|"))


@query(r"select doc_id, regexp_replace(text, '[^\x00-\x7F]', '', 'g') as folded from documents")
def ascii_fold(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "documents").select("doc_id", tx.ascii_fold(F.col("text")).alias("folded"))


@query(f"""with {fx.SQL_FAULTY}
select record, len(f) as n_fields, f[1] as first_field, f[6] as sixth_field, f[7] as seventh_field,
       f[len(f)] as last_field from faulty_fields""")
def split_fields(spark: SparkSession, sf: str) -> DataFrame:
    f = F.col("fields")
    return records.with_fields(fx.faulty_orders(spark, sf), "|").select(
        "record", F.size(f).cast("bigint").alias("n_fields"),
        tx.field_at(f, 0).alias("first_field"), tx.field_at(f, 5).alias("sixth_field"),
        tx.field_at(f, 6).alias("seventh_field"), tx.field_at(f, -1).alias("last_field"))


KEYWORDS = ("PIPE", "tab", "Comma", "colon", "SEMICOLON", "tilde", "Caret", "slash")


@query("""with k as (select o_orderkey, ['PIPE', 'tab', 'Comma', 'colon', 'SEMICOLON', 'tilde', 'Caret',
    'slash'][o_custkey % 8 + 1] as keyword from orders)
select o_orderkey, keyword, case upper(keyword) when 'TAB' then chr(9) when 'COMMA' then ','
    when 'COLON' then ':' when 'SEMICOLON' then ';' when 'TILDE' then '~' when 'CARET' then '^'
    else '|' end as delimiter from k""")
def delimiter_keyword(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(k) for k in KEYWORDS])
    keyword = F.get(names, (F.col("o_custkey") % 8).cast("int"))
    return fx.table(spark, sf, "orders").select("o_orderkey", keyword.alias("keyword")).withColumn(
        "delimiter", tx.delimiter_of(F.col("keyword")))


@query(f"select o_orderkey, replace({fx.SQL_ORDER}, '|', '') as record from orders")
def strip_backslash(spark: SparkSession, sf: str) -> DataFrame:
    escaped = F.replace(fx._plain().record(), F.lit("|"), F.lit("\\"))
    return fx.table(spark, sf, "orders").select("o_orderkey", escaped.alias("record")).withColumn(
        "record", tx.strip_backslashes(F.col("record")))


DOC_REPLACEMENTS = '{"replacements":[{"find":"e","replace":"é"},{"find":"th","replace":"z"},{"find":"a","replace":"à"}]}'


@query(r"""select doc_id, replace(replace(replace(regexp_replace(text, '[^\x00-\x7F]', '', 'g'),
    'e', ''), 'th', 'z'), 'a', 'à') as text from documents""")
def replace_literal(spark: SparkSession, sf: str) -> DataFrame:
    """Each rule folds first, so only the last rule's own accents stay."""
    return fx.table(spark, sf, "documents").select(
        "doc_id", tx.replace_literals(F.col("text"), replacements(DOC_REPLACEMENTS)).alias("text"))


@query(f"""with {fx.SQL_PAIR}
select {fx.sql_cleaned()} as record, md5(record) as hash from ins""")
def clean_record(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.order_pair(spark, sf)
    return delta_of(previous, current, fx.CLEANED_FEED, fx.RUN_TS).inserts.select("record", "hash")


def _sql_line(op: str, rows: str) -> str:
    return (f"select concat_ws('|', {fx.sql_cleaned()}, md5(record), 'False', '{op}', '{fx.RUN_TS}', "
            f"'{fx.ADDITIONAL}') as value from {rows}")


@query(f"with {fx.SQL_PAIR} {_sql_line('insert', 'ins')} union all {_sql_line('delete', 'del')}")
def delta_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Output lines with their metadata."""
    result = delta_of(*fx.order_pair(spark, sf), fx.CLEANED_FEED, fx.RUN_TS)
    return result.rows.where(F.col("op") != "bad").select(line(DELTA_COLUMNS, "|").alias("value"))


@query(f"with {fx.SQL_PRICED} select concat_ws('|', record, md5(record), 'True') as value from judged where is_bad")
def bad_rows(spark: SparkSession, sf: str) -> DataFrame:
    bad = quarantine(records.distinct_records(fx.priced_orders(spark, sf)), Quality.of(fx.PRICE_FEED), "|")
    return bad.select(line(BAD_COLUMNS, "|").alias("value"))


MIXED_FORMATS = format_rules(
    '{"formats":[{"column_index":"4","format_type":"date","in_expression":"%m/%d/%y","out_expression":"%d.%m.%Y"},'
    '{"column_index":3,"format_type":"decimal","function":"format"},'
    '{"column_index":"1","format_type":"number","function":"parse"},'
    '{"column_index":"6","format_type":"currency"},'
    '{"column_index":"2","format_type":"initials"}]}')

_SQL_GROUPED = ("format('{:,}', cast(trunc(cast(f[4] as decimal(18,2))) as bigint)) || "
                "rtrim(rtrim(right(f[4], 3), '0'), '.')")


def _sql_errors(*pairs: tuple[str, int]) -> str:
    return "concat_ws(',', " + ", ".join(f"case when {c} then '{i}' end" for c, i in pairs) + ")"


@query(f"""with {fx.SQL_FAULTY},
parts as (select record, f, f[5] = '13/45/99' as bad_date, f[4] in ('n/a', '  ', '1,234.50') as bad_price,
                 f[2] = 'x1' as bad_key, len(f) = 7 as has_extra from faulty_fields)
select concat_ws('|', f[1], f[2], f[3],
    case when bad_price or f[4] = '?' then f[4] else {_SQL_GROUPED} end,
    case when bad_date then f[5] else strftime(strptime(f[5], '%m/%d/%y'), '%d.%m.%Y') end,
    f[6], f[7]) as record, md5(record) as hash,
  {_sql_errors(("bad_date", 4), ("bad_price", 3), ("bad_key", 1), ("has_extra", 6))} as format_errors
from parts""")
def format_record(spark: SparkSession, sf: str) -> DataFrame:
    """Several formats at once; fields that cannot be formatted keep their text."""
    cleaning = formatting.Cleaning("|", format=tuple(MIXED_FORMATS))
    tagged = records.with_fingerprint(fx.faulty_orders(spark, sf))
    return cleaning.apply(tagged).withColumn(
        "format_errors", F.array_join(F.col("format_errors").cast("array<string>"), ","))


FROM_END = format_rules('{"formats":[{"column_index":"-2","format_type":"date",'
                        '"in_expression":"%m/%d/%y","out_expression":"%Y%m%d"}]}')


@query(f"""with r as (select {fx.SQL_ORDER} as record, o_orderdate from orders)
select record, concat_ws('|', string_split(record, '|')[1], string_split(record, '|')[2],
    string_split(record, '|')[3], string_split(record, '|')[4], strftime(o_orderdate, '%Y%m%d'),
    string_split(record, '|')[6]) as formatted from r""")
def format_from_end(spark: SparkSession, sf: str) -> DataFrame:
    lines = fx.order_records(spark, sf).withColumn("original", F.col("record"))
    return formatting.format_records(lines, FROM_END, "|").select(
        F.col("original").alias("record"), F.col("record").alias("formatted"))
