"""Scalar operators over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import dates as dt, numbers as nm, text as tx, typed
from ..operators.records import with_fields
from . import fixtures as fx
from .registry import query


def _orders(spark: SparkSession, sf: str, **columns) -> DataFrame:
    return fx.table(spark, sf, "orders").select(
        "o_orderkey", *[c.alias(name) for name, c in columns.items()])


def _lines(spark: SparkSession, sf: str, **columns) -> DataFrame:
    return fx.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[c.alias(name) for name, c in columns.items()])


@query("select o_orderkey, strftime(o_orderdate, '%d.%m.%Y') as formatted from orders")
def format_date(spark, sf):
    return _orders(spark, sf, text=F.date_format("o_orderdate", "MM/dd/yy")).select(
        "o_orderkey", dt.reformat_date(F.col("text"), "%m/%d/%y", "%d.%m.%Y").alias("formatted"))


_SQL_TWO_DIGITS = "strftime(o_orderdate, '%m/%d/') || lpad(cast(o_orderkey % 100 as varchar), 2, '0')"
_SQL_FULL_YEAR = ("strftime(o_orderdate, '%m/%d/') || case when o_orderkey % 100 >= {pivot} then '19' "
                  "else '20' end || lpad(cast(o_orderkey % 100 as varchar), 2, '0')")


@query(f"""select o_orderkey, {_SQL_TWO_DIGITS} as text,
  strftime(try_strptime({_SQL_FULL_YEAR.format(pivot=50)}, '%m/%d/%Y'), '%Y-%m-%d') as slashed,
  strftime(try_strptime({_SQL_FULL_YEAR.format(pivot=69)}, '%m/%d/%Y'), '%Y-%m-%d') as dashed
from orders""")
def format_date_pivot(spark, sf):
    """The century of two-digit years, for the expression with its own rule and another."""
    text = F.concat(F.date_format("o_orderdate", "MM/dd/"),
                    F.lpad((F.col("o_orderkey") % 100).cast("string"), 2, "0"))
    dashed = F.replace(F.col("text"), F.lit("/"), F.lit("-"))
    return _orders(spark, sf, text=text).select(
        "o_orderkey", "text",
        dt.reformat_date(F.col("text"), "%m/%d/%y", "%Y-%m-%d").alias("slashed"),
        dt.reformat_date(dashed, "%m-%d-%y", "%Y-%m-%d").alias("dashed"))


@query("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as iso,
  strftime(ts, '%d %B %Y, %I:%M %p') as long_form from events""")
def format_datetime(spark, sf):
    """Month names and a twelve-hour clock, read and printed."""
    written = F.date_format("ts", "MMM d, yyyy hh:mm:ss a")
    moment = dt.parse_date(F.col("text"), "%b %d, %Y %I:%M:%S %p")
    return fx.table(spark, sf, "events").select("event_id", written.alias("text")).select(
        "event_id",
        F.date_format(moment, dt.spark_date_pattern("%Y-%m-%d %H:%M:%S")).alias("iso"),
        F.date_format(moment, dt.spark_date_pattern("%d %B %Y, %I:%M %p")).alias("long_form"))


LINE = ("l_orderkey", "l_linenumber")


@query("""select l_orderkey, l_linenumber, cast(cast(l_extendedprice as decimal(18,2)) as varchar) as parsed
from lineitem""")
def parse_decimal(spark, sf):
    text = F.concat(F.lit("$0"), F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2))
    return _lines(spark, sf, text=text).select(*LINE, nm.parse_decimal(F.col("text")).alias("parsed"))


@query("""with v as (select l_orderkey, l_linenumber,
    cast(l_extendedprice as decimal(18,2)) * cast(l_discount as decimal(18,2)) as x from lineitem),
w as (select *, cast(x * 10000 as bigint) as n from v),
r as (select *, n // 10 + case when n % 10 > 5 or (n % 10 = 5 and (n // 10) % 2 = 1) then 1 else 0 end as k from w)
select l_orderkey, l_linenumber, cast(cast(x as decimal(18,4)) as varchar) as text,
  format('{:,}', k // 1000) || rtrim(rtrim('.' || lpad(cast(k % 1000 as varchar), 3, '0'), '0'), '.') as formatted
from r""")
def format_decimal(spark, sf):
    """Three decimals at most, ties to even."""
    value = F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_discount").cast("decimal(18,2)")
    return _lines(spark, sf, text=value.cast("decimal(18,4)").cast("string")).withColumn(
        "formatted", nm.format_decimal(F.col("text")))


@query("""with v as (select l_orderkey, l_linenumber, '1' || lpad(cast(l_orderkey as varchar), 29, '0') as whole,
    lpad(cast(l_partkey * 10 + l_linenumber as varchar), 22, '0') as small from lineitem)
select l_orderkey, l_linenumber, whole || '.000' || small as text,
  rtrim(regexp_replace(whole, '(\\d{3})', '\\1,', 'g'), ',') as formatted,
  '$' || rtrim(regexp_replace(whole, '(\\d{3})', '\\1,', 'g'), ',') || '.00' as money from v""")
def format_wide_number(spark, sf):
    """Thirty whole digits and 25 decimals."""
    whole = F.concat(F.lit("1"), F.lpad(F.col("l_orderkey").cast("string"), 29, "0"))
    small = F.lpad((F.col("l_partkey") * 10 + F.col("l_linenumber")).cast("string"), 22, "0")
    return _lines(spark, sf, text=F.concat(whole, F.lit(".000"), small)).withColumns({
        "formatted": nm.format_decimal(F.col("text")), "money": nm.format_currency(F.col("text"))})


@query("""select l_orderkey, l_linenumber, cast(l_orderkey * 997 as varchar) as parsed from lineitem""")
def parse_number(spark, sf):
    text = F.concat(F.lit("$"), F.format_number(F.col("l_orderkey") * 997, 0))
    return _lines(spark, sf, text=text).select(*LINE, nm.parse_number(F.col("text")).alias("parsed"))


@query("""select l_orderkey, l_linenumber, format('{:,}', l_orderkey * 997) as formatted from lineitem""")
def format_number(spark, sf):
    return _lines(spark, sf, text=(F.col("l_orderkey") * 997).cast("string")).select(
        *LINE, nm.format_number(F.col("text")).alias("formatted"))


_SQL_AMOUNT = "format('{:,.2f}', abs(cast(c_acctbal as decimal(18,2))))"
_SQL_MINUS = "case when c_acctbal < 0 then '-' else '' end"


@query("""select l_orderkey, l_linenumber,
  '$' || format('{:,.2f}', cast(l_extendedprice as decimal(18,2))) as formatted from lineitem""")
def format_currency(spark, sf):
    return _lines(spark, sf, text=fx.money("l_extendedprice")).select(
        *LINE, nm.format_currency(F.col("text")).alias("formatted"))


def _balances(spark: SparkSession, sf: str) -> DataFrame:
    return fx.table(spark, sf, "customer").select("c_custkey", fx.money("c_acctbal").alias("balance"))


@query(f"select c_custkey, {_SQL_MINUS} || '$' || {_SQL_AMOUNT} as formatted from customer")
def format_currency_signed(spark, sf):
    return _balances(spark, sf).select("c_custkey", nm.format_currency(F.col("balance")).alias("formatted"))


@query(f"""select c_custkey, {_SQL_MINUS} || '£' || {_SQL_AMOUNT} as pounds,
  case when c_acctbal < 0 then '($' || {_SQL_AMOUNT} || ')' else '$' || {_SQL_AMOUNT} end as accounting,
  {_SQL_MINUS} || translate({_SQL_AMOUNT}, ',.', '.,') || chr(160) || '€' as euros
from customer""")
def currency_locale(spark, sf):
    balance = F.col("balance")
    comma = F.replace(balance, F.lit("."), F.lit(","))
    return _balances(spark, sf).select(
        "c_custkey",
        nm.currency(balance, "en_GB", "GBP").alias("pounds"),
        nm.currency(balance, "en_US", "USD", "accounting").alias("accounting"),
        nm.currency(comma, "de_DE", "EUR").alias("euros"))


@query(r"""select doc_id, regexp_replace(regexp_replace(text, '\s+$', ''), '(\w+)\s+(the|of)\b', '\2:\1$', 'g') as text
from documents""")
def regex_replace(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", tx.regex_replace(F.col("text"), r"(?P<word>\w+)\s+(the|of)\b", r"\2:\g<word>$").alias("text"))


@query(r"""select page_id, array_to_string(regexp_extract_all(html, 'href="[^"]*"'), '') as links from pages""")
def regex_extract_all(spark, sf):
    return fx.table(spark, sf, "pages").select(
        "page_id", tx.regex_extract(F.col("html"), r'href="[^"]*"').alias("links"))


@query(r"select doc_id, regexp_matches(text, '\d{3}-\d{4}') as found from documents")
def regex_match(spark, sf):
    return fx.table(spark, sf, "documents").select(
        "doc_id", tx.regex_search(F.col("text"), r"\d{3}-\d{4}").alias("found"))


def _faulty_field(spark: SparkSession, sf: str, index: int) -> DataFrame:
    return with_fields(fx.faulty_orders(spark, sf), "|").select(
        "record", tx.field_at(F.col("fields"), index).alias("field"))


@query(f"""with {fx.SQL_FAULTY}
select record, try_strptime(f[5], '%m/%d/%y') is not null as ok from faulty_fields""")
def is_date(spark, sf):
    return _faulty_field(spark, sf, 4).select("record", dt.is_date(F.col("field"), "%m/%d/%y").alias("ok"))


@query(f"""with {fx.SQL_FAULTY}
select record, regexp_full_match(f[4], '[+-]?(\\d+(\\.\\d*)?|\\.\\d+)') as ok from faulty_fields""")
def is_decimal(spark, sf):
    """Without the exemptions of a rule: blanks, `?` and grouped numbers are no decimals."""
    return _faulty_field(spark, sf, 3).select("record", tx.is_decimal(F.col("field")).alias("ok"))


@query(f"with {fx.SQL_FAULTY} select record, regexp_full_match(f[2], '[+-]?\\d+') as ok from faulty_fields")
def is_integer(spark, sf):
    return _faulty_field(spark, sf, 1).select("record", tx.is_integer(F.col("field")).alias("ok"))


@query(f"""with {fx.SQL_FAULTY}
select try_cast(f[1] as bigint) as order_key, try_cast(f[2] as integer) as customer, f[3] as status,
  try_cast(trim(f[4]) as double) as price, f[5] as day, f[6] as priority
from faulty_fields""")
def typed_projection(spark, sf):
    schema = typed.build_schema([
        {"name": "order_key", "type": "long"}, {"name": "customer", "type": "integer"},
        {"name": "status", "type": "string"}, {"name": "price", "type": "double"},
        {"name": "day", "type": "calendar"}, {"name": "priority", "type": "string"}])
    return typed.typed_projection(with_fields(fx.faulty_orders(spark, sf), "|"), schema)


_PROPS = T.StructType([T.StructField("k", T.LongType())])


@query("select event_id, cast(json_extract(props, '$.k') as bigint) as k, "
       "'{\"k\":' || json_extract_string(props, '$.k') || '}' as encoded from events")
def json_roundtrip(spark, sf):
    decoded = typed.json_decode(F.col("props"), _PROPS)
    return fx.table(spark, sf, "events").select("event_id", decoded.alias("v")).select(
        "event_id", F.col("v.k").alias("k"), typed.json_encode(F.col("v")).alias("encoded"))


@query("""with v as (select event_id, cast(json_extract(props, '$.k') as bigint) - 50 as k from events)
select event_id, case when k % 4 = 0 then cast(k // 4 as varchar) else cast(k / 4.0 as varchar) end as number,
  case when k = 0 then '0' else rtrim(cast(cast(k as decimal(18,0)) / 100000 as decimal(38,5))::varchar, '0') end as small,
  cast(20000000 + event_id as varchar) || '.5' as large from v""")
def json_numeric(spark, sf):
    """Quarters of a whole number, negative ones too: only real fractions print one."""
    k = typed.json_decode(F.col("props"), _PROPS).getField("k")
    quarter = ((k - 50).cast("decimal(18,0)") / F.lit(4).cast("decimal(18,0)")).cast("decimal(18,4)")
    small = (k - 50).cast("decimal(38,5)") / F.lit(100000).cast("decimal(18,0)")
    large = (F.col("event_id") + 20000000).cast("decimal(18,1)") + F.lit("0.5").cast("decimal(2,1)")
    return fx.table(spark, sf, "events").select("event_id", quarter.alias("v"), small.alias("s"), large.alias("l")).select(
        "event_id", nm.json_number(F.col("v")).alias("number"), nm.json_number(F.col("s")).alias("small"),
        nm.json_number(F.col("l")).alias("large"))


@query("""select o_orderkey, strftime(o_orderdate, '%Y%j') as text,
  strftime(o_orderdate, '%a %U %d.%m.%Y') || ' ' || strftime(o_orderdate, '%W %j') as shown from orders""")
def format_day_of_year(spark, sf):
    day = F.col("o_orderdate")
    text = F.concat(F.year(day), F.lpad(F.dayofyear(day).cast("string"), 3, "0"))
    return _orders(spark, sf, text=text).withColumn(
        "shown", dt.reformat_date(F.col("text"), "%Y%j", "%a %U %d.%m.%Y %W %j"))


@query("""select o_orderkey, strftime(o_orderdate, '%Y-%m-%d') as from_sunday, strftime(o_orderdate, '%d.%m.%Y') as from_monday
from orders""")
def format_week_date(spark, sf):
    """Dates given by year, week and weekday only."""
    day = F.col("o_orderdate")
    sunday = dt.format_moment(day, "%Y %U %w")
    monday = dt.format_moment(day, "%a, %W of %Y")
    return _orders(spark, sf, from_sunday=dt.reformat_date(sunday, "%Y %U %w", "%Y-%m-%d"),
                   from_monday=dt.reformat_date(monday, "%a, %W of %Y", "%d.%m.%Y"))


@query("""select o_orderkey, strftime(o_orderdate, '%d.%m.%Y') || ' 10:30 '
  || case when o_orderkey % 3 = 0 then '+0000' when o_orderkey % 3 = 1 then '+0530' else '-093015' end as moment from orders""")
def format_zone(spark, sf):
    zone = F.when(F.col("o_orderkey") % 3 == 0, "Z").when(F.col("o_orderkey") % 3 == 1, "+05:30").otherwise("-09:30:15")
    text = F.concat_ws(" ", dt.format_moment(F.col("o_orderdate"), "%Y-%m-%d"), F.lit("10:30"), zone)
    return _orders(spark, sf, moment=dt.reformat_date(text, "%Y-%m-%d %H:%M %z", "%d.%m.%Y %H:%M %z"))


@query(r"""select doc_id, regexp_replace(regexp_replace(regexp_replace(text, '\s+$', ''), '([^0-9])', '#\1', 'g'), '[0-9]', '##', 'g')
  || '#' as text from documents""")
def regex_replace_empty(spark, sf):
    """A pattern that matches empty text at every place, and then a digit there."""
    return fx.table(spark, sf, "documents").select("doc_id", tx.regex_replace(F.col("text"), r"|[0-9]", "#").alias("text"))


@query("""select o_orderkey, not (o_orderkey % 7 = 0) as ok from orders""")
def validate_day_of_year(spark, sf):
    """Every seventh date has a day past the end of any year."""
    day = F.when(F.col("o_orderkey") % 7 == 0, "367").otherwise(F.lpad(F.dayofyear("o_orderdate").cast("string"), 3, "0"))
    return _orders(spark, sf, ok=dt.is_date(F.concat(F.year("o_orderdate"), day), "%Y%j"))


@query("select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as run_ts from events")
def run_timestamp(spark, sf):
    return fx.table(spark, sf, "events").select("event_id", dt.timestamp_text(F.col("ts")).alias("run_ts"))


@query("""select o_orderkey, strftime(o_orderdate - interval 1 day, '%Y-%m-%d') as yesterday,
  strftime(o_orderdate - interval 30 day, '%Y-%m-%d') as month_ago from orders""")
def days_ago(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return _orders(spark, sf, yesterday=dt.days_ago(day, 1).cast("string"),
                   month_ago=dt.days_ago(day, 30).cast("string"))


@query("""select o_orderkey, 's3://feeds/raw/orders/' || strftime(o_orderdate, '%Y/%m/%d') || '/' as current_path,
  's3://feeds/raw/orders/' || strftime(o_orderdate - interval 1 day, '%Y/%m/%d') || '/' as previous_path,
  'feed_' || strftime(o_orderdate, '%Y-%m-%d') as file_name from orders""")
def dated_paths(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return _orders(spark, sf,
                   current_path=dt.dated_path("s3://feeds/", "raw/orders/", day),
                   previous_path=dt.dated_path("s3://feeds/", "raw/orders/", dt.days_ago(day, 1)),
                   file_name=dt.dated_text("feed_{0}-{1}-{2}", day))
