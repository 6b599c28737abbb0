"""Record frames derived from the given tables, with the SQL that derives the same.

The snapshot pair is a rolling extract of all orders: the previous snapshot
ends before the last month, the current one starts after the first, some
orders change price in between, and some carry a price that is no number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..model import FeedSpec
from ..operators.records import canonical_records

RUN_TS = "2018-09-10 06:30:00"
ADDITIONAL = "UNIT|20180910"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def money(name: str) -> Column:
    """A double as text with two decimals."""
    return F.col(name).cast("decimal(18,2)").cast("string")


def _key_is(divisor: int) -> Column:
    return F.col("o_orderkey") % divisor == 0


@dataclass(frozen=True)
class OrderParts:
    """The text of each field of an order record."""

    custkey: Column
    price: Column
    date: Column
    priority: Column
    extra: Column | None = None

    def record(self) -> Column:
        cells = [F.col("o_orderkey").cast("string"), self.custkey, F.col("o_orderstatus"), self.price,
                 self.date, self.priority]
        line = F.concat_ws("|", *cells)
        return line if self.extra is None else F.concat(line, self.extra)


def _plain() -> OrderParts:
    return OrderParts(F.col("o_custkey").cast("string"), money("o_totalprice"),
                      F.date_format("o_orderdate", "MM/dd/yy"), F.col("o_orderpriority"))


def order_records(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(_plain().record().alias("record"))


SQL_PRICE = "cast(cast(o_totalprice as decimal(18,2)) as varchar)"
SQL_DATE = "strftime(o_orderdate, '%m/%d/%y')"
SQL_ORDER = (f"concat_ws('|', o_orderkey, o_custkey, o_orderstatus, {SQL_PRICE}, {SQL_DATE}, "
             "o_orderpriority)")


def faulty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as records, with faults of every kind injected."""
    plain = _plain()
    parts = OrderParts(
        F.when(_key_is(31), "x1").otherwise(plain.custkey),
        F.when(_key_is(19), "n/a").when(_key_is(41), "?").when(_key_is(43), "  ")
        .when(_key_is(47), "1,234.50").otherwise(plain.price),
        F.when(_key_is(23), "13/45/99").otherwise(plain.date),
        F.when(_key_is(37), "x" * 40).otherwise(plain.priority),
        F.when(_key_is(29), "|extra").otherwise(""),
    )
    return table(spark, sf, "orders").select(parts.record().alias("record"))


SQL_FAULTY = f"""faulty as (
  select concat_ws('|', o_orderkey,
      case when o_orderkey % 31 = 0 then 'x1' else cast(o_custkey as varchar) end,
      o_orderstatus,
      case when o_orderkey % 19 = 0 then 'n/a' when o_orderkey % 41 = 0 then '?'
           when o_orderkey % 43 = 0 then '  ' when o_orderkey % 47 = 0 then '1,234.50'
           else {SQL_PRICE} end,
      case when o_orderkey % 23 = 0 then '13/45/99' else {SQL_DATE} end,
      case when o_orderkey % 37 = 0 then repeat('x', 40) else o_orderpriority end)
    || case when o_orderkey % 29 = 0 then '|extra' else '' end as record
  from orders),
faulty_fields as (select record, string_split(record, '|') as f from faulty)"""

LAST_MONTH, FIRST_MONTH_END = "2001-07-01", "1995-02-01"


def order_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(previous, current) snapshots of orders."""
    orders, plain = table(spark, sf, "orders"), _plain()
    raised = (F.col("o_totalprice").cast("decimal(18,2)") + 1).cast("decimal(18,2)").cast("string")

    def snapshot(rows: DataFrame, price: Column) -> DataFrame:
        price = F.when(_key_is(19), "n/a").otherwise(price)
        return rows.select(
            OrderParts(plain.custkey, price, plain.date, plain.priority).record().alias("record"))

    day = F.col("o_orderdate")
    return (
        snapshot(orders.where(day < F.lit(LAST_MONTH).cast("timestamp_ntz")), plain.price),
        snapshot(orders.where(day >= F.lit(FIRST_MONTH_END).cast("timestamp_ntz")),
                 F.when(_key_is(17), raised).otherwise(plain.price)),
    )


def priced_orders(spark: SparkSession, sf: str) -> DataFrame:
    """All orders as records, some without a price."""
    plain = _plain()
    price = F.when(_key_is(19), "n/a").otherwise(plain.price)
    return table(spark, sf, "orders").select(
        OrderParts(plain.custkey, price, plain.date, plain.priority).record().alias("record"))


def _sql_snapshot(price: str, where: str) -> str:
    return (f"select concat_ws('|', o_orderkey, o_custkey, o_orderstatus, "
            f"case when o_orderkey % 19 = 0 then 'n/a' else {price} end, {SQL_DATE}, o_orderpriority) "
            f"as record from orders where {where}")


SQL_PAIR = f"""prev_raw as ({_sql_snapshot(SQL_PRICE, f"o_orderdate < timestamp '{LAST_MONTH}'")}),
cur_raw as ({_sql_snapshot(
    "case when o_orderkey % 17 = 0 then cast(cast(cast(o_totalprice as decimal(18,2)) + 1 "
    f"as decimal(18,2)) as varchar) else {SQL_PRICE} end", f"o_orderdate >= timestamp '{FIRST_MONTH_END}'")}),
prev as (select distinct record, string_split(record, '|')[4] = 'n/a' as is_bad from prev_raw),
cur as (select distinct record, string_split(record, '|')[4] = 'n/a' as is_bad from cur_raw),
ins as (select record from cur where not is_bad and record not in (select record from prev)),
del as (select record from prev where not is_bad and record not in (select record from cur)),
bad as (select record from cur where is_bad)"""

SQL_PRICED = f"""priced as ({_sql_snapshot(SQL_PRICE, "true")}),
judged as (select distinct record, string_split(record, '|')[4] = 'n/a' as is_bad from priced)"""

PRICE_RULES = '{"validates":[{"validation_type":"field","column_index":"3","data_type":"decimal"}]}'
ORDER_FORMATS = (
    '{"formats":[{"column_index":"4","format_type":"date","in_expression":"%m/%d/%y",'
    '"out_expression":"%Y-%m-%d"},{"column_index":"3","format_type":"currency"}]}')
ORDER_REPLACEMENTS = '{"replacements":[{"find":"NOT SPECIFIED","replace":"NONE"},{"find":"5-","replace":"V-"}]}'

PRICE_FEED = FeedSpec(
    feed="orders", validate=True, validations_json=PRICE_RULES, additional_output=ADDITIONAL)

CLEANED_FEED = FeedSpec(
    feed="orders", validate=True, validations_json=PRICE_RULES, additional_output=ADDITIONAL,
    replace_data=True, replacements_json=ORDER_REPLACEMENTS,
    format_data=True, formats_from_argument=True, formats_json=ORDER_FORMATS)


def sql_cleaned(record: str = "record") -> str:
    """An order record after the replacements and formats of the cleaned feed."""
    f = f"string_split(replace(replace({record}, 'NOT SPECIFIED', 'NONE'), '5-', 'V-'), '|')"
    return (f"concat_ws('|', ({f})[1], ({f})[2], ({f})[3], "
            f"'$' || format('{{:,.2f}}', cast(({f})[4] as decimal(18,2))), "
            f"strftime(strptime(({f})[5], '%m/%d/%y'), '%Y-%m-%d'), ({f})[6])")


DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def document_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as an all-string frame, as a CSV reader would give it."""
    return table(spark, sf, "documents").select(
        *[F.col(c).cast("string").alias(c) for c in DOC_COLUMNS])


def sql_canonical(columns: tuple[str, ...] = DOC_COLUMNS) -> str:
    cells = ", ".join(
        f"replace(replace(replace(coalesce(cast({c} as varchar), ''), chr(10), ''), '|', ';'), chr(9), ' ')"
        for c in columns)
    return f"regexp_replace(concat_ws('|', {cells}), '[^\\x00-\\x7F]', '', 'g')"


def document_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Documents without one source each, with a changed cell in between."""
    cells = document_cells(spark, sf)
    changed = F.when(F.col("lang") == "de", F.concat("n_chars", F.lit("+"))).otherwise(F.col("n_chars"))
    return (cells.where(F.col("source") != "src0"),
            cells.where(F.col("source") != "src1").withColumn("n_chars", changed))


def document_lines(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    previous, current = document_pair(spark, sf)
    return canonical_records(previous, "|"), canonical_records(current, "|")


_CHANGED = ("doc_id", "text", "lang", "source",
            "case when lang = 'de' then n_chars || '+' else cast(n_chars as varchar) end")
SQL_DOCS = f"""docs_before as (select distinct {sql_canonical()} as record from documents where source <> 'src0'),
docs_now as (select distinct {sql_canonical(_CHANGED)} as record from documents where source <> 'src1')"""
