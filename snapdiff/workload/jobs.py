"""Whole delta jobs."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import snapshot_path
from ..model import FeedSpec
from ..plans.delta_job import delta_of, run_delta, run_job
from ..plans.feeds import combined, run_workflow
from ..plans.publish import read_published
from ..session import scratch_path
from ..sinks.text import DELTA_COLUMNS
from ..sources.properties import PROPERTY_SCHEMA
from . import fixtures as fx
from .io import CSV_FEED, write_config, write_csv, write_snapshot
from .registry import query


def _sql_rows(op: str, rows: str, record: str = "record", bad: str = "False",
              ts: str = fx.RUN_TS, additional: str = fx.ADDITIONAL) -> str:
    return (f"select '{op}' as op, {record} as record, md5(record) as hash, '{bad}' as bad, "
            f"'{ts}' as run_ts, '{additional}' as additional from {rows}")


def _sql_job(record: str = "record") -> str:
    return " union all ".join((
        _sql_rows("insert", "ins", record), _sql_rows("delete", "del", record),
        _sql_rows("bad", "bad", bad="True", ts="", additional="")))


@query(f"with {fx.SQL_PAIR} {_sql_job(fx.sql_cleaned())}")
def full_delta_text(spark: SparkSession, sf: str) -> DataFrame:
    """Compare, validate, clean and format: every row a run writes, from one pass."""
    result = delta_of(*fx.order_pair(spark, sf), fx.CLEANED_FEED, fx.RUN_TS)
    return result.rows.select(*DELTA_COLUMNS)


SQL_DOCS = f"""{fx.SQL_DOCS},
prev as (select record from docs_before),
marked as (select record, ends_with(record, '+') as is_bad from docs_now),
ins as (select record from marked where not is_bad and record not in (select record from prev)),
del as (select record from prev where record not in (select record from marked)),
bad as (select record from marked where is_bad)"""

DOC_RULES = ('{"validates":[{"validation_type":"record","column_count":5},'
             '{"validation_type":"field","column_index":-1,"data_type":"integer"}]}')


@query(f"with {SQL_DOCS} {_sql_job()}")
def full_delta_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The same for CSV extracts with newlines, quotes and accents in cells."""
    previous, current = (write_csv(spark, s, True, "csv") for s in fx.document_pair(spark, sf))
    path = scratch_path(spark, "config")
    spark.createDataFrame([('{"filename":"documents",' + DOC_RULES[1:],)], "value string").write.text(path)
    spec = replace(CSV_FEED, previous_path=previous, current_path=current, feed="documents", validate=True,
                   config_path=path, additional_output=fx.ADDITIONAL)
    return run_delta(spark, spec, fx.RUN_TS).rows.select(*DELTA_COLUMNS)


def _lines_of(spark: SparkSession, path: str, op: str) -> DataFrame:
    return spark.read.text(path).select(F.lit(op).alias("op"), F.col("value").alias("line"))


def _sql_line(op: str, rows: str, record: str = "record") -> str:
    return (f"select '{op}' as op, concat_ws('|', {record}, md5(record), 'False', '{op}', '{fx.RUN_TS}', "
            f"'{fx.ADDITIONAL}') as line from {rows}")


@query(f"""with {fx.SQL_PAIR} {_sql_line('insert', 'ins', fx.sql_cleaned())}
union all {_sql_line('delete', 'del', fx.sql_cleaned())}
union all select 'bad', concat_ws('|', record, md5(record), 'True') from bad""")
def full_job_files(spark: SparkSession, sf: str) -> DataFrame:
    """A whole job: text snapshots in, staged comparison, text outputs read back."""
    previous, current = fx.order_pair(spark, sf)
    out = scratch_path(spark, "out")
    run_job(spark, replace(
        fx.CLEANED_FEED, regex_validation=True, record_regex=r"^(?:[^|]*\|){3}-?\d",
        previous_path=write_snapshot(spark, previous, "previous"),
        current_path=write_snapshot(spark, current, "current"),
        inserts_path=f"{out}/inserts", deletes_path=f"{out}/deletes", bad_path=f"{out}/bad",
        audit_path=f"{out}/audit", delete_before_write=True), fx.RUN_TS)
    return _lines_of(spark, f"{out}/inserts", "insert").unionAll(
        _lines_of(spark, f"{out}/deletes", "delete")).unionAll(_lines_of(spark, f"{out}/bad", "bad"))


@query(f"""with {fx.SQL_PAIR} {_sql_line('insert', 'ins', fx.sql_cleaned())}
union all {_sql_line('delete', 'del', fx.sql_cleaned())}
union all select 'bad', concat_ws('|', record, md5(record), 'True') from bad""")
def published_job(spark: SparkSession, sf: str) -> DataFrame:
    """A reseed, then a day's comparison: what the last manifest names is that day's outputs alone."""
    previous, current = (write_snapshot(spark, s, "day") for s in fx.order_pair(spark, sf))
    out = scratch_path(spark, "out")
    spec = replace(
        fx.CLEANED_FEED, regex_validation=True, record_regex=r"^(?:[^|]*\|){3}-?\d", inserts_path=f"{out}/inserts",
        deletes_path=f"{out}/deletes", bad_path=f"{out}/bad", audit_path=f"{out}/audit", manifest_path=f"{out}/manifests")
    run_job(spark, replace(spec, reseed=True, current_path=previous), fx.RUN_TS)
    run_job(spark, replace(spec, previous_path=previous, current_path=current), fx.RUN_TS)
    found = read_published(spark, spec.manifest_path)
    lines = [found[name].select(F.lit(op).alias("op"), F.col("value").alias("line"))
             for name, op in (("inserts", "insert"), ("deletes", "delete"), ("bad", "bad"))]
    return lines[0].unionAll(lines[1]).unionAll(lines[2])


@query(f"with {SQL_DOCS} {_sql_job()}")
def full_delta_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents compared by fingerprint: every row a run writes."""
    spec = FeedSpec(feed="documents", validate=True, validations_json=DOC_RULES, additional_output=fx.ADDITIONAL,
                    comparison="fingerprint")
    return delta_of(*fx.document_lines(spark, sf), spec, fx.RUN_TS).rows.select(*DELTA_COLUMNS)


@query(f"""with {fx.SQL_PAIR} {_sql_line('insert', 'ins')} union all {_sql_line('delete', 'del')}
union all select 'bad', concat_ws('|', record, md5(record), 'True') from bad""")
def job_arguments(spark: SparkSession, sf: str) -> DataFrame:
    """A job described by its argument list alone."""
    previous, current = fx.order_pair(spark, sf)
    out = scratch_path(spark, "out")
    spec = replace(
        fx.PRICE_FEED, previous_path=write_snapshot(spark, previous, "previous"),
        current_path=write_snapshot(spark, current, "current"), config_path=write_config(
            spark, '{"filename":"orders",' + fx.PRICE_RULES[1:]),
        inserts_path=f"{out}/inserts", deletes_path=f"{out}/deletes", bad_path=f"{out}/bad")
    run_job(spark, FeedSpec.from_args(spec.to_args()), fx.RUN_TS)
    return _lines_of(spark, f"{out}/inserts", "insert").unionAll(
        _lines_of(spark, f"{out}/deletes", "delete")).unionAll(_lines_of(spark, f"{out}/bad", "bad"))


def customer_pair(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Customers without one segment each; the balance of one nation changes."""
    rows = fx.table(spark, sf, "customer")

    def snapshot(df: DataFrame, balance) -> DataFrame:
        return df.select(F.concat_ws("~", "c_custkey", "c_name", balance, "c_mktsegment").alias("record"))

    moved = (F.col("c_acctbal").cast("decimal(18,2)") + 1).cast("decimal(18,2)").cast("string")
    balance = fx.money("c_acctbal")
    return (snapshot(rows.where("c_mktsegment <> 'BUILDING'"), balance),
            snapshot(rows.where("c_mktsegment <> 'MACHINERY'"),
                     F.when(F.col("c_nationkey") == 7, moved).otherwise(balance)))


_BALANCE = "cast(c_acctbal as decimal(18,2))"
_CUSTOMER = "concat_ws('~', c_custkey, c_name, {balance}, c_mktsegment)"
SQL_CUSTOMERS = f"""cprev as (select {_CUSTOMER.format(balance=_BALANCE)} as record from customer
  where c_mktsegment <> 'BUILDING'),
ccur as (select {_CUSTOMER.format(
    balance=f"case when c_nationkey = 7 then cast({_BALANCE} + 1 as decimal(18,2)) else {_BALANCE} end")} as record
  from customer where c_mktsegment <> 'MACHINERY'),
cins as (select record from ccur where record not in (select record from cprev)),
cdel as (select record from cprev where record not in (select record from ccur))"""

CUSTOMER_FEED = FeedSpec(feed="customer", source_delimiter="TILDE")


@query(f"""with {fx.SQL_PAIR}, {SQL_CUSTOMERS}
select *, 'orders' as feed from ({_sql_job(fx.sql_cleaned())})
union all select *, 'customer' from ({_sql_rows('insert', 'cins', additional='')}
union all {_sql_rows('delete', 'cdel', additional='')})""")
def multi_feed(spark: SparkSession, sf: str) -> DataFrame:
    """Feeds of different shape and rules in one frame."""
    feeds = {
        "orders": delta_of(*fx.order_pair(spark, sf), fx.CLEANED_FEED, fx.RUN_TS),
        "customer": delta_of(*customer_pair(spark, sf), CUSTOMER_FEED, fx.RUN_TS),
    }
    return combined(feeds).select(*DELTA_COLUMNS, "feed")


RUN_DATE = date(2018, 9, 10)


def _property_row(base: str, app: str, feed: str, delimiter: str, regex: str) -> tuple:
    """One row of the property table; members not named here stay empty."""
    values = {
        "sparkBasePath": base + "/", "sparkAppName": app, "sparkLookupTableName": feed,
        "sparkRawPreviousPath": f"raw/{feed}/", "sparkRawCurrentPath": f"raw/{feed}/",
        "sparkDeltaDataPath": f"processed/{feed}/", "sparkBadRecordsPath": f"bad/{feed}/",
        "sparkAuditRecordsPath": f"audit/{feed}/", "sparkConfigurationPath": "config/",
        "sparkFileFormat": feed + "_{0}-{1}-{2}", "sparkInputBucketFolder": "input/{0}/{1}/{2}/",
        "sparkDeltaDeletePath": f"processed/{feed}/", "sparkDeltaBadPath": f"bad/{feed}/",
        "sparkDelimiterOutput": "PIPE", "sparkDelimiterSource": delimiter, "sparkAdditionalOutput": "",
        "sparkRegexValidation": regex, "sparkSourceType": "TEXT",
        "sparkFlagReseed": "0", "sparkFlagFormatData": "0", "sparkFlagJSONStringFormatting": "0",
        "sparkFlagValidateRecords": "1" if regex else "0", "sparkFlagRegexValidation": "1" if regex else "0",
        "sparkFlagReplaceData": "0", "sparkCsvHasHeader": "0", "sparkBucketDeleteBeforeWrite": "1",
    }
    names = PROPERTY_SCHEMA["sparkCommandLineArguments"].dataType.names
    return (app, "spark", "CONTINUE", "daily", "UNIT", tuple(values.get(n) for n in names))


def _sql_fed(feed: str, op: str, rows: str) -> str:
    return (f"select '{feed}' as feed, '{op}' as op, concat_ws('|', record, md5(record), 'False', '{op}', "
            f"'{fx.RUN_TS}', '') as line from {rows}")


@query(f"""with {fx.SQL_PAIR}, {SQL_CUSTOMERS}
{_sql_fed('orders', 'insert', 'ins')} union all {_sql_fed('orders', 'delete', 'del')}
union all {_sql_fed('customer', 'insert', 'cins')} union all {_sql_fed('customer', 'delete', 'cdel')}""")
def workflow_files(spark: SparkSession, sf: str) -> DataFrame:
    """Every feed of a property table, from and to dated folders."""
    base = scratch_path(spark, "workflow")
    for feed, pair in {"orders": fx.order_pair(spark, sf), "customer": customer_pair(spark, sf)}.items():
        for day, snapshot in zip((date(2018, 9, 9), RUN_DATE), pair):
            snapshot.write.text(snapshot_path(base + "/", f"raw/{feed}/", day))
    properties = spark.createDataFrame(
        [_property_row(base, "a1", "missing", "PIPE", ""),  # fails, and the others go on
         _property_row(base, "a1", "orders", "PIPE", r"^(?:[^|]*\|){3}-?\d"),
         _property_row(base, "a1", "customer", "TILDE", "")], PROPERTY_SCHEMA)
    runs = run_workflow(spark, properties, "daily", "UNIT", RUN_DATE, run_ts=fx.RUN_TS)
    if [run.error is None for run in runs] != [False, True, True]:
        raise RuntimeError(f"unexpected results: {runs}")
    lines = [
        _lines_of(spark, snapshot_path(base + "/", f"processed/{feed}/", RUN_DATE) + folder, op).withColumn(
            "feed", F.lit(feed))
        for feed in ("orders", "customer") for folder, op in (("inserts", "insert"), ("deletes", "delete"))
    ]
    first, *rest = lines
    for more in rest:
        first = first.unionAll(more)
    return first




def _sql_audit(feed: str, flag: str, *rows: str) -> str:
    counts = ", ".join(f"(select count(*) from {r})" for r in rows)
    changed = f"(select count(*) from {rows[1]}) + (select count(*) from {rows[2]})"
    return f"select '{feed}' as feed, concat_ws('|', '{flag}', {counts}, {'' if len(rows) == 4 else '0, '}{changed}, '{fx.RUN_TS}') as line"


@query(f"""with {fx.SQL_PAIR}, {SQL_CUSTOMERS}
{_sql_audit('orders', 'True', 'cur', 'ins', 'del', 'bad')} union all {_sql_audit('customer', 'False', '(select distinct * from ccur)', 'cins', 'cdel')}""")
def workflow_restart(spark: SparkSession, sf: str) -> DataFrame:
    """One feed's snapshot comes late: the second run does that feed alone, and each has one audit line, here without its paths."""
    base, late = scratch_path(spark, "workflow"), []
    for feed, pair in {"orders": fx.order_pair(spark, sf), "customer": customer_pair(spark, sf)}.items():
        for day, snapshot in zip((date(2018, 9, 9), RUN_DATE), pair):
            path = snapshot_path(base + "/", f"raw/{feed}/", day)
            if (feed, day) == ("customer", RUN_DATE):
                late.append((snapshot, path))
            else:
                snapshot.write.text(path)
    properties = spark.createDataFrame(
        [_property_row(base, "a1", "customer", "TILDE", ""),
         _property_row(base, "a1", "orders", "PIPE", r"^(?:[^|]*\|){3}-?\d")], PROPERTY_SCHEMA)

    def run() -> list[tuple[bool, bool]]:
        runs = run_workflow(spark, properties, "daily", "UNIT", RUN_DATE, run_ts=fx.RUN_TS, ledger_path=f"{base}/ledger")
        return [(r.error is None, r.earlier) for r in runs]

    first = run()
    for snapshot, path in late:
        snapshot.write.text(path)
    found = (first, run(), run())
    if found != ([(False, False), (True, False)], [(True, False), (True, True)], [(True, True), (True, True)]):
        raise RuntimeError(f"unexpected results: {found}")
    lines = spark.read.text([snapshot_path(base + "/", f"audit/{feed}/", RUN_DATE) for feed in ("orders", "customer")])
    cells = F.split("value", r"\|")
    return lines.select(F.when(F.contains("value", F.lit("raw/orders/")), "orders").otherwise("customer").alias("feed"),
                        F.concat_ws("|", F.slice(cells, 1, 6), F.element_at(cells, -1)).alias("line"))
