"""Fingerprints, distinct records, snapshot differences and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..model import FeedSpec
from ..operators import audit, delta, kept, records
from ..operators.validation import Quality, quarantine, tag
from ..plans.delta_job import delta_of
from ..session import scratch_path
from ..sources.snapshots import empty_snapshot
from . import fixtures as fx
from .registry import query

PRICES = Quality.of(fx.PRICE_FEED)


@query(f"select {fx.SQL_ORDER} as record, md5({fx.SQL_ORDER}) as hash from orders")
def fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    return records.with_fingerprint(fx.order_records(spark, sf))


@query(f"""with {fx.SQL_PRICED}
select record, md5(record) as hash,
       case when string_split(record, '|')[4] = 'n/a' then 'True' else 'False' end as bad from priced""")
def tagged_records(spark: SparkSession, sf: str) -> DataFrame:
    return tag(fx.priced_orders(spark, sf), PRICES, "|")


@query("select distinct text as record, md5(text) as hash from documents")
def distinct_records(spark: SparkSession, sf: str) -> DataFrame:
    docs = fx.table(spark, sf, "documents").select(F.col("text").alias("record"))
    return records.with_fingerprint(records.distinct_records(docs))


@query(f"with {fx.SQL_PAIR} select record, md5(record) as hash, 'False' as bad from ins")
def delta_inserts(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.order_pair(spark, sf)
    return delta.snapshot_delta(current, previous, PRICES, "|")


@query(f"with {fx.SQL_PAIR} select record, md5(record) as hash, 'False' as bad from del")
def delta_deletes(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.order_pair(spark, sf)
    return delta.snapshot_delta(previous, current, PRICES, "|")


@query(f"""with {fx.SQL_PAIR}
select record, md5(record) as hash, 'True' as bad from cur
where is_bad and record not in (select record from prev)""")
def delta_new_bad(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.order_pair(spark, sf)
    return delta.snapshot_delta(current, previous, PRICES, "|", bad=True)


@query(f"""with {fx.SQL_DOCS} select record, md5(record) as hash, 'False' as bad from docs_now
where record not in (select record from docs_before)""")
def delta_inserts_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Whole documents as records, matched by fingerprint."""
    previous, current = fx.document_lines(spark, sf)
    return delta.snapshot_delta_wide(current, previous, Quality(), "|")


@query(f"""with {fx.SQL_DOCS} select record, md5(record) as hash, 'False' as bad from docs_before
where record not in (select record from docs_now)""")
def delta_deletes_wide(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.document_lines(spark, sf)
    return delta.snapshot_delta_wide(previous, current, Quality(), "|")


@query(f"""with {fx.SQL_PAIR}
select 'insert' as op, record, md5(record) as hash, 'False' as bad from ins
union all select 'delete', record, md5(record), 'False' from del
union all select 'bad', record, md5(record), 'True' from bad""")
def delta_changes(spark: SparkSession, sf: str) -> DataFrame:
    """All three result sets from one pass over both snapshots."""
    previous, current = fx.order_pair(spark, sf)
    return delta.changes(delta.compare(previous, current, PRICES, "|"))


@query(f"""with {fx.SQL_PAIR}
select 'insert' as op, record, md5(record) as hash, 'False' as bad from ins
union all select 'delete', record, md5(record), 'False' from del
union all select 'bad', record, md5(record), 'True' from bad""")
def delta_kept(spark: SparkSession, sf: str) -> DataFrame:
    """Two days in a row: the first keeps its fingerprints, the second joins them bucket to bucket."""
    tables = []
    for snapshot in fx.order_pair(spark, sf):
        path = scratch_path(spark, "kept")
        kept.keep(kept.fingerprints(snapshot, PRICES, "|"), path, 8)
        tables.append(kept.kept(spark, path, 8))
    return delta.changes_wide(kept.compare_kept(*tables), *fx.order_pair(spark, sf))


@query(f"with {fx.SQL_PRICED} select record, md5(record) as hash, 'False' as bad from judged where not is_bad")
def reseed(spark: SparkSession, sf: str) -> DataFrame:
    result = delta_of(empty_snapshot(spark), fx.priced_orders(spark, sf), fx.PRICE_FEED, fx.RUN_TS)
    return result.inserts.select("record", "hash", "bad")


SQL_COUNTS = """(select count(*) from prev_raw) as raw_previous,
  (select count(*) from cur_raw) as raw_current,
  (select count(*) from prev) as distinct_previous,
  (select count(*) from cur) as distinct_current,
  (select count(*) from ins) as inserted,
  (select count(*) from del) as deleted,
  (select count(*) from bad) as bad,
  (select count(*) from ins) + (select count(*) from del) as changed"""


@query(f"with {fx.SQL_PAIR} select {SQL_COUNTS}")
def audit_counts(spark: SparkSession, sf: str) -> DataFrame:
    previous, current = fx.order_pair(spark, sf)
    return audit.audit_counts(delta.compare(previous, current, PRICES, "|"))


FAULTS = Quality.of(FeedSpec(validate=True, validations_json=(
    '{"validates":[{"validation_type":"record","column_count":6},{"validation_type":"field","column_index":1,"data_type":"integer"},'
    '{"validation_type":"field","column_index":3,"data_type":"decimal"},{"validation_type":"field","column_index":5,"data_type":"string","length":20}]}')))


@query(f"""with {fx.SQL_FAULTY}, {fx.SQL_PAIR}, now as (select distinct record, f from faulty_fields)
select cast((select min(len(string_split(record, '|'))) from prev) as integer) as least_fields_previous,
  cast((select max(len(string_split(record, '|'))) from prev) as integer) as most_fields_previous,
  cast((select min(len(f)) from now) as integer) as least_fields_current, cast((select max(len(f)) from now) as integer) as most_fields_current,
  (select count(*) from now where len(f) <> 6) as arity, (select count(*) from now where f[2] = 'x1') as customer,
  (select count(*) from now where f[4] = 'n/a') as price, (select count(*) from now where length(f[6]) > 20) as priority""")
def audit_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot with faults after one without: fields of both, and failures by rule, from the pass that counts."""
    compared = delta.compare(fx.order_pair(spark, sf)[0], fx.faulty_orders(spark, sf), FAULTS, "|")
    found = audit.audit_counts(compared, FAULTS)
    failures = {"arity": "record", "customer": "1:integer", "price": "3:decimal", "priority": "5:string"}
    return found.select(*audit.FIELDS, *[F.col("rule_failures")[rule].alias(name) for name, rule in failures.items()])


@query(f"with {fx.SQL_PRICED} select count(*) as bad from judged where is_bad")
def bad_count(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine(records.distinct_records(fx.priced_orders(spark, sf)), PRICES, "|").agg(F.count("*").alias("bad"))


@query("select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey limit 3")
def preview(spark: SparkSession, sf: str) -> DataFrame:
    orders = fx.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return records.preview(orders.orderBy("o_orderkey"))
