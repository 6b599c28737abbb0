"""Sources, sinks and config lookup. Written data goes to a new scratch folder."""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.typed import typed_projection
from ..model import FeedSpec
from ..operators import audit, delta, records, validation as va
from ..plans.delta_job import delta_of
from ..session import scratch_path, stored_bytes
from ..sinks import text as sink
from ..sources import config, csv_records, properties, snapshots
from . import fixtures as fx
from .registry import query


def write_snapshot(spark: SparkSession, records_df: DataFrame, label: str) -> str:
    path = scratch_path(spark, label)
    records_df.select("record").write.text(path)
    return path


@query(f"select {fx.SQL_ORDER} as record from orders")
def text_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = write_snapshot(spark, fx.order_records(spark, sf), "text")
    return snapshots.read_snapshot(spark, path, FeedSpec())


def write_csv(spark: SparkSession, cells: DataFrame, header: bool, label: str) -> str:
    path = scratch_path(spark, label)
    cells.write.csv(path, header=header, escape='"')
    return path


CSV_FEED = FeedSpec(source_type="CSV", csv_header=True, csv_options={"escape": '"'})


@query(f"select {fx.sql_canonical()} as record from documents")
def csv_roundtrip_header(spark: SparkSession, sf: str) -> DataFrame:
    """Cells with quotes, newlines and accents, through a file with a header."""
    path = write_csv(spark, fx.document_cells(spark, sf), True, "csv")
    return snapshots.read_snapshot(spark, path, CSV_FEED)


TABLE_BYTES = 1 << 28  # of a table, that one task writes to one file


@query(f"select {fx.sql_canonical()} as record from documents")
def csv_split_records(spark: SparkSession, sf: str) -> DataFrame:
    """Files of many splits with newlines in cells, one for every 256 MB of the table, cut into records at the splits of a text scan."""
    cells = fx.document_cells(spark, sf)
    files = math.ceil(stored_bytes(spark, f"{sf}/documents.parquet") / TABLE_BYTES)
    path = write_csv(spark, cells.coalesce(max(files, 1)), True, "csv")
    rows = csv_records.read_csv_split(spark, path, True, csv_records.Dialect(escape='"'), cells.columns, {})
    return records.canonical_records(rows, "|")


@query(f"""select {fx.sql_canonical(("c_custkey", "c_name", "c_nationkey",
       "cast(c_acctbal as decimal(18,2))", "c_mktsegment"))} as record from customer""")
def csv_roundtrip_noheader(spark: SparkSession, sf: str) -> DataFrame:
    cells = fx.table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", fx.money("c_acctbal").alias("c_acctbal"), "c_mktsegment")
    path = write_csv(spark, cells, False, "csv")
    return snapshots.read_snapshot(spark, path, replace(CSV_FEED, csv_header=False))


def write_config(spark: SparkSession, *documents: str) -> str:
    path = scratch_path(spark, "config")
    spark.createDataFrame([(d,) for d in documents], "value string").write.text(path)
    return path


@query(f"""with {fx.SQL_PRICED}
select record, string_split(record, '|')[4] = 'n/a' as is_bad from priced""")
def config_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Orders judged by rules read from a config file of several feeds."""
    path = write_config(
        spark, '{"filename":"orders",' + fx.PRICE_RULES[1:],
        '{"filename":"other","validates":[{"validation_type":"record","column_count":1}]}',
        '{"filename":"orders",' + fx.ORDER_FORMATS[1:])
    spec = FeedSpec(feed="orders", validate=True, config_path=path)
    quality = va.Quality.of(config.resolve_rules(spark, spec))
    return quality.mark(fx.priced_orders(spark, sf), "|")


@query(f"""with {fx.SQL_FAULTY}
select try_cast(f[1] as bigint) as order_key, try_cast(f[2] as bigint) as customer, f[3] as status
from faulty_fields""")
def schema_lookup(spark: SparkSession, sf: str) -> DataFrame:
    path = write_config(
        spark, '{"filename":"orders","schema":{"fields":[{"name":"order_key","type":"long"},'
        '{"name":"customer","type":"long"},{"name":"status","type":"string"}]}}')
    schema = config.lookup_schema(spark, path, "orders")
    return typed_projection(records.with_fields(fx.faulty_orders(spark, sf), "|"), schema)


@query("""select c_custkey as id, c_mktsegment as "sparkFileName", n_name as "sparkBusinessProperty"
from customer join nation on c_nationkey = n_nationkey
where c_mktsegment = 'BUILDING' and n_name = 'NATION_3'""")
def feed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Both property tests reach the scan as filters."""
    nations = fx.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("sparkBusinessProperty"))
    rows = fx.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("sparkFileName"), "c_nationkey")
    table = rows.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).drop("c_nationkey", "n_nationkey")
    return properties.select_properties(table, "BUILDING", "NATION_3")


@query(f"with {fx.SQL_PAIR} select concat_ws('|', record, md5(record), 'False', 'delete', "
       f"'{fx.RUN_TS}', '{fx.ADDITIONAL}') as value from del")
def sink_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """A second write replaces the first."""
    spec = replace(fx.PRICE_FEED, delete_before_write=True)
    result = delta_of(*fx.order_pair(spark, sf), spec, fx.RUN_TS)
    path = scratch_path(spark, "sink")
    sink.write_delta(result.inserts, path, spec)
    sink.write_delta(result.deletes, path, spec)
    return spark.read.text(path)


@query("select count(*) as rows, 7 as files from orders")
def sink_files(spark: SparkSession, sf: str) -> DataFrame:
    """All orders in as many files as the feed asks for."""
    path = scratch_path(spark, "files")
    sink.write_lines(fx.order_records(spark, sf).withColumnRenamed("record", "value"), path, FeedSpec(output_files=7))
    return spark.read.text(path).select(F.input_file_name().alias("file")).agg(
        F.count("*").alias("rows"), F.countDistinct("file").cast("int").alias("files"))


@query(f"""with {fx.SQL_PAIR}
select concat_ws('|', record, md5(record), 'True') as value from bad""")
def sink_bad(spark: SparkSession, sf: str) -> DataFrame:
    result = delta_of(*fx.order_pair(spark, sf), fx.PRICE_FEED, fx.RUN_TS)
    path = scratch_path(spark, "bad")
    sink.write_bad(result.bad, path, fx.PRICE_FEED)
    return spark.read.text(path)


@query(f"""with {fx.SQL_PAIR}
select concat_ws('|', 'True', (select count(*) from cur), (select count(*) from ins), (select count(*) from del),
  (select count(*) from bad), (select count(*) from ins) + (select count(*) from del),
  'current', 'inserts', 'deletes', 'bad', '{fx.RUN_TS}') as value""")
def sink_audit(spark: SparkSession, sf: str) -> DataFrame:
    spec = replace(fx.PRICE_FEED, current_path="current", inserts_path="inserts",
                   deletes_path="deletes", bad_path="bad")
    compared = delta.compare(*fx.order_pair(spark, sf), va.Quality.of(spec), "|")
    row = audit.with_context(audit.audit_counts(compared), spec, fx.RUN_TS)
    path = scratch_path(spark, "audit")
    sink.append_audit(audit.audit_line(row), path)
    return spark.read.text(path)
