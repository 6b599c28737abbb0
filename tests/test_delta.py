import random
import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from snapdiff.model import FeedSpec
from snapdiff.operators import audit, delta, kept, membership
from snapdiff.operators.membership import bloom_filter, filter_bits, might_hold
from snapdiff.operators.validation import Quality
from snapdiff.plans.delta_job import delta_of
from snapdiff.workload import QUERIES, fixtures as fx

PRICE = '{"validates":[{"validation_type":"f","column_index":1,"data_type":"decimal"}]}'
SPEC = FeedSpec(validate=True, validations_json=PRICE, additional_output="UNIT|1")
QUALITY = Quality.of(SPEC)


def ops(previous, current):
    rows = delta.changes(delta.compare(previous, current, QUALITY, "|")).collect()
    return sorted((r.op, r.record) for r in rows)


def test_inserts_deletes_bad(records):
    previous = records("a|1", "b|2", "c|x", "d|4", "d|4", "e|5")
    current = records("a|1", "b|3", "b|3", "c|x", "f|y", "f|y", "e|5", "e|5")
    assert ops(previous, current) == [
        ("bad", "c|x"), ("bad", "f|y"), ("delete", "b|2"), ("delete", "d|4"), ("insert", "b|3")]


def test_counts(records):
    compared = delta.compare(records("a|1", "a|1", "b|2", "z|x"), records("a|1", "c|3", "c|3", "w|x"), QUALITY, "|")
    assert audit.audit_counts(compared).first().asDict() == {
        "raw_previous": 4, "raw_current": 4, "distinct_previous": 3, "distinct_current": 3,
        "inserted": 1, "deleted": 1, "bad": 1, "changed": 2}


def test_counts_of_nothing(records, spark):
    empty = records("x").where("false")
    compared = delta.compare(empty, empty, QUALITY, "|")
    assert set(audit.audit_counts(compared).first().asDict().values()) == {0}
    assert ops(empty, empty) == []


@pytest.mark.parametrize("difference", [delta.snapshot_delta, delta.snapshot_delta_wide])
@pytest.mark.parametrize("bad", [False, True])
def test_one_sided(records, difference, bad):
    a, b = records("a|1", "a|1", "b|2", "c|x", "d|x"), records("b|2", "d|x", "e|5")
    got = {(r.record, r.bad) for r in difference(a, b, QUALITY, "|", bad).collect()}
    assert got == ({("c|x", "True")} if bad else {("a|1", "False")})


LINES = st.lists(st.sampled_from(["a|1", "b|2", "c|3", "d|x", "e|y", "f|6", "g", "|7"]), max_size=14)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(LINES, LINES)
def test_properties(spark, previous, current):
    def frame(lines):
        return spark.createDataFrame([(line,) for line in lines], "record string")

    def good(lines):
        return {x for x in lines if x in ("a|1", "b|2", "c|3", "f|6", "|7")}

    def split(p, c):
        rows = ops(frame(p), frame(c))
        assert len(rows) == len(set(rows))
        return tuple({r for o, r in rows if o == op} for op in ("insert", "delete", "bad"))

    inserts, deletes, bad = split(previous, current)
    assert inserts == good(current) - set(previous)
    assert (good(previous) - deletes) | inserts == good(current)
    assert bad == set(current) - good(current)
    assert split(current, previous)[:2] == (deletes, inserts)
    shuffled = current + current[:3]
    random.Random(0).shuffle(shuffled)
    assert split(previous, shuffled) == (inserts, deletes, bad)


def test_documented_pair(spark, sf):
    """Known counts on orders: some rows missing on each side, some changed, some bad."""
    orders, key = fx.table(spark, sf, "orders"), F.col("o_orderkey")

    def snapshot(rows, price):
        return rows.select(F.concat_ws(
            "|", "o_orderkey", F.when(key % 19 == 0, "n/a").otherwise(price.cast("decimal(18,2)").cast("string")),
            F.date_format("o_orderdate", "MM/dd/yy")).alias("record"))

    total = F.col("o_totalprice").cast("decimal(18,2)")
    previous = snapshot(orders.where(key % 11 != 0), total)
    current = snapshot(orders.where(key % 13 != 0), F.when(key % 17 == 0, total + 1).otherwise(total))
    counts = audit.audit_counts(delta.compare(previous, current, QUALITY, "|")).first()
    assert (counts.distinct_previous, counts.distinct_current) == (13636, 13846)
    assert (counts.inserted, counts.deleted, counts.bad) == (1895, 1696, 729)
    new_bad = delta.snapshot_delta(current, previous, QUALITY, "|", bad=True)
    assert new_bad.count() == 66


def test_result_rows(records):
    spec = FeedSpec(validate=True, validations_json=PRICE, additional_output="UNIT|1", format_data=True,
                    formats_json='{"formats":[{"column_index":1,"format_type":"currency"}]}')
    result = delta_of(records("a|1\\0"), records("b|1234.5", "é\\|x"), spec, "T")
    rows = {r.op: r for r in result.rows.collect()}
    assert set(rows) == {"insert", "bad"}  # the previous record is bad: backslash is judged before it is dropped
    assert (rows["insert"].record, rows["insert"].run_ts, rows["insert"].additional) == ("b|$1,234.50", "T", "UNIT|1")
    assert rows["bad"].record == "é\\|x"  # as it came
    assert [r.record for r in result.bad.collect()] == ["é\\|x"]


def test_fingerprint_is_of_the_original(records):
    from hashlib import md5
    spec = FeedSpec(replace_data=True, replacements_json='{"replacements":[{"find":"a","replace":"b"}]}')
    row = delta_of(records("x"), records("a\\é"), spec, "T").inserts.first()
    assert (row.record, row.hash) == ("b", md5("a\\é".encode()).hexdigest())


def plan_of(df):
    """The physical plan in full, and the names of its operators."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return text, re.findall(r"^\(\d+\) (\w+)", text, re.MULTILINE)


def test_plans(spark, sf):
    previous, current = fx.order_pair(spark, sf)
    text, nodes = plan_of(delta_of(previous, current, fx.CLEANED_FEED, fx.RUN_TS).rows)
    assert [n for n in nodes if n not in ("Project", "Filter", "AdaptiveSparkPlan")] == [
        "Scan", "Scan", "Union", "HashAggregate", "Exchange", "HashAggregate"]
    assert text.count("split(") == 2  # once to judge, once to format
    assert "PushedFilters: [IsNotNull(o_orderdate)" in text

    text, nodes = plan_of(delta.snapshot_delta(current, previous, QUALITY, "|"))
    assert nodes.count("Exchange") == 1 and not any("Join" in n or "Sort" in n for n in nodes)


def test_counts_need_no_second_pass(spark, sf):
    previous, current = fx.order_pair(spark, sf)
    _, nodes = plan_of(audit.audit_counts(delta.compare(previous, current, QUALITY, "|")))
    assert nodes.count("Scan") == 2


def test_wide_plan(spark, sf):
    """The reduction to fingerprints lies below every exchange, however small the other side is."""
    previous, current = fx.order_pair(spark, sf)
    for other in (previous, previous.limit(10)):
        text, nodes = plan_of(delta.keys_only_in(current, other))
        at = text.index("max(known")
        assert "partial_max(known" in text and "LeftAnti" not in text and text.index("Exchange") > 0 and at


def test_wide_hot_record(spark):
    """Copies of one record leave a task as one row."""
    rows = spark.range(0, 40_000, 1, 4).selectExpr("if(id % 2 = 0, 'same|1', concat(id, '|1')) as record")
    other = spark.createDataFrame([("3|1",)], "record string")
    found = delta.snapshot_delta_wide(rows, other, QUALITY, "|")
    assert found.count() == 20_000 - 1 + 1
    assert found.where("record = 'same|1'").count() == 1


def test_wide_comparison(spark, sf):
    previous, current = fx.order_pair(spark, sf)
    compared = delta.compare_wide(previous, current, QUALITY, "|")
    wide = delta.changes_wide(compared, previous, current)
    plain = delta.changes(delta.compare(previous, current, QUALITY, "|"))
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, plain.collect()))
    assert audit.audit_counts(compared).collect() == audit.audit_counts(
        delta.compare(previous, current, QUALITY, "|")).collect()


def test_no_query_runs_python_or_crosses(spark, sf):
    for name, query in QUERIES.items():
        if name.startswith(("full_job", "workflow", "sink", "csv", "text_", "full_delta_csv")):
            continue  # these write files first
        _, nodes = plan_of(query.run(spark, sf))
        assert not [n for n in nodes if "Python" in n or "Cartesian" in n or "NestedLoop" in n], name


def test_wide_texts_pass_a_filter_below_the_exchange(spark, sf):
    """With broadcasting off, only wanted records and a few others of their snapshot are shuffled."""
    previous, current = fx.document_lines(spark, sf)
    compared = delta.compare_wide(previous, current, Quality(), "|")
    wanted = delta.staged_keys(delta.wanted_of(compared).where("op = 'insert'").limit(20).select("key"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text, nodes = plan_of(delta.texts_of(current, wanted))
        assert "might_contain" in text and not any(n.startswith("Broadcast") for n in nodes)
        assert text.count("regexp_replace(") == 1  # the record is made once, below the test
        assert sorted(r.key for r in delta.texts_of(current, wanted).select("key").collect()) == sorted(r.key for r in wanted.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = bloom_filter(wanted, wanted.count())
    passing = delta.keyed(current).where(might_hold(current, F.col("key"), found)).count()
    copies = delta.keyed(current).join(wanted, "key", "left_semi").count()
    assert copies <= passing <= copies + 0.05 * current.count()


def test_sizes_of_filters():
    assert filter_bits(0) == 64 and filter_bits(1000) == 9586
    assert filter_bits(20_000_000) == 1 << 26 and filter_bits(100_000_000) is None


def test_without_a_filter(spark, sf, monkeypatch):
    """Too many keys for a filter are joined without one."""
    monkeypatch.setattr(membership, "MOST_BITS", 64)
    previous, current = fx.order_pair(spark, sf)
    wide = delta.snapshot_delta_wide(current, previous, QUALITY, "|").select("record")
    plain = delta.snapshot_delta(current, previous, QUALITY, "|").select("record")
    assert sorted(map(tuple, wide.collect())) == sorted(map(tuple, plain.collect()))


def test_kept_sides_are_not_shuffled(spark, sf, tmp_path):
    previous, current = fx.order_pair(spark, sf)
    tables = []
    for name, snapshot in (("p", previous), ("c", current)):
        kept.keep(kept.fingerprints(snapshot, QUALITY, "|"), str(tmp_path / name), 8)
        tables.append(kept.kept(spark, str(tmp_path / name), 8))
    compared = kept.compare_kept(*tables)
    text, nodes = plan_of(compared)
    assert "Exchange" not in nodes and "record" not in text and "SelectedBucketsCount: 8 out of 8" in text
    plain = delta.compare_wide(previous, current, QUALITY, "|").select(*compared.columns)
    assert sorted(map(repr, compared.collect())) == sorted(map(repr, plain.collect()))
    assert len(list((tmp_path / "p").glob("part-*"))) <= 8
    assert kept.kept(spark, str(tmp_path / "none"), 8) is None


def test_kept_copies_and_nothing(spark, records, tmp_path):
    for name, snapshot in (("p", records("a|1", "a|1", "b|x")), ("c", records("x").where("false"))):
        kept.keep(kept.fingerprints(snapshot, QUALITY, "|"), str(tmp_path / name), 3)
    p, c = (kept.kept(spark, str(tmp_path / n), 3) for n in "pc")
    rows = {(r.previous_rows, r.current_rows, r.is_bad, r.op) for r in kept.compare_kept(p, c).collect()}
    assert rows == {(2, 0, False, "delete"), (1, 0, True, None)}


@pytest.mark.parametrize("compare", [delta.compare, delta.compare_wide])
def test_profile(records, compare):
    """Numbers of fields by side and failures by rule; without rules there are none to count."""
    compared = compare(records("a|1", "b|2|c"), records("a|1", "x", "y|q", "y|q", "z|1|2|3"), QUALITY, "|")
    row = audit.audit_counts(compared, QUALITY).first()
    assert [row[c] for c in audit.FIELDS] == [2, 3, 1, 4] and row.rule_failures == {"1:decimal": 2}
    plain = audit.audit_counts(compare(records("x").where("false"), records("x"), Quality(), "|"), Quality()).first()
    assert [plain[c] for c in audit.FIELDS] == [None, None, 1, 1] and plain.rule_failures == {}
