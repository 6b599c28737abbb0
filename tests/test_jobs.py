from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest

from snapdiff import ConfigError, FeedSpec, run_feeds, run_job
from snapdiff.model import ARGUMENTS
from snapdiff.plans import publish
from snapdiff.plans.publish import published, read_published
from snapdiff.sinks import text as sink
from snapdiff.sinks.text import write_lines
from snapdiff.session import scratch_path
from snapdiff.sources import config, properties, snapshots
from snapdiff.workload.jobs import _property_row

TS = "2018-09-10 06:30:00"
RULES = '{"filename":"f1","validates":[{"validation_type":"field","column_index":1,"data_type":"decimal"}]}'
FORMATS = '{"filename":"f1","formats":[{"column_index":"1","format_type":"currency"}]}'


def write(path, *lines):
    path.mkdir(parents=True)
    (path / "part.txt").write_text("".join(line + "\n" for line in lines), encoding="utf-8")
    return str(path)


def lines_of(path):
    return sorted(line for f in path.glob("part-*") for line in f.read_text(encoding="utf-8").splitlines())


def md5(text):
    from hashlib import md5 as h
    return h(text.encode()).hexdigest()


@pytest.fixture
def feed(tmp_path):
    """A feed with rules and formats in config files."""
    return FeedSpec(
        app_name="t", feed="f1", validate=True, format_data=True, additional_output="UNIT|20180910",
        previous_path=write(tmp_path / "prev", "a|1", "b|2", "c|3", "z|x"),
        current_path=write(tmp_path / "cur", "a|1", "b|2.5", "b|2.5", "é|y"),
        inserts_path=str(tmp_path / "out/inserts"), deletes_path=str(tmp_path / "out/deletes"),
        bad_path=str(tmp_path / "out/bad"), audit_path=str(tmp_path / "out/audit"),
        config_path=write(tmp_path / "config", RULES, FORMATS, '{"filename":"f2","validates":[]}', "not json"),
        delete_before_write=True)


def test_job_files(spark, feed, tmp_path):
    counts = run_job(spark, feed, TS)
    assert counts == {"raw_previous": 4, "raw_current": 4, "distinct_previous": 4, "distinct_current": 3,
                      "inserted": 1, "deleted": 2, "bad": 1, "changed": 3, "format_failures": 0}
    out = tmp_path / "out"
    tail = f"False|%s|{TS}|UNIT|20180910"
    assert lines_of(out / "inserts") == [f"b|$2.50|{md5('b|2.5')}|" + tail % "insert"]
    assert lines_of(out / "deletes") == sorted(
        f"{shown}|{md5(raw)}|" + tail % "delete" for shown, raw in (("b|$2.00", "b|2"), ("c|$3.00", "c|3")))
    assert lines_of(out / "bad") == [f"é|y|{md5('é|y')}|True"]
    assert lines_of(out / "audit") == [
        f"True|3|1|2|1|3|{feed.current_path}|{feed.inserts_path}|{feed.deletes_path}|{feed.bad_path}|{TS}"]


def test_small_outputs_are_one_file(spark, feed, tmp_path):
    run_job(spark, feed, TS)
    for folder in ("inserts", "deletes", "bad", "audit"):
        assert len(list((tmp_path / "out" / folder).glob("part-*"))) == 1


def test_output_files_are_a_parameter(spark, tmp_path):
    rows = spark.range(100).selectExpr("cast(id as string) as value")
    for files, rows_per_file, expected in ((1, 0, 1), (4, 0, 4), (1, 30, 4)):
        path = tmp_path / f"{files}-{rows_per_file}"
        write_lines(rows, str(path), FeedSpec(output_files=files, rows_per_file=rows_per_file))
        assert len(list(path.glob("part-*"))) == expected and len(lines_of(path)) == 100


def test_large_outputs_are_several_files(spark, tmp_path, monkeypatch):
    """Where the feed asks for no number, no task writes much more than `FILE_BYTES`."""
    monkeypatch.setattr(sink, "FILE_BYTES", 2000, raising=False)
    rows = spark.range(1000).selectExpr("cast(id + 1000 as string) as value")
    for files, expected in ({}, 2), ({"output_files": 1}, 1), ({"output_files": 3}, 3):
        path = tmp_path / f"lines-{len(files)}-{expected}"
        write_lines(rows, str(path), FeedSpec(**files))
        assert len(list(path.glob("part-*"))) == expected and lines_of(path) == sorted(str(i + 1000) for i in range(1000))
    assert not list(Path(spark.conf.get("spark.checkpoint.dir")).glob("snapdiff-lines-*"))


@pytest.mark.parametrize("comparison", ["record", "fingerprint"])
@pytest.mark.parametrize("manifest", [False, True])
def test_large_outputs_of_a_job_are_several_files(spark, feed, tmp_path, monkeypatch, comparison, manifest):
    monkeypatch.setattr(sink, "FILE_BYTES", 4000, raising=False)
    previous = [f"{i}|1" for i in range(100)]
    current = [f"{i}|2" for i in range(50, 150)] + [f"{i}|é{i}" for i in range(200)]
    spec = replace(feed, comparison=comparison, previous_path=write(tmp_path / "p2", *previous), current_path=write(tmp_path / "c2", *current),
                   manifest_path=str(tmp_path / "manifests") if manifest else "")
    counts = run_job(spark, spec, TS)
    assert (counts["inserted"], counts["deleted"], counts["bad"]) == (100, 100, 200)
    found = published(spark, spec.manifest_path).outputs if manifest else {f: str(tmp_path / "out" / f) for f in ("inserts", "deletes", "bad", "audit")}
    for name, raw in (("inserts", [c for c in current if "é" not in c]), ("deletes", previous), ("bad", [c for c in current if "é" in c])):
        folder = Path(found[name])
        files = [f.stat().st_size for f in folder.glob("part-*")]
        assert len(files) > 1 and max(files) < 4400
        assert sorted(line.split("|")[0 if name != "bad" else 2] for line in lines_of(folder)) == sorted(
            r.split("|")[0] if name != "bad" else md5(r) for r in raw)
    assert len(lines_of(Path(found["audit"]))) == 1


def test_format_failures_are_counted(spark, feed, tmp_path):
    rules = '{"formats":[{"column_index":0,"format_type":"currency"}]}'
    counts = run_job(spark, replace(feed, formats_from_argument=True, formats_json=rules), TS)
    assert counts["format_failures"] == counts["changed"] > 0


def test_comparison_by_fingerprint(spark, feed, tmp_path):
    by_record = run_job(spark, feed, TS)
    before = {f: lines_of(tmp_path / "out" / f) for f in ("inserts", "deletes", "bad")}
    assert run_job(spark, replace(feed, comparison="fingerprint"), TS) == by_record
    assert {f: lines_of(tmp_path / "out" / f) for f in before} == before


@pytest.mark.parametrize("clash", ["audit_path", "config_path"])
def test_paths_do_not_overlap(spark, feed, clash):
    with pytest.raises(ConfigError, match="overlaps"):
        run_job(spark, replace(feed, **{clash: "file://" + feed.inserts_path}), TS)


def test_overwrite_flag(spark, feed, tmp_path):
    run_job(spark, feed, TS)
    before = lines_of(tmp_path / "out/inserts")
    run_job(spark, feed, TS)
    assert lines_of(tmp_path / "out/inserts") == before
    assert len(lines_of(tmp_path / "out/audit")) == 2  # appended
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        run_job(spark, replace(feed, delete_before_write=False), TS)


def test_no_bad_records_no_bad_folder(spark, feed, tmp_path):
    run_job(spark, feed, TS)
    assert (tmp_path / "out/bad").exists()
    counts = run_job(spark, replace(feed, validate=False), TS)
    assert counts["bad"] == 0 and not (tmp_path / "out/bad").exists()


def test_failed_run_keeps_old_outputs(spark, feed, tmp_path):
    run_job(spark, feed, TS)
    with pytest.raises(ConfigError):
        run_job(spark, replace(feed, feed="nobody"), TS)
    with pytest.raises(Exception):
        run_job(spark, replace(feed, current_path=str(tmp_path / "missing")), TS)
    assert lines_of(tmp_path / "out/inserts")


def test_staged_rows_are_removed(spark, feed):
    from pathlib import Path
    base = Path(spark.conf.get("spark.checkpoint.dir"))
    run_job(spark, feed, TS)
    assert not list(base.glob("snapdiff-changes-*"))


def test_reseed(spark, feed):
    counts = run_job(spark, replace(feed, reseed=True, previous_path=""), TS)
    assert (counts["raw_previous"], counts["inserted"], counts["deleted"], counts["bad"]) == (0, 2, 0, 1)


def test_paths_may_not_overlap(spark, feed):
    for bad in (replace(feed, inserts_path=feed.current_path), replace(feed, deletes_path=feed.inserts_path),
                replace(feed, bad_path=feed.inserts_path + "/bad"), replace(feed, inserts_path="")):
        with pytest.raises(ConfigError):
            run_job(spark, bad, TS)


def test_text_feed_keeps_its_delimiter(spark, feed, tmp_path):
    """A text record is never re-delimited; only the metadata uses the output delimiter."""
    spec = replace(feed, validate=False, format_data=False, output_delimiter="TILDE", additional_output="")
    run_job(spark, spec, TS)
    assert lines_of(tmp_path / "out/inserts")[0] == f"b|2.5~{md5('b|2.5')}~False~insert~{TS}~"


def csv_file(path, text):
    path.mkdir(parents=True)
    (path / "a.csv").write_bytes(text.encode("utf-8"))
    return str(path)


CSV = 'id,name,note\n1,"x\ny","a|b"\n2,"q ""z"" w",\n3,short\n4,long,x,extra\n5,"r\\"s",""\n6,"c\r\nd",é\tt\n'


def test_csv_with_header(spark, tmp_path):
    path = csv_file(tmp_path / "csv", CSV)
    got = [r.record for r in snapshots.read_snapshot(spark, path, FeedSpec(source_type="CSV", csv_header=True)).collect()]
    assert got == ["1|xy|a;b", '2|"q ""z"" w"|', "3|short|", "4|long|x", '5|r"s|', "6|c\rd| t"]


def test_csv_without_header_and_rfc_quotes(spark, tmp_path):
    path = csv_file(tmp_path / "csv", CSV)
    spec = FeedSpec(source_type="CSV", output_delimiter="CARET", csv_options={"escape": '"'})
    got = [r.record for r in snapshots.read_snapshot(spark, path, spec).collect()]
    assert got[:3] == ["id^name^note", "1^xy^a|b", '2^q "z" w^']


def test_text_header_is_data(spark, tmp_path):
    path = write(tmp_path / "t", "id|name", "1|x")
    assert [r.record for r in snapshots.read_snapshot(spark, path, FeedSpec()).collect()] == ["id|name", "1|x"]


def test_csv_validates_cells(spark, tmp_path):
    """Cells are judged as they are joined, whatever the source delimiter says."""
    spec = FeedSpec(source_type="CSV", csv_header=True, source_delimiter="COMMA", validate=True, feed="f1",
                    previous_path=csv_file(tmp_path / "p", "a,b\n1,2\n"), current_path=csv_file(tmp_path / "c", "a,b\n1,x\n1,3\n"),
                    inserts_path=str(tmp_path / "i"), deletes_path=str(tmp_path / "d"), bad_path=str(tmp_path / "b"),
                    config_path=write(tmp_path / "config", RULES))
    counts = run_job(spark, spec, TS)
    assert (counts["inserted"], counts["deleted"], counts["bad"]) == (1, 1, 1)


def test_rule_precedence(spark, feed):
    """Rules always come from the files; formats only when the argument is not to be used."""
    own = replace(feed, validations_json="ignored", formats_json='{"formats":[]}')
    resolved = config.resolve_rules(spark, own)
    assert "decimal" in resolved.validations_json and "currency" in resolved.formats_json
    kept = config.resolve_rules(spark, replace(own, formats_from_argument=True, regex_validation=True))
    assert (kept.validations_json, kept.formats_json) == ("ignored", '{"formats":[]}')


def test_config_lookup_errors(spark, tmp_path):
    path = write(tmp_path / "config", RULES, RULES)
    with pytest.raises(ConfigError, match="more than once"):
        config.lookup_validations(spark, path, "f1")
    with pytest.raises(ConfigError, match="no 'formats'"):
        config.lookup_formats(spark, path, "f1")


def test_schema_lookup(spark, tmp_path):
    path = write(tmp_path / "config", '{"filename":"f1","schema":{"fields":[{"name":"a","type":"long"},{"name":"b","type":"?"}]}}')
    assert config.lookup_schema(spark, path, "f1").simpleString() == "struct<a:bigint,b:string>"


def test_arguments_round_trip():
    args = [f"v{i}" for i in range(len(ARGUMENTS))]
    for name, value in (("reseed", "0"), ("format_data", "1"), ("formats_from_argument", "0"), ("validate", "1"),
                        ("regex_validation", "0"), ("replace_data", "1"), ("csv_header", "1"), ("delete_before_write", "0")):
        args[ARGUMENTS.index(name)] = value
    spec = FeedSpec.from_args(args)
    assert spec.to_args() == args and len(args) == 34
    assert (spec.format_data, spec.reseed, spec.csv_header, spec.delete_before_write) == (True, False, True, False)
    assert (spec.previous_path, spec.feed, spec.bad_bucket) == ("v1", "v11", "v33")
    with pytest.raises(ConfigError):
        FeedSpec.from_args(args[:-1])
    with pytest.raises(ConfigError):
        FeedSpec.from_args(["x"] * 34)


def test_property_rows(spark):
    rows = [_property_row("s3://b", "a1", "orders", "TILDE", "^x"), _property_row("s3://b", "a2", "other", "PIPE", "")]
    table = spark.createDataFrame(rows, properties.PROPERTY_SCHEMA)
    specs = properties.feed_specs(table, "daily", "UNIT", date(2018, 9, 10), 0, 1)
    assert [s.app_name for s in specs] == ["a1", "a2"]
    one = specs[0]
    assert one.previous_path == "s3://b/raw/orders/2018/09/09/" and one.current_path == "s3://b/raw/orders/2018/09/10/"
    assert one.inserts_path == "s3://b/processed/orders/2018/09/10/inserts/"
    assert one.deletes_path == "s3://b/processed/orders/2018/09/10/deletes/"
    assert one.bad_path == "s3://b/bad/orders/2018/09/10/" and one.audit_path == "s3://b/audit/orders/2018/09/10/"
    assert one.file_name == "orders_2018-09-10" and one.input_folder == "s3://b/input/2018/09/10/"
    assert one.delta_prefix == "processed/orders/2018/09/10/" and (one.year, one.month, one.day) == ("2018", "09", "10")
    assert one.regex_validation and one.delete_before_write and not one.csv_header
    with pytest.raises(ConfigError):
        properties.feed_specs(table, "weekly", "UNIT", date(2018, 9, 10), 0, 1)


def test_run_feeds(spark, feed, tmp_path):
    other = replace(feed, app_name="u", reseed=True, inserts_path=str(tmp_path / "u/i"),
                    deletes_path=str(tmp_path / "u/d"), bad_path=str(tmp_path / "u/b"))
    lost = replace(feed, previous_path=str(tmp_path / "none"))
    runs = run_feeds(spark, [feed, lost, replace(other, app_name="t")], TS)  # equal names, a failing feed
    assert [r.error is None for r in runs] == [True, False, True]
    assert (runs[0].counts["inserted"], runs[2].counts["inserted"]) == (1, 2)
    runs = run_feeds(spark, [replace(lost, on_failure="TERMINATE"), feed], TS)
    assert runs[0].error is not None and runs[1].counts is runs[1].error is None


def test_scratch_paths_are_new(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_fingerprints_kept_from_day_to_day(spark, feed, tmp_path):
    """The second day compares with what the first kept, and reads the text of yesterday's records only for deletes."""
    days = [["a|1", "b|2", "c|3", "z|x"], ["a|1", "b|2.5", "b|2.5", "é|y"], ["a|1", "b|2.5", "é|y", "n|9"], []]
    paths = [write(tmp_path / f"day{n}", *day) for n, day in enumerate(days)]
    own = dict(comparison="fingerprint", kept_path=str(tmp_path / "kept"), kept_buckets=4)
    for n in range(1, len(days)):
        spec = replace(feed, previous_path=paths[n - 1], current_path=paths[n])
        by_record = run_job(spark, spec, TS)
        before = {f: lines_of(tmp_path / "out" / f) for f in ("inserts", "deletes", "bad")}
        assert run_job(spark, replace(spec, **own), TS) == by_record
        assert {f: lines_of(tmp_path / "out" / f) for f in before} == before
        if n == 1:  # changed behind the job's back: only what was kept counts
            (tmp_path / "day1" / "part.txt").write_text("")
            kept_only = replace(spec, previous_path=paths[1], current_path=paths[2], **own)
            assert run_job(spark, kept_only, TS)["raw_previous"] == 4
            (tmp_path / "day1" / "part.txt").write_text("".join(x + "\n" for x in days[1]), encoding="utf-8")
    assert run_job(spark, replace(spec, reseed=True, current_path=paths[2], **own), TS)["deleted"] == 0
    with pytest.raises(ConfigError, match="keeps"):
        replace(feed, kept_path="x")


def published_lines(spark, path):
    return {name: sorted(r.value for r in df.collect()) for name, df in read_published(spark, path).items()}


@pytest.mark.parametrize("stopped_at", ["write_bad", "append_audit", "publish"])
def test_outputs_appear_together(spark, feed, tmp_path, monkeypatch, stopped_at):
    """A run that stops between two sinks leaves all of the last one's outputs, and the next run clears what it left."""
    spec = replace(feed, manifest_path=str(tmp_path / "manifests"), delete_before_write=False)
    assert published_lines(spark, spec.manifest_path) == {}
    first = run_job(spark, spec, TS)
    before = published_lines(spark, spec.manifest_path)
    assert set(before) == {"inserts", "deletes", "bad", "audit"} and len(before["audit"]) == 1 and len(before["deletes"]) == first["deleted"]

    def fail(*args):
        raise OSError("stopped")

    next_day = replace(spec, previous_path=spec.current_path, current_path=write(tmp_path / "next", "a|1", "n|7", "q|x"))
    with monkeypatch.context() as patch:
        patch.setattr(publish if stopped_at == "publish" else sink, "publish_bytes" if stopped_at == "publish" else stopped_at, fail)
        with pytest.raises(OSError, match="stopped"):
            run_job(spark, next_day, TS)
    assert published_lines(spark, spec.manifest_path) == before
    second = run_job(spark, next_day, TS)
    after = published_lines(spark, spec.manifest_path)
    assert after["inserts"] != before["inserts"] and len(after["inserts"]) == second["inserted"] == 1
    last = run_job(spark, replace(next_day, validate=False), TS)
    assert "bad" not in published_lines(spark, spec.manifest_path) and last["bad"] == 0
    versions = publish.published_versions(spark, spec.manifest_path)
    assert len(versions) == spec.keep_versions == 2
    assert sorted(p.name for p in (tmp_path / "out/inserts").iterdir()) == versions


def test_a_ledger_skips_what_is_done(spark, feed, tmp_path, monkeypatch):
    """A feed that stopped after its first sink is done again, even where it may not replace outputs, with one audit line."""
    ledger = str(tmp_path / "ledger")
    other = replace(feed, feed="f2", config_path="", validate=False, format_data=False, inserts_path=str(tmp_path / "o2/inserts"),
                    deletes_path=str(tmp_path / "o2/deletes"), bad_path=str(tmp_path / "o2/bad"), audit_path=str(tmp_path / "o2/audit"))
    specs = [replace(feed, delete_before_write=False), other]
    real, stops = sink.write_bad, [True]

    def fail_once(*args):
        if stops.pop() if stops else False:
            raise OSError("stopped")
        real(*args)

    monkeypatch.setattr(sink, "write_bad", fail_once)
    first = run_feeds(spark, specs, TS, ledger_path=ledger)
    assert [(r.error is None, r.earlier) for r in first] == [(False, False), (True, False)]
    second = run_feeds(spark, specs, TS, ledger_path=ledger)
    assert [(r.error is None, r.earlier) for r in second] == [(True, False), (True, True)] and second[1].counts == first[1].counts
    third = run_feeds(spark, specs, TS, ledger_path=ledger)
    assert [r.earlier for r in third] == [True, True] and third[0].counts == second[0].counts
    for out in ("out", "o2"):
        assert [len(f.read_text().splitlines()) for f in (tmp_path / out / "audit").glob("audit-*")] == [1]
    assert len(lines_of(tmp_path / "out/inserts")) == second[0].counts["inserted"]
    moved = run_feeds(spark, [replace(other, current_path=feed.previous_path, inserts_path=str(tmp_path / "o3"))], TS, ledger_path=ledger)
    assert not moved[0].earlier  # another input is another run
