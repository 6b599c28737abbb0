"""Large CSV files cut into records by many tasks, against Spark's own reader, which takes one."""

import csv
import io
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from snapdiff.session import stored_bytes
from snapdiff.sources import snapshots
from snapdiff.sources.csv_records import Dialect, read_csv_split
from snapdiff.workload import io as workload
from snapdiff.workload.io import write_csv


def both(spark, path, header, options, split_bytes):
    """Rows by Spark's reader and by splits, and how many tasks the splits were."""
    one = spark.read.options(header=header, multiLine=True, inferSchema=False, encoding="UTF-8").options(**options).csv(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        many = read_csv_split(spark, path, header, Dialect.of(options), one.columns, options)
        rows = many.collect()
        tasks = spark.read.text(path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert many.columns == one.columns
    return sorted(map(repr, one.collect())), sorted(map(repr, rows)), tasks


CELL = st.text(st.sampled_from(list('ab ,"\n\r\té;\\')), max_size=12)
ROWS = st.lists(st.lists(CELL, min_size=3, max_size=3), min_size=1, max_size=25)


def spelled(rows, quoting=csv.QUOTE_MINIMAL, end="\n"):
    out = io.StringIO()
    csv.writer(out, quoting=quoting, lineterminator=end).writerows([["n1", "n2", "n3"], *rows])
    return out.getvalue()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ROWS, st.sampled_from([csv.QUOTE_MINIMAL, csv.QUOTE_ALL]), st.sampled_from(["\n", "\r\n"]), st.booleans(), st.integers(8, 90))
def test_written_files(spark, tmp_path_factory, rows, quoting, end, header, split_bytes):
    """Whatever a CSV writer spells, cut at any place."""
    if end == "\r\n":
        rows = [[c.replace("\r", "") for c in r] for r in rows]
    path = tmp_path_factory.mktemp("csv") / "a.csv"
    path.write_bytes(spelled(rows, quoting, end).encode())
    one, many, tasks = both(spark, str(path), header, {"escape": '"'}, split_bytes)
    assert many == one and (tasks > 1 or path.stat().st_size <= 2 * split_bytes)


@pytest.mark.parametrize("text", [
    'a,b\n"x\ny",2\n"q ""z"" w",3\n', 'a,b\n"r\\"s\nt",1\nshort\nlong,2,3,4\n', 'h1,h2\n\n\n"one\n\n\ntwo",2\n\nlast,"no end', 'a\n5" pipe\n"in\nner"\n',
    '﻿a,b\n"1\n2",3\n', 'a,b\r\n"x\r\ny",2\r\n\r\nz,3\r\n', 'a,b\n"",""\n,\n"\n","\n"\n', 'only,a header\n', 'a,b\n"x" ,2\n"y"\t,"3\n4"\n',
    "a,b\n" + '"' + "line\n" * 60 + '",end\n' + "x,y\n" * 30, "a,b\n" + "x,\"1\n2\"\n" * 40,
])
@pytest.mark.parametrize("split_bytes", [5, 16, 33])
def test_hand_written_files(spark, tmp_path, text, split_bytes):
    (tmp_path / "a.csv").write_bytes(text.encode())
    for header in (True, False):
        one, many, _ = both(spark, str(tmp_path / "a.csv"), header, {"escape": '"'} if '""' in text else {}, split_bytes)
        assert many == one


def test_lines_that_end_in_a_carriage_return(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\r1,2\r3,4\n5,6")
    assert read_csv_split(spark, str(tmp_path / "a.csv"), True, Dialect(), ["a", "b"], {}) is None


def test_several_files_and_separators(spark, tmp_path):
    for n in range(4):
        (tmp_path / f"{n}.csv").write_text("k;v\n" + "".join(f"{n}-{i};'cell ''{i}''\nof {n}; two'\n" for i in range(30)))
    one, many, tasks = both(spark, str(tmp_path), True, {"sep": ";", "quote": "'", "escape": "'"}, 100)
    assert many == one and len(many) == 120 and tasks > 12


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """The reader itself chooses: Spark's for small files, splits for large ones."""
    path = tmp_path / "a.csv"
    path.write_text(spelled([[f"cell {i}", f"two\nlines \"{i}\"", "x" * 50] for i in range(4000)]))
    one = snapshots.read_csv(spark, str(path), True, options={"escape": '"'})
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        many = snapshots.read_csv(spark, str(path), True, options={"escape": '"'})
        assert many.rdd.getNumPartitions() > 10
        assert sorted(map(tuple, many.collect())) == sorted(map(tuple, one.collect()))
        unknown = snapshots.read_csv(spark, str(path), True, options={"comment": "#"})
        assert unknown.rdd.getNumPartitions() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert one.rdd.getNumPartitions() == 1 and one.count() == 4000


def test_no_task_writes_the_whole_table(spark, tmp_path, monkeypatch):
    """A large table becomes several files, each written by a task of its own and larger than a split."""
    rows = [(i, f'line "{i}"\ntwo, é ' + f"{i * i * 7919:x}" * 40, "en", f"src{i % 3}", i) for i in range(2000)]
    table = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(8).write.parquet(table)
    size, paths = stored_bytes(spark, table), []
    monkeypatch.setattr(workload, "write_csv", lambda *args: paths.append(write_csv(*args)) or paths[-1])
    want = sorted(f"{i}|{t}|{lang}|{s}|{n}".replace("\n", "").replace("é", "") for i, t, lang, s, n in rows)
    for limit, files in ((size // 3 + 1, 3), (size, 1)):
        monkeypatch.setattr(workload, "TABLE_BYTES", limit, raising=False)
        assert sorted(r.record for r in workload.csv_split_records(spark, str(tmp_path)).collect()) == want
        written = [p.stat().st_size for p in Path(paths[-1].removeprefix("file:")).glob("part-*")]
        assert len(written) == files and max(written) < 2 * sum(written) / files
