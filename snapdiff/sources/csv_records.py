"""Large CSV files with newlines in cells, read by many tasks.

Spark splits a text file at newlines, but whether a newline ends a record depends on
the quotes before it. Each split is therefore read for what it makes of either start:
inside a quoted cell or outside. These functions of two states, composed along a
file, give every split its true start; records are cut there, pieces of records
that cross splits are joined, and Spark's own `from_csv` takes the cells apart.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

_WHOLE, _HEAD, _MIDDLE, _TAIL = range(4)
_ROWS = 4096
# Options under which a record ends where `Dialect` says it does.
_KNOWN = {"sep", "delimiter", "quote", "escape", "header", "nullvalue", "emptyvalue", "ignoreleadingwhitespace", "ignoretrailingwhitespace",
          "maxcharspercolumn", "maxcolumns", "encoding", "charset", "mode", "multiline", "inferschema"}


@dataclass(frozen=True)
class Dialect:
    """Where quoted cells begin and end."""

    sep: str = ","
    quote: str = '"'
    escape: str = "\\"

    @classmethod
    def of(cls, options: Mapping[str, str]) -> "Dialect | None":
        """The dialect of reader options; null if records may end elsewhere under them."""
        given = {k.lower(): str(v) for k, v in options.items()}
        own = cls(given.get("sep", given.get("delimiter", ",")), given.get("quote", '"'), given.get("escape", "\\"))
        plain = (given.get("encoding", given.get("charset", "UTF-8")).upper() in ("UTF-8", "UTF8")
                 and given.get("mode", "PERMISSIVE").upper() == "PERMISSIVE" and given.get("ignoreleadingwhitespace", "false").lower() == "false")
        return own if plain and given.keys() <= _KNOWN and len(own.quote) == len(own.escape) == 1 and own.sep else None

    def inside_after(self, line: str, inside: bool) -> bool:
        """Whether the line ends inside a quoted cell, if it begins inside one or not."""
        line = line[:-1] if line.endswith("\r") else line
        at, end, quote = 0, len(line), self.quote
        while True:
            if not inside:
                if line.startswith(quote, at):
                    at, inside = at + 1, True
                    continue
                at = line.find(self.sep, at)
                if at < 0:
                    return False
                at += len(self.sep)
                continue
            close = line.find(quote, at)
            if self.escape != quote:
                escaped = line.find(self.escape, at)
                if 0 <= escaped < (end if close < 0 else close):
                    at = escaped + (2 if line.startswith((quote, self.escape), escaped + 1) else 1)
                    continue
            if close < 0:
                return True
            if self.escape == quote and line.startswith(quote, close + 1):
                at = close + 2
                continue
            at = close + 1
            while at < end and line[at] in " \t" and not line.startswith(self.sep, at):
                at += 1
            inside = False
            if at == end:
                return False
            if line.startswith(self.sep, at):
                at += len(self.sep)
            else:  # a quote inside a cell that was not escaped: the cell goes on to the next separator
                at = line.find(self.sep, at)
                if at < 0:
                    return False
                at += len(self.sep)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """The lines of one split each, as they come."""
    block, file = batch["block"].to_numpy(), batch["file"]
    at = 0
    while at < batch.num_rows:
        name, start = file[at].as_py(), int(block[at])
        to = at + 1
        if block[-1] == start and file[batch.num_rows - 1].as_py() == name:
            to = batch.num_rows
        else:
            while to < batch.num_rows and block[to] == start and file[to].as_py() == name:
                to += 1
        yield name, start, batch["value"].slice(at, to - at)
        at = to


def split_states(lines: DataFrame, dialect: Dialect) -> DataFrame:
    """`file, block, outside, inside, ending`: whether a split that begins outside or inside a cell ends inside one.

    `ending` tells how a file's first line ends, by which Spark's reader knows how all do.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, int], tuple[bool, bool]] = {}
        endings: dict[tuple[str, int], str] = {}
        for batch in batches:
            for file, block, values in _runs(batch):
                states = held.get((file, block), (False, True))
                if block == 0 and (file, block) not in held:
                    endings[file, block] = values[0].as_py() or ""
                for line in values.drop_null().to_pylist():
                    left = dialect.inside_after(line, states[0])
                    states = (left, left if states[0] == states[1] else dialect.inside_after(line, states[1]))
                held[file, block] = states
        out = [(f, b, *s, _ending(endings.get((f, b), ""))) for (f, b), s in held.items()]
        types = (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], ["file", "block", "outside", "inside", "ending"])

    told = F.contains("value", F.lit(dialect.quote)) | F.contains("value", F.lit("\r"))
    quoted = F.when(told, F.col("value")).alias("value")  # others change nothing
    return lines.select("file", "block", quoted).mapInArrow(run, "file string, block long, outside boolean, inside boolean, ending string")


def _ending(line: str) -> str:
    at = line.find("\r")
    return "LF" if at < 0 else "CRLF" if at == len(line) - 1 else "CR"


def split_starts(states: DataFrame) -> DataFrame:
    """`file, block, ending, start`: whether a split begins inside a quoted cell.

    A split keeps the state, turns it or sets it. What the last one to set it left,
    turned as often as splits since have turned it, is where the next begins.
    """
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    turned = F.sum((F.col("outside") & ~F.col("inside")).cast("int"))
    marked = states.withColumn("turns", turned.over(order.rowsBetween(Window.unboundedPreceding, 0)))
    marked = marked.withColumn("set", F.when(F.col("outside") == F.col("inside"), (F.col("outside").cast("int") + F.col("turns")) % 2))
    left = F.coalesce(F.last("set", ignorenulls=True).over(before), F.lit(0))
    passed = F.coalesce(F.last("turns").over(before), F.lit(0))
    return marked.select("file", "block", "ending", ((left + passed) % 2 == 1).alias("start"))


def _pieces(lines: DataFrame, dialect: Dialect, inside: set[tuple[str, int]], crlf: set[str]) -> DataFrame:
    """`file, block, kind, first, record`: whole records, and pieces of those that cross splits.

    `inside` holds the splits that begin inside a cell, at most all splits, which the
    driver lists anyway, and `crlf` the files whose lines end in both characters.
    """
    shared = lines.sparkSession.sparkContext.broadcast((inside, crlf))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        here: tuple[str, int] | None = None
        open_lines: list[str] = []  # of the record that is not at its end
        within = headed = False     # inside a cell; the record began in an earlier split
        begun: set[str] = set()     # files whose first record has come

        def put(kind: int, record: str) -> None:
            file, block = here
            first = block == 0 and file not in begun and record.strip("\ufeff") != ""
            if first:
                begun.add(file)
            out.append((file, block, kind, first, record))

        def close() -> None:
            if open_lines:
                put(_MIDDLE if headed else _TAIL, "\n".join(open_lines))
                open_lines.clear()

        def ready(least: int) -> Iterator[pa.RecordBatch]:
            if len(out) > least:
                yield _batch(out)
                out.clear()

        inside, crlf = shared.value
        for batch in batches:
            for file, block, values in _runs(batch):
                if here != (file, block):
                    close()
                    here, within = (file, block), (file, block) in inside
                    headed = within
                if file in crlf:
                    values = pc.replace_substring_regex(values, r"\r\z", "")
                if not within and not pc.any(pc.match_substring(values, dialect.quote)).as_py():
                    for line in values.to_pylist():
                        put(_WHOLE, line)
                    yield from ready(_ROWS)
                    continue
                for line in values.to_pylist():
                    was, within = within, dialect.inside_after(line, within) if dialect.quote in line or within else False
                    if not was and not within:
                        put(_WHOLE, line)
                        continue
                    open_lines.append(line)
                    if not within:
                        put(_HEAD if headed else _WHOLE, "\n".join(open_lines))
                        open_lines.clear()
                        headed = False
                yield from ready(_ROWS)
        close()
        yield from ready(0)

    return lines.mapInArrow(run, "file string, block long, kind int, first boolean, record string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], ["file", "block", "kind", "first", "record"])


def csv_records(spark: SparkSession, path: str, dialect: Dialect) -> DataFrame | None:
    """`first, record`: the text of every record, without the newline that ends it, in no order.

    `first` marks a file's first record. Empty lines are no records. Null if the
    lines of a file end in a carriage return alone, where Spark does not split.
    """
    lines = _lines(spark, path)
    starts = split_starts(split_states(lines, dialect)).where("start OR ending <> 'LF'").collect()
    if any(r.ending == "CR" for r in starts):
        return None
    pieces = _pieces(lines, dialect, {(r.file, r.block) for r in starts if r.start}, {r.file for r in starts if r.ending == "CRLF"})
    order = Window.partitionBy("file").orderBy("block", "kind")
    crossing = pieces.where(F.col("kind") != _WHOLE).withColumn("of", F.sum((F.col("kind") == _TAIL).cast("int")).over(order))
    parts = F.sort_array(F.collect_list(F.struct("block", "kind", "record")))
    joined = crossing.groupBy("file", "of").agg(
        F.max("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["record"]), "\n").alias("record"))
    records = pieces.where(F.col("kind") == _WHOLE).select("first", "record").unionAll(joined.select("first", "record"))
    marked = F.when(F.col("first"), F.ltrim(F.col("record"), F.lit("\ufeff"))).otherwise(F.col("record"))
    return records.select("first", marked.alias("record")).where("record <> ''")


def read_csv_split(spark: SparkSession, path: str, header: bool, dialect: Dialect, names: Sequence[str],
                   options: Mapping[str, str]) -> DataFrame | None:
    """All-string CSV columns, as Spark's reader gives them for files with newlines in cells; null as in `csv_records`."""
    records = csv_records(spark, path, dialect)
    if records is None:
        return None
    if header:
        records = records.where(~F.col("first"))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    own = ("header", "multiline", "inferschema", "encoding", "charset", "delimiter", "sep", "quote", "escape")
    given = {k: str(v) for k, v in options.items() if k.lower() not in own}
    cells = F.from_csv("record", schema, {"sep": dialect.sep, "quote": dialect.quote, "escape": dialect.escape, **given})
    return records.select(cells.alias("cells")).select(*[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)])
