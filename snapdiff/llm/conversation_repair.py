"""Conversation repair: cheapest edits by a Viterbi search that emits what all survivors agree on."""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small, staged

RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5  # costs of edits, and of keeping a truncated row; fixed by the contract
_ROWS = 2048  # repaired rows put out together

# What has been put out so far, by its last role initial: nothing, system, user, assistant.
# An insertion or a new role goes from the first to the second of each pair.
_NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
_ROLE = {"u": "user", "a": "assistant"}
# States reached by insertions before a row, and how many it takes.
_BRIDGES = {"": (("", 0), ("u", 1), ("a", 2)), "s": (("s", 0), ("u", 1), ("a", 2)), "u": (("u", 0), ("a", 1)), "a": (("a", 0), ("u", 1))}
_LEGAL = {"su", "ua", "au"}
_KEPT = {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}  # state and initial of a row that may stay


class _Node:
    """An edit of the backpointer tree; `refs` counts its children and the survivor that ends in it."""

    __slots__ = ("parent", "edit", "times", "refs")

    def __init__(self, parent: "_Node | None", edit: str, times: int = 1) -> None:
        self.parent, self.edit, self.times, self.refs = parent, edit, times, 0
        if parent is not None:
            parent.refs += 1


def _release(node: _Node | None) -> None:
    while node is not None:
        node.refs -= 1
        if node.refs:
            return
        node = node.parent


class Decoder:
    """The cheapest edits of one conversation, whose rows come in order.

    One survivor is kept per state. Survivors share a tree of edits; what no survivor
    needs is freed by its reference count, and once all survivors descend from one
    edit, it and the edits before it are put out and forgotten. So memory holds the
    edits and rows on which the survivors still differ, however long the conversation is.
    Only what later rows decide stays open, as in a conversation of users alone, whose
    first row stays or goes by the number of rows.
    Ties are decided by the whole unresolved suffixes. Survivors have read the same rows, so none
    is the beginning of another, and their order, once found, holds for all that follows: it is
    carried along as a rank.
    """

    def __init__(self, emit: Callable[[str, int, str, str], None]) -> None:
        """`emit(edit, times, role, text)` gets the edits in order; deleted rows have no role."""
        self.emit = emit
        self.root = _Node(None, "")
        self.best: dict[str, tuple[int, int, _Node]] = {"": (0, 0, self.root)}  # cost, rank, last edit
        self.root.refs = 1
        self.rows: deque[tuple[str, str]] = deque()  # rows read after the root, but for those that had to go
        self.last = ""

    def must_go(self, times: int) -> None:
        """Rows that every repair deletes."""
        if times:
            best = {}
            for state, (cost, rank, node) in self.best.items():
                if node.edit == "d" and node.refs == 1 and node is not self.root:
                    node.times += times
                else:
                    grown = _Node(node, "d", times)
                    grown.refs = 1
                    node.refs -= 1  # the survivor moves on to the new edit
                    node = grown
                best[state] = (cost + DELETE * times, rank, node)
            self.best = best
            self._settle()

    def row(self, role: str, text: str, truncated: bool) -> None:
        """A row that may stay, get another role or go."""
        initial, more = role[:1], TRUNCATED * truncated
        found: dict[str, tuple[int, int, str, _Node]] = {}

        def offer(state: str, *way) -> None:
            if state not in found or way[:3] < found[state][:3]:
                found[state] = way

        for state, (cost, rank, node) in self.best.items():
            offer(state, cost + DELETE, rank, "D", node)
            for at, inserted in _BRIDGES[state]:
                here, edits = cost + INSERT * inserted + more, "I" * inserted
                if (at, initial) in _KEPT:
                    offer(initial, here, rank, edits + "K", node)
                offer(_NEXT[at], here + RETYPE, rank, edits + "R", node)
        self.rows.append((role, text))
        before = [node for _, _, node in self.best.values()]
        self.best = {}
        found = {s: way for s, way in found.items() if not self._hopeless(s, way[0], found)}
        for rank, state in enumerate(sorted(found, key=lambda s: found[s][1:3])):
            cost, _, edits, node = found[state]
            for edit in edits:
                node = _Node(node, edit)
            node.refs = 1
            self.best[state] = (cost, rank, node)
        for node in before:
            _release(node)
        self._settle()

    @staticmethod
    def _hopeless(state: str, cost: int, found: dict[str, tuple[int, int, str, _Node]]) -> bool:
        """Whether another survivor can do all that this one can, for less even after edits that bring it there."""
        least = {s: f[0] for s, f in found.items()}
        none = 1 << 62
        empty, system, user, assistant = (least.get(s, none) for s in ("", "s", "u", "a"))
        if state == "":
            return cost > min(assistant + DELETE, user + INSERT + DELETE)
        if state == "u":
            return cost > min(empty, system, assistant) + INSERT
        return cost > min(empty, user + INSERT, assistant if state == "s" else none)

    def _settle(self) -> None:
        """Put out the edits that all survivors share."""
        if self.root.refs > 1:
            return
        node, path = next(iter(self.best.values()))[-1], []
        while node is not self.root:
            path.append(node)
            node = node.parent
        leaves = {id(n) for _, _, n in self.best.values()}
        for node in reversed(path):
            if self.root.refs > 1 or id(self.root) in leaves:
                return
            self._put(node)
            node.parent, self.root = None, node

    def _put(self, node: _Node) -> None:
        edit = node.edit
        if edit == "d":
            self.emit("D", node.times, "", "")
        elif edit == "D":
            self.rows.popleft()
            self.emit("D", 1, "", "")
        elif edit == "I":
            self.last = _NEXT[self.last]
            self.emit("I", 1, _ROLE[self.last], "")
        else:
            role, text = self.rows.popleft()
            self.last = role[:1] if edit == "K" else _NEXT[self.last]
            self.emit(edit, 1, role if edit == "K" else _ROLE[self.last], text)

    def finish(self) -> int:
        """Put out the rest, and give the cost of all edits."""
        ends = {"": "", "a": "", "u": "I", "s": "II"}
        cost, _, edits, node = min(((c + INSERT * len(ends[s]), rank, ends[s], n) for s, (c, rank, n) in self.best.items()), key=lambda way: way[:3])
        path = []
        for edit in edits:
            node = _Node(node, edit)
        while node is not self.root:
            path.append(node)
            node = node.parent
        for node in reversed(path):
            self._put(node)
        return cost


class _Conversation:
    """Counts and repair of one conversation."""

    def __init__(self, emit: Callable[[str, int, str, str], None]) -> None:
        self.decoder = Decoder(emit)
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.turn = self.before = None

    def add(self, turn: int | None, role: str, text: str, n: int, later: bool) -> None:
        """`n` equal rows; `later` if earlier turns have their role and text."""
        if turn is not None and turn != self.turn:
            self.first, self.turn, self.turns = turn if self.first is None else self.first, turn, self.turns + 1
        initial = role[:1]
        self.illegal += n - 1 + (self.before is not None and self.before + initial not in _LEGAL)
        self.before = initial
        bare = text.rstrip(_SPACE)
        if not bare:
            self.blank += n
            self.decoder.must_go(n)
            return
        stays = 0 if later else 1
        if stays:
            truncated = bare[-1] not in ".!?"
            self.truncated += truncated
            self.decoder.row(role, text, truncated)
        self.duplicate += n - stays
        self.decoder.must_go(n - stays)

    def counts(self) -> dict[str, int]:
        gaps = self.turn - self.first + 1 - self.turns if self.turns else 0
        return {"gaps": gaps, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
                "cost": self.decoder.finish()}


_SPACE = " \t\n\x0b\f\r"
_COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _in_order(conversations: DataFrame, copies: Column | None) -> DataFrame:
    """`conv_id, turn, role, text, n, later`: different rows in order, each conversation in one task.

    Equal rows are counted before they move. Whether a role and text came in an
    earlier turn is a grouped minimum, so no task remembers what it has seen.
    """
    n = F.lit(1) if copies is None else copies
    gone = n == 0
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.when(~gone, F.col("turn")).cast("long").alias("turn"),
        *[F.when(gone, "").otherwise(F.coalesce(F.col(c).cast("string"), F.lit(" "))).alias(c) for c in ("role", "text")], n.cast("long").alias("n"))
    rows = staged(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    named = rows.withColumn("key", F.unhex(F.md5("text")))
    several = named.where("n > 0").groupBy("conv_id", "role", "key").agg(
        F.count(F.lit(1)).alias("rows"), F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("unnumbered")).where("rows > 1")
    several = small(staged(several.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("key").alias("_key"), "first", "unnumbered"), "several"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("key") == F.col("_key"))
    later = F.when(F.col("unnumbered"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("first"))
    marked = named.join(several, same, "left").select("conv_id", "turn", "role", "text", "n", F.coalesce(later, F.lit(False)).alias("later"))
    return marked.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Each conversation's id and rows, as they come."""
    rows = chain.from_iterable(zip(*(batch[c].to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "later"))) for batch in batches)
    row = next(rows, None)
    while row is not None:
        conv = row[0]

        def own() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[0] == conv:
                if row[4]:
                    yield row[1:]
                row = next(rows, None)

        yield conv, own()


def repair(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """One row per conversation: `conv_id`, counts of its faults, the cost and letters of its edits, and a digest.

    Rows are taken by turn (null first), then role and text; nulls in role and text
    are one space. A row is blank, else a duplicate of an earlier row, else truncated, by its first
    fault. Blank rows and duplicates must go; the cheapest edits (ties: least letters)
    leave role initials `(s?(ua)+)?`. `gaps` counts turns missing between the smallest and
    the largest, `illegal` neighbouring rows that may not follow each other. `copies`
    says how often a row counts; a conversation whose rows all count zero times, and one
    without an id, have a row. The digest is SHA-256 of the repaired `role:text`, by lines.
    Other columns are ignored. A conversation is read in one task, because its digest
    is made in order, but no more of it is held than its survivors differ on.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: dict[str, list] = {c: [] for c in ("conv_id", *_COUNTS, "audit", "repaired_sha256")}
        for conv, rows in _conversations(batches):
            audit, digest, kept = [], hashlib.sha256(), 0

            def emit(edit: str, times: int, role: str, text: str) -> None:
                nonlocal kept
                audit.append(edit * times)
                if edit != "D":
                    digest.update(f"{chr(10) if kept else ''}{role}:{text}".encode())
                    kept += 1

            one = _Conversation(emit)
            for row in rows:
                one.add(*row)
            for c, value in {"conv_id": conv, **one.counts(), "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}.items():
                out[c].append(value)
            if len(out["conv_id"]) == _ROWS:
                yield pa.RecordBatch.from_pydict(out, _SUMMARY)
                out = {c: [] for c in out}
        yield pa.RecordBatch.from_pydict(out, _SUMMARY)

    counts = ", ".join(f"{c} long" for c in _COUNTS)
    return _in_order(conversations, copies).mapInArrow(run, f"conv_id long, {counts}, audit string, repaired_sha256 string")


def repaired_turns(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """The repaired rows: `conv_id, at` (from 0), `edit` (K, R or I), `role, text`. Rows are read as in `repair`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for conv, rows in _conversations(batches):
            at = 0

            def emit(edit: str, times: int, role: str, text: str) -> None:
                nonlocal at
                if edit != "D":
                    out.append((conv, at, edit, role, text))
                    at += 1

            one = _Conversation(emit)
            for row in rows:
                one.add(*row)
                if len(out) >= _ROWS:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TURNS.types)], schema=_TURNS)
                    out.clear()
            one.counts()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), _TURNS.types)], schema=_TURNS)

    return _in_order(conversations, copies).mapInArrow(run, "conv_id long, at long, edit string, role string, text string")


_SUMMARY = pa.schema([("conv_id", pa.int64()), *((c, pa.int64()) for c in _COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_TURNS = pa.schema([("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
