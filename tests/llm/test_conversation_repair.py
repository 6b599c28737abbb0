"""Conversation repair against all edits, against SQL, and on conversations too long to be held."""

import hashlib
import itertools
import random
import re

import duckdb
import pytest
from hypothesis import given, settings, strategies as st

from snapdiff.llm import QUERIES, conversation_repair
from snapdiff.llm.conversation_repair import Decoder, repair, repaired_turns

GOAL = re.compile(r"(s?(ua)+)?\Z")


def decoded(rows):
    """`cost, edits, roles` by the decoder; a row is its role, whether it must go, and whether it is truncated."""
    edits, roles = [], []

    def emit(edit, times, role, text):
        edits.append(edit * times)
        if edit != "D":
            roles.append(role[:1])

    decoder = Decoder(emit)
    for role, gone, truncated in rows:
        decoder.must_go(1) if gone else decoder.row(role, "", truncated)
    return decoder.finish(), "".join(edits), "".join(roles)


def all_edits(rows):
    """The least (cost, edits) that gives a legal conversation, by trying everything."""
    def choices(role, gone, truncated):
        own = [(2, "D", "")]
        if not gone:
            own += [(5 * truncated, "K", role[:1] or "?"), *((1 + 5 * truncated, "R", x) for x in "ua")]
        return [(5 * n + c, "I" * n + e, "".join(put) + x) for c, e, x in own for n in range(3) for put in itertools.product("ua", repeat=n)]

    ends = [(5 * n, "I" * n, "".join(put)) for n in range(3) for put in itertools.product("ua", repeat=n)]
    best = None
    for way in itertools.product(*(choices(*r) for r in rows), ends):
        found = (sum(c for c, _, _ in way), "".join(e for _, e, _ in way))
        roles = "".join(x for _, _, x in way)
        if (best is None or found < best[:2]) and GOAL.match(roles):
            best = (*found, roles)
    return best


def table(rows):
    """The same by a full table of states, for long conversations."""
    best = {"": (0, "", "")}
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    def put(found, state, way):
        if state not in found or way[:2] < found[state][:2]:
            found[state] = way

    for role, gone, truncated in rows:
        found = {}
        for state, (cost, edits, roles) in best.items():
            put(found, state, (cost + 2, edits + "D", roles))
            for n in range(0 if gone else 3):
                more = 5 * truncated
                put(found, after[state], (cost + 1 + more, edits + "R", roles + after[state]))
                if (state, role[:1]) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    put(found, role[:1], (cost + more, edits + "K", roles + role[:1]))
                state, cost, edits, roles = after[state], cost + 5, edits + "I", roles + after[state]
        best = found
    ends = {"": "", "a": "", "u": "a", "s": "ua"}
    return min((c + 5 * len(ends[s]), e + "I" * len(ends[s]), r + ends[s]) for s, (c, e, r) in best.items())


ROW = st.tuples(st.sampled_from(["system", "user", "assistant", "tool", "", " ", "undefined"]), st.booleans(), st.booleans())


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_against_all_edits(rows):
    assert decoded(rows) == all_edits(rows) == table(rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(ROW, max_size=40))
def test_against_a_table(rows):
    assert decoded(rows) == table(rows)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(ROW, min_size=1, max_size=3), st.integers(1, 12)), max_size=5))
def test_repeated_parts(parts):
    """Ties that stay open for long."""
    rows = [r for part, n in parts for r in part * n]
    assert decoded(rows) == table(rows)


@pytest.mark.parametrize("kind", ["sound", "any", "truncated", "gone", "late"])
def test_memory_of_a_long_conversation(kind):
    """Unresolved rows and edits stay few in fifty thousand rows, and the result is that of the table."""
    rng = random.Random(kind)
    n = 50_000
    row = {
        "sound": lambda i: (("user", "assistant")[i % 2], False, False), "any": lambda i: (rng.choice(("system", "user", "assistant", "x")), rng.random() < .1, rng.random() < .2),
        "truncated": lambda i: (("user", "assistant")[i % 2], False, True),
        "gone": lambda i: ("user", i > 0, False), "late": lambda i: (("user", "assistant")[i // 7 % 2], i % 3 == 0, i % 5 == 0),
    }[kind]
    edits, most = [], 0
    decoder = Decoder(lambda edit, times, role, text: edits.append(edit * times))
    rows = [row(i) for i in range(n)]
    for i, (role, gone, truncated) in enumerate(rows):
        decoder.must_go(1) if gone else decoder.row(role, "", truncated)
        most, nodes = max(most, len(decoder.rows)), set()
        for _, _, node in decoder.best.values() if i % 16 == 0 else ():
            while node is not decoder.root and id(node) not in nodes:
                nodes.add(id(node))
                node = node.parent
        most = max(most, len(nodes))
    assert most < 512
    cost, text = decoder.finish(), "".join(edits)
    assert (cost, text) == _cost_of(rows, text)
    assert (decoded(rows[:900])) == table(rows[:900])


@pytest.mark.parametrize("role", ["system", "user", "assistant", "x"])
@pytest.mark.parametrize("n", [1500, 1501])
def test_what_the_last_row_decides(role, n):
    """Rows of one role stay open to the end: how many there are decides what becomes of the first."""
    rows = [(role, False, i % 200 == 199) for i in range(n)]
    assert decoded(rows) == table(rows)


def _cost_of(rows, edits):
    cost, at = 0, 0
    for e in edits:
        cost += {"K": 0, "R": 1, "D": 2, "I": 5}[e]
        if e != "I":
            cost += 5 * (e != "D" and rows[at][2])
            at += 1
    assert at == len(rows)
    return cost, edits


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hello there."), (1, 2, "user", "Hello there."), (1, 3, "assistant", "Hi!"), (1, 9, "assistant", "Hi!"),
    (2, 0, None, None), (2, None, "user", "Who is it?"), (2, None, "assistant", "I."), (2, 3, "user", "Who is it?"),
    (None, 0, "user", "One."), (None, 1, "assistant", "Two."), (3, 0, "user", " \t\n\x0b\f\r"), (4, None, None, None), (5, 0, "assistant", "no end"),
    (6, 0, "user", "é\U0001f600?\xa0"), (6, 1, "", "x."), (6, 2, "undefined", "a: b\nc."), (6, 5, "assistant", "y. \n"), (7, 0, "user", "same."), (7, 0, "user", "same."),
    (7, 1, "assistant", "b."), (7, 1, "assistant", "a."), *((8 + i, -4 + j, ("user", "assistant")[j % 2], f"text {j}.") for i in range(60) for j in range(5)),
    *((100, i, ("user", "assistant")[i % 2], "long " * 400 + f"{i % 40}.") for i in range(300)),
]
SCHEMA = "conv_id long, turn long, role string, text string, n long, copies string, later int"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 7, "x", 1) for r in ODD], SCHEMA).repartition(4)


def rows_of(frame):
    return sorted(map(repr, map(tuple, frame.collect())))


@pytest.mark.parametrize("source", ["sf0.001", "sf0.01", "odd", "empty"])
def test_same_rows_as_sql(spark, odd, tmp_path, sf, sf_small, source):
    folder = {"sf0.001": sf_small, "sf0.01": sf}.get(source, str(tmp_path))
    if folder == str(tmp_path):
        (odd if source == "odd" else odd.limit(0)).drop("copies").write.parquet(f"{folder}/conversations.parquet")
    run, sql = QUERIES["op12_conversation_repair"]
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet{'/*.parquet' if folder == str(tmp_path) else ''}'")
    want = con.sql(sql)
    got = run(spark, folder)
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.select(*want.columns)) == sorted(map(repr, want.fetchall()))


def test_repaired_turns(spark, odd):
    """The digests are those of the repaired rows, and the rows are legal."""
    turns, texts = {}, {}
    for r in repaired_turns(odd).collect():
        turns.setdefault(r.conv_id, []).append(r)
    for r in repair(odd).collect():
        own = sorted(turns.get(r.conv_id, []), key=lambda x: x["at"])
        assert [x["at"] for x in own] == list(range(len(own))) and GOAL.match("".join(x.role[:1] for x in own))
        assert "".join(x.edit for x in own) == r.audit.replace("D", "")
        assert hashlib.sha256("\n".join(f"{x.role}:{x.text}" for x in own).encode()).hexdigest() == r.repaired_sha256
        texts[r.conv_id] = [f"{x.role}:{x.text}" for x in own]
    assert texts[1] == ["system:Be kind.", "user:Hello there.", "assistant:Hi!"]
    assert texts[2] == ["user:I.", "assistant:Who is it?"] and texts[None] == ["user:One.", "assistant:Two."] and texts[3] == texts[4] == []
    assert repaired_turns(odd.limit(0)).count() == 0


def test_a_conversation_with_most_rows(spark):
    """One conversation, one text that is most of it, and many rows of one turn."""
    rows = [(1, i % 500, ("user", "assistant")[i % 2], "The same." if i % 3 else f"Row {i}.") for i in range(6000)] + [(i, 0, "user", "x.") for i in range(2, 300)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    one = repair(frame).where("conv_id = 1").first()
    ordered = sorted(r[1:] for r in rows if r[0] == 1)
    seen, judged = set(), []
    for _, role, text in ordered:
        judged.append((role, (role, text) in seen, False))
        seen.add((role, text))
    cost, edits, _ = table(judged)
    assert (one.cost, one.audit, one.duplicate, one.gaps) == (cost, edits, sum(j[1] for j in judged), 0)
    assert repair(frame).count() == 299


def test_batches(spark, odd, monkeypatch):
    want = rows_of(repaired_turns(odd)), rows_of(repair(odd))
    monkeypatch.setattr(conversation_repair, "_ROWS", 2)
    assert (rows_of(repaired_turns(odd)), rows_of(repair(odd))) == want
