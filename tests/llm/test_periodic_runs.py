"""Periodic runs against plain comparison of words a period apart."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from snapdiff.llm import QUERIES, periodic_runs
from snapdiff.llm.common import documents
from snapdiff.llm.periodic_runs import collapse, runs_in
from snapdiff.llm.wavelet import WaveletTree


def plain_runs(w, least=12):
    """`start, end, period` of every run, by comparing the sequence with itself at every distance."""
    w, out = np.array(w), {}
    for q in range(1, len(w) // 2 + 1):
        same = np.r_[False, w[q:] == w[:-q], False]
        for a, b in zip(np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])):
            if b - a + q >= max(least, 2 * q):
                out.setdefault((int(a), int(b + q)), q)
    return sorted((a, b, q) for (a, b), q in out.items())


def got_runs(*texts):
    ids = np.array([x for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    runs, of = runs_in(ids, row)
    begin = np.cumsum([0, *map(len, texts)])
    return [sorted((a - begin[k], b - begin[k], q) for (a, b, q), r in zip(runs.tolist(), of.tolist()) if r == k) for k in range(len(texts))]


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


REPEATED = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 6)), max_size=6).map(
    lambda parts: [x for words, n in parts for x in words * n])


@settings(max_examples=300, deadline=None)
@given(st.lists(REPEATED, min_size=1, max_size=4))
def test_runs_of_repeated_parts(texts):
    assert got_runs(*texts) == [plain_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(REPEATED, min_size=1, max_size=2), st.integers(2, 4), st.integers(1, 60))
def test_runs_of_runs(parts, times, cut):
    texts = [(p * times)[:max(0, len(p) * times - cut)] for p in parts]
    assert got_runs(*texts) == [plain_runs(t) for t in texts]


@pytest.mark.parametrize("text", [
    [], [1], [1] * 11, [1] * 12, [1] * 1000, [1, 2] * 6, list(range(6)) * 2, list(range(300)) * 2, list(range(300)) * 2 + [7], fibonacci(700),
    [x for n in range(40) for x in [0] * n + [1]], ([0] * 40 + [1]) * 3 + [0] * 41, ([0, 1] * 20 + [2]) * 5, list(range(500)),
    [bin(n).count("1") % 2 for n in range(512)], (list(range(37)) * 5)[3:-11] + [99] + list(range(23)) * 4,
])
def test_runs_of_known_shapes(text):
    for shift in range(3):
        assert got_runs(list(range(900, 900 + shift)) + text)[0] == plain_runs(list(range(900, 900 + shift)) + text)


def test_random_words_and_long_stretches():
    rng = np.random.default_rng(1)
    for size, letters in ((400, 2), (2000, 3), (3000, 30)):
        text = rng.integers(0, letters, size).tolist()
        loop = text[:50] + text[50:50 + size // 7] * 5 + text[:100]
        assert got_runs(text, loop, loop) == [plain_runs(text), plain_runs(loop), plain_runs(loop)]


def test_a_run_does_not_cross_texts():
    assert got_runs([1] * 8, [1] * 8, [1] * 12, [], [1, 1]) == [[], [], [(0, 12, 1)], [], []]


def test_a_very_long_text():
    """Half a million words, a period of 60,000 and one of three."""
    rng = np.random.default_rng(2)
    base = rng.integers(10, 1 << 40, 60_000).tolist()
    text = base * 4 + base[:17] + [1, 2, 3] * 90_000
    assert got_runs(text)[0] == [(0, 240_017, 60_000), (240_017, 510_017, 3)]


def test_chunks_of_stretches(monkeypatch):
    texts = [[n, n + 1, n + 2] * 5 + [50] for n in range(20)]
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", 40)
    assert got_runs(*texts) == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=60), st.data())
def test_wavelet_tree(values, data):
    tree, v = WaveletTree(np.array(values)), values
    l = data.draw(st.integers(0, len(v) - 1))
    r = data.draw(st.integers(l + 1, len(v)))
    for bound in (0, 1, 20, 40, 41, 64, 1000):
        assert tree.below(np.array([l]), np.array([r]), np.array([bound]))[0] == sum(x < bound for x in v[l:r])
    assert tree.smallest(np.full(r - l, l), np.full(r - l, r), np.arange(r - l)).tolist() == sorted(v[l:r])


def test_collapse():
    runs = np.array([(0, 12, 2), (10, 26, 4)])
    assert collapse(" ".join(map(str, range(28))), runs).split() == ["0", "1", "12", "13", "26", "27"]
    assert collapse(None, runs[:0]) == "" and collapse(" \ta\x0bb\n", runs[:0]) == "a b"


def plain_row(doc_id, text):
    """The contract of the query, word by word."""
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    names = {}
    runs = plain_runs([names.setdefault(x, len(names)) for x in w])
    gone = {i for a, b, q in runs for i in range(a + q, b)}
    best = min(((a - b, a, q) for a, b, q in runs), default=None)
    shown = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    digests = ("".join(f"{a},{b - a},{q}\n" for a, b, q in sorted(runs, key=lambda r: (r[0], r[2]))),
               " ".join(x for i, x in enumerate(w) if i not in gone))
    return (doc_id, len(runs), *shown, *(hashlib.sha256(d.encode()).hexdigest() for d in digests))


def test_the_query_on_a_table(spark, sf_small):
    rows = [(r.doc_id, r.text) for r in documents(spark, sf_small).select("doc_id", "text").collect()]
    got = QUERIES["op13_periodic_runs"][0](spark, sf_small)
    want = [plain_row(*r) for r in rows]
    assert sum(r[1] > 0 for r in want) > 10
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_odd_documents(spark, tmp_path):
    texts = [None, "", " \t\n\x0b\f\r", "w " * 11, "w " * 12, "W w " * 9, "a b " * 4 + "\n" + "a\xa0b " * 12, "é 😀 " * 8, "x y z " * 40_000]
    rows = [(i, t, "old", 3, "r") for i, t in enumerate(texts)] + [(None, "q r " * 8, None, None, None)] * 2 + [(4, "w " * 12, "old", 3, "r")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, collapsed string, n_words int, row string")
    out = periodic_runs.periodic_runs(frame.repartition(3))
    assert out.columns == ["doc_id", "text", "row", "runs", "n_words", "collapsed"]
    for r in out.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", r.text or "")
        runs = plain_runs([hash(x) for x in w]) if len(w) < 1000 else [(0, len(w), 3)]
        assert [(x.start, x.start + x.length, x.period) for x in r.runs] == runs and r.n_words == len(w)
        assert r.collapsed == " ".join(x for i, x in enumerate(w) if not any(a + q <= i < b for a, b, q in runs))
    assert periodic_runs.periodic_runs(frame.limit(0)).count() == 0
    frame.drop("collapsed", "n_words").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_periodic_runs"][0](spark, str(tmp_path)).where("doc_id IS NULL OR doc_id < 8").collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(repr(plain_row(i, t)) for i, t, *_ in rows if i is None or i < 8)
