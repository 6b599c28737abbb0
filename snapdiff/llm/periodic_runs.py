"""Periodic runs of words: internal pattern matching of dyadic blocks in neighbouring windows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import words
from .wavelet import WaveletTree

LEAST = 12           # words of the shortest run, fixed by the contract
CHUNK_WORDS = 1 << 19  # words searched together; a longer stretch is searched alone
_GRAM = LEAST // 2   # words that any run has twice, a period apart


class Factors:
    """Names of all factors whose lengths are powers of two, and the suffix array they give.

    Two places hold one factor of 2^k words if their k-th names are equal; a name is
    the place in the suffix array where the factor's occurrences begin.
    """

    def __init__(self, ids: np.ndarray, levels: int) -> None:
        self.n = len(ids)
        self.names: list[np.ndarray] = []
        order = np.argsort(ids, kind="stable")
        key = ids
        for level in range(levels):
            ordered = key[order]
            starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            name = np.empty(self.n, np.int64)
            name[order] = np.repeat(starts, np.diff(np.r_[starts, self.n]))
            self.names.append(name.astype(np.int32))
            if level + 1 < levels:
                size = 1 << level
                after = np.r_[name[size:] + 1, np.zeros(min(size, self.n), np.int64)]  # 0: past the end
                key = name * (self.n + 2) + after
                order = np.argsort(key, kind="stable")
        self.suffixes = order

    def ends(self, level: int) -> np.ndarray:
        """Per place in the suffix array that begins a name: where its occurrences end."""
        starts = np.unique(self.names[level])
        ends = np.zeros(self.n, np.int64)
        ends[starts] = np.r_[starts[1:], self.n]
        return ends

    def alike_after(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree from i and j on, i < j."""
        found = np.zeros(len(i), np.int64)
        top = len(self.names) - 1
        active = np.arange(len(i))
        while active.size:  # whole factors of the largest size first; longer agreements take more of them
            a, b = i[active] + found[active], j[active] + found[active]
            fits = b + (1 << top) <= self.n
            fits[fits] = self.names[top][a[fits]] == self.names[top][b[fits]]
            active = active[fits]
            found[active] += 1 << top
        for level in range(top - 1, -1, -1):
            a, b, size = i + found, j + found, 1 << level
            fits = b + size <= self.n
            fits[fits] = self.names[level][a[fits]] == self.names[level][b[fits]]
            found[fits] += size
        return found

    def alike_before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Words that agree right before i and j, i < j."""
        found = np.zeros(len(i), np.int64)
        top = len(self.names) - 1
        active = np.arange(len(i))
        while active.size:
            a, b = i[active] - found[active] - (1 << top), j[active] - found[active] - (1 << top)
            fits = a >= 0
            fits[fits] = self.names[top][a[fits]] == self.names[top][b[fits]]
            active = active[fits]
            found[active] += 1 << top
        for level in range(top - 1, -1, -1):
            size = 1 << level
            a, b = i - found - size, j - found - size
            fits = a >= 0
            fits[fits] = self.names[level][a[fits]] == self.names[level][b[fits]]
            found[fits] += size
        return found


def _levels(longest: int) -> int:
    """Levels of factors that periods up to half of the longest stretch need."""
    level = 1
    while 4 * (1 << level) - 2 < longest // 2:
        level += 1
    return level + 1


def _windows(level: int) -> list[tuple[int, int]]:
    """Distances at which a block of 2^level words is looked for: periods, in windows of one block.

    A run of period q and max(12, 2q) words or more holds an aligned block of b
    words and that block q words later if 2b - 1 <= max(q, 12 - q). So blocks of two
    words serve the periods up to 6, and blocks of b words those from 2b - 1 to 4b - 2.
    """
    b = 1 << level
    first = 1 if level == 1 else 2 * b - 1
    return [(at, min(at + b, 4 * b - 1)) for at in range(first, 4 * b - 1, b)]


def runs_of(ids: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """All runs in a sequence of word ids: rows `start, end, period`, in no order.

    `longest` bounds the length of a run. For every dyadic block the occurrences in
    a window after it come from range successors in its interval of the suffix
    array. In a window of one block they are a progression, which three queries
    give. The distances are candidate periods; each is extended to both sides.
    """
    if len(ids) < least:
        return np.empty((0, 3), np.int64)
    factors = Factors(ids, _levels(longest))
    tree = WaveletTree(factors.suffixes)
    found = [np.empty((0, 3), np.int64)]
    for level in range(1, len(factors.names)):
        b = 1 << level
        blocks = np.arange(0, len(ids) - b, b)
        left = factors.names[level][blocks].astype(np.int64)
        right = factors.ends(level)[left]
        again = right - left > 1
        blocks, left, right = blocks[again], left[again], right[again]
        for low, high in _windows(level):
            before = tree.below(left, right, blocks + low)
            upto = tree.below(left, right, np.minimum(blocks + high, len(ids)))
            some = np.flatnonzero(upto > before)
            if not some.size:
                continue
            block, n = blocks[some], (upto - before)[some]
            first = tree.smallest(left[some], right[some], before[some])
            step = np.zeros(len(some), np.int64)
            several = np.flatnonzero(n > 1)
            second = tree.smallest(left[some][several], right[some][several], before[some][several] + 1)
            step[several] = second - first[several]
            found.append(_candidates(factors, block, b, first, step, n, least))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.r_[True, np.any(runs[1:, :2] != runs[:-1, :2], axis=1)][:len(runs)]
    return runs[new]  # of one stretch the smallest period; larger ones are its multiples


def _candidates(factors: Factors, block: np.ndarray, b: int, first: np.ndarray, step: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """The runs that blocks of b words and their progressions of occurrences lie in.

    A progression of three or more has the block's own period as step. Occurrences
    in the block's own run of that period only repeat this period, so they are left out.
    """
    own = np.flatnonzero(n > 2)
    until = np.full(len(block), -1)
    until[own] = block[own] + step[own] + factors.alike_after(block[own], block[own] + step[own])
    found = [_extended(factors, block[own], step[own], least)]
    at = np.repeat(np.arange(len(block)), n)
    place = first[at] + step[at] * (np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n))
    elsewhere = place + b > until[at]
    return np.concatenate([*found, _extended(factors, block[at[elsewhere]], place[elsewhere] - block[at[elsewhere]], least)])


def _extended(factors: Factors, i: np.ndarray, period: np.ndarray, least: int) -> np.ndarray:
    """The longest stretches around i that have a period, if they are long enough to be runs."""
    start = i - factors.alike_before(i, i + period)
    end = i + period + factors.alike_after(i, i + period)
    long = end - start >= np.maximum(least, 2 * period)
    return np.stack([start[long], end[long], period[long]], axis=1)


def _grams(ids: np.ndarray, row: np.ndarray) -> np.ndarray:
    """A mixed hash of the words from each place on, `_GRAM` of them; places too near a text's end get their own."""
    total = np.zeros(len(ids), np.uint64)
    for k in range(_GRAM):
        total[:len(ids) - k] += (ids[k:] ^ (ids[k:] >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15 + 2 * (k << 40) + 2 * k)
    whole = np.zeros(len(ids), bool)
    whole[:len(ids) - _GRAM + 1] = row[:len(ids) - _GRAM + 1] == row[_GRAM - 1:]
    total ^= row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.where(whole, total, np.arange(len(ids), dtype=np.uint64))


def _stretches(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of texts outside which no run has a word.

    Every word of a run lies in six words of it that come again in it, a period
    later or earlier, so a run lies in one stretch of such words.
    """
    n = len(ids)
    if n < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    grams = _grams(ids, row)
    by = np.argsort(grams)
    same = grams[by][1:] == grams[by][:-1]
    twice = np.zeros(n, bool)
    twice[by[1:][same]] = True
    twice[by[:-1][same]] = True
    covered = twice.copy()
    for k in range(1, _GRAM):
        covered[k:] |= twice[:n - k]
    new = np.r_[True, row[1:] != row[:-1]]
    starts = np.flatnonzero(covered & (new | ~np.r_[False, covered[:-1]]))
    ends = np.flatnonzero(covered & np.r_[new[1:] | ~covered[1:], True]) + 1
    long = ends - starts >= LEAST
    return starts[long], ends[long]


def _chunks(starts: np.ndarray, ends: np.ndarray) -> Iterator[slice]:
    """Stretches that are searched together."""
    at, sizes = 0, np.cumsum(ends - starts + 1)
    while at < len(starts):
        base = sizes[at] - (ends[at] - starts[at] + 1)
        to = max(at + 1, int(np.searchsorted(sizes, base + CHUNK_WORDS, "right")))
        yield slice(at, to)
        at = to


def runs_in(ids: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of all texts: rows `start, end, period` by places in `ids`, sorted, and each run's text.

    `ids` holds the words' hashes, text by text, and `row` the text of each.
    """
    starts, ends = _stretches(ids, row)
    found = [np.empty((0, 3), np.int64)]
    for part in _chunks(starts, ends):
        first, size = starts[part], ends[part] - starts[part]
        begin = np.cumsum(size + 1) - size - 1  # each stretch is followed by a word of its own
        place = np.arange(begin[-1] + size[-1] + 1) + np.repeat(first - begin, size + 1)
        _, names = np.unique(ids[np.minimum(place, len(ids) - 1)], return_inverse=True)
        names = names.astype(np.int64)
        names[begin + size] = len(place) + np.arange(len(begin))
        runs = runs_of(names, int(size.max()))
        shift = place[runs[:, 0]] - runs[:, 0]
        found.append(runs + np.stack([shift, shift, np.zeros_like(shift)], axis=1))
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs, row[runs[:, 0]]


def dropped(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of n words lie in a run behind its first period."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 1], -1)
    return np.cumsum(edges)[:n] > 0


def collapse(text: str | None, runs: np.ndarray) -> str:
    """The text's words, one space between them, without those that repeat a run's first period."""
    split = (text or "").encode().split()  # bytes: ASCII white space only
    if len(runs):
        split = [w for w, gone in zip(split, dropped(len(split), runs).tolist()) if not gone]
    return b" ".join(split).decode()


def periodic_runs(docs: DataFrame) -> DataFrame:
    """`docs` with `runs` (an array of `start, length, period`), `n_words` and `collapsed`.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0. A run is a stretch with smallest
    period q, of at least max(12, 2q) words, that no neighbouring word extends; runs
    come by start, then period. `collapsed` holds the words, joined by one space, that
    no run has behind its first q words. Words are compared by 64-bit hashes. Null, empty
    and blank texts have no words and no runs. Every row is worked on by itself, whatever
    its length, so repeated rows and rows without an id give a result each.
    Existing columns of the three names are replaced.
    """
    added = ("runs", "n_words", "collapsed")
    own = [c for c in docs.columns if c.lower() not in added]
    source = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    schema = T.StructType([*source.schema, *T.StructType.fromDDL(
        "runs array<struct<start:long,length:long,period:long>>, n_words long, collapsed string")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["row"].field("text").cast(pa.string())
            sizes, held = np.zeros(len(texts), np.int64), [[] for _ in range(len(texts))]
            for found in words(texts, cased=True):
                heads = np.flatnonzero(np.r_[True, found.row[1:] != found.row[:-1]][:len(found.row)])
                sizes[found.row[heads]] = np.diff(np.r_[heads, len(found.row)])
                begin = np.zeros(len(texts), np.int64)
                begin[found.row[heads]] = heads
                for (start, end, period), of in zip(*map(np.ndarray.tolist, runs_in(found.hash, found.row))):
                    held[of].append((start - begin[of], end - begin[of], period))
            collapsed = [collapse(t, np.array(h, np.int64).reshape(-1, 3)) for t, h in zip(texts.to_pylist(), held)]
            listed = [[{"start": int(a), "length": int(b - a), "period": q} for a, b, q in h] for h in held]
            yield pa.RecordBatch.from_arrays(
                [batch["row"], pa.array(listed, _RUNS), pa.array(sizes), pa.array(collapsed, pa.string())], ["row", *added])

    found = source.mapInArrow(run, schema)
    return found.select(*[F.col(f"row.`{c}`").alias(c) for c in own], *added)


_RUNS = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
