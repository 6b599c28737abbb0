"""Words of whole Arrow batches at once: their places and 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts worked on together; a longer text is a chunk of its own

# A word's hash is a sum over its bytes of a random number per byte times a power
# of an odd base, modulo 2^64: sums over ranges come from one running sum.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_UNDO = np.uint64(pow(0x94D049BB133111EB, -1, 1 << 64))
_OF_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_OF_CASED_BYTE = _OF_BYTE.copy()
_OF_BYTE[ord("A"):ord("Z") + 1] = _OF_BYTE[ord("a"):ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _BASE
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def unmix(x: np.ndarray) -> np.ndarray:
    """The value that `mix` made `x` of."""
    x = (x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))) * _UNDO
    x = (x ^ (x >> np.uint64(27)) ^ (x >> np.uint64(54))) * _INVERSE
    return x ^ (x >> np.uint64(31)) ^ (x >> np.uint64(62))


class Words(NamedTuple):
    """Every word of the texts of a chunk, in order."""

    row: np.ndarray    # its text's row in the batch
    line: np.ndarray   # its line in the text, from 0
    hash: np.ndarray   # equal for equal words, A-Z read as a-z unless cased


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first n powers; those of two usual chunks are kept."""
    if n <= 2 * CHUNK_BYTES:
        return _kept_powers(base)[:n]
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


@lru_cache(maxsize=2)
def _kept_powers(base: np.uint64) -> np.ndarray:
    out = np.full(2 * CHUNK_BYTES, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _which(starts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many of `starts` are at or before each of `places`; both ascend, and places are many."""
    cuts = np.searchsorted(places, starts)
    return np.repeat(np.arange(len(starts) + 1), np.diff(np.r_[0, cuts, len(places)]))


def words(texts: pa.StringArray, cased: bool = False) -> Iterator[Words]:
    """The words of a text column, chunk by chunk; a null text has none."""
    if texts.null_count:
        texts = texts.fill_null("")
    cuts = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, 4 * texts.offset).astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + CHUNK_BYTES, "right")) - 1)
        to = min(to, len(texts))
        part, starts = data[cuts[at]:cuts[to]], cuts[at:to + 1] - cuts[at]
        if len(part):
            yield _chunk(part, starts, at, _OF_CASED_BYTE if cased else _OF_BYTE)
        at = to


def _chunk(part: np.ndarray, starts: np.ndarray, at: int, of_byte: np.ndarray) -> Words:
    word = (part != 0x20) & (part - np.uint8(0x09) > 4)
    edge = np.zeros(len(part) + 1, bool)  # whether a word ends or begins before a byte, if it has one there
    edge[0] = edge[-1] = True
    np.not_equal(word[1:], word[:-1], out=edge[1:-1])
    edge[starts] = True
    first = np.flatnonzero(word & edge[:-1])
    last = np.flatnonzero(word & edge[1:]) + 1
    total = np.zeros(len(part) + 1, np.uint64)
    each = of_byte.take(part.astype(np.intp), mode="clip")
    np.cumsum(np.multiply(each, _powers(_BASE, len(part)), out=each), out=total[1:])
    found = mix((total[last] - total[first]) * _powers(_INVERSE, len(part))[first])
    breaks = np.flatnonzero(part == 0x0A)
    row = _which(starts[1:], first)
    return Words(at + row, _which(breaks, first) - np.searchsorted(breaks, starts)[row], found)


def counts(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and how often each occurs."""
    ordered = np.sort(hashes)
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, np.int64)
    return ordered[starts], np.diff(np.r_[starts, len(ordered)])
