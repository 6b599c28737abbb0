"""A minimal acyclic transducer over byte strings, laid out flat to be memory-mapped.

Equal suffixes share states. Each edge carries how many words sort before those it
leads to, so the sum along a word's path is the word's number, and the number
finds its output. One int64 file holds everything.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np


def build(words: dict[bytes, Sequence[int]]) -> np.ndarray:
    """The flat transducer that maps each non-empty word to its outputs."""
    ordered = sorted(words)
    register: dict[tuple, int] = {}
    edges: list[tuple[tuple[int, int], ...]] = []   # of each finished state: (byte, target)
    final: list[bool] = []
    path: list[list] = [[False, []]]                # unfinished states of the last word: [final, edges]

    def finish(depth: int) -> None:
        while len(path) > depth + 1:
            ends, out = path.pop()
            key = (ends, tuple(out))
            state = register.setdefault(key, len(edges))
            if state == len(edges):
                edges.append(key[1])
                final.append(ends)
            path[-1][1][-1] = (path[-1][1][-1][0], state)

    last = b""
    for word in ordered:
        shared = next((i for i, (a, b) in enumerate(zip(word, last)) if a != b), min(len(word), len(last)))
        finish(shared)
        for byte in word[shared:]:
            path[-1][1].append((byte, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    finish(0)
    edges.append(tuple(path[0][1]))
    final.append(False)
    count = [0] * len(edges)                         # words below each state; targets come first
    flat = []
    for state, out in enumerate(edges):
        before = int(final[state])
        for byte, target in out:
            flat.append((state << 8 | byte, target, before))
            before += count[target]
        count[state] = before
    keys, targets, weights = np.array(sorted(flat), np.int64).reshape(-1, 3).T
    outputs = [words[w] for w in ordered]
    cuts = np.cumsum([0, *map(len, outputs)])
    ids = np.array([i for o in outputs for i in o], np.int64)
    parts = [keys, targets, weights, np.array(final, np.int64), cuts, ids]
    return np.concatenate([np.array([len(p) for p in parts], np.int64), *parts]).astype("<i8")


class Transducer:
    """Looks words up in a flat transducer, all of a batch at once."""

    def __init__(self, flat: np.ndarray) -> None:
        cuts = 6 + np.cumsum([0, *flat[:6]])
        self.keys, self.targets, self.weights, self.final, self.cuts, self.ids = (
            flat[a:b] for a, b in zip(cuts, cuts[1:]))
        self.packed = self.ids.astype("<u4").tobytes()

    @classmethod
    def open(cls, path: str) -> Transducer:
        return cls(np.memmap(path, "<i8", "r"))

    def lookup(self, words: Sequence[bytes]) -> np.ndarray:
        """The number of each word, -1 for one that is not held."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        text, start = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        state = np.full(len(words), len(self.final) - 1, np.int64)
        number, live = np.zeros(len(words), np.int64), np.arange(len(words))
        at = 0
        while (live := live[size[live] > at]).size and len(self.keys):
            key = state[live] << 8 | text[start[live] + at]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            held = self.keys[edge] == key
            state[live[~held]] = -1
            live, edge = live[held], edge[held]
            state[live] = self.targets[edge]
            number[live] += self.weights[edge]
            at += 1
        ends = (state >= 0) & (size > 0) & (self.final[state] == 1)
        return np.where(ends, number, -1)

    def outputs(self, numbers: Iterable[int]) -> list[bytes]:
        """The outputs of word numbers, each packed as little-endian 32-bit ids."""
        cuts = self.cuts
        return [self.packed[4 * cuts[n]:4 * cuts[n + 1]] for n in numbers]
