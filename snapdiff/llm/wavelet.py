"""A wavelet tree over whole numbers, level by level in numpy, for many queries at once."""

from __future__ import annotations

import numpy as np


class WaveletTree:
    """Counts and order statistics of ranges `values[l:r]`, in one step per bit of the values."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max(initial=0)).bit_length())
        self.zeros: list[np.ndarray] = []  # per level, from the highest bit: zero bits before each place
        values = values.astype(np.int64)
        for bit in range(self.bits - 1, -1, -1):
            one = (values >> bit & 1).astype(bool)
            self.zeros.append(np.r_[0, np.cumsum(~one)].astype(np.int32))
            values = np.r_[values[~one], values[one]]

    def below(self, l: np.ndarray, r: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many of `values[l:r]` are smaller than `bound`."""
        whole = bound >= 1 << self.bits
        n, l, r = np.where(whole, r - l, 0), l.copy(), r.copy()
        for level, zeros in enumerate(self.zeros):
            bit = bound >> (self.bits - 1 - level) & 1
            l0, r0 = zeros[l], zeros[r]
            n += np.where(bit.astype(bool) & ~whole, r0 - l0, 0)
            l = np.where(bit, zeros[-1] + l - l0, l0)
            r = np.where(bit, zeros[-1] + r - r0, r0)
        return n

    def smallest(self, l: np.ndarray, r: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest of `values[l:r]`, from 0; k must lie in the range."""
        value, l, r, k = np.zeros(len(l), np.int64), l.copy(), r.copy(), k.copy()
        for zeros in self.zeros:
            l0, r0 = zeros[l], zeros[r]
            one = k >= r0 - l0
            value = value << 1 | one
            k = np.where(one, k - (r0 - l0), k)
            l = np.where(one, zeros[-1] + l - l0, l0)
            r = np.where(one, zeros[-1] + r - r0, r0)
        return value
