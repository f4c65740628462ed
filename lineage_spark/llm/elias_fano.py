"""Elias-Fano coded monotone sequences as numpy arrays, with vectorised access and search."""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_ONE = U64(1)


def _mask(bits: int) -> np.uint64:
    return U64((1 << bits) - 1)


def _select_in_word(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """Position of the ``k``-th (from 0) set bit of each word."""
    words, k, at = words.copy(), k.astype(np.int64), np.zeros(len(words), np.int64)
    for half in (32, 16, 8, 4, 2, 1):
        below = np.bitwise_count(words & _mask(half)).astype(np.int64)
        up = k >= below
        k -= np.where(up, below, 0)
        at += np.where(up, half, 0)
        words = np.where(up, words >> U64(half), words)
    return at


class EliasFano:
    """A non-decreasing sequence of unsigned integers: low bits packed, high parts as a unary bit vector."""

    def __init__(self, low: np.ndarray, upper: np.ndarray, ones: np.ndarray, n: int, bits: int):
        self.low, self.upper, self.ones, self.n, self.bits = low, upper, ones, n, bits

    @staticmethod
    def build(values: np.ndarray) -> "EliasFano":
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros((n * bits + 63) // 64 + 2, U64)
        if bits:
            part = values & _mask(bits)
            at = np.arange(n, dtype=U64) * U64(bits)
            word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
            np.bitwise_or.at(low, word, part << shift)
            over = shift + U64(bits) > U64(64)
            np.bitwise_or.at(low, word[over] + 1, part[over] >> (U64(64) - shift[over]))
        high = (values >> U64(bits)).astype(np.int64) + np.arange(n)
        upper = np.zeros(((top >> bits) + n + 1 + 63) // 64 + 1, U64)
        np.bitwise_or.at(upper, high >> 6, _ONE << (high & 63).astype(U64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])
        return EliasFano(low, upper, ones, n, bits)

    def arrays(self) -> dict[str, np.ndarray]:
        return {"low": self.low, "upper": self.upper, "ones": self.ones}

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), U64)
        at = i.astype(U64) * U64(self.bits)
        word, shift = (at >> U64(6)).astype(np.int64), at & U64(63)
        first = self.low[word] >> shift
        rest = np.where(shift > 0, self.low[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return (first | rest) & _mask(self.bits)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The ``i``-th values."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        at = (word << 6) + _select_in_word(self.upper[word], i - self.ones[word])
        return ((at - i).astype(U64) << U64(self.bits)) | self._low(i)

    def _bucket_end(self, bucket: np.ndarray) -> np.ndarray:
        """Number of values whose high part is at most ``bucket`` (which must not exceed the last one)."""
        zeros = (np.arange(len(self.ones), dtype=np.int64) << 6) - self.ones
        word = np.searchsorted(zeros, bucket, side="right") - 1
        return (word << 6) + _select_in_word(~self.upper[word], bucket - zeros[word]) - bucket

    def find(self, values: np.ndarray) -> np.ndarray:
        """Index of each value in a strictly increasing sequence, or -1: the successor in the value's bucket."""
        out = np.full(len(values), -1, np.int64)
        if not self.n:
            return out
        last = int(self.get(np.array([self.n - 1]))[0])
        ok = np.flatnonzero(values <= U64(last))
        v = values[ok]
        bucket = (v >> U64(self.bits)).astype(np.int64)
        hi = self._bucket_end(bucket)
        lo = np.where(bucket > 0, self._bucket_end(np.maximum(bucket - 1, 0)), 0)
        end, target = hi.copy(), v & _mask(self.bits)
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            middle = (lo[live] + hi[live]) >> 1
            less = self._low(middle) < target[live]
            lo[live] = np.where(less, middle + 1, lo[live])
            hi[live] = np.where(less, hi[live], middle)
        inside = np.flatnonzero(lo < end)
        equal = inside[self._low(lo[inside]) == target[inside]]
        out[ok[equal]] = lo[equal]
        return out
