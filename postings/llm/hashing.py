"""Vectorised hashes of byte stretches by running sums."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_U = np.uint64


def mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A fixed bijective scrambling of 64-bit values."""
    x = (x ^ _U(salt * 0x9E3779B97F4A7C15 & 2**64 - 1)) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(31))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(29))


BYTE = mix(np.arange(1, 257, dtype=np.uint64), 7)
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 2**64)


@lru_cache(maxsize=2)
def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    def powers(base: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = _U(base)
        return np.multiply.accumulate(out)

    return powers(_BASE), powers(_INVERSE)


class Stretches:
    """Hashes of stretches [start, end) of some bytes; equal stretches have equal hashes wherever they lie."""

    def __init__(self, data: np.ndarray, symbols: np.ndarray = BYTE):
        """``symbols``: the scrambled value of each symbol of ``data``, bytes by default."""
        up, self._down = _tables(1 << max(16, int(len(data) + 1).bit_length()))
        self._sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(symbols[data] * up[:len(data)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 1) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._down[start], salt)

    def every(self, size: int, salt: int = 1) -> np.ndarray:
        """Hashes of all stretches of one size."""
        return mix((self._sums[size:] - self._sums[:-size]) * self._down[:len(self._sums) - size], salt)
