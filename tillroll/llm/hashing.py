"""Vectorised hashing of UTF-8 texts with numpy.

``Rolling`` gives each string of a byte buffer a 64-bit name that depends on
its bytes only: with a table T of random odd numbers and a multiplier B, the
name of ``bytes[i:j]`` is ``sum T[bytes[x]] * B**(x - i)``, mixed. Running sums
give the name of any string in a few array operations. All arithmetic is
modulo 2**64.
"""

from __future__ import annotations

import functools

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit integers (the splitmix64 finaliser)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: Powers that are kept; longer tables are made from them for one buffer.
KEPT = 4096


@functools.lru_cache(maxsize=8)
def _powers(factor: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(KEPT - 1, factor, _U)]))


def powers(factor: int, n: int) -> np.ndarray:
    """factor ** 0, ..., factor ** (n - 1)."""
    low = _powers(factor)
    if n <= KEPT:
        return low[:n]
    step = pow(factor, KEPT, 1 << 64)
    high = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full((n - 1) // KEPT, step, _U)]))
    return (high[:, None] * low[None, :]).ravel()[:n]


class Rolling:
    """Names of strings of one buffer; the seed chooses the hash function."""

    def __init__(self, data: np.ndarray, seed: int = 1):
        base = mix(np.arange(seed * 1000, seed * 1000 + 257, dtype=_U)) | _U(1)
        factor, n = int(base[256]), len(data)
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(base[data] * powers(factor, n), out=self.sums[1:])
        self.down = powers(pow(factor, -1, 1 << 64), n + 1)

    def names(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, length: int) -> np.ndarray:
        """The names of all strings of this length, by their start."""
        m = len(self.sums) - length
        if m <= 0:
            return np.empty(0, _U)
        return mix((self.sums[length:] - self.sums[:m]) * self.down[:m])


def batches(sizes: list[int], limit: int):
    """Ranges of neighbouring texts of about ``limit`` bytes together."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)
