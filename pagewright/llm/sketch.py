"""Rolling hashes over code points and fixed-size bitmaps of hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser (SplitMix64) over uint64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_TABLES: dict[int, np.ndarray] = {}


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    known = _TABLES.get(int(base))
    if known is None or len(known) < n:
        step = np.full(max(n, 2 * len(known) if known is not None else 1024), base, np.uint64)
        step[0] = 1
        _TABLES[int(base)] = known = np.cumprod(step, dtype=np.uint64)
    return known[:n]


class Spans:
    """Hashes of any spans of a code point array, from one running sum: equal spans have equal hashes wherever they stand."""

    def __init__(self, codes: np.ndarray) -> None:
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * powers(len(codes)), dtype=np.uint64, out=self.sums[1:])
        self.back = powers(len(codes) + 1, _INVERSE)

    def of(self, start: np.ndarray, end: np.ndarray, salt: int = 0) -> np.ndarray:
        """Hashes of codes[start:end]; spans of another length or salt have another hash."""
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64) * _M1 + np.uint64(salt) * _M2)


#: Bits of a filter for each hash, and the most that a filter has (2**27 bits, 16 MB). Beyond about 8 million hashes a filter
#: lets more rows through to the exact join, whose result is the same.
PER_HASH, MOST_BITS = 16, 27


def size_of(n: int) -> int:
    """Bits (as a power of two) of a filter for n hashes."""
    return min(MOST_BITS, max(16, (n * PER_HASH).bit_length()))


def bitmap(hashes: DataFrame, column: str, bits: int) -> np.ndarray:
    """A filter of 2**bits bits with two bits for each hash, folded on the executors; the driver gets at most 2**(bits - 6) words."""
    mask = F.lit((1 << bits) - 1)
    low = F.explode(F.array(F.col(column).bitwiseAND(mask), F.shiftrightunsigned(F.col(column), 64 - bits)))
    at = hashes.select(low.alias("p"))
    words = at.select(F.shiftright("p", 6).alias("w"), F.expr("shiftleft(1L, cast(p & 63 as int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b"))
    out = np.zeros(1 << (bits - 6), np.int64)
    table = words.toArrow()
    out[table.column("w").to_numpy().astype(np.int64)] = table.column("b").to_numpy()
    return out.view(np.uint64)


def hits(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Positions whose hash may be in the filter."""
    one = lambda p: (words[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) != 0
    bits = (len(words) * 64).bit_length() - 1
    found = np.flatnonzero(one(hashes & np.uint64((1 << bits) - 1)))
    return found[one(hashes[found] >> np.uint64(64 - bits))]
