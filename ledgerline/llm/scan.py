"""Whole texts as numpy arrays: words, lines and their 64-bit hashes, without a Python step per word.

A hash of bytes ``[s, e)`` is ``(sum of T[byte] * BASE**i)``, taken relative to ``s``: prefix sums make the hash of
any stretch two look-ups and a multiplication, all modulo 2**64. ``mixed`` spreads its bits.
"""

from __future__ import annotations

import numpy as np

#: The bytes that part words.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
#: Bytes handled at a time, so that what is held beside a text is bounded.
BLOCK = 1 << 19

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every other."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (2**64 - 1), dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


_POW: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    held = _POW.get(base)
    if held is None or len(held) < n:
        held = _POW[base] = powers(base, max(n, 1 << 16))
    return held[:n]


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums for ``stretch``; one longer than ``data`` (bytes)."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=out[1:], dtype=np.uint64)
    return out


def stretch(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the stretches ``[start, end)``: equal for equal bytes, wherever they lie."""
    raw = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(sums))[starts]
    return mixed(raw + (ends - starts).astype(np.uint64))


def _blocks(data: np.ndarray, space: np.ndarray, most: int):
    """(start, end) of consecutive blocks of about ``most`` bytes that end after a space or with the data."""
    start = 0
    while start < len(data):
        end = min(start + most, len(data))
        while end < len(data) and not space[end - 1]:
            later = np.flatnonzero(space[end : end + most])
            end = end + later[0] + 1 if len(later) else min(end + most, len(data))
        yield start, end
        start = end


def words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words of ``data`` (bytes of one or more texts, parted by any space)."""
    return _runs(data, _IS_SPACE[data])


def lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of the lines that are not empty."""
    return _runs(data, data == 10)


def _runs(data: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, hashes = [], [], []
    for a, b in _blocks(data, space, BLOCK):
        part = np.ones(b - a + 2, dtype=bool)
        part[1:-1] = space[a:b]
        edge = np.flatnonzero(part[1:] != part[:-1])
        s, e = edge[0::2], edge[1::2]
        starts.append(s + a)
        ends.append(e + a)
        hashes.append(stretch(prefix(data[a:b]), s, e))
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.uint64)
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts one after the other, each followed by a line end, and where each starts (one more at the end)."""
    starts = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=starts[1:])
    return np.frombuffer(b"\n".join(texts) + b"\n" if texts else b"", dtype=np.uint8), starts


def encoded(texts) -> list[bytes]:
    """UTF-8 of each text; null is empty, and a lone surrogate, which UTF-8 has no place for, a question mark."""
    return [t.encode("utf-8", "replace") if isinstance(t, str) else b"" for t in texts]


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` neighbours; none where there are fewer."""
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(len(hashes) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = out * np.uint64(_BASE) + hashes[i : len(hashes) - n + 1 + i]
    return mixed(out)
