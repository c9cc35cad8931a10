"""Words of many texts at once, as numpy arrays: bounds, rolling hashes, shingles, repeats.

A word is ``[^\\x20\\x09-\\x0D]+``. Those separators are single bytes in UTF-8, so words are found on the bytes.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_U = np.uint64
_STEP = _U(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd, so that it has an inverse modulo 2**64

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    x = x + _STEP
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_BYTE_VALUE = mix(np.arange(256, dtype=_U))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        x = np.full(n, base, _U)
        x[0] = 1
        return np.multiply.accumulate(x)

    return run(_BASE), run(pow(_BASE, -1, 1 << 64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, ``n`` at least."""
    return _powers(1 << max(16, (n - 1).bit_length()))


@dataclass
class Texts:
    """Texts laid end to end. A null text is an empty one."""

    bytes: np.ndarray
    bounds: np.ndarray  # text i has the bytes bounds[i]:bounds[i + 1]

    @classmethod
    def of(cls, column: pa.Array, lower: bool = False) -> Texts:
        column = pc.fill_null(column, "").cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[bounds[0] : bounds[-1]] if data and len(bounds) else np.zeros(0, np.uint8)
        return cls(LOWER[raw] if lower else raw, bounds - bounds[0])

    @functools.cached_property
    def separator(self) -> np.ndarray:
        return SEPARATOR[self.bytes]

    @functools.cached_property
    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where words begin and end, and the number of the first word of each text (one more: of all)."""
        gap, n = self.separator, len(self.bytes)
        if not n:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(self.bounds), np.int64)
        opens, closes = np.empty(n, bool), np.empty(n, bool)
        opens[1:], closes[:-1] = gap[:-1], gap[1:]
        opens[0] = closes[-1] = True
        inner = self.bounds[(self.bounds > 0) & (self.bounds < n)]
        opens[inner] = True
        closes[inner - 1] = True
        begin, end = np.flatnonzero(~gap & opens), np.flatnonzero(~gap & closes) + 1
        return begin, end, np.searchsorted(begin, self.bounds)

    @functools.cached_property
    def _sums(self) -> np.ndarray:
        out = np.zeros(len(self.bytes) + 1, _U)
        np.cumsum(_BYTE_VALUE[self.bytes] * powers(len(self.bytes))[0][: len(self.bytes)], out=out[1:])
        return out

    def hashes(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range, whatever its place."""
        back = powers(len(self.bytes) + 1)[1]
        return mix((self._sums[end] - self._sums[begin]) * back[begin] + (end - begin).astype(_U))

    @functools.cached_property
    def word_hashes(self) -> np.ndarray:
        begin, end, _ = self.words
        return self.hashes(begin, end)

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """How many flagged bytes each text has, or the sum of byte-wise numbers."""
        total = np.zeros(len(self.bytes) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return np.diff(total[self.bounds])


def windows(hashes: np.ndarray, firsts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For windows of ``n`` words that lie within one text: number of the first word, and the window's hash."""
    if len(hashes) < n:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    step, rolled = powers(n)[0], np.zeros(len(hashes) - n + 1, _U)
    for j in range(n):
        rolled += hashes[j : len(hashes) - n + 1 + j] * step[j]
    left = np.repeat(firsts[1:], np.diff(firsts)) - np.arange(len(hashes))
    at = np.flatnonzero(left >= n)
    return at, mix(rolled[at] + _U(n))


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` occur twice or more."""
    order = np.argsort(keys)
    same = np.diff(keys[order]) == 0
    out, found = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    found[1:] |= same
    found[:-1] |= same
    out[order] = found
    return out


def sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values`` that begin at ``firsts``; the last entry of ``firsts`` is the end."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[firsts])


def packed(texts: Texts, kept: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The words, or those with a flag, each followed by one space; and where each of them begins, and the end."""
    begin, end, _ = texts.words
    size = end - begin if kept is None else (end - begin)[kept]
    inner = ~texts.separator
    if kept is not None:
        inner[inner] = np.repeat(kept, end - begin)
    starts = np.append(0, np.cumsum(size + 1))
    out = np.full(int(starts[-1]), 0x20, np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = texts.bytes[inner]
    return out, starts


def joined(texts: Texts, kept: np.ndarray) -> pa.Array:
    """The flagged words of each text, joined by one space."""
    raw, starts = packed(texts, kept)
    left = np.append(0, np.cumsum(kept))[texts.words[2]]
    bounds = starts[left]
    some = np.diff(left) > 0  # their last space goes: it is cut off by an entry of its own
    edges = np.append(np.stack([bounds[:-1], bounds[1:] - some], axis=1).ravel(), bounds[-1:])
    pieces = pa.LargeStringArray.from_buffers(len(edges) - 1, pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(raw))
    return pieces.take(pa.array(np.arange(0, len(edges) - 1, 2))).cast(pa.string())


def word_numbers(texts: Texts) -> np.ndarray:
    """A number for each word, equal for equal words and for no others."""
    raw, starts = packed(texts)
    if len(starts) == 1:
        return np.zeros(0, np.int64)
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts), pa.py_buffer(raw)])
    return words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
