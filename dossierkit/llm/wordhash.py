"""Hashes of words and word windows of Arrow text columns, in numpy."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of text hashed at a time: numpy needs some fifty bytes for each.
GROUP_BYTES = 1 << 20

# Odd bases of polynomial hashes modulo 2**64, and the multiplier of the finishing step.
BYTE_BASE, WORD_BASE, WINDOW_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93
FINISH = np.uint64(0xBF58476D1CE4E5B9)
SECOND = np.uint64(0x94D049BB133111EB)


class _Kept(dict):
    """Tables that a process has made; they do not travel to tasks."""

    def __reduce__(self):
        return _Kept, ()


_KEPT = _Kept()


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. n - 1`` modulo 2**64."""
    if base not in _KEPT or len(_KEPT[base]) < n:
        out = np.full(1 << max(16, int(n).bit_length()), base, dtype=np.uint64)
        out[0] = 1
        out = np.cumprod(out, dtype=np.uint64)
        if len(out) > 4 * GROUP_BYTES:  # for one long text only
            return out[:n]
        _KEPT[base] = out
    return _KEPT[base][:n]


def inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def finished(x: np.ndarray) -> np.ndarray:
    """Every bit of the input changes every bit of the output."""
    x = x ^ (x >> np.uint64(32))
    x = x * FINISH
    x = x ^ (x >> np.uint64(29))
    x = x * SECOND
    return x ^ (x >> np.uint64(32))


def _byte_values() -> np.ndarray:
    return finished(np.arange(1, 257, dtype=np.uint64) * FINISH)


def ranges_sum(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for each pair: equal contents give equal hashes."""
    n = len(values)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(values * powers(base, n), out=total[1:])
    return (total[ends] - total[starts]) * powers(inverse(base), n + 1)[starts]


def is_separator() -> np.ndarray:
    """Of each byte: space and U+0009 to U+000D."""
    table = np.zeros(256, dtype=bool)
    table[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
    return table


def is_no_letter(digits: bool) -> np.ndarray:
    """Of each byte: ASCII other than letters, and than digits if those count as letters."""
    table = np.zeros(256, dtype=bool)
    table[:128] = True
    table[65:91] = table[97:123] = False
    table[48:58] = not digits
    return table


def lowered() -> np.ndarray:
    """Of each byte: A to Z in lower case."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


class Words:
    """Words of a run of texts: ``hashes``, and for text ``i`` those from ``first[i]`` to ``first[i + 1]``."""

    def __init__(
        self,
        data: np.ndarray,
        offsets: np.ndarray,
        lower: bool = False,
        between: np.ndarray | None = None,
        prefixes: tuple[int, ...] = (),
    ):
        self.n = len(offsets) - 1
        self.between = is_separator() if between is None else between
        self.lengths = prefixes
        found = [self._cut(data, offsets, lower)] if len(data) <= 2 * GROUP_BYTES else list(self._pieces(data, offsets, lower))
        none = np.zeros(0, np.uint64)
        self.hashes = np.concatenate([f[0] for f in found]) if found else none
        self.doc = np.concatenate([f[1] for f in found]) if found else none.astype(np.int64)
        # Hashes of the first bytes of words, 0 where a word is no longer than that.
        self.prefixes = {k: np.concatenate([f[2][i] for f in found]) if found else none for i, k in enumerate(prefixes)}
        self.first = np.searchsorted(self.doc, np.arange(self.n + 1))

    def _pieces(self, data, offsets, lower):
        """One long text, cut at separators."""
        separator = self.between
        start = 0
        while start < len(data):
            end = min(start + GROUP_BYTES, len(data))
            while end < len(data) and not separator[data[end]]:
                end += 1
            yield self._cut(data[start:end], np.clip(offsets - start, 0, end - start), lower)
            start = end

    def _cut(self, data, offsets, lower):
        n = len(data)
        if not n:
            none = np.zeros(0, np.uint64)
            return none, none.astype(np.int64), [none for _ in self.lengths]
        gap = self.between[data]
        begins = np.ones(n, dtype=bool)
        begins[1:] = gap[:-1]
        begins[offsets[:-1][offsets[:-1] < n]] = True
        ends = np.ones(n, dtype=bool)
        ends[:-1] = gap[1:]
        ends[offsets[1:][offsets[1:] > 0] - 1] = True
        starts = np.flatnonzero(begins & ~gap)
        stops = np.flatnonzero(ends & ~gap) + 1
        values = _byte_values()[lowered()[data] if lower else data]
        hashes = finished(ranges_sum(values, starts, stops, BYTE_BASE))
        short = []
        for length in self.lengths:
            longer = np.flatnonzero(stops - starts > length)
            part = np.zeros(len(starts), np.uint64)
            part[longer] = finished(ranges_sum(values, starts[longer], starts[longer] + length, BYTE_BASE) + np.uint64(length))
            short.append(part)
        return hashes, np.searchsorted(offsets, starts, side="right") - 1, short


def text_groups(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of a text column, about ``GROUP_BYTES`` at a time; null is empty."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    start = 0
    while start < len(column):
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + GROUP_BYTES, side="right")) - 1)
        end = min(end, len(column))
        low, high = offsets[start], offsets[end]
        yield start, end, data[low:high], offsets[start : end + 1] - low
        start = end


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of ``values[p : p + width]`` for every p where that fits."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out
