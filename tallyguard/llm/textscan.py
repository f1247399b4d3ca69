"""Words, lines and hashes of many texts at once, over the bytes of an Arrow text column.

A word is a maximal run of bytes that are not ASCII white space (space, TAB to CR). A hash of any
byte range comes from one running sum: sum(T[b_i] * P^i) over the range, shifted by P^-start, mixed
with the length. Ranges of equal bytes have equal hashes wherever they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
"""Bytes worked on at once; one longer text is a slice of its own."""

_P = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_LOWER, _INK = LOWER.tobytes(), (~SPACE).astype(np.uint8).tobytes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 4096)
        out = np.empty(size, np.uint64)
        out[0] = 1
        done, step = 1, base
        while done < size:
            take = min(done, size - done)
            out[done:done + take] = out[:take] * np.uint64(step)
            done, step = done + take, step * step & _MASK
        have = _powers[base] = out
    return have[:n]


@cache
def _inverse() -> int:
    return pow(_P, -1, 1 << 64)


def column_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows with at most ``limit`` bytes, or one row."""
    raw, at = column_bytes(texts)
    lo = 0
    while lo < len(at) - 1:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, "right")) - 1)
        yield lo, hi, raw[at[lo]:at[hi]], at[lo:hi + 1] - at[lo]
        lo = hi


def translated(raw: np.ndarray, table: bytes) -> np.ndarray:
    """What ``table`` has for every byte; read-only."""
    return np.frombuffer(raw.tobytes().translate(table), np.uint8)


def give_back() -> None:
    """Return the memory that this worker has freed to the system: Spark keeps the worker for other tasks."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()                   # the heap that numpy's arrays come from


class Scan:
    """Hashes and words of consecutive texts: ``raw`` bytes, text i at ``at[i]:at[i + 1]``."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, lower: bool = False):
        self.raw = translated(raw, _LOWER) if lower else raw
        self.at, self.n = at, len(at) - 1

    @cached_property
    def sums(self) -> np.ndarray:
        n = len(self.raw)
        out = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE[self.raw] * _power(_P, n), out=out[1:])
        return out

    def word_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of every byte range, read eight bytes at a time: quick for short ranges."""
        n = len(self.raw)
        padded = np.zeros(n + 8, np.uint8)
        padded[:n] = self.raw
        eight = np.ndarray((n + 1,), "<u8", padded, strides=(1,))
        left = end - start
        out = left.astype(np.uint64) * np.uint64(_P)
        which, at = None, start
        while len(at):
            x = eight[at] & _FIRST[np.minimum(left, 8)]
            if which is None:
                out = (out ^ x) * np.uint64(0xD6E8FEB86659FD93)
                out ^= out >> np.uint64(32)
                which = np.flatnonzero(left > 8)
                at, left = start[which] + 8, left[which] - 8
            else:
                y = (out[which] ^ x) * np.uint64(0xD6E8FEB86659FD93)
                out[which] = y ^ (y >> np.uint64(32))
                more = left > 8
                which, at, left = which[more], at[more] + 8, left[more] - 8
        return mix(out)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of every byte range, from one running sum: any length costs the same."""
        x = (self.sums[end] - self.sums[start]) * _power(_inverse(), len(self.raw) + 1)[start]
        return mix(x + (end - start).astype(np.uint64))

    def edges(self, start: np.ndarray, end: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of runs of ``wanted`` bytes inside the given consecutive ranges."""
        first, last = wanted.copy(), wanted.copy()
        first[1:] &= ~wanted[:-1]
        last[:-1] &= ~wanted[1:]
        full = start < end
        s, e = start[full], end[full]
        first[s] = wanted[s]
        last[e - 1] = wanted[e - 1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, first word of each text and the end) of all words."""
        start, end = self.edges(self.at[:-1], self.at[1:], translated(self.raw, _INK).view(bool))
        return start, end, np.searchsorted(start, self.at)

    def lines(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, first line of each text and the end) of all lines; a text of k newlines has k + 1."""
        cuts = np.flatnonzero(self.raw == 10)
        count = np.searchsorted(cuts, self.at)
        first = count + np.arange(self.n + 1)
        owner = np.searchsorted(self.at[1:], cuts, "right")
        start, end = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
        slot = np.arange(len(cuts)) + owner
        end[slot], start[slot + 1] = cuts, cuts + 1
        start[first[:-1]], end[first[1:] - 1] = self.at[:-1], self.at[1:]
        return start, end, first

    def chars(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Code points in every byte range."""
        seen = np.zeros(len(self.raw) + 1, np.int64)
        np.cumsum((self.raw & 0xC0) != 0x80, out=seen[1:])
        return seen[end] - seen[start]


def owners(first: np.ndarray) -> np.ndarray:
    """Group number of every member of consecutive groups that begin at ``first``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k consecutive values (the last k - 1 positions have none)."""
    n = max(0, len(hashes) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j:j + n]
    return mix(out)


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... (count[i] values) for every i, in one array."""
    total = int(count.sum())
    before = np.cumsum(count) - count
    return np.arange(total) - np.repeat(before - start, count)
