"""Token ids of many texts: each distinct stretch between safe places is encoded once and remembered.

The tokenizer splits text before its merges, and no piece reaches into a single space that stands
between two letters, digits or signs, nor from letters, digits or signs into another of these kinds
(save from an apostrophe into letters), nor from a single line break into what follows it. So a
text's ids are those of its stretches, one after another.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import pyarrow as pa

from tallyguard.llm.textscan import Scan, ranges, translated

TABLE_BITS = 22
MOST_KNOWN = 900_000
"""Stretches remembered by one worker; then it starts afresh, with the same results."""

_LETTER, _DIGIT, _SIGN = 1, 2, 3
_KIND = bytes(0 if x <= 32 or x >= 127 else _DIGIT if chr(x).isdigit() else _LETTER if chr(x).isalpha() else _SIGN
              for x in range(256))
_APOSTROPHE = 39
JOINED = 1 << 7
"""Stretches that the library encodes as one text, a line each."""


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def kinds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Kind of the character that begins and of the one that ends at each byte; 0 for white space and others."""
    begins = translated(raw, _KIND).copy()
    ends = begins.copy()
    latin = np.flatnonzero(raw[:-1] == 0xC3)                   # first byte of letters like é and of two signs
    latin = latin[(raw[latin + 1] != 0x97) & (raw[latin + 1] != 0xB7)]
    begins[latin], ends[latin + 1] = _LETTER, _LETTER
    return begins, ends


def stretches(raw: np.ndarray, at: np.ndarray, begins: np.ndarray,
              ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first stretch of each text and the end); a stretch begins at a text's start or a safe place."""
    n = len(raw)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        before, after = ends > 0, begins > 0
        cut[1:n - 1] = (raw[1:-1] == 32) & before[:-2] & after[2:]
        cut[1:n] |= after[1:] & before[:-1] & (begins[1:] != ends[:-1]) & (
            (raw[:-1] != _APOSTROPHE) | (begins[1:] != _LETTER))
        cut[2:n] |= (raw[1:-1] == 10) & before[:-2] & after[2:]
    full = at[:-1] < at[1:]
    first_bytes, last_bytes = at[:-1][full], at[1:][full] - 1
    cut[last_bytes] &= raw[last_bytes] != 32                  # what follows it is another text
    cut[first_bytes] = True
    start = np.flatnonzero(cut[:n])
    return start, np.r_[start[1:], n][:len(start)], np.searchsorted(start, at)


class Encoder:
    """Ids of texts, with what was encoded before; ``end`` is put after every text."""

    def __init__(self, path: str, end: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"        # Spark deals out the work
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True           # their strings are ordinary text
        self.end = end
        ids = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = ids[0] if len(ids) == 1 else None
        self._forget()

    def _forget(self) -> None:
        self.slot = np.full(1 << TABLE_BITS, -1, np.int32)
        self.more: dict[int, int] = {}
        self.hash = np.zeros(1 << 16, np.uint64)
        self.at = np.zeros((1 << 16) + 1, np.int64)
        self.ids = np.zeros(1 << 18, np.uint32)
        self.known, self.ids[0], self.at[1] = 1, self.end, 1

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _new_ids(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray,
                 odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, their number in each stretch); ``odd`` marks all but the bytes of letters, digits and signs.

        Stretches of these kinds after at most one space are encoded many at once, as the lines of one text.
        """
        before = np.zeros(len(raw) + 1, np.int32)
        np.cumsum(odd, out=before[1:])
        body = start + (raw[start] == 32)
        line = (body < end) & (before[body] == before[end]) & (self.line is not None)
        size, parts = np.zeros(len(start), np.int64), []
        order = np.r_[np.flatnonzero(line), np.flatnonzero(~line)]
        for lo in range(0, int(line.sum()), JOINED):
            some = order[lo:min(lo + JOINED, int(line.sum()))]
            width = end[some] - start[some] + 1
            data = raw[np.minimum(ranges(start[some], width), len(raw) - 1)]
            data[np.cumsum(width) - 1] = 10
            ids, = self._encoded([data.tobytes().decode()])
            cuts = np.flatnonzero(ids == self.line)
            size[some] = np.diff(cuts, prepend=-1) - 1
            parts.append(np.delete(ids, cuts))
        rest = order[int(line.sum()):]
        for lo in range(0, len(rest), JOINED):
            some = rest[lo:lo + JOINED]
            found = self._encoded([raw[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start[some], end[some])])
            size[some] = [len(x) for x in found]
            parts += found
        ids = np.concatenate([np.zeros(0, np.uint32), *parts])
        first = np.empty(len(order), np.int64)
        first[order] = np.cumsum(size[order]) - size[order]
        return ids[ranges(first, size)], size

    def _learn(self, hashes: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        lo, hi = self.known, self.known + len(hashes)
        while len(self.hash) < hi:
            self.hash, self.at = np.resize(self.hash, 2 * len(self.hash)), np.resize(self.at, 2 * len(self.hash) + 1)
        end = self.at[lo] + np.cumsum(size)
        while len(self.ids) < end[-1]:
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        self.ids[self.at[lo]:end[-1]] = ids
        self.hash[lo:hi], self.at[lo + 1:hi + 1], self.known = hashes, end, hi
        place = (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        number = np.arange(lo, hi)
        free = self.slot[place] < 0
        self.slot[place[free]] = number[free]
        late = self.slot[place] != number                     # another stretch holds the place
        self.more.update(zip(hashes[late].tolist(), number[late].tolist()))

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        number = self.slot[(hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)]
        lost = np.flatnonzero((number >= 0) & (self.hash[number] != hashes))
        number[lost] = [self.more.get(x, -1) for x in hashes[lost].tolist()]
        return number

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first id of each text and the end)."""
        if self.known > MOST_KNOWN:
            self._forget()
        begins, ends = kinds(raw)
        start, end, first = stretches(raw, at, begins, ends)
        hashes = Scan(raw, at).word_hashes(start, end)
        number = self._find(hashes)
        new = np.flatnonzero(number < 0)
        if len(new):
            unique, which, turn = np.unique(hashes[new], return_index=True, return_inverse=True)
            number[new] = self.known + turn
            self._learn(unique, *self._new_ids(raw, start[new[which]], end[new[which]], (begins | ends) == 0))
        number = np.insert(number, first[1:], 0)
        size = self.at[number + 1] - self.at[number]
        total = np.r_[0, np.cumsum(size)]
        return self.ids[ranges(self.at[number], size)], total[first + np.arange(len(first))]


_encoders: dict[tuple[str, int], Encoder] = {}


def encoder(path: str | None, end: int) -> Encoder:
    """This worker's encoder."""
    key = (path or default_tokenizer(), end)
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]

