"""Quality rules: repeated substrings by suffix arrays over the words of every text."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyguard.catalog.registry import table
from tallyguard.llm.textscan import SPACE, Scan, _power, chain, mix, owners, ranges, slices

LEAST_REPEAT = 10
MOST_COVERED = 0.2
LONGEST_REPEAT = 30
"""Both act beside the base rule, which lets up to half of the words be repeated."""
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_BASE = 0xD6E8FEB86659FD93


def _own(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Hashes that are equal only inside one text."""
    return mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.sort(keys)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def repeated_windows(hashes: np.ndarray, owner: np.ndarray, k: int) -> np.ndarray:
    """Starts of the k-word windows that their text holds twice or more."""
    wide = chain(hashes, k)
    at = np.flatnonzero(owner[:len(wide)] == owner[k - 1:]) if len(wide) else np.zeros(0, np.int64)
    return at[_repeated(_own(wide[at], owner[at]))]


def covered(n: int, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
    """Which of n places lie in one of the spans."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + length, -1)
    return np.cumsum(step[:n]) > 0


def suffix_order(rank: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; suffix i runs from i to end[i], its first sign is rank[i]."""
    n = len(rank)
    here = np.arange(n)
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        later = np.minimum(here + step, n - 1)
        key = rank.astype(np.int64) * (n + 1) + np.where(here + step < end, rank[later] + 1, 0)
        order = np.argsort(key, kind="stable")
        new = np.zeros(n, np.int64)
        new[order[1:]] = np.cumsum(key[order[1:]] != key[order[:-1]])
        rank, step = new, 2 * step
        if rank[order[-1]] == n - 1 or step > (end - here).max():
            return order


def common_prefixes(hashes: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Length of the common prefix of the suffixes at a and b, at most ``most``, by halving over running sums."""
    n = len(hashes)
    power = _power(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * power[:n], out=sums[1:])
    low, high = np.zeros(len(a), np.int64), most.astype(np.int64).copy()
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = (sums[a + mid] - sums[a]) * power[n - a] == (sums[b + mid] - sums[b]) * power[n - b]
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def longest_repeats(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every word of consecutive texts the longest repeat inside its text that begins there.

    Neighbours in the suffix array have the longest common prefixes (the ends of LCP intervals), so a
    suffix's longest repeat is the longer prefix that it shares with the one before or after it.
    """
    owner = owners(first)
    end = first[1:][owner]
    rank = np.unique(_own(hashes, owner), return_inverse=True)[1]
    order = suffix_order(rank, end)
    a, b = order[:-1], order[1:]
    together = owner[a] == owner[b]
    a, b = a[together], b[together]
    shared = common_prefixes(hashes, a, b, np.minimum(end[a] - a, end[b] - b))
    out = np.zeros(len(hashes), np.int64)
    out[a] = shared
    out[b] = np.maximum(out[b], shared)
    return out


def _sum_by(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.diff(np.r_[0, np.cumsum(values)][first])


def measure(raw: np.ndarray, at: np.ndarray, least: int) -> dict[str, np.ndarray]:
    """All counts of consecutive texts, one value a text."""
    scan = Scan(raw, at)
    start, end, first = scan.words()
    hashes = scan.word_hashes(start, end)
    owner = owners(first)
    n = len(hashes)
    letters = ~SPACE[scan.raw]
    lines, line_end, first_line = scan.lines()
    in_bytes = np.r_[0, np.cumsum(letters)]
    with_word = in_bytes[line_end] > in_bytes[lines]
    line_owner = owners(first_line)[with_word]
    keys = _own(scan.hashes(lines[with_word], line_end[with_word]), line_owner)
    distinct = line_owner[np.unique(keys, return_index=True)[1]]
    texts = len(at) - 1
    out = {
        "n_words": np.diff(first),
        "word_chars": _sum_by(at, letters & ((scan.raw & 0xC0) != 0x80)),
        "n_symbols": _sum_by(at, SYMBOL[scan.raw]),
        "n_dup_lines": np.bincount(line_owner, minlength=texts) - np.bincount(distinct, minlength=texts),
        "n_repeat_words": _sum_by(first, covered(n, repeated_windows(hashes, owner, 3), 3)),
        "covered_words": np.zeros(texts, np.int64), "longest_repeat": np.zeros(texts, np.int64),
    }
    some = np.unique(owner[repeated_windows(hashes, owner, least)])     # no other text has a repeat so long
    if len(some):
        size = np.diff(first)[some]
        part_first = np.r_[0, np.cumsum(size)]
        longest = longest_repeats(hashes[ranges(first[:-1][some], size)], part_first)
        spans = np.flatnonzero(longest >= least)
        out["covered_words"][some] = _sum_by(part_first, covered(len(longest), spans, longest[spans]))
        out["longest_repeat"][some] = np.maximum.reduceat(longest, part_first[:-1])
    return out


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def _measured(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, at in slices(batch.column(1)):
            found = measure(raw, at, least)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), *(pa.array(found[c].astype(np.int64)) for c in COUNTS)],
                ["doc_id", *COUNTS])


def repetition_rules(docs: DataFrame, least: int = LEAST_REPEAT, most_covered: float = MOST_COVERED,
                     longest: int = LONGEST_REPEAT) -> DataFrame:
    """Counts and verdict of every row of ``docs``: doc_id, COUNTS, base_failed, kept.

    covered_words is the size of the union of all maximal repeats of ``least`` words or more,
    longest_repeat the longest of them (0: none; a repeat may overlap itself). A text is kept when
    the base rules hold, at most ``most_covered`` of its words are covered and no repeat has more
    than ``longest`` words. Null and empty texts have no words and fail; repeated rows are judged
    alike; other columns are not looked at; an empty table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    counts = docs.select("doc_id", "text").mapInArrow(
        partial(_measured, least=least), f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    fine = (F.col("covered_words") <= most_covered * F.col("n_words")) & (F.col("longest_repeat") <= longest)
    return counts.select("*", failed.alias("base_failed"), (~failed & fine).alias("kept"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts over the whole table."""
    return repetition_rules(table(spark, sf_dir, "documents"))
