"""Seeded draws as pure functions of (seed, row key, slot).

The same row always draws the same values, whatever the partitioning and however often a task is
retried; different slots of a row are independent.
"""

from __future__ import annotations

import itertools
import json
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyguard.functions.columns import as_col

DRAW_RANGE = 16 ** 8
LISTED_ORDERS = 5_000


def draw(key: str | Column, slot: str, seed: int | str = 42) -> Column:
    """Whole number in [0, 2^32)."""
    text = F.concat(F.lit(f"{seed}|{slot}|"), as_col(key).cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def draw_unit(key: str | Column, slot: str, seed: int | str = 42) -> Column:
    """Double in [0, 1)."""
    return draw(key, slot, seed) / F.lit(float(DRAW_RANGE))


def choice(values: list, key: str | Column, slot: str, seed: int | str = 42) -> Column:
    """One of the values."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (draw(key, slot, seed) % len(values)).cast("int") + 1)


def sample_without_replacement(values: list[str], n: int, key: str | Column, slot: str,
                               seed: int | str = 42) -> Column:
    """``n`` different values in random order.

    One draw is read as n shrinking picks: its leading part picks the first value, the next part one
    of those left, and so on, whatever the number of values. Orders listed lexicographically come in
    just that way, so where they are few the picks are looked up in a constant, which draws once.
    """
    orders = math.perm(len(values), n)
    if orders > DRAW_RANGE:
        raise ValueError(f"{n} of {len(values)} values have more orders than one draw can tell apart")
    if orders <= LISTED_ORDERS:
        listed = F.from_json(F.lit(json.dumps(list(itertools.permutations(values, n)))), "array<array<string>>")
        return F.element_at(listed, (draw(key, slot, seed) % orders).cast("int") + 1)       # the list is folded once
    number = draw(key, slot, seed) % orders
    rest, picks = F.array(*[F.lit(v) for v in values]), []
    for i in range(n):
        size = len(values) - i
        later = math.perm(size - 1, n - 1 - i)
        at = (F.floor(number / later) % size).cast("int")
        picks.append(F.element_at(rest, at + 1))
        rest = F.concat(F.slice(rest, F.lit(1), at), F.slice(rest, at + 2, F.lit(size)))
    return F.array(*picks)
