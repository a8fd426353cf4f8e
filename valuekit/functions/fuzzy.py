"""Partial text similarity: the one score Spark has no expression for."""

from __future__ import annotations

import math
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from valuekit.functions.text import let
from valuekit.scale import col


def _common(masks: dict[str, int], window: str) -> int:
    """Length of the longest common subsequence, one machine word per step."""
    row = 0
    for char in window:
        hit = masks.get(char, 0)
        joined = row | hit
        row = joined & ~(joined - ((row << 1) | 1))
    return row.bit_count()


def _best_window(short: str, long: str) -> float:
    masks: dict[str, int] = {}
    for i, char in enumerate(short):
        masks[char] = masks.get(char, 0) | (1 << i)
    size, best = len(short), 0.0
    for start in range(1 - size, len(long)):
        window = long[max(start, 0) : start + size]
        if 2 * len(window) / (size + len(window)) > best:
            best = max(best, 2 * _common(masks, window) / (size + len(window)))
    return 100.0 * best


@lru_cache(maxsize=100_000)
def best_alignment(a: str, b: str) -> float:
    """Highest 0-100 similarity of the shorter text to any stretch of the longer one (of equal texts: either way)."""
    if not a or not b:
        return 100.0 if a == b else 0.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(*sorted((a, b), key=len))


@F.pandas_udf(DoubleType())
def _alignment(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else best_alignment(x, y) for x, y in zip(a, b)], dtype="float64")


# Marked so that a filter on the score neither moves it into a join nor has it computed twice.
_alignment = _alignment.asNondeterministic()


def least_shared(size: int, min_score: float) -> int:
    """Neighbouring characters (pairs) of a text of ``size`` that must occur in another one it scores ``min_score`` or more against.

    With ``L`` characters in common, a stretch of ``w <= size`` scores ``200 L / (size + w)``. A character left out parts two pairs of the text, one put
    in parts one, so ``2 (size - L) + (w - L)`` pairs can be lost at most. That is greatest for the shortest stretch, ``w = L``, at scores
    above two thirds, else for ``w = size``.
    """
    share = min(max(min_score, 0.0), 100.0) / 100.0
    shortest = share / (2.0 - share)
    lost = max(2 - 1.5 * share + w * (1 - 1.5 * share) for w in (shortest, 1.0))
    return math.ceil(size - 1 - lost * size - 1e-9)


def may_reach(a: Column, b: Column, min_score: float) -> Column:
    """False only for texts whose partial similarity is below ``min_score``: too few neighbouring characters of the shorter one occur in the longer one."""

    def pairs(text: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2)))

    def shared(short: Column, long: Column) -> Column:
        return let(pairs(long), lambda known: F.size(F.filter(pairs(short), lambda g: F.array_contains(known, g))))

    # Sizes of which nothing is required never fail; beyond, the bound grows by the same share per character.
    first = next((m for m in range(2, 10_000) if least_shared(m, min_score) > 0), None)
    if first is None:
        return F.lit(True)
    share = min(max(min_score, 0.0), 100.0) / 100.0
    lost = max(2 - 1.5 * share + w * (1 - 1.5 * share) for w in (share / (2.0 - share), 1.0))
    size, other = F.char_length(a), F.char_length(b)
    least = F.least(size, other)
    needed = F.ceil(least * (1 - lost) - 1 - 1e-9)
    ahead, back = size <= other, other <= size
    enough = (ahead & (shared(a, b) >= needed)) | (back & (shared(b, a) >= needed))
    return (least < first) | enough


def partial_ratio(a: Column, b: Column) -> Column:
    """Case-insensitive partial similarity, 0-100. Contained texts are settled without Python."""
    x, y = F.lower(a), F.lower(b)
    empty = (x == "") | (y == "")
    contained = F.contains(x, y) | F.contains(y, x)
    settled = F.when(empty, F.when(x == y, 100.0).otherwise(0.0)).when(contained, 100.0)
    undecided = settled.isNull()
    scored = _alignment(F.when(undecided, x), F.when(undecided, y))
    return F.coalesce(settled, scored)


def resembling(pairs: DataFrame, a: str, b: str, min_score: float, name: str = "score") -> DataFrame:
    """The rows whose texts score ``min_score`` or more, with the score; Python sees only texts with enough pairs of characters in common."""
    x, y = col(a), col(b)
    hopeful = pairs.filter(may_reach(F.lower(x), F.lower(y), min_score))
    return hopeful.withColumn(name, partial_ratio(x, y)).filter(col(name) >= min_score)
