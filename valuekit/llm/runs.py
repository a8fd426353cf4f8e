"""Periodic runs of words: Lyndon arrays under both orders by Baier's grouping, their roots extended through LCE into runs."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_WORDS = 12
# Multiplier of the rolling sums, and the seed of the words' numbers in them. Equal stretches always agree; what agrees is compared word by word.
BASE = np.uint64(0x9E3779B97F4A7C15)
SEED = 11


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each place: phase one of a suffix sorter.

    Suffixes start in groups of one symbol. The greatest group left is taken; each of its members is reported to the nearest earlier place
    whose group is still to come. A place with ``k`` reports now begins with ``k`` more copies of the group's word: it moves to a group just
    above its old one, the higher the more copies. A place's word is final when its group is taken.
    """
    size = len(symbols)
    ranks = {s: r for r, s in enumerate(sorted(set(symbols)))}
    group = [ranks[s] for s in symbols]
    members: list[list[int]] = [[] for _ in ranks]
    for place, g in enumerate(group):
        members[g].append(place)
    below = list(range(-1, len(members) - 1))
    above = [*range(1, len(members)), -1]
    length = [1] * size
    # Place p is at index p + 1; index 0 stands for none. Taken places point to an earlier one.
    up = list(range(size + 1))
    taking = len(members) - 1
    while taking >= 0:
        block = [p for p in members[taking] if group[p] == taking]
        members[taking] = []
        for p in block:
            up[p + 1] = p
        reports: dict[int, int] = {}
        for p in block:
            at = p
            while up[at] != at:
                up[at] = at = up[up[at]]
            up[p + 1] = at
            if at:
                reports[at - 1] = reports.get(at - 1, 0) + 1
        if reports:
            word = length[block[0]]
            moves: dict[tuple[int, int], list[int]] = {}
            for p, copies in reports.items():
                length[p] += copies * word
                moves.setdefault((group[p], copies), []).append(p)
            # Most copies first: each new group goes directly above the old one.
            for old, copies in sorted(moves, key=lambda m: -m[1]) if len(moves) > 1 else moves:
                moved, new = moves[old, copies], len(members)
                members.append(moved)
                for p in moved:
                    group[p] = new
                over = above[old]
                below.append(old)
                above.append(over)
                above[old] = new
                if over >= 0:
                    below[over] = new
        taking = below[taking]
    return length


def stretches(ids: np.ndarray, part: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, number of the stretch of each) that may lie in a run: a run holds each of its words twice, so words that occur once part it."""
    places = np.arange(len(ids))
    while len(places):
        before = len(places)
        key = part.astype(np.int64) * (int(ids.max()) + 1) + ids[places]
        _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
        again = counts[inverse] > 1
        places, part = places[again], part[again]
        fresh = np.ones(len(places), bool)
        fresh[1:] = (np.diff(places) != 1) | (np.diff(part) != 0)
        part = np.cumsum(fresh) - 1
        long = np.bincount(part, minlength=1)[part] >= least if len(part) else np.zeros(0, bool)
        places, part = places[long], part[long]
        if len(places) == before:
            break
    return places, np.unique(part, return_inverse=True)[1] if len(part) else part


class Extensions:
    """How far two places of ``row`` agree, onward and backward, by rolling sums and halving."""

    def __init__(self, row: np.ndarray):
        random = np.random.default_rng(SEED).integers(0, 2**64, int(row.max()) + 1, np.uint64)
        self.power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(row), BASE, np.uint64))))
        self.sums = np.concatenate(([np.uint64(0)], np.cumsum(random[row] * self.power[:-1])))

    def agree(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.sums[a + size] - self.sums[a]) * self.power[b - a] == self.sums[b + size] - self.sums[b]

    def onward(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Most words, up to ``limit``, from ``a`` and ``b > a`` on that are the same."""
        low, high = np.zeros_like(limit), limit.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.agree(a, b, middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Most words, up to ``limit``, in front of ``a`` and ``b > a`` that are the same."""
        low, high = np.zeros_like(limit), limit.copy()
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.agree(a - middle, b - middle, middle)
            low, high = np.where(open_ & same, middle, low), np.where(open_ & ~same, middle - 1, high)
        return low


def _plain_run(row: np.ndarray, place: int, period: int, first: int, end: int) -> tuple[int, int]:
    """(start, end) of the stretch around ``place`` that keeps ``period``, word by word."""
    differ = row[first : end - period] != row[first + period : end]
    after = np.flatnonzero(differ[place - first :])
    before = np.flatnonzero(differ[: place - first])
    start = first + int(before[-1]) + 1 if len(before) else first
    stop = place + int(after[0]) + period if len(after) else end
    return start, stop


def runs_in(ids: np.ndarray, part: np.ndarray, least: int = MIN_WORDS) -> np.ndarray:
    """Rows ``(start, length, period)``, in order, of all runs of at least ``least`` words within equal numbers of ``part``."""
    places, stretch = stretches(ids, part, least)
    none = np.zeros((0, 3), np.int64)
    if not len(places):
        return none
    row = ids[places]
    first = np.searchsorted(stretch, stretch)
    end = np.searchsorted(stretch, stretch, "right")
    lengths = np.empty((2, len(row)), np.int64)
    for start, stop in np.unique(np.column_stack((first, end)), axis=0).tolist():
        symbols = row[start:stop].tolist()
        lengths[0, start:stop] = lyndon_lengths(symbols)
        lengths[1, start:stop] = lyndon_lengths([-s for s in symbols])
    root = np.tile(np.arange(len(row)), 2)
    period = lengths.ravel()
    # A root that isn't followed or preceded by any word a period away is in no run.
    behind, front = root + period < end[root], root > first[root]
    follows = behind & (row[np.minimum(root + period, len(row) - 1)] == row[root])
    precedes = front & (row[np.maximum(root - 1, 0)] == row[root + period - 1])
    root, period = (x[follows | precedes] for x in (root, period))
    lce = Extensions(row)
    onward = lce.onward(root, root + period, end[root] - root - period)
    backward = lce.backward(root, root + period, root - first[root])
    size = onward + backward + period
    found = (size >= 2 * period) & (size >= least)
    runs = np.column_stack((root - backward, size, period, root))[found]
    runs = runs[np.unique(runs[:, [0, 1, 2]], axis=0, return_index=True)[1]] if len(runs) else runs
    out = []
    for start, size, period, root in runs.tolist():
        if not np.array_equal(row[start : start + size - period], row[start + period : start + size]):
            start, stop = _plain_run(row, root, period, int(first[root]), int(end[root]))
            size = stop - start
        if size >= max(2 * period, least):
            out.append((int(places[start]), size, period))
    if not out:
        return none
    out = np.unique(np.array(out, np.int64), axis=0)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def _batch(texts: list[str], least: int) -> list[tuple]:
    """(starts, lengths, periods, collapsed text) of each text."""
    cut = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    sizes = np.array([len(words) for words in cut], np.int64)
    ids = pd.factorize(np.array([w for words in cut for w in words], object))[0]
    at = np.concatenate(([0], np.cumsum(sizes)))
    runs = runs_in(ids, np.repeat(np.arange(len(cut)), sizes), least)
    owner = np.searchsorted(at, runs[:, 0], "right") - 1
    out = []
    for k, words in enumerate(cut):
        mine = runs[slice(*np.searchsorted(owner, [k, k + 1]))]
        if len(mine):
            start, length, period = (mine - [at[k], 0, 0]).T
            edge = np.zeros(len(words) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0).tolist()]
            found = start.tolist(), length.tolist(), period.tolist()
        else:
            found = [], [], []
        out.append((*found, b" ".join(words).decode("utf-8", "surrogatepass")))
    return out


def periodic_runs(docs: DataFrame, least: int = MIN_WORDS) -> DataFrame:
    """``docs`` with ``runs``, an array of ``(start, length, period)``, and ``collapsed``, the text without what repeats.

    Words are what ASCII white space parts, numbered from 0. A run is a longest stretch of at least ``least`` words and of two periods in which words
    one (smallest) period apart are the same. Runs are in order of start, then period. ``collapsed`` drops what a run holds after its first period; words that
    stay are joined by one space. Null and empty texts have no runs and collapse to an empty text. Rows are independent of each other, so repeated rows,
    ties and null ids need no rule; a batch holds 2 MB of texts or one text. Columns ``runs`` and ``collapsed`` of the input are replaced.
    """

    @F.pandas_udf("start array<long>, length array<long>, period array<long>, collapsed string")
    def search(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(_batch(texts.tolist(), least), columns=["start", "length", "period", "collapsed"])

    held = [F.col(f"`{c}`") for c in docs.columns if c not in ("runs", "collapsed")]
    # The answer is one column of a table of its own, so that no other use of it makes Python run again.
    found = docs.select(F.struct(*held).alias("row"), search(F.coalesce("text", F.lit(""))).alias("answer"))
    runs = F.arrays_zip(F.col("answer.start").alias("start"), F.col("answer.length").alias("length"), F.col("answer.period").alias("period"))
    return found.select("row.*", runs.alias("runs"), F.col("answer.collapsed").alias("collapsed"))
