"""Score documents with histogram gradient-boosted trees over text statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.llm.shingles import batches, word_hashes

# Labelled rows that a fit takes at most: those with the smallest hash of doc_id.
MAX_LABELLED = 20_000
BINS = 64
TREES = 40
DEPTH = 5
RATE = 0.2
L2 = 1.0
MIN_ROWS = 10

_KIND = np.full(256, 7, np.uint8)  # the rest: bytes of characters beyond ASCII
for _k, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\v\f", b"\n", b".,;:?'\"()-")):
    _KIND[list(_chars)] = _k
_KIND[[c for c in range(128) if _KIND[c] == 7]] = 6  # signs
FEATURES = [
    "log_bytes", "log_words", "lower", "upper", "digits", "blanks", "breaks", "punctuation", "signs", "beyond_ascii",
    "word_bytes", "distinct_words", "repeats", "line_bytes", "top_word",
]


def features(texts: Sequence[bytes]) -> np.ndarray:
    """One row of ``FEATURES`` per text: sizes, shares of character kinds and of distinct and repeated words."""
    n = len(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    kinds = _KIND[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int64)
    owner = np.repeat(np.arange(n), sizes)
    counts = np.bincount(owner * 8 + kinds, minlength=8 * n).reshape(n, 8)
    words, start = word_hashes(texts)
    n_words = np.diff(start)
    whose = np.repeat(np.arange(n), n_words)
    repeats = np.bincount(whose[1:][(words[1:] == words[:-1]) & (whose[1:] == whose[:-1])], minlength=n)
    order = np.lexsort((words, whose))
    words, whose = words[order], whose[order]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (words[1:] != words[:-1]) | (whose[1:] != whose[:-1])
    distinct = np.bincount(whose[fresh], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(fresh), len(words)))
    top = np.zeros(n)
    np.maximum.at(top, whose[fresh], runs)
    length, many = np.maximum(sizes, 1), np.maximum(n_words, 1)
    columns = [np.log1p(sizes), np.log1p(n_words), *(counts / length[:, None]).T]
    columns += [(sizes - counts[:, 3] - counts[:, 4]) / many, distinct / many, repeats / many, sizes / (counts[:, 4] + 1), top / many]
    return np.column_stack(columns).astype(np.float32)


@dataclass
class Trees:
    """Complete binary trees of one depth in flat arrays: node k has children 2k+1 and 2k+2, leaves hold values."""

    base: float
    feature: np.ndarray  # (trees, nodes)
    above: np.ndarray  # threshold: greater values go right
    value: np.ndarray  # (trees, leaves)

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, above, value in zip(self.feature, self.above, self.value):
            node = np.zeros(len(x), np.int64)
            while inner and node[:1].size and node[0] < inner:  # all rows are on the same level
                node = 2 * node + 1 + (x[rows, feature[node]] > above[node])
            total += value[node - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost on the logistic loss, level by level, on histograms of the binned features."""
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    if len(np.unique(y)) < 2:
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.float32), np.zeros((0, leaves)))
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32)) for column in x.T]
    binned = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)])
    width, columns = BINS, np.arange(x.shape[1])
    score, made = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, above, node = np.zeros(inner, np.int64), np.full(inner, np.inf, np.float32), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, many = 2**level - 1, 2**level
            slot = ((node - first)[:, None] * len(columns) + columns) * width + binned
            sums = [
                np.bincount(slot.ravel(), np.repeat(w, len(columns)), many * len(columns) * width).reshape(many, len(columns), width)
                for w in (gradient, hessian, np.ones(len(y)))
            ]
            left = [s.cumsum(2) for s in sums]
            whole = [s[:, :, -1:] for s in left]
            gain = sum(g * g / (h + L2) for g, h in ((left[0], left[1]), (whole[0] - left[0], whole[1] - left[1])))
            gain = gain - whole[0] ** 2 / (whole[1] + L2)
            gain[(left[2] < MIN_ROWS) | (whole[2] - left[2] < MIN_ROWS)] = 0
            best = gain.reshape(many, -1).argmax(1)
            for k in range(many):
                column, at = divmod(int(best[k]), width)
                if gain[k, column, at] > 1e-6 and at < len(cuts[column]):
                    feature[first + k], above[first + k] = column, cuts[column][at]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > above[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + L2)
        score = score + value[leaf]
        made.append((feature, above, value))
    return Trees(base, *(np.array(part) for part in zip(*made)))


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def train_quality(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Trees:
    """Fit on the labelled documents that aren't held out, at most ``max_labelled`` of them.

    Labels other than 0 and 1 are ignored; several labels of a document count by their mean, rounded. Without labels of both
    kinds the score is a constant.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.round(F.avg("quality")).alias("quality"))
    # Bounded by the limit, so it may be broadcast.
    picked = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    measured = docs.select("doc_id", "text").join(picked, "doc_id").select("doc_id", "quality", text_features(F.col("text")).alias("x"))
    rows = measured.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled).toPandas()
    x = np.array(rows["x"].tolist(), np.float32).reshape(-1, len(FEATURES))
    return fit(x, rows["quality"].to_numpy(float))


@F.pandas_udf(T.ArrayType(T.FloatType()))
def text_features(texts: pd.Series) -> pd.Series:
    parts = [features(raw) for _, _, raw in batches(texts)]
    return pd.Series(list(np.concatenate(parts)) if parts else [], index=texts.index, dtype=object)


def quality_score(trees: Trees, text: Column) -> Column:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [trees.score(features(raw)) for _, _, raw in batches(texts)]
        return pd.Series(np.concatenate(parts) if parts else [], index=texts.index, dtype=float)

    return score(text)


def classify_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier), ``predicted`` (score >= threshold) and ``held_out``.

    Only statistics of the text enter a score. Null and empty texts are scored like any text, with no words. Columns of these three
    names are replaced; a null ``doc_id`` gives a null ``held_out``. An empty table stays empty.
    """
    trees = train_quality(docs, labels, max_labelled)
    scored = docs.withColumn("score", quality_score(trees, F.col("text")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int")).withColumn("held_out", held_out(F.col("doc_id")))
