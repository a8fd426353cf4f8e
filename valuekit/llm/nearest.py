"""Approximate nearest neighbours by collision counting over query-centred windows of sorted projections."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.llm.vectors import stacked, usable
from valuekit.scale import BROADCAST_ROWS, attach, settle, settled_size

BLOCK = 8192
QUERIES = 1024
PILOTS = 24
# Vectors whose norms differ by no more than this factor are sorted and searched together.
RATIO = 1.1
# Allowances for the error of a collision count, which grows with the norm; the one that needs the fewest vectors is taken.
BONUSES = (0.0, 0.1, 0.2, 0.4, 0.8)


@dataclass(frozen=True)
class Settings:
    """``projections`` sorted arrays; a vector in the windows of ``collisions`` of them is verified. Windows grow until as many vectors
    are verified as held a share ``recall`` of the true neighbours of a sample of the queries."""

    projections: int = 96
    collisions: float = 0.6
    recall: float = 0.95
    seed: int = 11


class Projections:
    """Index of one block, in slices of similar norm. In a slice, inner products become distances by one more component, up to its largest norm.

    A level is an inner product with the query's direction. It stands for a distance in each slice and so for a width of its windows: a vector
    of that inner product is expected in a share ``collisions`` of them. Long vectors thus meet wide windows and leave those of the others alone.
    """

    def __init__(self, x: np.ndarray, settings: Settings):
        self.x, self.settings = x, settings
        self.must = int(np.ceil(settings.collisions * settings.projections))
        self.spread = NormalDist().inv_cdf((1 + settings.collisions) / 2)
        norms = np.sqrt(np.einsum("ij,ij->i", x, x))
        part = np.unique(np.ceil(np.log(norms / norms.max()) / np.log(RATIO)), return_inverse=True)[1]
        self.tops = np.zeros(part.max() + 1)
        np.maximum.at(self.tops, part, norms)
        self.top = self.tops[part]
        lifted = np.column_stack((x / self.top[:, None], np.sqrt(np.maximum(1 - (norms / self.top) ** 2, 0))))
        self.axes = np.random.default_rng(settings.seed).standard_normal((settings.projections, lifted.shape[1]))
        self.values = lifted @ self.axes.T
        # All sorted arrays in one, each moved behind the last, so that one search finds the ends of all windows.
        reach = float(np.abs(self.values).max()) + float(np.sqrt((self.axes**2).sum(1)).max()) + 1.0
        self.limit = 1.5 * reach
        self.shift = 4 * reach * np.arange(len(self.axes) * len(self.tops)).reshape(len(self.axes), -1)
        moved = self.values.T + self.shift[:, part]
        order = np.argsort(moved, axis=1)
        self.flat = np.take_along_axis(moved, order, axis=1).ravel()
        self.flat_order = order.ravel()

    def _centre(self, query: np.ndarray) -> np.ndarray:
        return self.axes[:, :-1] @ (query / np.sqrt(query @ query))

    def calibrate(self, queries: np.ndarray, owns: np.ndarray, k: int) -> None:
        """Measure on some queries how many vectors to verify and at which levels to look."""
        taken = []
        for query, own in zip(queries, owns):
            others = np.flatnonzero(~own)
            if len(others):
                away = np.abs(self.values[others] - self._centre(query))
                enters = np.partition(away, self.must - 1, axis=1)[:, self.must - 1]
                true = np.argsort(-(self.x[others] @ query), kind="stable")[:k]
                taken.append((self.top[others], (enters / self.spread) ** 2 / 2, true))
        if not taken:
            taken = [(self.top, np.zeros(len(self.x)), np.arange(len(self.x)))]
        self.enough, self.bonus, reached = min((self._stop(bonus, taken) for bonus in BONUSES), key=lambda stop: stop[0])
        self.levels = np.quantile(reached, [1, 0.75, 0.5, 0.25, 0])
        self.step = max((self.levels[0] - self.levels[-1]) / 4, 1e-3 * self.tops.max())

    def _stop(self, bonus: float, taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[int, float, list[float]]:
        """How many vectors come first when a share ``recall`` of the true neighbours has come, and each query's level then."""
        falling, ranks = [], []
        for top, enters, true in taken:
            levels = -top * (1 + bonus - enters)
            falling.append(np.sort(levels))
            ranks.append(np.searchsorted(falling[-1], levels[true], side="right"))
        enough = int(np.quantile(np.concatenate(ranks), self.settings.recall, method="higher"))
        return enough, bonus, [-levels[min(enough, len(levels)) - 1] for levels in falling]

    def candidates(self, query: np.ndarray, k: int, own: int) -> np.ndarray:
        """Vectors that collide with the query often enough, from the highest level that gives enough of them."""
        n = len(self.x)
        enough = min(n, max(k, self.enough) + own)
        centre = (self._centre(query)[:, None] + self.shift).ravel()
        low = high = np.searchsorted(self.flat, centre)
        counts, tries, level, step = np.zeros(n, np.int64), 0, self.levels[0], self.step
        while True:
            width = np.minimum(self.spread * np.sqrt(np.maximum(2 + 2 * self.bonus - 2 * level / self.tops, 0)), self.limit)
            wide = np.broadcast_to(width, self.shift.shape).ravel()
            wide_low, wide_high = np.searchsorted(self.flat, centre - wide), np.searchsorted(self.flat, centre + wide, side="right")
            starts, ends = np.concatenate((wide_low, high)), np.concatenate((low, wide_high))
            some = starts < ends
            new = [self.flat_order[a:b] for a, b in zip(starts[some].tolist(), ends[some].tolist())]
            if new:
                counts += np.bincount(np.concatenate(new), minlength=n)
            low, high = wide_low, wide_high
            hits = np.flatnonzero(counts >= self.must)
            if len(hits) >= enough:
                return hits
            tries += 1
            if tries < len(self.levels):
                level = self.levels[tries]
            else:
                level, step = level - step, 2 * step

    def best(self, query: np.ndarray, own: np.ndarray, k: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` candidates of largest inner product, ties to the smaller id."""
        hits = self.candidates(query, k, int(own.sum()))
        hits = hits[~own[hits]]
        scores = np.einsum("ij,j->i", self.x[hits], query)
        top = np.lexsort((ids[hits], -scores))[:k]
        return hits[top], scores[top]


def _pack(key: str):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        length = frame["length"].iloc[0]
        row = length, frame[key].iloc[0], frame["vec_id"].to_numpy("<i8").tobytes(), stacked(frame["vec"], length).astype("<f8").tobytes()
        return pd.DataFrame([row], columns=["length", key, "ids", "vecs"])

    return pack


def _search(k: int, settings: Settings):
    """Rows arrive sorted by length and block, so a block's index is built once for all its batches of queries."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, index, ids = None, None, None
        for frame in frames:
            for row in frame.itertuples(index=False):
                if (row.length, row.block) != block:
                    block, ids = (row.length, row.block), np.frombuffer(row.ids, "<i8")
                    index = Projections(np.frombuffer(row.vecs, "<f8").reshape(-1, row.length), settings)
                queries = np.frombuffer(row.query_vecs, "<f8").reshape(-1, row.length)
                query_ids, out = np.frombuffer(row.query_ids, "<i8"), []
                some = np.random.default_rng(settings.seed).choice(len(queries), min(PILOTS, len(queries)), replace=False)
                index.calibrate(queries[some], ids == query_ids[some, None], k)
                for query_id, query in zip(query_ids, queries):
                    hits, scores = index.best(query, ids == query_id, k, ids)
                    out.append((np.full(len(hits), query_id), ids[hits], scores))
                yield pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out)))))

    return run


def nearest(table: DataFrame, queries: Column, k: int = 20, settings: Settings = Settings()) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` vectors of largest inner product found for each query row.

    ``table`` holds ``(vec_id, embedding)``; rows for which ``queries`` holds are searched for among all rows but their own. Scores are inner
    products of the original vectors in double precision; ties go to the smaller ``vec_id``. All vectors are indexed, in blocks; each batch of queries meets each
    block. In a block every vector is projected on single axes and sorted along each, apart from vectors of other norms. A query's windows on all axes
    widen together (virtual rehashing), and vectors in enough windows at once are verified. How many that takes is measured per block and batch, on a
    sample of its queries. The result is approximate; tests measure its recall.

    Vectors of different lengths are never neighbours; each length has blocks of its own. Vectors that are null, zero or hold null or non-finite
    components take no part, and neither do rows without ``vec_id``. Rows that repeat a ``vec_id`` are candidates each, but not for that id's query, which is the smallest of their vectors. Other
    columns don't matter; without vectors or queries there are no rows.
    """
    rows = table.filter(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
    vec, length = F.col("embedding").cast("array<double>").alias("vec"), F.size("embedding").alias("length")
    rows = settle(rows.select(F.col("vec_id").cast("long").alias("vec_id"), vec, length, F.coalesce(queries, F.lit(False)).alias("asks")))
    sizes = settle(rows.groupBy("length").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"), F.greatest(F.ceil(F.count_if("asks") / QUERIES), F.lit(1)).alias("batches")))
    total = sizes.agg(F.sum("blocks").alias("n")).first()["n"] or 1
    known = attach(rows, sizes, ["length"])
    dealt = known.withColumn("block", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    held = settle(dealt.groupBy("length", "block").applyInPandas(_pack("block"), "length int, block int, ids binary, vecs binary"))
    batch = F.pmod(F.xxhash64(F.lit("query"), "vec_id"), "batches").cast("int")
    asking = rows.filter("asks").groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("length", F.size("vec"))
    asked = attach(asking, sizes, ["length"]).withColumn("batch", batch).groupBy("length", "batch").applyInPandas(_pack("batch"), "length int, batch int, ids binary, vecs binary")
    asked = settle(asked).join(F.broadcast(sizes), "length") if settled_size(sizes)[0] <= BROADCAST_ROWS else settle(asked).join(sizes, "length")
    last = (F.col("blocks") - 1).cast("int")
    asked = asked.select("length", F.col("ids").alias("query_ids"), F.col("vecs").alias("query_vecs"), F.explode(F.sequence(F.lit(0), last)).alias("block"))
    # Few, heavy rows: as many tasks as blocks, which no size of the data makes fewer.
    keys = ["length", "block"]
    met = asked.repartition(total, *keys).join(held.repartition(total, *keys), keys).sortWithinPartitions(*keys)
    found = met.mapInPandas(_search(k, settings), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
