"""Near-duplicate embeddings within a label: int8 tile products with error bounds, full precision where they leave doubt."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.llm.graph import components
from valuekit.llm.vectors import common_length, stacked, unit, usable
from valuekit.scale import attach, positions, settle

TILE = 1024
# Directions whose signs put vectors that lie together into the same tiles.
SIGNS = 12
# For rounding in the bounds themselves.
SLACK = 1e-9


def _tiles():
    """Pack one tile: ids, numbers of copies, vectors; its mean direction and the widest angle from it."""

    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        length = frame["length"].iloc[0]
        x = stacked(frame["vec"], length)
        u = unit(x)
        mean = u.sum(0)
        size = np.sqrt(mean @ mean)
        centre = mean / size if size > 0 else u[0]
        wide = float(np.arccos(np.clip(u @ centre, -1, 1)).max())
        blobs = frame["vec_id"].to_numpy("<i8").tobytes(), frame["copies"].to_numpy("<i8").tobytes(), x.astype("<f8").tobytes()
        row = (frame["label"].iloc[0], length, frame["tile"].iloc[0], *blobs, centre.tolist(), wide)
        return pd.DataFrame([row], columns=["label", "length", "tile", "ids", "copies", "vecs", "centre", "wide"])

    return pack


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes of unit vectors, their scales, the norms of what the codes stand for and the norms of the errors."""
    scale = np.abs(u).max(1) / 127
    codes = np.rint(u / scale[:, None]).astype(np.int8)
    stands = codes * scale[:, None]
    error = u - stands
    return codes, scale, np.sqrt(np.einsum("ij,ij->i", stands, stands)), np.sqrt(np.einsum("ij,ij->i", error, error))


def linked_pairs(u: np.ndarray, v: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) with ``u[i] . v[j] >= threshold``: only pairs that the bound can't rule out are computed in full."""
    a, a_scale, a_norm, a_error = quantised(u)
    b, b_scale, b_norm, b_error = quantised(v)
    # Sums of int8 products are whole numbers that the wider type holds exactly; as floats they run through BLAS.
    exact = np.float32 if u.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (a.astype(exact) @ b.astype(exact).T) * a_scale[:, None] * b_scale
    bound = product + a_norm[:, None] * b_error + a_error[:, None] + SLACK
    i, j = np.nonzero(bound >= threshold)
    keep = [np.einsum("ij,ij->i", u[p], v[q]) >= threshold for p, q in _parts(i, j)]
    keep = np.concatenate(keep) if keep else np.zeros(0, bool)
    return i[keep], j[keep]


def _parts(i: np.ndarray, j: np.ndarray, size: int = 1 << 16) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(0, len(i), size):
        yield i[k : k + size], j[k : k + size]


def _compare(threshold: float):
    """One row per vector of two tiles that has a link there: links to the other tile's vectors and their copies, and a hub."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                same = row.tile_a == row.tile_b
                ids = np.concatenate([np.frombuffer(b, "<i8") for b in (row.ids_a, row.ids_b)])
                copies = np.concatenate([np.frombuffer(b, "<i8") for b in (row.copies_a, row.copies_b)])
                u, v = (unit(np.frombuffer(b, "<f8").reshape(-1, row.length)) for b in (row.vecs_a, row.vecs_b))
                i, j = linked_pairs(u, v, threshold)
                if same:
                    i, j = i[i < j], j[i < j]
                j = j if same else j + len(u)
                count = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                hub = np.argsort(np.argsort(ids, kind="stable"), kind="stable")
                while True:
                    low = np.minimum(hub[i], hub[j])
                    before = hub.copy()
                    np.minimum.at(hub, i, low)
                    np.minimum.at(hub, j, low)
                    if (hub == before).all():
                        break
                some = np.flatnonzero(count)
                yield pd.DataFrame({"vec_id": ids[some], "links": count[some].astype(np.int64), "hub": np.sort(ids)[hub[some]]})

    return run


def near_duplicates(table: DataFrame, threshold: float = 0.93, tile: int = TILE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``(vec_id, embedding, label)``.

    Vectors of the same label link when their cosine, in double precision, is at least ``threshold``. ``n_links`` counts
    the other vectors linked directly, ``component_id`` is the smallest ``vec_id`` that links reach, ``kept`` says that it's the row's own. Every pair of a
    label is covered: exact copies are compared as one, the rest in pairs of tiles. Two tiles are skipped only if no angle between their vectors can be small
    enough. In a pair of tiles int8 codes give each cosine up to a bound made of the vectors' quantisation errors; a pair whose bound reaches the threshold is
    computed from the original numbers. A task puts out a row per vector, not per link.

    Vectors of different lengths don't link. Vectors that are null, zero or hold null or non-finite components link with nothing, and neither do
    rows without label or ``vec_id``; these come back with 0 links and themselves as component. Rows that repeat a ``vec_id`` are
    vectors of their own, each with its own links and component. Other columns don't matter; an empty table gives no rows.
    """
    length = common_length(table.filter(usable(F.col("embedding"))), "embedding")
    vec = F.col("embedding").cast("array<double>")
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vec.alias("vec"))
    takes = usable(F.col("vec")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    prints = F.xxhash64("vec").alias("fp_a"), F.xxhash64(F.lit("second"), "vec").alias("fp_b")
    part = rows.filter(takes).select("vec_id", "label", F.size("vec").alias("length"), "vec", *prints)
    group = ["label", "length"]
    classes = part.groupBy(*group, "fp_a", "fp_b").agg(
        F.min("vec_id").alias("first"), F.count("*").alias("copies"), F.any_value("vec").alias("vec")
    )
    rng = np.random.default_rng(7)
    signs = [rng.standard_normal(length) for _ in range(SIGNS)]

    def side(k: int):
        axis = F.slice(F.array(*[F.lit(float(x)) for x in signs[k]]), F.lit(1), F.size("vec"))
        terms = F.zip_with(F.slice("vec", 1, length), axis, lambda x, y: x * y)
        return F.when(F.aggregate(terms, F.lit(0.0), lambda x, y: x + y) > 0, 1 << k).otherwise(0)

    classes = settle(classes.withColumn("signs", sum((side(k) for k in range(SIGNS)), F.lit(0)) if length else F.lit(0)))
    # Classes go by their smallest id; where rows repeat an id with other vectors or labels, by their place in its order.
    plain = classes.groupBy("first").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    order = [F.col(c) for c in ("first", *group, "fp_a", "fp_b")]
    classes = classes.withColumn("number", F.col("first")) if plain else settle(positions(classes, [], order, "number"))
    # As many signs as make cells of about a tile; a cell that is larger all the same is dealt out by a hash.
    many = classes.groupBy(*group).agg(F.count("*").alias("n"))
    bits = F.least(F.lit(SIGNS), F.greatest(F.lit(0), F.floor(F.log2(F.col("n") / tile)))).cast("int")
    celled = attach(classes, many, group)
    celled = celled.withColumn("cell", F.col("signs").bitwiseAND((F.pow(F.lit(2), bits) - 1).cast("int")))
    cells = celled.groupBy(*group, "cell").agg(F.ceil(F.count("*") / tile).cast("int").alias("parts"))
    slot = F.pmod(F.xxhash64("number"), F.col("parts"))
    dealt = attach(celled, cells, [*group, "cell"]).select(
        F.col("number").alias("vec_id"), "copies", "vec", *group, F.xxhash64("cell", slot).alias("tile")
    )
    schema = f"label {dealt.schema['label'].dataType.simpleString()}, length int, tile long, ids binary, copies binary, vecs binary, centre array<double>, wide double"
    tiles = settle(dealt.groupBy(*group, "tile").applyInPandas(_tiles(), schema))
    brief = tiles.select(*group, "tile", "centre", "wide")
    other = brief.select(*group, *[F.col(c).alias(f"{c}_b") for c in ("tile", "centre", "wide")])
    pairs = brief.withColumnsRenamed({c: f"{c}_a" for c in ("tile", "centre", "wide")}).join(other, group).filter("tile_a <= tile_b")
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    apart = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot))) - F.col("wide_a") - F.col("wide_b")
    near = pairs.filter((F.col("tile_a") == F.col("tile_b")) | (apart <= float(np.arccos(threshold)) + 1e-6)).select(*group, "tile_a", "tile_b")
    packed = tiles.select(*group, "tile", "ids", "copies", "vecs")
    for end in "ab":
        near = near.join(packed.withColumnsRenamed({c: f"{c}_{end}" for c in ("tile", "ids", "copies", "vecs")}), [*group, f"tile_{end}"])
    # Few, heavy rows: deal them out evenly, a few to a batch.
    spread = near.repartition(F.xxhash64(*group, "tile_a", "tile_b"))
    found = settle(spread.mapInPandas(_compare(threshold), "vec_id long, links long, hub long"))
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("vec_id").alias("a"), F.col("hub").alias("b")))
    by_class = classes.select(*group, "fp_a", "fp_b", "number", "copies")
    by_class = by_class.join(links, by_class["number"] == links["vec_id"], "left").drop("vec_id")
    by_class = by_class.join(joined, by_class["number"] == joined["id"], "left").select(
        *group, "fp_a", "fp_b",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "number").alias("component_id"),
    )
    if not plain:
        smallest = classes.select(F.col("number").alias("component_id"), "first")
        by_class = by_class.join(smallest, "component_id").drop("component_id").withColumnRenamed("first", "component_id")
    inside = part.select("vec_id", *group, "fp_a", "fp_b").join(by_class, [*group, "fp_a", "fp_b"]).select("vec_id", "n_links", "component_id")
    outside = rows.filter(~F.coalesce(takes, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return inside.unionByName(outside).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
