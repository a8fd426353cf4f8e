"""Mix sources to target weights by Poisson replication and a global shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.scale import attach, col

# A mean above this is split into equal parts with a draw each: a sum of Poisson counts is a Poisson count.
MEAN_PER_DRAW = 64.0


def _uniform(*parts: Column) -> Column:
    """In (0, 1), from 52 bits of an MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))


def shuffle_key(*parts: Column) -> Column:
    """60 bits of an MD5 of the parts, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def _distribution(mean: Column) -> Column:
    """``P(X <= k)`` for k = 0, 1, ... until nothing is left that a double could tell."""
    last = F.ceil(mean + 12 * F.sqrt(mean) + 20).cast("int")
    first = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("upto"))

    def step(seen: Column, k: Column) -> Column:
        p = seen["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(seen["upto"], F.array(F.element_at(seen["upto"], -1) + p)).alias("upto"))

    return F.aggregate(F.sequence(F.lit(1), last), first, step)["upto"]


def source_rates(docs: DataFrame, weights: Mapping[str, float] | None, tempering: float, epochs: float, by: str) -> DataFrame:
    """``(source, __mean, __draws, __upto)``: the mean repetition rate of a source's documents and what draws need."""
    size = F.greatest(F.sum(F.coalesce(F.char_length("text"), F.lit(0))), F.lit(1)).cast("double")
    sizes = docs.groupBy(col(by)).agg(size.alias("__size"))
    if weights is None:
        weight = F.pow("__size", F.lit(float(tempering)))
    else:
        pairs = [F.lit(x) for name, value in weights.items() for x in (name, float(value))]
        weight = F.coalesce(F.create_map(*pairs)[col(by)], F.lit(0.0)) if pairs else F.lit(0.0)
    weighed = sizes.withColumn("__weight", weight)
    totals = weighed.agg(F.sum("__size").alias("all"), F.sum("__weight").alias("weights")).first()
    share = F.col("__weight") / F.lit(totals["weights"] or 1.0)
    mean = share * F.lit(float(epochs) * (totals["all"] or 0.0)) / F.col("__size")
    rates = weighed.select(col(by), mean.alias("__mean"))
    rates = rates.withColumn("__draws", F.greatest(F.ceil(F.col("__mean") / MEAN_PER_DRAW), F.lit(1)).cast("int"))
    return rates.withColumn("__upto", _distribution(F.col("__mean") / F.col("__draws")))


def mix_sources(
    docs: DataFrame, weights: Mapping[str, float] | None = None, tempering: float = 0.7, epochs: float = 1.0,
    seed: int = 0, by: str = "source", key: str = "doc_id",
) -> DataFrame:
    """Each document as often as its source's target asks, in a random order over everything.

    A source's share of the output, in characters, is its share of ``weights``; without them it is its size to the power
    ``tempering``. The output holds ``epochs`` times the input's characters in expectation. A document occurs ``n`` times, where ``n``
    inverts a Poisson distribution, whose mean is its source's target size over its size, at a uniform number hashed from ``seed`` and ``key``.
    The copies are numbered in ``copy`` (from 1); ``n_copies`` holds ``n``. The rows are range partitioned and sorted by ``shuffle_key``,
    a hash of seed, key and copy, so files written from them hold a global shuffle. Columns of these three names are replaced.

    A null source is a source of its own. One that ``weights`` leaves out is dropped, as its target is zero. Rows that
    repeat a key share its draw, and so does every row with a null key. Null and empty texts have size 0 but are drawn like any other. An empty table
    stays empty.
    """
    rates = source_rates(docs, weights, tempering, epochs, by)
    named = col(key).cast("string")
    drawn = attach(docs.drop("copy", "n_copies", "shuffle_key"), rates, [by])
    draws = F.transform(
        F.sequence(F.lit(1), F.col("__draws")),
        lambda j: F.size(F.filter("__upto", lambda c: c < _uniform(F.lit(f"draw:{seed}"), named, j.cast("string")))),
    )
    counted = drawn.withColumn("n_copies", F.aggregate(draws, F.lit(0), lambda a, b: a + b)).drop("__mean", "__draws", "__upto")
    copies = counted.filter("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    placed = copies.withColumn("shuffle_key", shuffle_key(F.lit(f"order:{seed}"), named, F.col("copy").cast("string")))
    order = [F.col("shuffle_key"), col(key), F.col("copy")]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order)
