"""Building blocks that keep the operators exact when one group holds a large share of all rows.

* ``settle``      - write a table once to the shared folder, so that it is fixed and its size is known
* ``attach``      - many-to-one left join: broadcast only after a size check, hot keys split off otherwise
* ``pair_off``    - many-to-many join that cuts keys with too many pairs into slices
* ``positions``   - row numbers inside groups of any size, by range partitioning instead of a window
* ``medians``     - exact medians per group; sketches narrow the range of groups too large to hold
* ``modes``       - most frequent value per group by counting in two steps
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.session import fresh_path

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 500_000
# A key with more than HOT_ROWS rows is hot, if it is among the HOT_KEYS most frequent ones.
HOT_KEYS = 1000
HOT_ROWS = 100_000
# Values (rows times columns) of one group that a task may hold for medians.
MEDIAN_VALUES = 2_000_000
# Pairs under one key that a task may make in a join that pairs rows off.
PAIRS_PER_TASK = 1_000_000
SKETCH_ACCURACY = 10_000
SKETCH_CUTS = 512


_SIZES: WeakKeyDictionary[DataFrame, tuple[int, int]] = WeakKeyDictionary()


def col(name: str) -> Column:
    """Column by exact name; names may hold spaces, signs or a leading digit."""
    return F.col(f"`{name}`")


def _width(field: T.StructField) -> Column:
    """Bytes of one cell in memory, roughly."""
    if isinstance(field.dataType, T.AtomicType) and not isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.lit(8)
    return F.coalesce(F.octet_length(col(field.name).cast("string")), F.lit(0)) + 16


def known(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows in which none of the columns is NULL, as plain filters that reach the scan."""
    return df.filter(reduce(and_, [col(c).isNotNull() for c in columns], F.lit(True)))


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back; its size is observed on the way."""
    path = fresh_path(df.sparkSession)
    seen = Observation()
    width = sum((_width(f) for f in df.schema.fields), F.lit(0)).cast("long")
    df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _SIZES[table] = (seen.get.get("n") or 0, seen.get.get("size") or 0)
    return table


def settled_size(table: DataFrame) -> tuple[int, int]:
    """Rows and bytes of a table that ``settle`` returned."""
    return _SIZES[table]


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys equal each other; the right side's keys are dropped."""
    renamed = {k: f"__key_{i}" for i, k in enumerate(keys)}
    side = right.select([col(c).alias(renamed.get(c, c)) for c in right.columns])
    joined = left.join(side, reduce(and_, [col(k).eqNullSafe(col(r)) for k, r in renamed.items()]), how)
    return joined.drop(*renamed.values())


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The ``HOT_KEYS`` most frequent keys, of those with more than ``HOT_ROWS`` rows.

    Any other key holds at most ``1/HOT_KEYS`` of the rows or few rows altogether.
    """
    counts = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("__n")).filter(F.col("__n") > HOT_ROWS)
    return settle(counts.orderBy(F.desc("__n")).limit(HOT_KEYS).drop("__n"))


def attach(
    df: DataFrame, dim: DataFrame, keys: Sequence[str], max_bytes: int = BROADCAST_BYTES, split_hot: bool = True
) -> DataFrame:
    """Left join ``dim`` (one row per key) to ``df`` without ever routing a hot key to one task.

    A small ``dim`` is broadcast. A large one is joined by shuffle, but the rows of hot keys are first
    split off and served from a broadcast of those keys alone. That reads ``df`` more than once; callers
    whose keys are unique in ``df`` turn it off with ``split_hot``.
    """
    table = dim if dim in _SIZES else settle(dim)
    rows, size = settled_size(table)
    if rows <= BROADCAST_ROWS and size <= max_bytes:
        return null_safe_join(df, F.broadcast(table), keys, "left")
    hot = hot_keys(df, keys) if split_hot else None
    if hot is None or settled_size(hot)[0] == 0:
        return null_safe_join(df, table, keys, "left")
    hot_dim = null_safe_join(F.broadcast(hot), table, keys, "left")
    hot_rows = null_safe_join(df, F.broadcast(settle(hot_dim)), keys, "inner")
    cold_rows = null_safe_join(null_safe_join(df, F.broadcast(hot), keys, "left_anti"), table, keys, "left")
    return hot_rows.unionByName(cold_rows)


def lookup(df: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join ``dim`` (one row per key) without writing it first, for tables of distinct keys.

    The join merges sorted partitions, which can spill, and adaptive execution splits one that a hot key has filled. Left to itself it would broadcast a side
    by its shuffled bytes, and keys that compress well (numbered names) take some fifty times as much in a hash table.
    """
    return null_safe_join(df, dim.hint("merge"), keys, "left")


def pair_off(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: str, other: str, pairs: int = PAIRS_PER_TASK
) -> DataFrame:
    """Inner join of sides that both repeat keys, for scores that need every pair of a key.

    Both sides should be reduced to distinct values first. A key with more than ``pairs`` pairs is cut on both sides by a hash of
    ``spread`` (left) and ``other`` (right), each into so many slices that the squares they form hold about ``pairs`` pairs; a row is
    repeated once per slice of the other side. Each pair still occurs exactly once, but no task has to make all
    pairs of one key, also if one side has a single row.
    """
    on = list(keys)
    n_left = left.groupBy(*[col(k) for k in on]).agg(F.count("*").alias("__left"))
    n_right = right.groupBy(*[col(k) for k in on]).agg(F.count("*").alias("__right"))
    edge = F.sqrt(F.lit(float(pairs)))
    # A side shorter than the edge stays whole, and the other one is cut by that much more.
    slices = [
        F.greatest(F.lit(1), F.ceil(F.col(a) / F.greatest(edge, F.lit(float(pairs)) / F.col(b)))).cast("int").alias(name)
        for a, b, name in (("__left", "__right", "__cut_left"), ("__right", "__left", "__cut_right"))
    ]
    many = n_left.join(n_right, on).filter(F.col("__left") * F.col("__right") > pairs)
    heavy = settle(many.select(*[col(k) for k in on], *slices))
    if settled_size(heavy)[0] == 0:
        return left.join(right, on)

    def cut(side: DataFrame, by: str, mine: str, theirs: str) -> DataFrame:
        own = F.pmod(F.xxhash64(col(by)), F.coalesce(f"__cut_{mine}", F.lit(1))).cast("int").alias(f"__{mine}")
        met = F.explode(F.sequence(F.lit(0), F.coalesce(f"__cut_{theirs}", F.lit(1)) - 1)).alias(f"__{theirs}")
        return attach(side, heavy, on).select(*[col(c) for c in side.columns], own, met)

    return cut(left, spread, "left", "right").join(cut(right, other, "right", "left"), [*on, "__left", "__right"]).drop("__left", "__right")


def positions(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "position") -> DataFrame:
    """1-based position of each row inside its group, in ``order``.

    The rows are range-partitioned by group and order, so a large group spans many tasks; each slice
    then starts after the rows its group has in earlier slices. The input partition is the last sort
    key: equal rows may take any order among themselves but do not pile up in one slice.
    """
    keys = [col(k) for k in by]
    source = df.withColumn("__from", F.spark_partition_id())
    order = [*keys, *order, F.col("__from")]
    ranged = source.repartitionByRange(*order).sortWithinPartitions(*order).drop("__from")
    table = settle(ranged.withColumn("__slot", F.monotonically_increasing_id()))
    table = table.withColumn("__slice", F.shiftright("__slot", 33))
    slices = table.groupBy(*keys, "__slice").agg(F.min("__slot").alias("__first"), F.count("*").alias("__rows"))
    earlier = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__before", F.coalesce(F.sum("__rows").over(earlier), F.lit(0))).drop("__rows")
    placed = attach(table, slices, [*by, "__slice"])
    place = F.col("__before") + F.col("__slot") - F.col("__first") + 1
    return placed.withColumn(name, place).drop("__slot", "__slice", "__first", "__before")


def long_form(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One row per group key and non-NULL cell: ``(*by, __column, __value)``."""
    cells = F.array(*[F.struct(F.lit(c).alias("__column"), col(c).alias("__value")) for c in columns])
    flat = df.select(*[col(k) for k in by], F.explode(cells).alias("__cell")).select(
        *[col(k) for k in by], "__cell.__column", "__cell.__value"
    )
    return flat.filter(F.col("__value").isNotNull())


def wide_form(df: DataFrame, by: Sequence[str], columns: Sequence[str], value: str) -> DataFrame:
    """Inverse of ``long_form`` for one value per group and column."""
    picks = [F.max(F.when(F.col("__column") == c, F.col(value))).alias(c) for c in columns]
    return df.groupBy(*[col(k) for k in by]).agg(*picks)


def medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), limit: int = MEDIAN_VALUES) -> DataFrame:
    """Exact, interpolated median of each column per group (NULLs ignored).

    Groups up to ``limit`` values (all columns together) use the built-in exact median. Beyond that the middle rank is read off counted
    values, if no group has more than about ``limit`` distinct ones: one pass, combined before the shuffle. Else the middle of every group is
    narrowed with quantile sketches until at most ``limit`` distinct values remain. All are exact, with no task holding a whole group.
    """
    keys = [col(k) for k in by]
    doubles = df.select(*keys, *[col(c).cast("double").alias(c) for c in columns])
    distinct = [F.approx_count_distinct(col(c)) for c in columns]
    sizes = doubles.groupBy(*keys).agg(F.count("*").alias("n"), F.greatest(F.lit(0), *distinct).alias("d")).agg(F.max("n"), F.max("d")).first()
    if (sizes[0] or 0) * len(columns) <= limit:
        return doubles.groupBy(*keys).agg(*[F.median(col(c)).alias(c) for c in columns])
    if sizes[1] <= limit:
        return _medians_by_count(doubles, list(columns), list(by))
    return _medians_by_sketch(doubles, list(columns), list(by), limit)


def _medians_by_count(df: DataFrame, columns: list[str], by: list[str]) -> DataFrame:
    keys = [col(k) for k in [*by, "__column"]]
    counted = long_form(df, by, columns).groupBy(*keys, "__value").agg(F.count("*").alias("__times"))
    group = Window.partitionBy(*keys)
    ranked = counted.withColumns({"__n": F.sum("__times").over(group), "__upto": F.sum("__times").over(group.orderBy("__value"))})
    middle = ranked.groupBy(*keys).agg(_middle(F.col("__n")).alias("__median"))
    found = wide_form(middle, by, columns, "__median")
    return null_safe_join(df.select(*[col(k) for k in by]).distinct(), found, by, "left") if by else found


def _middle(n: Column) -> Column:
    """Median of ``n`` values, over rows of distinct values with the number of values up to each."""
    value, start, upto = F.col("__value"), F.col("__upto") - F.col("__times"), F.col("__upto")
    covers = lambda rank: F.max(F.when((rank >= start) & (rank < upto), value))
    return (covers(F.floor((n - 1) / 2)) + covers(F.floor(n / 2))) / 2


def _medians_by_sketch(df: DataFrame, columns: list[str], by: list[str], limit: int) -> DataFrame:
    group = [*by, "__column"]
    keys = [col(k) for k in group]
    flat = settle(long_form(df, by, columns))
    ends = settle(
        flat.groupBy(*keys).agg(
            F.count("*").alias("__n"), F.min("__value").alias("__lo"), F.max("__value").alias("__hi")
        )
    )
    value, low, high = F.col("__value"), F.col("__lo"), F.col("__hi")
    previous = None
    while True:
        ranged = attach(flat, ends, group)
        # The ends may repeat without limit but are one value each; only what lies between them counts.
        between = F.count(F.when((value > low) & (value < high), 1)).alias("n")
        widest = ranged.groupBy(*keys).agg(between).agg(F.max("n")).first()[0] or 0
        if widest <= limit or widest == previous:
            break
        previous = widest
        ends = settle(_narrow(flat, ends, group))
    inside = ranged.filter(value.between(low, high))
    below = attach(flat, ends, group).groupBy(*keys).agg(F.count(F.when(value < low, 1)).alias("__below"))
    counted = inside.groupBy(*keys, "__n", "__value").agg(F.count("*").alias("__times"))
    running = Window.partitionBy(*keys).orderBy("__value")
    ranked = attach(counted, below, group).withColumn("__upto", F.col("__below") + F.sum("__times").over(running))
    middle = ranked.groupBy(*keys).agg(_middle(F.col("__n")).alias("__median"))
    # Groups without any value have no cells; they come back with NULLs, as from the built-in.
    found = wide_form(middle, by, columns, "__median")
    return null_safe_join(df.select(*[col(k) for k in by]).distinct(), found, by, "left") if by else found


def _narrow(flat: DataFrame, ends: DataFrame, group: list[str]) -> DataFrame:
    """Tighter ends around both middle ranks. Sketches propose them; exact counts decide which to take."""
    keys = [col(k) for k in group]
    value, low, high = F.col("__value"), F.col("__lo"), F.col("__hi")
    first_rank, last_rank = F.floor((F.col("__n") - 1) / 2), F.floor(F.col("__n") / 2)
    between = F.when((value > low) & (value < high), value)
    shares = [i / SKETCH_CUTS for i in range(1, SKETCH_CUTS)]
    seen = attach(flat, ends, group).groupBy(*keys, "__n", "__lo", "__hi").agg(
        F.count(F.when(value <= low, 1)).alias("__upto_lo"),
        F.count(between).alias("__between"),
        F.percentile_approx(between, shares, SKETCH_ACCURACY).alias("__cuts"),
    )
    at = F.floor((first_rank - F.col("__upto_lo")) * SKETCH_CUTS / F.nullif(F.col("__between"), F.lit(0))).cast("int")
    cut_low = F.when(at >= 2, F.get("__cuts", at - 2)).otherwise(low)
    cut_high = F.when(at <= SKETCH_CUTS - 4, F.get("__cuts", F.greatest(at, F.lit(0)) + 2)).otherwise(high)
    in_low = last_rank < F.col("__upto_lo")
    in_high = first_rank >= F.col("__upto_lo") + F.col("__between")
    proposed = seen.select(
        *keys, "__n", "__lo", "__hi",
        F.when(in_low, low).when(in_high, high).otherwise(F.coalesce(cut_low, low)).alias("__cut_lo"),
        F.when(in_low, low).when(in_high, high).otherwise(F.coalesce(cut_high, high)).alias("__cut_hi"),
    )
    tried = attach(flat, proposed, group).groupBy(*keys, "__n", "__lo", "__hi", "__cut_lo", "__cut_hi").agg(
        F.count(F.when(value < F.col("__cut_lo"), 1)).alias("__under"),
        F.count(F.when(value <= F.col("__cut_hi"), 1)).alias("__upto"),
    )
    return tried.select(
        *keys, "__n",
        F.when(F.col("__under") <= first_rank, F.col("__cut_lo")).otherwise(low).alias("__lo"),
        F.when(F.col("__upto") > last_rank, F.col("__cut_hi")).otherwise(high).alias("__hi"),
    )


def modes(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Most frequent text per column and group, ties to the smallest."""
    keys = [col(k) for k in [*by, "__column"]]
    counted = long_form(df, by, columns).groupBy(*keys, "__value").agg(F.count("*").alias("__times"))
    best = counted.groupBy(*keys).agg(
        F.min_by("__value", F.struct(-F.col("__times"), F.col("__value"))).alias("__mode")
    )
    return wide_form(best, by, columns, "__mode")
