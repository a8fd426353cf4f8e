import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuekit import scale
from valuekit.operators import windows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("max_bytes", [scale.BROADCAST_BYTES, 0])
def test_attach_small_and_hot(frame, monkeypatch, max_bytes):
    """A key with most rows, NULL keys and unknown keys give the same rows on both paths."""
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    keys = ["hot"] * 3000 + [f"k{i}" for i in range(2000)] + [None] * 5
    df = frame([(k, i) for i, k in enumerate(keys)], "k string, i int")
    dim = frame([("hot", 1.0), ("k1", 2.0), (None, 3.0), ("unused", 9.0)], "k string, v double")
    got = {(r.i, r.k): r.v for r in scale.attach(df, dim, ["k"], max_bytes).collect()}
    assert len(got) == len(keys)
    known = {"hot": 1.0, "k1": 2.0, None: 3.0}
    assert got == {(i, k): known.get(k) for i, k in enumerate(keys)}


def test_attach_keeps_hot_rows_out_of_the_shuffle(frame, monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 100)
    df = frame([("hot" if i % 3 else f"k{i}", i) for i in range(5000)], "k string, i int")
    dim = frame([("hot", 1)] + [(f"k{i}", i) for i in range(0, 5000, 3)], "k string, v int")
    text = plan(scale.attach(df, dim, ["k"], 0))
    assert "Union" in text and "BroadcastHashJoin" in text
    assert [r.k for r in scale.hot_keys(df, ["k"]).collect()] == ["hot"]
    assert "Union" not in plan(scale.attach(df, dim, ["k"], 0, split_hot=False))


def test_hot_keys_are_few(frame, monkeypatch):
    df = frame([(min(i % 50, i % 7),) for i in range(5000)], "k int")
    assert scale.hot_keys(df, ["k"]).isEmpty()
    monkeypatch.setattr(scale, "HOT_ROWS", 10)
    monkeypatch.setattr(scale, "HOT_KEYS", 2)
    top = [r.k for r in df.groupBy("k").count().orderBy(F.desc("count")).limit(2).collect()]
    assert sorted(r.k for r in scale.hot_keys(df, ["k"]).collect()) == sorted(top)


def test_settled_size(frame):
    table = scale.settle(frame([("abc", 1.0, ["x", "y"]), (None, None, None)], "a string, b double, c array<string>"))
    rows, size = scale.settled_size(table)
    assert rows == 2 and 30 < size < 200 and table.count() == 2
    empty = scale.settle(frame([], "a string"))
    assert scale.settled_size(empty) == (0, 0) and empty.count() == 0


@pytest.mark.parametrize("pairs", [1_000_000, 10])
def test_pair_off_makes_each_pair_once(frame, pairs):
    left = frame([("hot", f"l{i}") for i in range(40)] + [("a", "l"), ("only", "l")], "k string, l string")
    right = frame([("hot", i) for i in range(30)] + [("a", 1), ("none", 2)], "k string, r int")
    got = sorted(tuple(r) for r in scale.pair_off(left, right, ["k"], "l", "r", pairs).collect())
    assert got == sorted([("hot", f"l{i}", j) for i in range(40) for j in range(30)] + [("a", "l", 1)])


@pytest.mark.parametrize("swap", [False, True])
def test_pair_off_cuts_the_long_side(spark, swap):
    """One row meets 20,000: no task makes many more pairs than asked for."""
    one = spark.createDataFrame([("hot", "x")], "k string, l string")
    many = spark.range(20_000).select(F.lit("hot").alias("k"), F.col("id").alias("r"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scale.pair_off(many, one, ["k"], "r", "l", 1000) if swap else scale.pair_off(one, many, ["k"], "l", "r", 1000)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 20_000 and max(sizes) <= 6000


def test_positions_with_one_large_group_and_copies(spark):
    """One group holds most rows, many of them equal: numbers stay gapless and in order."""
    df = spark.range(20000).select(
        F.when(F.col("id") % 10 < 7, "big").otherwise(F.concat(F.lit("g"), F.col("id") % 13)).alias("g"),
        F.when(F.col("id") % 3 == 0, 5).otherwise(F.pmod(F.col("id") * 7919, F.lit(10007))).alias("v"),
    )
    rows = scale.positions(df, ["g"], [F.col("v")]).toPandas()
    assert len(rows) == 20000
    for _, part in rows.groupby("g"):
        part = part.sort_values("position")
        assert list(part["position"]) == list(range(1, len(part) + 1))
        assert part["v"].is_monotonic_increasing


def test_rank_has_no_window_over_raw_rows(frame):
    df = frame([("a", i) for i in range(100)], "g string, v int")
    assert "Window" not in plan(windows.rank_in(df, ["g"], [F.col("v")]))


def samples():
    rng = random.Random(5)
    return {
        "smooth": [rng.gauss(0, 1) for _ in range(4001)],
        "ties_at_ends": [0.0] * 1500 + [1.0] * 1500 + [rng.random() for _ in range(501)],
        "two_values": [0.0] * 1000 + [1.0] * 1000,
        "heavy_tail": [10 ** rng.uniform(-9, 9) for _ in range(3000)],
        "constant": [7.0] * 100,
        "one": [3.5],
        "between_two": [1.0, 2.0],
        "mostly_null": [None] * 500 + [1.0, 5.0, 6.0],
    }


@pytest.mark.parametrize("limit", [scale.MEDIAN_VALUES, 20])
def test_medians_match_numpy(frame, limit):
    """The narrowing path (tiny limit) and the built-in one give numpy's median, per group and overall."""
    data = samples()
    rows = [(g, v, None if v is None else v * 3 - 1) for g, vs in data.items() for v in vs]
    df = frame(rows, "g string, a double, b double")
    got = {r.g: (r.a, r.b) for r in scale.medians(df, ["a", "b"], ["g"], limit).collect()}
    for g, vs in data.items():
        known = [v for v in vs if v is not None]
        assert got[g] == pytest.approx((np.median(known), np.median([v * 3 - 1 for v in known])), rel=1e-12)
    everything = [v for vs in data.values() for v in vs if v is not None]
    assert scale.medians(df, ["a"], limit=limit).first().a == pytest.approx(np.median(everything), rel=1e-12)


def test_modes_break_ties_to_the_smallest(frame):
    df = frame([("x", "b", None), ("x", "a", None), ("x", None, None), ("y", "b", "q"), ("y", "b", "p"), ("y", "a", "q")], "g string, a string, c string")
    got = {r.g: (r.a, r.c) for r in scale.modes(df, ["a", "c"], ["g"]).collect()}
    assert got == {"x": ("a", None), "y": ("b", "q")}


def test_scratch_leaves_nothing_behind(spark, tmp_path):
    from pathlib import Path

    from valuekit.session import fresh_path, scratch, shared_folder

    kept = scale.settle(spark.range(3))
    before = set(Path(shared_folder(spark)).iterdir())
    with scratch(spark):
        table = scale.settle(spark.range(10))
        with scratch(spark):
            inner = fresh_path(spark)
            scale.settle(spark.range(5)).write.parquet(inner)
        assert not Path(inner).exists() and table.count() == 10
        table.write.parquet(str(tmp_path / "out"))
    assert set(Path(shared_folder(spark)).iterdir()) == before and kept.count() == 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    with pytest.raises(ZeroDivisionError), scratch(spark):
        scale.settle(spark.range(10))
        raise ZeroDivisionError
    assert set(Path(shared_folder(spark)).iterdir()) == before


def test_medians_of_few_distinct_values_are_read_off_counts(frame, monkeypatch):
    """A group beyond the limit with few distinct values takes one pass, not a search by sketches."""
    monkeypatch.setattr(scale, "_medians_by_sketch", None)
    rng = np.random.default_rng(4)
    values = [(g, float(a), None if b % 3 == 0 else float(b)) for g, n in (("big", 999), ("even", 200), (None, 5)) for a, b in rng.integers(0, 12, (n, 2)).tolist()]
    df = frame([*values, ("none", None, None)], "g string, a double, b double")
    got = {r.g: (r.a, r.b) for r in scale.medians(df, ["a", "b"], ["g"], 100).collect()}
    middle = lambda xs: float(np.median(xs)) if xs else None
    for g in ("big", "even", None, "none"):
        assert got[g] == tuple(middle([v[k] for v in values if v[0] == g and v[k] is not None]) for k in (1, 2))
    assert scale.medians(df, ["a"], limit=100).first().a == np.median([v[1] for v in values])


def test_lookup_holds_no_side_in_a_hash_table(spark):
    """A side that compresses well is small by its shuffled bytes and large in a broadcast: 200,000 numbered names."""
    numbered = spark.range(200_000).select(F.format_string("Name#%09d", "id").alias("k"), "id")
    joined = scale.lookup(numbered.select("k").distinct(), numbered, ["k"])
    assert joined.filter("id IS NULL").count() == 0 and joined.count() == 200_000
    joined.collect()
    assert "SortMergeJoin" in plan(joined) and "BroadcastHashJoin" not in plan(joined)
