import math

import pytest
from pyspark.sql import functions as F

from valuekit.functions import numbers
from valuekit.functions.features import diff, features, ratio, total, weighted
from valuekit.operators import clean, collapse, impute, quality, schema, windows
from valuekit.plans import players


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def one(df):
    return df.first().asDict()


def test_flatten_and_normalize_names(frame):
    levels = [("Unnamed", "Player"), ("Per 90 Minutes", "Gls "), ("", "Squad"), ("nan", "Age")]
    assert schema.flatten_names(levels) == ["Unnamed_Player", "Per 90 Minutes_Gls", "Squad", "Age"]
    df = frame([(1, 2)], "`Goals Per 90` int, Squad int")
    assert schema.normalize_names(df).columns == ["goals_per_90", "squad"]


def test_positional_rename(frame):
    df = frame([(1, 2, 3)], "a int, b int, c int")
    assert one(schema.positional_rename(df, ["x", "90s_+"])) == {"x": 1, "90s_+": 2}
    with pytest.raises(ValueError):
        schema.positional_rename(df, list("wxyz"))
    same = df.select(F.col("a"), F.col("b").alias("a"))
    assert one(schema.positional_rename(same, ["p", "q"])) == {"p": 1, "q": 2}


def test_rename_only_if_absent(frame):
    assert schema.rename_if_absent(frame([("a",)], "nation string"), "nation", "country_code").columns == ["country_code"]
    both = frame([("a", "b")], "nation string, country_code string")
    assert schema.rename_if_absent(both, "nation", "country_code").columns == both.columns


def test_to_number(frame):
    cases = {"12": 12.0, " 1.5 ": 1.5, "1e3": 1000.0, "-.5": -0.5, "1d": None, "2,700": None, "25-123": None, "nan": None, "": None, "inf": math.inf, None: None, "0x1": None}
    df = frame(list(enumerate(cases)), "i int, v string")
    assert [r.n for r in df.select("i", numbers.to_number(F.col("v")).alias("n")).orderBy("i").collect()] == list(cases.values())
    floats = schema.coerce_numeric(frame([(math.nan,), (2.0,)], "v double"), ["v", "absent"])
    assert [r.v for r in floats.collect()] == [None, 2.0]


def test_clean_code(frame):
    df = frame([("eng ENG",), ("  fra",), ("Nation",), (None,)], "c string")
    assert [r.c for r in df.select(numbers.clean_code(F.col("c")).alias("c")).collect()] == ["ENG", "FRA", None, None]


def test_round_half_even_like_numpy(frame):
    import numpy as np

    values = [0.125, 0.375, 2.675, -0.125, 1e6 + 0.005, 3.14159]
    df = frame([(v,) for v in values], "v double")
    assert [r.v for r in df.select(numbers.round_half_even(F.col("v")).alias("v")).collect()] == list(np.round(values, 2))


def test_is_missing(frame):
    values = ["", " N/A ", "na", "NULL", "None", "nan", "-", "0", "x", None]
    df = frame([(v,) for v in values], "v string")
    assert [r.m for r in df.select(numbers.is_missing(F.col("v")).alias("m")).collect()] == [True] * 7 + [False, False, True]
    nums = frame([(math.nan,), (0.0,), (None,)], "v double")
    assert [r.m for r in nums.select(numbers.is_missing(F.col("v")).alias("m")).collect()] == [True, False, True]


def test_types_and_value_column(frame):
    df = frame([("a", 1, 2.0)], "player string, n int, `Market Value` double")
    assert schema.numeric_columns(df) == ["n", "Market Value"] and schema.text_columns(df) == ["player"]
    assert schema.resolve_value_column(df.columns) == "Market Value"
    assert schema.resolve_value_column(["x", "value_of_market", "market_value"]) == "market_value"
    assert schema.resolve_value_column(["x", "The Market Book Value"]) == "The Market Book Value"
    assert schema.resolve_value_column(["x"]) is None
    with pytest.raises(ValueError, match="goals"):
        schema.require_columns(df, ["player", "goals"])


def test_dedupe_limits_before_the_shuffle(frame):
    df = frame([("a", 2, "late"), ("a", 1, "early"), ("b", 1, "only"), (None, 1, "null")], "k string, o int, v string")
    first = clean.dedupe_first(df, ["k"], [F.col("o")])
    assert {(r.k, r.v) for r in first.collect()} == {("a", "early"), ("b", "only"), (None, "null")}
    text = plan(clean.dedupe_first(df, ["k"], [F.col("o")]))
    before, after = text.split("Exchange")[:2]
    assert "WindowGroupLimit" in before and "WindowGroupLimit" in after


def test_group_first_takes_each_column_on_its_own(frame):
    df = frame([("a", 1, None, "x"), ("a", 2, 5, None), ("a", 3, 6, "y"), (None, 1, 1, "z")], "k string, o int, n int, s string")
    assert clean.group_first(df, ["k"], [F.col("o")]).select("k", "n", "s").collect() == [("a", 5, "x")]


def test_header_rows_ranges_and_rejects(frame):
    df = frame([("Player", 1.0), ("Bo", 16.0), (None, 45.0), ("Al", 46.0), ("Cy", None)], "player string, age double")
    kept = clean.drop_header_rows(df, "player")
    assert kept.count() == 4
    assert [r.age for r in clean.range_filter(kept, {"age": (16, 45), "goals": (0, None)}).collect()] == [16.0, 45.0]
    good, bad = clean.reject_rows(df, F.col("age") > 15)
    assert (good.count(), bad.count()) == (3, 2)


def test_collapse_rules(frame):
    rows = [
        ("p", 2.0, 10.0, "B", "MF, FW", "x"), ("p", 1.0, 40.0, "A", "DF/MF", "x"),
        ("zero", 0.0, 1.0, None, None, None), ("zero", 0.0, 4.0, None, None, None),
        ("gap", None, 8.0, "A", "", "y"), ("gap", 1.0, None, "A", " ,", "z"),
        ("none", 1.0, None, "A", "GK", "y"), (None, 1.0, 1.0, "A", "GK", "y"),
    ]
    df = frame(rows, "player string, w double, v double, squad string, position string, note string")
    policy = {"w": "sum", "v": "wmean", "squad": "join_blank", "position": "tokens", "note": "join"}
    got = {r.player: tuple(r)[1:] for r in collapse.collapse(df, ["player"], "w", policy).collect()}
    assert got == {
        "p": (3.0, 20.0, "A/B", "DF, FW, MF", "x"), "zero": (0.0, 2.5, "", "", None),
        "gap": (1.0, None, "A", "", "y/z"), "none": (1.0, None, "A", "GK", "y"),
    }
    skip = {r.player: r.v for r in collapse.collapse(df, ["player"], "w", {"v": "wmean"}, nulls="skip").collect()}
    assert skip == {"p": 20.0, "zero": 2.5, "gap": 8.0, "none": None}
    unweighted = {r.player: r.v for r in collapse.collapse(df, ["player"], "absent", {"v": "wmean"}).collect()}
    assert unweighted["p"] == 25.0


def test_sum_policy_of_merged_duplicates(frame):
    rows = [("Player1", "Team A", 25, 15, 1350, 5, 2, "2020-21", 1), ("Player1", "Team A", 25, 15, 1350, 5, 3, "2020-21", 2), ("Player2", "Team B", 27, 28, 2520, 5, 8, "2020-21", 3)]
    df = frame(rows, "player string, squad string, age int, matches_played int, minutes_played int, goals int, assists int, season string, seq int")
    policy = {"squad": "first", "age": "first", "matches_played": "sum", "minutes_played": "sum", "goals": "sum", "assists": "sum"}
    merged = collapse.collapse(df, ["player", "season"], None, policy, order=[F.col("seq")])
    first = merged.filter("player = 'Player1'").first()
    assert merged.count() == 2 and (first.goals, first.assists, first.matches_played, first.minutes_played) == (10, 5, 30, 2700)


def test_sparse_and_imputation_per_group(frame):
    """Column b is absent in group y only; a group of three rows loses nothing."""
    rows = [("x", float(i), float(i) if i % 2 else None, "q" if i < 3 else None) for i in range(10)]
    rows += [("y", float(i), 1.0 if i == 0 else None, "r") for i in range(10)]
    rows += [("z", None, None, None)] * 3
    df = frame(rows, "g string, a double, b double, t string")
    masked = impute.drop_sparse(df, 0.3, ["g"], ["a", "b", "t"])
    absent = {r.g: r.absent_columns for r in masked.select("g", clean.ABSENT).distinct().collect()}
    assert absent == {"x": [], "y": ["b"], "z": []}
    filled = impute.impute(masked, ["a", "b"], ["t"], ["g"])
    done = clean.fill_zero(filled)
    got = {(r.g, r.b) for r in done.select("g", "b").collect()}
    assert got == {("x", float(i)) for i in (1, 3, 5, 7, 9)} | {("y", None), ("z", 0.0)}
    assert {(r.g, r.t) for r in done.select("g", "t").collect()} == {("x", "q"), ("y", "r"), ("z", None)}
    whole = impute.drop_sparse(df, 0.7)
    assert whole.columns == ["g", "a"]
    overall = impute.impute(df, ["a"], ["t"])
    assert overall.filter("a IS NULL OR t IS NULL").count() == 0
    assert overall.filter("g = 'z'").first().a == 4.5 and overall.filter("g = 'z'").first().t == "r"


def test_feature_specs(frame):
    df = frame([(1.0, 2.0, 0.0)], "`a+b` double, c double, `0s` double")
    made = features(df, {"r": ratio("a+b", "c"), "z": ratio("c", "0s"), "d": diff(total("a+b", "c"), "0s"), "w": weighted({"c": 3}), "no": ratio("c", "gone")})
    assert one(made) == {"a+b": 1.0, "c": 2.0, "0s": 0.0, "r": 0.5, "z": None, "d": 3.0, "w": 6.0}


STATS = {
    "matches_played": 10.0, "starts": 8.0, "minutes_played": 720.0, "90s_played": 8.0, "goals": 6.0, "assists": 2.0,
    "expected_goals": 4.0, "expected_assists": 4.0, "penalty_kicks_made": 1.0, "penalty_kicks_attempted": 2.0, "yellow_cards": 3.0,
    "red_cards": 1.0, "goals_per_90": 0.75, "assists_per_90": 0.25, "xg_per_90": 0.5, "xag_per_90": 0.5, "goals_+_assists_per_90": 1.0,
    "xg_+_xag_per_90": 1.25, "goals_+_assists_-_penalties_per_90": 0.875, "non-penalty_xg_+_xag_per_90": 0.5,
    "progressive_carries": 20.0, "progressive_passes": 30.0, "progressive_receives": 50.0,
}
EXPECTED = {
    "minutes_per_match": 72.0, "minutes_played_ratio": 0.8, "start_rate": 0.8, "nineties_per_match": 0.8, "goal_overperformance": 2.0,
    "assist_overperformance": -2.0, "overall_overperformance": 0.0, "assist_to_goal_ratio": 1 / 3, "penalty_conversion_rate": 0.5,
    "discipline_score": 6.0, "finishing_efficiency": 1.5, "assisting_efficiency": 0.5, "overall_efficiency": 1.0, "goal_ratio": 0.75,
    "per90_goal_diff": 0.25, "conversion_rate_per90": 1.5, "per90_assist_diff": -0.25, "assist_conversion_per90": 0.5,
    "per90_overall_diff": -0.25, "non_penalty_overperformance": 0.375, "penalty_impact": 0.125, "progressive_total": 100.0,
    "progressive_actions_per_match": 10.0, "progressive_carries_ratio": 0.2, "progressive_passes_ratio": 0.3, "progressive_receives_ratio": 0.5,
}


def test_all_player_features_by_hand(frame):
    schema_text = ", ".join(f"`{c}` double" for c in STATS)
    df = frame([tuple(STATS.values()), tuple(0.0 for _ in STATS)], schema_text)
    full, zero = features(df, players.ADVANCED).orderBy(F.desc("matches_played")).collect()
    assert {k: full[k] for k in EXPECTED} == pytest.approx(EXPECTED) and set(players.ADVANCED) == set(EXPECTED)
    ratios = [k for k in EXPECTED if k.endswith(("ratio", "rate", "efficiency", "match", "per90")) or "ratio" in k]
    assert all(zero[k] is None for k in ratios)
    assert zero["discipline_score"] == 0.0 and zero["goal_overperformance"] == 0.0


def test_features_stay_in_one_projection(frame):
    df = frame([tuple(STATS.values())], ", ".join(f"`{c}` double" for c in STATS))
    assert plan(features(df, players.ADVANCED)).count("Project [") <= 2


def test_quality_reports(frame):
    df = frame([("a", "ENG"), ("a", "ENG"), ("b", "XXX"), ("c", None), ("c", None)], "player string, country_code string")
    assert [tuple(r) for r in quality.duplicates(df, ["player"]).orderBy("player").collect()] == [("a", 2), ("c", 2)]
    assert {r.country_code for r in quality.unmapped(df, "country_code", players.countries(df.sparkSession)).collect()} == {"XXX", None}
    sizes = {r.column_name: (r.n_rows, r.n_known, r.n_distinct) for r in quality.profile(df).collect()}
    assert sizes == {"player": (5, 5, 3), "country_code": (5, 3, 2)}
    flags = {r.column_name: r.is_category for r in schema.low_cardinality(df).collect()}
    assert flags == {"player": False, "country_code": True}
    assert players.countries(df.sparkSession).count() == 80


def test_group_std_and_top_k(frame):
    df = frame([("a", 1.0), ("a", 3.0), ("b", 5.0), (None, 1.0), (None, 2.0)], "g string, v double")
    spread = {(r.g, r.v): r.s for r in windows.group_std(df, "v", ["g"], "s").collect()}
    assert spread[("a", 1.0)] == pytest.approx(math.sqrt(2)) and spread[("b", 5.0)] is None and spread[(None, 2.0)] is not None
    top = windows.top_k(df, F.col("v"), 1, by=["g"])
    assert {(r.g, r.v) for r in top.collect()} == {("a", 3.0), ("b", 5.0), (None, 2.0)} and "WindowGroupLimit" in plan(top)
    assert "TakeOrderedAndProject" in plan(windows.top_k(df, F.col("v"), 2, tie=[F.col("g")]))


def test_collapse_joins_texts_where_no_number_is(frame):
    df = frame([("a", 1.0, "25-100"), ("a", 1.0, "24-200"), ("b", 1.0, "2000"), ("b", 3.0, "1996"), ("c", 1.0, None)], "k string, w double, born string")
    got = {r.k: r.born for r in collapse.collapse(df, ["k"], "w", {"born": "wmean_or_join"}).collect()}
    assert got == {"a": "24-200/25-100", "b": "1997.0", "c": None}


def test_a_hot_key_may_hold_a_million_distinct_tokens(spark):
    """Values part before they meet: no raw set per key, and each value crosses the network once."""
    ids = spark.range(1_000_000).select(F.lit("hot").alias("k"), F.concat(F.col("id").cast("string"), F.lit(", x")).alias("t"), (F.col("id") % 3).cast("string").alias("j"), F.lit(1.0).alias("v"))
    df = ids.unionByName(ids.limit(5).withColumn("k", F.lit("small")))
    made = collapse.collapse(df, ["k"], "v", {"j": "join", "t": "tokens", "v": "sum"})
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in plan and "CartesianProduct" not in plan
    got = {r.k: r for r in made.select("k", "j", "v", F.size(F.split("t", ", ")).alias("n"), F.substring("t", 1, 10).alias("start"), F.substring("t", -4, 4).alias("end")).collect()}
    assert (got["hot"].n, got["hot"].j, got["hot"].v, got["hot"].start, got["hot"].end) == (1_000_001, "0/1/2", 1_000_000.0, "0, 1, 10, ", "9, x")
    assert (got["small"].n, got["small"].j) == (6, "0/1/2")


def test_tokens_and_joins_of_nulls_and_odd_names(frame):
    df = frame([("a", None, None), ("a", "x,,y / x", "q"), ("b", None, None), ("b", "", None), (None, "z", "z")], "k string, t string, `j.1` string")
    got = {r.k: (r.t, r["j.1"]) for r in collapse.collapse(df, ["k"], None, {"t": "tokens", "j.1": "join"}).collect()}
    assert got == {"a": ("x, y", "q"), "b": ("", None)}
    only = {r.k: r.t for r in collapse.collapse(df, ["k"], None, {"t": "tokens"}).collect()}
    assert only == {"a": "x, y", "b": ""}
