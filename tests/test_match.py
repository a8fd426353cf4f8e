import random

import pytest
from pyspark.sql import functions as F

from tests.test_text import brute_ratio
from valuekit.functions import text
from valuekit.operators import enrich, match
from valuekit.sources.history import explode_history


INDEX = "id long, name string, club string, market_value double, result_rank int"


def test_join_on_name_first_wins(frame):
    left = frame([("José Silva", 1), ("jose-silva", 2), ("Nobody", 3), (None, 4)], "player string, i int")
    right = frame([("Jose Silva", 20.0, 2), ("JOSE SILVA", 10.0, 1)], "player string, v double, o int")
    got = {r.i: r.v for r in match.join_on_name(left, right, "player", ["v"], [F.col("o")]).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: None, 4: None}
    assert match.join_on_name(left, right.drop("player"), "player", ["v"], []) is left


def test_cascade_order_and_value_preference(frame):
    index = frame(
        [(1, "Ana Braga", "A", None, 1), (2, "Ana Braga", "A", 5.0, 2), (3, "Braga Ana", "B", 9.0, 1), (4, "Braga", "C", 1.0, 1), (5, "Luís Figo", "D", 0.0, 1)], INDEX
    )
    wanted = frame([("Ana Braga",), ("Ana-Braga",), ("Zoe Braga",), ("LUIS FIGO",), ("Unknown Person",)], "player string")
    got = {r.player: r.id for r in match.match_by_spelling(wanted, index, "player").collect()}
    assert got == {"Ana Braga": 2, "Ana-Braga": 2, "Zoe Braga": 4, "LUIS FIGO": 5}


@pytest.mark.parametrize("pairs", [match.PAIRS_PER_TASK, 7])
def test_last_name_fallback_against_brute_force(frame, pairs):
    """Cut into many slices or not, each pair counts once; one last name holds most people and entries."""
    rng = random.Random(11)
    towns = ["Porto", "Lisboa", "Braga", "Madrid", "Sevilla", "Betis", "Getafe", "Girona"]
    club = lambda: f"{rng.choice(['FC ', 'Real ', '', 'CD '])}{rng.choice(towns)}{rng.choice(['', ' II', ' United'])}"
    last = lambda: "Silva" if rng.random() < 0.7 else rng.choice(["Da Costa", "Núñez", "O'Hara"])
    people = [(f"P{i} {last()}", club()) for i in range(60)] + [("", "Porto"), (" ", "x"), ("Solo Silva", "")]
    entries = [(i, f"E{i} {last()}", club() if i % 9 else None, 1.0, rng.randint(1, 30)) for i in range(80)]
    key = lambda n: {"Silva": "silva", "Costa": "costa", "Núñez": "nunez", "O'Hara": "ohara"}.get(n.split()[-1] if n.split() else "", "")
    want = {}
    for name, team in set(people):
        best = (0.0, None)
        for entry in sorted((e for e in entries if key(name) and key(e[1]) == key(name)), key=lambda e: (e[4], e[0])):
            score = brute_ratio(team.lower(), (entry[2] or "").lower()) if team else 0.0
            if score > best[0]:
                best = (score, entry[0])
        if best[0] >= 80:
            want[(name, team)] = (best[1], pytest.approx(best[0]))
    df = frame(people, "player string, squad string")
    found = match.match_by_last_name(df, frame(entries, INDEX), "player", "squad", pairs=pairs)
    assert {(r.player, r.squad): (r.id, r.score) for r in found.collect()} == want and len(want) > 20


def test_match_entities_prefers_spelling(frame):
    index = frame([(1, "Ana Braga", "Porto", 1.0, 1), (2, "Rui Costa", "Benfica", 1.0, 1)], INDEX)
    df = frame([("Ana Braga", "Anywhere"), ("R. M. Costa", "SL Benfica"), ("X Costa", "Milan"), (None, "Porto")], "player string, squad string")
    got = {(r.player, r.squad): (r.id, r.found_by) for r in match.match_entities(df, index, "player", "squad").collect()}
    assert got == {("Ana Braga", "Anywhere"): (1, "spelling"), ("R. M. Costa", "SL Benfica"): (2, "last_name")}


HISTORY = """[{"date":"2022-08-01","clubName":"Porto","marketValue":10},{"date":"2023-06-20","clubName":"FC Porto","marketValue":20},
 {"date":"2023-06-30","clubName":"Milan","marketValue":30},{"date":"bad","clubName":"Porto","marketValue":40},{"date":"2023-08-01","clubName":"Porto","marketValue":50}]"""


def test_history_forms(frame):
    df = frame([(1, HISTORY), (2, "[]"), (3, None), (4, '{"date":"2020-01-01","clubName":"A","marketValue":1}'), (5, "no json")], "id int, h string")
    flat = explode_history(df, "id", "h")
    assert flat.groupBy("id").count().orderBy("id").collect() == [(1, 5), (4, 1)]
    assert explode_history(df, "id", "h", keep_empty=True).select("id").distinct().count() == 5
    seasons = {r.value: r.season_end for r in enrich.in_season(flat).filter("id = 1").collect()}
    assert seasons == {10.0: 2023, 20.0: 2023, 30.0: 2023, 50.0: 2024}
    assert [enrich.in_season(flat, y).filter("id = 1").count() for y in (2024, 2023)] == [1, 3]


def test_pick_value_rules(frame):
    rows = [
        (1, 0, "2023-06-01", "Porto", 1.0), (1, 1, "2022-09-01", "Benfica", 2.0), (1, 2, "2023-06-01", "FC Porto", 3.0),
        (2, 0, None, "Porto", 4.0), (2, 1, "2019-01-01", "Other", 5.0), (3, 0, None, "Porto", -1000000.0), (3, 1, None, None, 999999999.0),
    ]
    history = frame(rows, "id int, position int, d string, club string, value double").withColumn("date", F.to_date("d")).drop("d")
    wanted = frame(
        [(1, "Porto", 2023), (1, "Benfica", 2023), (1, "Milan", 2023), (2, "Porto", 2023), (3, "Porto", 2023), (4, "Porto", 2023), (1, "Porto", 2023), (None, "x", 2023)],
        "id int, squad string, season_end int",
    )
    got = {(r.id, r.squad): (r.value, r.match_kind) for r in enrich.pick_value(wanted, history).collect()}
    assert got == {
        (1, "Porto"): (1.0, "season_club"), (1, "Benfica"): (2.0, "season_club"), (1, "Milan"): (2.0, "earliest"),
        (2, "Porto"): (5.0, "earliest"), (3, "Porto"): (-1000000.0, "earliest"), (4, "Porto"): (None, "none"),
    }


def test_enrich_keeps_every_row(frame):
    history = frame([(7, 0, "2023-05-01", "Porto", 3.0)], "id long, position int, d string, club string, value double").withColumn("date", F.to_date("d"))
    df = frame([("Ana", "Porto", 2023, 1), ("Ana", "Porto", 2023, 2), ("Bo", "Porto", 2023, 3), (None, None, None, 4)], "player string, squad string, season_end int, i int")
    matches = frame([("Ana", "Porto", 7, "spelling")], "player string, squad string, id long, found_by string")
    got = {r.i: (r["Market Value"], r.match_kind) for r in enrich.enrich(df, matches, history.drop("d")).collect()}
    assert got == {1: (3.0, "season_club"), 2: (3.0, "season_club"), 3: (None, "none"), 4: (None, "none")}
    assert enrich.full_history(df, matches, history.drop("d")).count() == 1


def test_name_joins_stay_equi_joins(frame):
    df = frame([("Ana", "Porto")], "player string, squad string")
    index = frame([(1, "Ana", "Porto", 1.0, 1)], INDEX)
    for made in (match.match_by_spelling(df, index, "player"), match.match_by_last_name(df, index, "player", "squad")):
        text_plan = made._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text_plan and "BroadcastNestedLoopJoin" not in text_plan and "BatchEvalPython" not in text_plan
    keys = df.select(text.cascade_keys(F.col("player")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in keys


def score_pairs():
    """Texts of clubs with slips of the pen, texts of few characters, and noise."""
    rng = random.Random(5)
    words = ["porto", "real", "fc", "united", "são", "paulo", "sporting", "city", "a", "xy", "zwolle", "1860", "münchen"]
    letters = "abcdeo pr"

    def slip(text):
        chars = list(text)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(chars) + 1)
            chars[at : at + rng.randint(0, 1)] = rng.choice(["", letters[rng.randrange(9)]])
        return "".join(chars)

    out = [("", ""), ("", "a"), ("a", "b"), ("ab", "ba"), ("abc", "xabxc")]
    for _ in range(1500):
        base = " ".join(rng.choice(words) for _ in range(rng.randint(1, 4)))
        other = slip(base)[rng.randint(0, 3) :] if rng.random() < 0.7 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 3)))
        out.append((base, other))
        out.append(tuple("".join(rng.choice(letters) for _ in range(rng.randint(1, 9))) for _ in range(2)))
    return out


@pytest.mark.parametrize("least", [0.0, 50.0, 70.0, 80.0, 95.0, 100.0])
def test_no_pair_is_lost_before_the_score(spark, least):
    """Pairs told by their characters alone never reach the score; at 80 most pairs never see Python."""
    from valuekit.functions import fuzzy

    pairs = score_pairs()
    df = spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(pairs)], "k int, a string, b string")
    want = {k: s for k, (a, b) in enumerate(pairs) if (s := brute_ratio(a.lower(), b.lower()) if a and b else 100.0 * (a == b)) >= least}
    hopeful = {r.k for r in df.filter(fuzzy.may_reach(F.col("a"), F.col("b"), least)).collect()}
    assert set(want) <= hopeful
    assert {r.k: pytest.approx(r.score) for r in fuzzy.resembling(df, "a", "b", least).collect()} == want
    if least >= 80:
        assert len(hopeful) < 0.75 * len(pairs)


def test_enrichment_writes_few_tables(spark, monkeypatch):
    from valuekit import scale
    from valuekit.plans import registry, value_queries

    written, fresh = [], scale.fresh_path
    monkeypatch.setattr(scale, "fresh_path", lambda s: written.append(1) or fresh(s))
    assert value_queries.enrich_left(registry.Tables(spark, "/root/testdata/sf0.001")).count() > 0
    assert len(written) <= 6
