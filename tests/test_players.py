"""Raw CSV files to variants, values, worklist and corrections, checked against plain pandas."""

import csv

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from valuekit.operators import correct
from valuekit.plans import players
from valuekit.sources.history import explode_history


def season_rows(seed, n=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        row = dict.fromkeys(players.RAW_COLUMNS, "")
        row |= {c: str(round(float(rng.integers(1, 40)) + (0.25 if "per_90" in c else 0), 2)) for c in players.STAT_COLUMNS}
        row |= {"rank": str(i + 1), "player": f"Player {i:02d}", "country_code": f"e{i} ENG" if i % 5 else "", "position": "FW,MF" if i % 2 else "DF",
                "squad": f"Club {i % 4}", "age": str(15 + i), "born": "1999", "matches": "Matches", "minutes_played": str(90 * (i + 1)),
                "progressive_receives": str(i) if seed == 1 or i < 3 else "", "league": "x", "season": "y"}
        if i % 6 == 0:
            row["assists"] = ""
        rows.append(row)
    moved = dict(rows[3], squad="Club 9", minutes_played="10", goals="7", position="GK")
    return [*rows, moved, dict(rows[4])]


def write_csv(path, rows, headers):
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        for header in headers:
            out.writerow(header)
        for i, row in enumerate(rows):
            out.writerow([row[c] for c in players.RAW_COLUMNS])
            if i == 9:
                out.writerow(["Rk", "Player", *["h"] * 37])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    base = tmp_path_factory.mktemp("scraped")
    upper = [f"Unnamed: {i}_level_0" if i < 8 else "Performance" for i in range(39)]
    lower = ["Rk", "Player", *[f"c{i}" for i in range(37)]]
    write_csv(base / "La-Liga_2022-2023_player_data.csv", season_rows(1), [upper, lower])
    write_csv(base / "Serie-A_2021-2022_player_data.csv", season_rows(2), [lower])
    (base / "Short_2020-2021_player_data.csv").write_text("player,squad\nA,B\nC,D\n")
    (base / "notes.txt").write_text("not a table")
    return str(base)


def expected(seed):
    """The cleaning rules for one file, row by row in pandas."""
    df = pd.DataFrame(season_rows(seed)).replace("", None).drop(columns=["rank", "matches"])
    df["country_code"] = df["country_code"].str.split().str[-1].str.upper()
    df = df.drop_duplicates(["player", "squad"])
    text = ["player", "country_code", "position", "squad", "league", "season"]
    numeric = [c for c in df.columns if c not in text]
    df[numeric] = df[numeric].apply(pd.to_numeric)
    out = []
    for player, part in df.groupby("player", sort=True):
        w = part["minutes_played"]
        row = {c: np.average(part[c], weights=w) for c in numeric} | {"player": player, "minutes_played": w.sum()}
        row["squad"] = "/".join(sorted(set(part["squad"])))
        row["position"] = ", ".join(sorted({t.strip() for p in part["position"] for t in p.split(",")}))
        row["country_code"] = next(iter(part["country_code"].dropna()), None)
        out.append(row)
    one = pd.DataFrame(out)
    one["rank"] = np.arange(1, len(one) + 1)
    one = one.dropna(axis=1, thresh=int(0.3 * len(one)))
    for c in one.columns:
        one[c] = one[c].fillna(one[c].mode()[0] if c in text else one[c].median())
    return one[one["age"].between(16, 45)]


@pytest.fixture(scope="module")
def cleaned(spark, folder):
    return players.clean_seasons(spark, folder)


def test_variants_match_pandas(cleaned):
    made, rejected = cleaned
    assert set(made) == set(players.VARIANTS)
    assert {r.file_path.rsplit("/", 1)[1] for r in rejected.select("file_path").collect()} == {"Short_2020-2021_player_data.csv"}
    plain = made["no_feature_engineering"].toPandas()
    for seed, league in ((1, "La-Liga"), (2, "Serie-A")):
        got = plain[plain.league == league].sort_values("player").reset_index(drop=True)
        want = expected(seed).reset_index(drop=True)
        assert len(got) == len(want) > 20
        for c in want.columns:
            if want[c].dtype == object:
                assert list(got[c]) == list(want[c]), c
            else:
                assert got[c].astype(float).to_numpy() == pytest.approx(want[c].astype(float).to_numpy()), c
    absent = plain[plain.league == "Serie-A"]["progressive_receives"]
    assert absent.isna().all() and plain[plain.league == "La-Liga"]["progressive_receives"].notna().all()


def test_features_of_variants(cleaned):
    made, _ = cleaned
    full, basic = made["enhanced_feature_engineering"], made["feature_engineering"]
    assert not set(players.REDUNDANT_COLUMNS) & set(full.columns) and set(players.ADVANCED) < set(full.columns)
    assert set(players.BASIC) < set(basic.columns) and "goal_ratio" not in basic.columns
    rows = full.toPandas()
    second = rows[rows.league == "Serie-A"]
    assert second["progressive_total"].isna().all() and second["goal_ratio"].notna().all()
    assert (rows["performance_consistency"] == 0).all()
    b = basic.toPandas()
    assert (b["goals"] - b["expected_goals"]).to_numpy() == pytest.approx(b["goal_overperformance"].to_numpy())
    assert rows.loc[rows.player == "Player 03", "squad"].tolist() == ["Club 3/Club 9"] * 2
    assert rows.loc[rows.player == "Player 03", "position"].tolist() == ["FW, GK, MF"] * 2


def test_integrity_reports(cleaned):
    reports = players.integrity_reports(cleaned[0]["no_feature_engineering"])
    assert reports["unmapped_codes"].isEmpty() and reports["duplicate_keys"].isEmpty()


def test_publish_enrich_worklist_and_correct(spark, cleaned, tmp_path):
    made, _ = cleaned
    names = [f"Player {i:02d}" for i in range(1, 20)]
    index = spark.createDataFrame([(i, n.lower() if i % 2 else n, "Club", 1.0, 1) for i, n in enumerate(names)], "id long, name string, club string, market_value double, result_rank int")
    nested = [(i, f'[{{"date":"2023-06-0{1 + i % 9}","clubName":"Club {(i + 1) % 4}","marketValue":{1000 + i}}},{{"date":"2015-01-01","clubName":"Old","marketValue":5}}]') for i in range(len(names))]
    history = explode_history(spark.createDataFrame(nested, "id long, h string"), "id", "h")
    valued = players.enrich_seasons(made, index, history)
    for name, df in valued.items():
        rows = {(r.league, r.player): r["Market Value"] for r in df.collect()}
        assert len(rows) == made[name].count()
        assert rows[("La-Liga", "Player 05")] == 1004.0 and rows[("Serie-A", "Player 05")] == 5.0
        assert rows[("La-Liga", "Player 22")] is None
    out = str(tmp_path / "updated")
    players.publish(valued, out)
    table = spark.read.option("mergeSchema", True).parquet(out)
    assert {r.variant for r in table.select("variant").distinct().collect()} == set(players.VARIANTS)
    work = players.worklist(table)
    todo = work.filter("fe_variant = 'feature_engineering'").select("dataset", "player", "team")
    assert {r.player for r in todo.collect()} == {"Player 20", "Player 21", "Player 22", "Player 23"}
    updates = todo.select("dataset", F.upper("player").alias("player"), "team", F.lit(77.0).alias("manual_transfer_value"), F.lit(1).alias("seq"))
    fixed = players.correct_values(table, updates, F.col("seq"))
    assert fixed.filter("`Market Value` = 77").count() == todo.count() == 8
    assert fixed.filter("`Market Value` IS NULL").count() == work.count() - 8
    assert fixed.columns == table.columns and correct.resolve_value_column(fixed.columns) == "Market Value"
    updates = spark.createDataFrame(updates.collect(), updates.schema)
    n_rows = table.count()
    # Written back: only the folders that the updates name get new files.
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "updated").rglob("*.parquet")}
    assert players.publish_corrections(spark, out, updates, F.col("seq")) == 2
    after = spark.read.option("mergeSchema", True).parquet(out)
    assert after.filter("`Market Value` = 77").count() == 8 and after.count() == n_rows
    gone = {f for f in files if not f.exists()}
    assert gone and all("variant=feature_engineering" in str(f) for f in gone)
    assert all(f.stat().st_mtime_ns == at for f, at in files.items() if f not in gone)
    assert players.publish_corrections(spark, out, updates.filter("false"), F.col("seq")) == 0


def test_country_names(frame):
    df = frame([("ENG",), ("SWI",), ("XXX",)], "country_code string")
    assert {r.country_code: r.country for r in players.with_country_names(df).collect()} == {"ENG": "England", "SWI": "Switzerland", "XXX": None}


def test_first_per_player(spark, tmp_path):
    (tmp_path / "a.csv").write_text("player,squad,goals\nPlayer1,,5\nPlayer1,Team A,6\nPlayer2,Team B,5\n")
    (tmp_path / "b.csv").write_text("player,squad,goals\nPlayer1,Team C,1\n,Team D,2\n")
    (tmp_path / "c.txt").write_text("player\nX\n")
    rows = players.first_per_player(spark, str(tmp_path)).collect()
    assert {(r.file_path[-5:], r.player, r.squad, r.goals) for r in rows} == {
        ("a.csv", "Player1", "Team A", "5"), ("a.csv", "Player2", "Team B", "5"), ("b.csv", "Player1", "Team C", "1"),
    }


def test_predictions_and_evaluation(spark, frame, tmp_path):
    scored = frame(
        [("A", "2022-2023", f"P{i}", "FW", "X", 100.0, 100.0 + (i - 5) * 10) for i in range(12)] + [("B", "2022-2023", "Q", "GK", "Y", None, 5.0)],
        "league string, season string, player string, position string, squad string, `Market Value` double, predicted_market_value double",
    )
    out = str(tmp_path / "predictions")
    players.publish_predictions(scored, out, "xgboost", "fe")
    players.publish_predictions(scored, out, "random_forest", "fe")
    table = spark.read.parquet(out)
    shown = players.evaluate([table], "p", model="xgboost", variant="fe", league="A", season="2022-2023")
    assert shown["rows"].columns == ["player", "position", "squad", "Market Value", "Predicted Price"] and shown["rows"].count() == 12
    assert [r.player for r in shown["undervalued"].collect()] == ["P0", "P1", "P2", "P3", "P4"]
    assert [r.player for r in shown["overvalued"].collect()] == ["P11", "P10", "P9", "P8", "P7"]
    assert sum(r.n_rows for r in shown["histogram"].collect()) == 12 and shown["scatter_extent"].first().axis_max == 160.0
    raw = players.evaluate([table.drop("predicted_market_value")], model="xgboost", variant="fe", league="B", season="2022-2023")
    assert set(raw) == {"rows"} and raw["rows"].count() == 1
    with pytest.raises(FileNotFoundError):
        players.evaluate([table], model="none", variant="fe", league="A", season="2022-2023")


def test_train_and_publish(spark, tmp_path):
    rows = [
        (f"p{i % 60}", "La-Liga" if i % 2 else "Serie-A", f"{2020 + i % 3}-{2021 + i % 3}", i, float(i % 9), float(20 + i % 15), 1e6 * (1 + i % 9) if i % 10 else None)
        for i in range(300)
    ]
    table = spark.createDataFrame(rows, "player string, league string, season string, rank int, goals double, age double, `Market Value` double")
    made = {"feature_engineering": table.withColumn("rate", F.col("goals") / F.col("age")), "no_feature_engineering": table, "empty": table.withColumn("Market Value", F.lit(None).cast("double"))}
    players.publish(made, f"{tmp_path}/in")
    report = players.train_and_publish(spark, f"{tmp_path}/in", f"{tmp_path}/out", "Linear Regression", list(made), grid={"alpha": [0.1]}, folds=3)
    got = {(r.variant, r.error is None) for r in report.collect()}
    assert got == {("feature_engineering", True), ("no_feature_engineering", True), ("empty", False)}
    predictions = spark.read.option("mergeSchema", True).parquet(f"{tmp_path}/out/predictions")
    assert predictions.count() == 600 and predictions.filter("predicted_market_value IS NULL").count() == 0
    assert set(predictions.columns) >= {"model", "variant", "league", "season", "rate"}
    assert spark.read.parquet(f"{tmp_path}/out/metrics").count() == report.count()
    assert (tmp_path / "out/models/Linear_Regression/no_feature_engineering/metadata").is_dir()
