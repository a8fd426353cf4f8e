import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from valuekit.ml import models, prep, search, train
from valuekit.ml.ensembles import HistogramBoost, HistogramForest

TARGET = "Market Value"


@pytest.fixture(scope="module")
def players(spark):
    """500 rows of 200 players; the value grows with goals and age has gaps."""
    rng = np.random.default_rng(0)
    rows = []
    for i in range(500):
        goals, minutes = int(rng.integers(0, 30)), float(rng.integers(100, 3000))
        value = float(np.exp(13 + 0.08 * goals + rng.normal(0, 0.2)))
        rows.append((f"p{i % 200}", f"t{i % 5}", None if i % 11 == 0 else float(rng.integers(18, 40)), goals, minutes, value if i % 25 else None))
    return spark.createDataFrame(rows, f"player string, team string, age double, goals int, minutes double, `{TARGET}` double").cache()


def test_features_target(players):
    kept = prep.features_target(players, TARGET, ["team", "absent"])
    assert "team" not in kept.columns and kept.count() == 480
    with pytest.raises(ValueError):
        prep.features_target(players.drop(TARGET), TARGET, [])


def test_mad_weights_by_hand(frame):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = frame([("a", v) for v in values] + [("b", 5.0), ("b", 5.0)], "g string, y double")
    y = np.array(values)
    want = 1 / (1 + abs(y - 3) / (1.0 * 1.5 + 1e-6))
    got = [r.weight for r in prep.mad_weights(df.filter("g = 'a'"), "y").orderBy("y").collect()]
    assert got == pytest.approx(list(want)) and max(got) == 1.0 and min(got) > 0
    grouped = {(r.g, r.y): r.weight for r in prep.mad_weights(df, "y", by=["g"]).collect()}
    assert grouped[("a", 100.0)] == pytest.approx(want[-1]) and grouped[("b", 5.0)] == 1.0


def test_split_and_folds_keep_groups_whole(spark):
    df = spark.range(20000).select((F.col("id") % 5000).cast("string").alias("player"))
    parts = prep.group_folds(prep.group_split(df, "player"), "player")
    per_player = parts.groupBy("player").agg(F.count_distinct("split").alias("s"), F.count_distinct("fold").alias("f"))
    assert per_player.filter("s > 1 OR f > 1").isEmpty()
    shares = {r.split: r["count"] / 20000 for r in parts.groupBy("split").count().collect()}
    assert shares == pytest.approx({"train": 0.6, "validation": 0.2, "test": 0.2}, abs=0.03)
    folds = {r.fold: r["count"] / 20000 for r in parts.groupBy("fold").count().collect()}
    assert folds == pytest.approx(dict.fromkeys(range(5), 0.2), abs=0.03)
    plan = parts._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_preparation_matches_numpy(frame):
    rows = [(1.0, "b", 5.0, None), (3.0, None, 5.0, None), (None, "a", 5.0, None), (8.0, "b", 5.0, None)]
    df = frame(rows, "n double, t string, same double, void double")
    fitted = Pipeline(stages=prep.prep_stages(df, [])).fit(df)
    unseen = frame([(None, "zzz", None, 2.0)], "n double, t string, same double, void double")
    got = np.array([r.v for r in fitted.transform(df.unionByName(unseen)).select(vector_to_array("features").alias("v")).collect()])
    filled = np.array([1.0, 3.0, 3.0, 8.0])
    z = (filled - filled.mean()) / filled.std()
    assert got[:4, 0] == pytest.approx(z) and got[4, 0] == pytest.approx((3.0 - filled.mean()) / filled.std())
    assert (got[:, 1] == 0).all() and got[:4, 2] == pytest.approx(0.0)
    assert got[:, 3:].tolist() == [[0, 1, 0], [0, 0, 1], [1, 0, 0], [0, 1, 0], [0, 0, 0]]


@pytest.mark.parametrize("alpha", [0.1, 50.0])
@pytest.mark.parametrize("weighted", [False, True])
def test_ridge_equals_closed_form(spark, alpha, weighted):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(120, 3)) * [1, 5, 0.3]
    y = x @ [2.0, -0.5, 4.0] + 7 + rng.normal(size=120)
    w = rng.uniform(0.2, 1.0, 120) if weighted else np.ones(120)
    df = spark.createDataFrame([(*map(float, r), float(t), float(v)) for r, t, v in zip(x, y, w)], "a double, b double, c double, y double, w double")
    from pyspark.ml.feature import VectorAssembler

    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = models.Ridge(labelCol="y", weightCol="w" if weighted else None, alpha=alpha).fit(data)
    mx, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    xc, yc = x - mx, y - my
    beta = np.linalg.solve(xc.T @ (xc * w[:, None]) + alpha * np.eye(3), xc.T @ (w * yc))
    assert model.coefficients.toArray() == pytest.approx(beta, rel=1e-6)
    assert model.intercept == pytest.approx(my - mx @ beta, rel=1e-6)


def test_train_score_and_save(players, tmp_path):
    best, metrics = train.train(players, "Linear Regression", TARGET, "player", drop=["team"], grid={"alpha": [0.01, 1000.0]}, folds=3, variant="v")
    rows = {r.dataset: r for r in metrics.collect()}
    assert set(rows) == {"Validation", "Test"} and all(r.variant == "v" and r.r2 > 0.5 and r.training_time > 0 for r in rows.values())
    assert "0.01" in rows["Test"].best_params
    scored = train.score(best, players, TARGET)
    assert scored.count() == 500 and scored.filter(F.col(train.PREDICTION).isNull()).isEmpty()
    assert scored.filter(F.abs(F.col(train.PREDICTION) * 100 - F.rint(F.col(train.PREDICTION) * 100)) > 1e-3).isEmpty()
    train.save_model(best, str(tmp_path / "m"))
    again = train.score(PipelineModel.load(str(tmp_path / "m")), players.drop(TARGET), TARGET)
    key = ["player", "goals", "minutes", train.PREDICTION]
    assert again.select(key).exceptAll(scored.select(key)).isEmpty()


def test_targets_without_logarithm_are_set_aside(frame):
    df = frame([("a", -2000000.0), ("b", 0.0), ("c", -0.5), ("d", None)], f"player string, `{TARGET}` double")
    usable, rest = train.trainable(df, TARGET)
    assert {r.player for r in usable.collect()} == {"b", "c"} and rest.count() == 2


@pytest.mark.parametrize("kind, options", [(HistogramForest, {"numTrees": 8, "maxDepth": 4}), (HistogramBoost, {"maxIter": 5, "maxDepth": 3})])
def test_trees_beat_the_mean(players, kind, options):
    regressor = kind(labelCol=models.LOG_LABEL, **options)
    rows = prep.features_target(players, TARGET, [])
    model = models.log_pipeline(rows, regressor, TARGET, ["player"]).fit(rows)
    from valuekit.operators.analysis import regression_metrics

    assert regression_metrics(model.transform(rows), TARGET, models.PREDICTED).first().r2 > 0.6


def test_grids_have_the_listed_sizes(spark):
    assert len(models.ridge()[1]) == 7 and len(models.forest()[1]) == 1620 * 4 and len(models.boosted()[1]) == 3 * 3 * 3 * 2 * 2 * 3 * 2 * 2 * 2
    assert len(search.SEARCHES) == 3


def test_searches_find_the_better_setting(players):
    rows = prep.group_folds(prep.features_target(players, TARGET, ["team"]), "player", 3).cache()
    model = models.Ridge(labelCol=models.LOG_LABEL)
    pipeline = models.log_pipeline(rows, model, TARGET, ["player", "fold"])
    maps = models.param_maps(model, {"alpha": [1e-3, 1e4, 1e5, 1e6]})
    for name in ("grid", "halving"):
        _, best = search.SEARCHES[name](pipeline, maps, rows, TARGET, folds=3, group="player")
        assert list(best.values()) == [1e-3]
    _, picked = search.SEARCHES["random"](pipeline, maps, rows, TARGET, folds=3, tries=2)
    assert list(picked.values())[0] in (1e-3, 1e4, 1e5, 1e6)


def test_report_goes_on_past_a_bad_variant(players):
    tables = {"bad": players.drop(TARGET), "good": players}
    kept = []
    report = train.train_report(tables, "Linear Regression", TARGET, "player", ["team"], on_model=lambda v, m: kept.append(v), grid={"alpha": [1.0]}, folds=3)
    rows = report.collect()
    assert kept == ["good"] and [r.variant for r in rows].count("good") == 2 and all(r.set_aside == 0 for r in rows if r.variant == "good")
    bad = [r for r in rows if r.variant == "bad"]
    assert len(bad) == 1 and "to train on" in bad[0].error and bad[0].rmse is None
    with pytest.raises(RuntimeError):
        train.train_report({"bad": players.drop(TARGET)}, "Linear Regression", TARGET, "player")


def test_halving_fits_small_tables(players, monkeypatch):
    """As many settings as the forest's on 80 groups: no round may leave a fold empty."""
    seen = []

    def judged(pipeline, maps, df, target, fold, folds, parallelism):
        seen.append((len(maps), {r[0] for r in df.select(fold).distinct().collect()}))
        return None, [float(i) for i in range(len(maps))]

    monkeypatch.setattr(search, "cross_validate", judged)
    rows = prep.group_folds(players.filter("player < 'p70'"), "player", 5)
    _, maps = models.forest()
    assert search.halving_search(None, maps, rows, TARGET, folds=5, group="player")[1] == maps[0]
    assert [n for n, _ in seen][0] == 6480 and all(folds == set(range(5)) for _, folds in seen)


def test_report_counts_rows_set_aside(players):
    rows = players.withColumn(TARGET, F.when(F.col("goals") == 3, -5.0).otherwise(F.col(TARGET)))
    report = train.train_report({"v": rows}, "Linear Regression", TARGET, "player", ["team"], grid={"alpha": [1.0]}, folds=3).collect()
    assert {r.set_aside for r in report} == {rows.filter(F.col(TARGET) == -5.0).count()} and all(r.error is None for r in report)


def test_hashed_texts_train_too(players):
    model = models.Ridge(labelCol=models.LOG_LABEL)
    rows = prep.features_target(players, TARGET, [])
    fitted = models.log_pipeline(rows, model, TARGET, ["player"], hash_width=64).fit(rows)
    assert fitted.transform(rows).select("features").first()[0].size == 64 + 3


def test_wide_ridge_equals_the_narrow_one(players, monkeypatch):
    rows = prep.features_target(players, TARGET, [])
    pipeline = models.log_pipeline(rows, models.Ridge(labelCol=models.LOG_LABEL, alpha=3.0), TARGET, ["player"])
    narrow = pipeline.fit(rows).stages[-2].coefficients.toArray()
    monkeypatch.setattr(models, "NORMAL_COLUMNS", 1)
    assert pipeline.fit(rows).stages[-2].coefficients.toArray() == pytest.approx(narrow, abs=1e-4)


@pytest.mark.parametrize("weighted", [False, True])
def test_ridge_scores_from_sums_equal_single_fits(players, weighted):
    """Gaps, texts with levels that some folds lack, weights: two passes against a fit per fold and penalty."""
    rows = prep.group_folds(prep.features_target(players, TARGET, []), "player", 4)
    rows = rows.withColumn("rare", F.when(F.col("player") == "p3", "only").when(F.col("goals") > 20, "many")).withColumn("__weight", 1 / (1 + F.col("goals")))
    model = models.Ridge(labelCol=models.LOG_LABEL, weightCol="__weight" if weighted else None)
    pipeline = models.log_pipeline(rows, model, TARGET, ["player", "fold", "__weight"])
    maps = models.param_maps(model, {"alpha": [0.01, 5.0, 300.0]})
    got = search._ridge_scores(pipeline, maps, rows, TARGET, "fold", 4)
    _, want = search.cross_validate(pipeline, maps, rows, TARGET, "fold", 4, 4)
    assert got == pytest.approx(want, rel=1e-6)


def test_wide_rows_are_fitted_one_by_one(players, monkeypatch):
    from valuekit.ml import gram

    monkeypatch.setattr(gram, "WIDEST", 3)
    rows = prep.group_folds(prep.features_target(players, TARGET, ["team"]), "player", 3)
    model = models.Ridge(labelCol=models.LOG_LABEL)
    pipeline = models.log_pipeline(rows, model, TARGET, ["player", "fold"])
    maps = models.param_maps(model, {"alpha": [1e-3, 1e6]})
    assert search._ridge_scores(pipeline, maps, rows, TARGET, "fold", 3) is None
    assert search.grid_search(pipeline, maps, rows, TARGET, folds=3)[1] == maps[0]


def test_many_levels_get_the_same_slots_from_a_table(frame, monkeypatch, tmp_path):
    """Levels numbered by a table and a join against those the driver lists; unseen and missing values included."""
    rows = [(float(i), None if i % 7 == 0 else f"l{i % 23}", "é" if i % 2 else "z") for i in range(120)]
    df = frame(rows, "n double, a string, b string")
    new = frame([(0.0, "never", "z"), (1.0, "l3", None)], "n double, a string, b string")
    vectors = lambda model: [r.features for r in model.transform(df.unionByName(new)).orderBy("n", "a", "b").select("features").collect()]
    listed = vectors(Pipeline(stages=prep.prep_stages(df, [])).fit(df))
    monkeypatch.setattr(prep, "LISTED_LEVELS", 5)
    model = Pipeline(stages=prep.prep_stages(df, [])).fit(df)
    assert any(isinstance(s, prep.LevelDictionary) for s in model.stages) and vectors(model) == listed
    model.write().overwrite().save(str(tmp_path / "m"))
    assert vectors(PipelineModel.load(str(tmp_path / "m"))) == listed


def test_a_million_levels_stay_off_the_driver(spark):
    df = spark.range(1_000_000).select((F.col("id") * 7919 % 1_000_000).cast("string").alias("t"))
    model = Pipeline(stages=prep.prep_stages(df, [])).fit(df)
    assert isinstance(model.stages[1], prep.LevelDictionary)
    got = model.transform(df.filter("t IN ('0', '1', '999999')")).select("t", "features").collect()
    assert {r.t: (r.features.size, r.features.indices.tolist()) for r in got} == {"0": (1_000_000, [0]), "1": (1_000_000, [1]), "999999": (1_000_000, [999_999])}
