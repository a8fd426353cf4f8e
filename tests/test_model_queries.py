"""The model queries run with the operators' own settings; nothing is fitted here."""

from pyspark.sql import functions as F

from valuekit.ml import models, search
from valuekit.ml.ensembles import HistogramForest
from valuekit.plans import model_queries, registry

FOLDER = "/root/testdata/sf0.001"


def named(settings):
    return [{p.name: v for p, v in setting.items()} for setting in settings]


class Constant:
    def transform(self, df):
        return df.withColumn(models.PREDICTED, F.lit(1.0))


def searched(spark, monkeypatch, name, kind):
    seen = []

    def record(pipeline, maps, *_, **__):
        seen.append(named(maps))
        return Constant(), maps[0]

    monkeypatch.setitem(search.SEARCHES, kind, record)
    return seen, registry.QUERIES[name](spark, FOLDER)


def test_halving_runs_over_the_whole_grids(spark, monkeypatch):
    for name, model, settings in (("halving_search", "Random Forest", models.forest()[1]), ("halving_search_boosted", "XGBoost", models.boosted()[1])):
        seen, got = searched(spark, monkeypatch, name, "halving")
        assert seen == [named(settings)] and {r.model for r in got.select("model").collect()} == {model}


def test_random_search_has_more_settings_than_tries(spark, monkeypatch):
    (settings,), _ = searched(spark, monkeypatch, "random_search", "random")
    alphas = [s["alpha"] for s in settings]
    assert len(alphas) > 10 and all(min(abs(a / b - 1) for a in alphas) < 1e-9 for b in models.RIDGE_ALPHAS)


def test_single_fits_use_settings_of_the_grids(monkeypatch):
    monkeypatch.setattr(model_queries, "fit_and_judge", lambda t, regressor: regressor)
    for query, (_, settings) in ((model_queries.forest_fit_score, models.forest()), (model_queries.gbt_fit_score, models.boosted())):
        fitted = query(None)
        assert any(all(fitted.getOrDefault(fitted.getParam(n)) == v for n, v in setting.items()) for setting in named(settings))


def test_rows_are_predicted_once_for_all_metrics(spark):
    """The metrics take several passes: they read predictions that were written, not the model's function."""
    rows = [(k % 40, 100.0 + k % 7, float(k % 5), 0.1 * (k % 3), 0.02 * (k % 2), "ANR"[k % 3], "FO"[k % 2]) for k in range(400)]
    schema = "l_partkey long, l_extendedprice double, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    table = spark.createDataFrame(rows, schema)
    got = model_queries.fit_and_judge(lambda _: table, HistogramForest(labelCol=models.LOG_LABEL, numTrees=2, maxDepth=2))
    assert "predict(" not in got._jdf.queryExecution().toString()
    assert {r.l_returnflag for r in got.collect()} == set("ANR")
