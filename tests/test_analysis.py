import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuekit.operators import analysis
from valuekit.plans import registry, value_queries


def test_gaps_and_reports(frame):
    df = frame([("a", 100.0, 150.0), ("b", 0.0, 5.0), ("c", 200.0, 50.0), ("d", None, 5.0), ("e", 10.0, 10.0), ("f", 100.0, 50.0)], "player string, `Market Value` double, p double")
    gaps = analysis.valuation_gap(df, "Market Value", "p")
    got = {r.player: (r.error, r.abs_diff, r.pct_diff) for r in gaps.collect()}
    assert got == {"a": (50.0, 50.0, 50.0), "b": (5.0, 5.0, None), "c": (-150.0, 150.0, 75.0), "d": (None, None, None), "e": (0.0, 0.0, 0.0), "f": (-50.0, 50.0, 50.0)}
    top = {n: [r.player for r in d.collect()] for n, d in analysis.gap_reports(gaps, 3, [F.col("player")]).items()}
    assert top == {"absolute": ["c", "a", "f"], "percentage": ["c", "a", "f"], "undervalued": ["c", "f"], "overvalued": ["a", "b"]}


def test_metrics_against_numpy(frame):
    rng = np.random.default_rng(1)
    y, p = rng.lognormal(3, 1, 200), rng.lognormal(3, 1, 200)
    df = frame([("m", float(a), float(b)) for a, b in zip(y, p)] + [("zero", 0.0, 1.0), ("zero", 2.0, 2.0), ("same", 3.0, 3.0), ("same", 3.0, 3.0), ("same", 3.0, None)], "model string, y double, p double")
    got = {r.model: r for r in analysis.regression_metrics(df, "y", "p", ["model"]).collect()}
    e = p - y
    want = (math.sqrt((e**2).mean()), 1 - (e**2).sum() / ((y - y.mean()) ** 2).sum(), abs(e).mean(), np.median(abs(e)), (abs(e) / y).mean() * 100)
    m = got["m"]
    assert (m.rmse, m.r2, m.mae, m.medae, m.mape) == pytest.approx(want)
    assert got["zero"].mape == pytest.approx(0.5 / 2.220446049250313e-16 * 100)
    assert (got["same"].n_rows, got["same"].r2, got["same"].medae) == (2, 1.0, 0.0)
    whole = analysis.regression_metrics(df.filter("model = 'm'"), "y", "p").first()
    assert (whole.rmse, whole.medae) == pytest.approx((want[0], want[3]))


@pytest.mark.parametrize("values", [[0.0, 1.5, 3.0, 2.9999, 0.2, 0.4, 0.6], [5.0, 5.0], list(np.linspace(0, 1, 16)), [i / 10 for i in range(-37, 90)]])
def test_histogram_like_numpy(frame, values):
    df = frame([(float(v),) for v in values] + [(None,)], "e double")
    bars = analysis.histogram(df, "e").orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=15)
    assert [b.n_rows for b in bars] == list(counts)
    assert [b.bin_start for b in bars] + [bars[-1].bin_end] == pytest.approx(list(edges))
    assert sum(r.n_rows for r in analysis.histogram(df.filter("e IS NULL"), "e").collect()) == 0


def test_search_and_view(frame):
    df = frame([("Ana (A)", 1.0), ("bob", 2.0), (None, 3.0)], "player string, predicted_market_value double")
    assert [r.player for r in analysis.search(df, "player", " ^ANA|bo+b ").collect()] == ["Ana (A)", "bob"]
    assert [r.player for r in analysis.search(df, "player", "(a)", literal=True).collect()] == ["Ana (A)"]
    assert analysis.search(df, "player", "  ") is df
    assert analysis.view(df, ["player", "squad", "predicted_market_value"], {"predicted_market_value": "Predicted Price"}).columns == ["player", "Predicted Price"]


def test_scatter_and_comparison(frame):
    df = frame([(1.0, 9.0), (4.0, 2.0), (None, None)], "a double, p double")
    points, end = analysis.scatter(df, "a", "p")
    assert points.count() == 3 and end.first().axis_max == 9.0
    metrics = frame([("B", "Test", 1.0, 2.0), ("A", "Test", 3.0, 4.0), ("A", "Validation", 5.0, 6.0)], "model string, dataset string, MAE double, rmse double")
    rows = analysis.compare_models(metrics).collect()
    assert [(r.model, r.dataset, r.mae, r.mse, r.rmse) for r in rows] == [("A", "Test", 3.0, 16.0, 4.0), ("A", "Validation", 5.0, 36.0, 6.0), ("B", "Test", 1.0, 4.0, 2.0)]


def test_models_are_compared_without_medians(spark, monkeypatch):
    want = {(r.model, r.dataset): r.mae for r in value_queries.model_comparison(registry.Tables(spark, "/root/testdata/sf0.001")).collect()}
    monkeypatch.setattr(analysis, "medians", None)
    got = {(r.model, r.dataset): r.mae for r in value_queries.model_comparison(registry.Tables(spark, "/root/testdata/sf0.001")).collect()}
    assert got == want and len(got) == 6
