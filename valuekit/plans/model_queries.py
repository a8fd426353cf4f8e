"""Training operators bound to the line items: price as target, part as group."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from valuekit.ml import prep, train
from valuekit.ml.ensembles import HistogramBoost, HistogramForest
from valuekit.ml.models import LOG_LABEL, PREDICTED, RIDGE_ALPHAS, Ridge, boosted, forest, log_pipeline
from valuekit.ml.search import chosen
from valuekit.operators import analysis
from valuekit.plans.registry import long, query, r4, sql_r4
from valuekit.plans.value_queries import METRICS
from valuekit.scale import settle

TARGET = "l_extendedprice"
GROUP = "l_partkey"


# Closed form of ridge on two columns ``a`` and ``b``, filled and scaled, from ``fit(k, w, t, a, b)``: ``st`` holds the scales of
# each ``k``, ``fo`` the coefficients of each ``k`` and penalty number ``i``.
RIDGE_CTES = """
  fill AS (SELECT k, median(a) AS fa, median(b) AS fb FROM fit GROUP BY k),
  st AS (SELECT k, any_value(fa) AS fa, any_value(fb) AS fb, avg(coalesce(a, fa)) AS ma, stddev_pop(coalesce(a, fa)) AS sa,
    avg(coalesce(b, fb)) AS mb, stddev_pop(coalesce(b, fb)) AS sb FROM fit JOIN fill USING (k) GROUP BY k),
  z AS (SELECT k, w, t, (coalesce(a, fa) - ma) / sa AS a, (coalesce(b, fb) - mb) / sb AS b FROM fit JOIN st USING (k)),
  s AS (SELECT k, sum(w) AS n, sum(w * a) AS a, sum(w * b) AS b, sum(w * t) AS t, sum(w * a * a) AS aa, sum(w * a * b) AS ab, sum(w * b * b) AS bb,
    sum(w * a * t) AS ta, sum(w * b * t) AS tb FROM z GROUP BY k),
  c AS (SELECT k, n, a, b, t, aa - a * a / n AS aa, ab - a * b / n AS ab, bb - b * b / n AS bb, ta - t * a / n AS ta, tb - t * b / n AS tb FROM s),
  co AS (SELECT c.*, i, ((bb + alpha) * ta - ab * tb) / ((aa + alpha) * (bb + alpha) - ab * ab) AS ca,
    ((aa + alpha) * tb - ab * ta) / ((aa + alpha) * (bb + alpha) - ab * ab) AS cb FROM c, alphas),
  fo AS (SELECT k, i, ca, cb, (t - ca * a - cb * b) / n AS c0 FROM co)"""
MARGIN = "c0 + ca * (coalesce(a, fa) - ma) / sa + cb * (coalesce(b, fb) - mb) / sb"


def penalties(alphas) -> str:
    """``alphas(i, alpha, shown)``: penalties by number, and the settings as a report names them."""
    named = (str({"alpha": a}).replace("'", "''") for a in alphas)
    return "alphas(i, alpha, shown) AS (VALUES " + ", ".join(f"({i}, {float(a)!r}::DOUBLE, '{n}')" for i, (a, n) in enumerate(zip(alphas, named))) + ")"


def searched_sql(a: str, b: str, alphas, variant: str = "") -> str:
    """Metrics of the best penalty over group folds, by the closed form."""
    key = lambda seed: f"substr(md5('{seed}:' || l_partkey::VARCHAR), 1, 8)"
    return f"""
WITH base AS (
  SELECT l_extendedprice AS y, ln(1 + l_extendedprice) AS t, {a} AS a, {b} AS b,
    CASE WHEN {key(42)} < '33333333' THEN 'test' WHEN {key(43)} < '40000000' THEN 'validation' ELSE 'train' END AS split,
    ({key(44)} >= '33333333')::INT + ({key(44)} >= '66666666')::INT + ({key(44)} >= '99999999')::INT + ({key(44)} >= 'cccccccc')::INT AS fold
  FROM lineitem
), m AS (SELECT median(y) AS med FROM base WHERE split = 'train'), d AS (SELECT median(abs(y - med)) AS mad FROM base, m WHERE split = 'train'),
wt AS (SELECT base.*, 1 / (1 + abs(y - med) / (mad * 1.5 + 1e-6)) AS w FROM base, m, d WHERE split = 'train'),
fit AS (SELECT k, wt.* FROM wt, (SELECT unnest(range(6)) AS k) WHERE fold <> k), {penalties(alphas)}, {RIDGE_CTES},
judged AS (SELECT i, k, avg((exp({MARGIN}) - 1 - y) ** 2) AS mse FROM wt JOIN st ON st.k = wt.fold JOIN fo USING (k) GROUP BY i, k),
best AS (SELECT i FROM judged GROUP BY i ORDER BY avg(mse), i LIMIT 1),
p AS (SELECT split, y, exp({MARGIN}) - 1 AS p FROM base, st JOIN fo USING (k) JOIN best USING (i) WHERE k = 5 AND split <> 'train')
SELECT '{variant}' AS variant, upper(substr(split, 1, 1)) || substr(split, 2) AS dataset, 'Linear Regression' AS model, {sql_r4('sqrt(avg((y - p) ** 2))')} AS rmse,
  {sql_r4('1 - sum((y - p) ** 2) / (var_pop(y) * count(*))')} AS r2, {sql_r4('avg(abs(y - p))')} AS mae, {sql_r4('median(abs(y - p))')} AS medae,
  {sql_r4(f'avg(abs(y - p) / greatest(abs(y), {analysis.EPSILON!r})) * 100')} AS mape, (SELECT shown FROM alphas JOIN best USING (i)) AS best_params
FROM p GROUP BY split"""


def lines(t):
    return t("lineitem").select(GROUP, TARGET, "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")


@query("features_target", "SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderkey % 10 > 0 THEN o_totalprice END AS value FROM orders WHERE o_orderkey % 10 > 0")
def features_target(t):
    rows = t("orders").withColumn("value", F.when(F.col("o_orderkey") % 10 > 0, F.col("o_totalprice")))
    return prep.features_target(rows, "value", ["o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice", "absent"])


@query(
    "mad_weights",
    f"""WITH m AS (SELECT median(o_totalprice) AS med FROM orders), a AS (SELECT o_orderkey, abs(o_totalprice - med) AS away FROM orders, m),
        s AS (SELECT median(away) AS mad FROM a) SELECT o_orderkey, {sql_r4('1 / (1 + away / (mad * 1.5 + 1e-6))')} AS weight FROM a, s""",
)
def mad_weights(t):
    return prep.mad_weights(t("orders"), "o_totalprice").select("o_orderkey", r4(F.col("weight")).alias("weight"))


@query(
    "mad_weights_per_group",
    f"""WITH m AS (SELECT o_orderpriority, median(o_totalprice) AS med FROM orders GROUP BY 1), a AS (SELECT o_orderkey, o_orderpriority, abs(o_totalprice - med) AS away FROM orders JOIN m USING (o_orderpriority)),
        s AS (SELECT o_orderpriority, median(away) AS mad FROM a GROUP BY 1) SELECT o_orderkey, {sql_r4('1 / (1 + away / (mad * 1.5 + 1e-6))')} AS weight FROM a JOIN s USING (o_orderpriority)""",
)
def mad_weights_per_group(t):
    weighed = prep.mad_weights(t("orders"), "o_totalprice", by=["o_orderpriority"])
    return weighed.select("o_orderkey", r4(F.col("weight")).alias("weight"))


@query(
    "standardize",
    f"""WITH g AS (SELECT l_linenumber, l_quantity, nullif(l_discount, 0) AS d FROM lineitem), f AS (SELECT l_linenumber, l_quantity AS q, coalesce(d, (SELECT median(d) FROM g)) AS d FROM g),
        s AS (SELECT avg(q) AS mq, stddev_pop(q) AS sq, avg(d) AS md, stddev_pop(d) AS sd FROM f)
        SELECT l_linenumber::BIGINT AS l_linenumber, {sql_r4('min((q - mq) / sq)')} AS low, {sql_r4('avg((q - mq) / sq)')} AS mean, {sql_r4('max((d - md) / sd)')} AS high FROM f, s GROUP BY 1""",
)
def standardize(t):
    rows = t("lineitem").select("l_linenumber", "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"))
    scaled = prep.standardize(rows, ["l_quantity", "l_discount"])
    return scaled.groupBy(long(F.col("l_linenumber")).alias("l_linenumber")).agg(
        r4(F.min("l_quantity")).alias("low"), r4(F.avg("l_quantity")).alias("mean"), r4(F.max("l_discount")).alias("high")
    )


@query(
    "one_hot",
    """WITH g AS (SELECT l_linestatus, CASE WHEN l_orderkey % 5 = 0 THEN 'missing' ELSE l_returnflag END AS flag FROM lineitem)
       SELECT l_linestatus, (i - 1)::BIGINT AS slot, count(*) FILTER (flag = ['A', 'N', 'R', 'missing'][i])::DOUBLE AS total FROM g, generate_series(1, 4) AS s(i) GROUP BY 1, 2""",
)
def one_hot(t):
    rows = t("lineitem").select("l_linestatus", F.when(F.col("l_orderkey") % 5 > 0, F.col("l_returnflag")).alias("flag"))
    encoded = Pipeline(stages=prep.prep_stages(rows, ["l_linestatus"])).fit(rows).transform(rows)
    slots = encoded.select("l_linestatus", F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.groupBy("l_linestatus", long(F.col("slot")).alias("slot")).agg(F.sum("value").alias("total"))


@query(
    "group_split",
    """SELECT DISTINCT l_partkey, CASE WHEN substr(md5('42:' || l_partkey::VARCHAR), 1, 8) < '33333333' THEN 'test'
       WHEN substr(md5('43:' || l_partkey::VARCHAR), 1, 8) < '40000000' THEN 'validation' ELSE 'train' END AS split FROM lineitem""",
)
def group_split(t):
    return prep.group_split(t("lineitem"), GROUP).select(GROUP, "split").distinct()


@query(
    "group_kfold",
    """WITH h AS (SELECT l_partkey, substr(md5('44:' || l_partkey::VARCHAR), 1, 8) AS h FROM lineitem)
       SELECT l_partkey, ((h >= '33333333')::INT + (h >= '66666666')::INT + (h >= '99999999')::INT + (h >= 'cccccccc')::INT)::BIGINT AS fold, count(*) AS n_rows FROM h GROUP BY 1, 2""",
)
def group_kfold(t):
    folded = prep.group_folds(t("lineitem"), GROUP)
    return folded.groupBy(GROUP, long(F.col("fold")).alias("fold")).agg(F.count("*").alias("n_rows"))


@query(
    "ridge_fit_score",
    f"""WITH fit AS (SELECT 0 AS k, l_discount + 0.5 AS w, ln(1 + l_extendedprice) AS t, l_quantity AS a, nullif(l_tax, 0) AS b FROM lineitem), {penalties([5000])}, {RIDGE_CTES}
        SELECT l_returnflag, count(*) AS n_rows, {sql_r4(f'sum(exp({MARGIN}) - 1) / count(*)')} AS predicted
        FROM (SELECT l_returnflag, l_quantity AS a, nullif(l_tax, 0) AS b FROM lineitem), st JOIN fo USING (k) GROUP BY 1""",
)
def ridge_fit_score(t):
    """Weighted, on two columns, one of them with gaps."""
    rows = t("lineitem").select("l_returnflag", (F.col("l_discount") + 0.5).alias("w"), "l_quantity", F.nullif("l_tax", F.lit(0.0)).alias("l_tax"), TARGET)
    fitted = log_pipeline(rows, Ridge(labelCol=LOG_LABEL, weightCol="w", alpha=5000.0), TARGET, ["l_returnflag", "w"]).fit(rows)
    scored = fitted.transform(rows).groupBy("l_returnflag")
    return scored.agg(F.count("*").alias("n_rows"), r4(F.avg(PREDICTED)).alias("predicted"))


def stump_sql(l1: float, l2: float, base: str, step: float) -> str:
    """The best single cut of the quantities by the penalised score, and what it predicts for each quantity."""
    soft = lambda g: f"sign({g}) * greatest(abs({g}) - {l1}, 0)"
    score = lambda g, n: f"({soft(g)}) ** 2 / ({n} + {l2})"
    return f"""
WITH v AS (SELECT l_quantity AS q, ln(1 + l_extendedprice) AS t FROM lineitem), b AS (SELECT {base} AS base FROM v),
g AS (SELECT q, count(*)::DOUBLE AS n, sum(t - base) AS g FROM v, b GROUP BY q), a AS (SELECT sum(n) AS nn, sum(g) AS gg FROM g),
c AS (SELECT q, sum(n) OVER (ORDER BY q) AS n, sum(g) OVER (ORDER BY q) AS g FROM g),
best AS (SELECT q AS cut, n, g, nn, gg, base FROM c, a, b WHERE n < nn ORDER BY {score('g', 'n')} + {score('gg - g', 'nn - n')} DESC, q LIMIT 1)
SELECT l_quantity, count(*) AS n_rows, {sql_r4(f"exp(any_value(base + {step} * CASE WHEN l_quantity <= cut THEN ({soft('g')}) / (n + {l2}) ELSE ({soft('gg - g')}) / (nn - n + {l2}) END)) - 1")} AS predicted
FROM lineitem, best GROUP BY l_quantity"""


def stump(t, regressor):
    rows = t("lineitem").select("l_quantity", TARGET)
    scored = log_pipeline(rows, regressor, TARGET, []).fit(rows).transform(rows).groupBy("l_quantity")
    return scored.agg(F.count("*").alias("n_rows"), r4(F.min(PREDICTED)).alias("predicted"))


@query("forest_stump_score", stump_sql(0, 0, "0::DOUBLE", 1))
def forest_stump_score(t):
    """One tree of one split on all rows."""
    return stump(t, HistogramForest(labelCol=LOG_LABEL, numTrees=1, maxDepth=1, bootstrap=False))


@query("boosted_stump_score", stump_sql(50, 1000, "avg(t)", 0.5))
def boosted_stump_score(t):
    """One boosted split with penalties on its leaves."""
    return stump(t, HistogramBoost(labelCol=LOG_LABEL, maxIter=1, maxDepth=1, stepSize=0.5, l1=50.0, l2=1000.0))


def fit_and_judge(t, regressor):
    """Trained on the training groups, judged on the others."""
    parts = prep.group_split(lines(t), GROUP)
    model = log_pipeline(parts, regressor, TARGET, [GROUP, "split"]).fit(parts.filter("split = 'train'"))
    # The metrics take several passes, so rows are predicted once and written.
    scored = settle(model.transform(parts.filter("split <> 'train'")).select("l_returnflag", TARGET, PREDICTED))
    metrics = analysis.regression_metrics(scored, TARGET, PREDICTED, ["l_returnflag"])
    return metrics.select("l_returnflag", "n_rows", *[r4(F.col(m)).alias(m) for m in METRICS])


@query("forest_fit_score")
def forest_fit_score(t):
    regressor, settings = forest()
    return fit_and_judge(t, regressor.copy(settings[0]))


@query("gbt_fit_score")
def gbt_fit_score(t):
    regressor, settings = boosted()
    return fit_and_judge(t, regressor.copy(settings[0]))


def judged(metrics):
    return metrics.select("variant", "dataset", "model", *[r4(F.col(m)).alias(m) for m in METRICS], "best_params")


def run(t, model, **options):
    return judged(train.train(lines(t), model, TARGET, GROUP, **options)[1])


def pair(t):
    """Two columns, so that SQL can solve the equations."""
    return t("lineitem").select(GROUP, TARGET, "l_quantity", "l_tax")


@query("grid_search", searched_sql("l_quantity", "l_tax", RIDGE_ALPHAS))
def grid_search(t):
    return judged(train.train(pair(t), "Linear Regression", TARGET, GROUP)[1])


# 25 penalties, the usual ones among them.
MANY_ALPHAS = [10 ** (k / 4 - 4) for k in range(25)]


@query("random_search", searched_sql("l_quantity", "l_tax", chosen(MANY_ALPHAS)))
def random_search(t):
    """Ten of 25 penalties."""
    return judged(train.train(pair(t), "Linear Regression", TARGET, GROUP, search="random", grid={"alpha": MANY_ALPHAS})[1])


@query("halving_search")
def halving_search(t):
    """All usual settings of forests."""
    return run(t, "Random Forest")


@query("halving_search_boosted")
def halving_search_boosted(t):
    """All usual settings of boosted trees."""
    return run(t, "XGBoost")


@query(
    "score_table",
    f"""WITH fit AS (SELECT 0 AS k, 1 AS w, ln(1 + l_extendedprice) AS t, l_quantity AS a, l_tax AS b FROM lineitem WHERE l_orderkey % 10 > 0), {penalties([1])}, {RIDGE_CTES}
        SELECT l_partkey, l_linestatus, count(*) AS n_rows, count(*) FILTER (l_orderkey % 10 = 0) AS without_target, {sql_r4(f'sum(round_even(exp({MARGIN}) - 1, 2))')} AS predicted
        FROM (SELECT l_partkey, l_linestatus, l_orderkey, l_quantity AS a, l_tax AS b FROM lineitem), st JOIN fo USING (k) GROUP BY 1, 2""",
)
def score_table(t):
    """Fit on rows with a target, score all rows."""
    rows = t("lineitem").select(GROUP, "l_linestatus", "l_quantity", "l_tax", F.when(F.col("l_orderkey") % 10 > 0, F.col(TARGET)).alias(TARGET))
    known = prep.features_target(rows, TARGET, [])
    model = log_pipeline(known, Ridge(labelCol=LOG_LABEL), TARGET, [GROUP, "l_linestatus"]).fit(known)
    return train.score(model, rows, TARGET).groupBy(GROUP, "l_linestatus").agg(
        F.count("*").alias("n_rows"), F.count_if(F.col(TARGET).isNull()).alias("without_target"), r4(F.sum(train.PREDICTION)).alias("predicted")
    )


# Each variant's second column; the first one is the quantity.
VARIANTS = {
    "enhanced_feature_engineering": "l_quantity * (1 - l_discount)", "feature_engineering": "l_tax / nullif(l_discount, 0)", "no_feature_engineering": "l_tax",
}


@query("train_report", " UNION ALL ".join(f"SELECT * FROM ({searched_sql('l_quantity', b, RIDGE_ALPHAS, name)})" for name, b in VARIANTS.items()))
def train_report(t):
    tables = {name: t("lineitem").select(GROUP, TARGET, "l_quantity", F.expr(b).alias("other")) for name, b in VARIANTS.items()}
    return judged(train.train_report(tables, "Linear Regression", TARGET, GROUP))
