"""Search, valuation gaps, metrics and the data behind the evaluation charts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.operators.windows import top_k
from valuekit.scale import col, known, medians, null_safe_join, settle

EPSILON = 2.220446049250313e-16


def search(df: DataFrame, column: str, term: str | None, literal: bool = False) -> DataFrame:
    """Rows whose lower-case text matches the lower-case term (a pattern); a blank term keeps all."""
    wanted = (term or "").strip().lower()
    if not wanted:
        return df
    text = F.lower(col(column))
    return df.filter(F.contains(text, F.lit(wanted)) if literal else text.rlike(wanted))


def view(df: DataFrame, columns: Sequence[str], renames: Mapping[str, str] | None = None) -> DataFrame:
    """The listed columns that exist, some under another name."""
    renames = renames or {}
    return df.select(*[col(c).alias(renames.get(c, c)) for c in columns if c in df.columns])


def lookup(table: DataFrame, **partition: str) -> DataFrame:
    """Rows of one combination of partition columns: the scan skips every other folder."""
    for name, value in partition.items():
        table = table.filter(col(name) == value)
    return table


def lookup_first(tables: Sequence[DataFrame], **partition: str) -> DataFrame:
    """The first table that has rows for the combination; an error when none has."""
    for table in tables:
        found = lookup(table, **{k: v for k, v in partition.items() if k in table.columns})
        if not found.isEmpty():
            return found
    raise FileNotFoundError(f"no rows for {partition}")


def valuation_gap(
    df: DataFrame, actual: str, predicted: str, error: str = "error", absolute: str = "abs_diff", percent: str = "pct_diff"
) -> DataFrame:
    """Signed, absolute and percentage difference; the percentage is NULL when the actual value is 0."""
    a, p = col(actual).cast("double"), col(predicted).cast("double")
    gap = p - a
    share = F.abs(gap / F.nullif(a, F.lit(0.0)) * 100)
    return df.withColumns({error: gap, absolute: F.abs(gap), percent: share})


def gap_reports(gaps: DataFrame, k: int, tie: Sequence[Column]) -> dict[str, DataFrame]:
    """Top k rows by absolute and by percentage difference, most under- and most over-valued."""
    return {
        "absolute": top_k(gaps, F.col("abs_diff"), k, tie=tie),
        "percentage": top_k(gaps, F.col("pct_diff"), k, tie=tie),
        "undervalued": top_k(gaps.filter(F.col("error") < 0), F.col("error"), k, ascending=True, tie=tie),
        "overvalued": top_k(gaps.filter(F.col("error") > 0), F.col("error"), k, tie=tie),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = (), middle: bool = True) -> DataFrame:
    """rmse, r2, mae, medae and mape (percent) per group, over rows that have both values. medae takes further passes; without ``middle`` it is left out."""
    y, p = F.col("y"), F.col("p")
    rows = df.select(*[col(k) for k in by], col(actual).cast("double").alias("y"), col(predicted).cast("double").alias("p"))
    rows = known(rows, ["y", "p"])
    squares, spread = F.sum((y - p) * (y - p)), F.var_pop(y) * F.count("*")
    r2 = (
        F.when(F.count("*") < 2, F.lit(None))
        .when(spread > 0, 1 - squares / F.nullif(spread, F.lit(0.0)))
        .otherwise(F.when(squares == 0, 1.0).otherwise(0.0))
    )
    sums = rows.groupBy(*[col(k) for k in by]).agg(
        F.count("*").alias("n_rows"),
        F.sqrt(F.avg((y - p) * (y - p))).alias("rmse"),
        r2.alias("r2"),
        F.avg(F.abs(y - p)).alias("mae"),
        (F.avg(F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))) * 100).alias("mape"),
    )
    if not middle:
        return sums
    found = medians(rows.withColumn("medae", F.abs(y - p)), ["medae"], by)
    if not by:
        return sums.withColumn("medae", F.lit(found.first().medae).cast("double"))
    return null_safe_join(sums, found, by, "left")


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    """Counts in equal bins from the least to the greatest value; the last bin is closed. NULLs are left out."""
    # Read twice, so what it is computed from should not be: one column is written and read back.
    df = settle(df.select(col(column).cast("double").alias("value")).filter("value IS NOT NULL"))
    value = F.col("value")
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    empty = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    if ends.lo is None:
        return empty.select("bin", F.lit(None).cast("double").alias("bin_start"), F.lit(None).cast("double").alias("bin_end"), F.lit(0).cast("long").alias("n_rows"))
    lo, hi = (ends.lo, ends.hi) if ends.lo < ends.hi else (ends.lo - 0.5, ends.hi + 0.5)
    step = (hi - lo) / bins

    def edge(i: Column) -> Column:
        return F.when(i >= bins, F.lit(hi)).otherwise(F.lit(lo) + i * F.lit(step))

    guess = F.least(F.floor((value - lo) / step), F.lit(bins - 1)).cast("int")
    # A value on an edge belongs to the bin that starts there, whatever the division rounded to.
    exact = (
        F.when(value < edge(guess), guess - 1)
        .when((value >= edge(guess + 1)) & (guess < bins - 1), guess + 1)
        .otherwise(guess)
    )
    counts = df.groupBy(exact.alias("bin")).agg(F.count("*").alias("n"))
    return empty.join(counts, "bin", "left").select(
        "bin", edge(F.col("bin")).alias("bin_start"), edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n_rows"),
    )


def scatter(df: DataFrame, actual: str, predicted: str) -> tuple[DataFrame, DataFrame]:
    """(points, one row with the end of the diagonal)."""
    points = df.select(col(actual), col(predicted))
    return points, points.agg(F.greatest(F.max(col(actual)), F.max(col(predicted))).alias("axis_max"))


def compare_models(metrics: DataFrame, names: Sequence[str] = ("mae", "mse", "rmse", "r2")) -> DataFrame:
    """One row per model and split with the metrics that exist (names in any case), by model name.

    ``mse`` is derived from ``rmse`` when only that is recorded.
    """
    lowered = {c.lower(): c for c in metrics.columns}
    found = {n: col(lowered[n]) for n in names if n in lowered}
    if "mse" in names and "mse" not in found and "rmse" in lowered:
        found["mse"] = col(lowered["rmse"]) * col(lowered["rmse"])
    picks = [F.avg(c).alias(n) for n, c in found.items()]
    return metrics.groupBy("model", "dataset").agg(*picks).orderBy("model", "dataset")
