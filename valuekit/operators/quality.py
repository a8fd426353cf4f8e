"""Data quality reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.operators.schema import short_form
from valuekit.scale import col


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    counted = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n_rows"))
    return counted.filter(F.col("n_rows") > 1)


def unmapped(df: DataFrame, column: str, dim: DataFrame, dim_column: str | None = None) -> DataFrame:
    """Distinct values without a row in the dimension, NULL included."""
    known = dim.select(col(dim_column or column).alias("__known")).distinct()
    return df.select(col(column)).distinct().join(known, col(column) == F.col("__known"), "left_anti")


def profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, known and distinct values per column."""
    names = list(columns or df.columns)
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), short_form(col(n)).alias("value")) for n in names])
    per_value = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count("*").alias("times"))
    return per_value.groupBy("column_name").agg(
        F.sum("times").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("times"))), F.lit(0)).alias("n_known"),
        F.count("value").alias("n_distinct"),
    )
