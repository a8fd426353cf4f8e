"""Group statistics on rows, ranks and top rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.scale import attach, col, positions


def group_std(df: DataFrame, column: str, keys: Sequence[str], name: str) -> DataFrame:
    """Sample standard deviation of the group on each of its rows; NULL for single rows."""
    spread = df.groupBy(*[col(k) for k in keys]).agg(F.stddev_samp(col(column)).alias(name))
    return attach(df, spread, keys)


def rank_in(df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str = "rank") -> DataFrame:
    """1-based position in the group's sort order, for groups of any size."""
    return positions(df, by, order, name)


def top_k(
    df: DataFrame, by_value: Column, k: int, ascending: bool = False, tie: Sequence[Column] = (), by: Sequence[str] = ()
) -> DataFrame:
    """The k first rows by value (NULL last), of the table or of every group."""
    order = [by_value.asc_nulls_last() if ascending else by_value.desc_nulls_last(), *tie]
    if not by:
        return df.orderBy(*order).limit(k)
    nth = F.row_number().over(Window.partitionBy(*[col(b) for b in by]).orderBy(*order))
    return df.withColumn("__nth", nth).filter(F.col("__nth") <= k).drop("__nth")
