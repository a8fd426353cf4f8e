"""Row hygiene: repeated headers, duplicates, ranges and zero fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from valuekit.operators.schema import numeric_columns
from valuekit.scale import col, known

ABSENT = "absent_columns"


def drop_header_rows(df: DataFrame, column: str, heading: str | None = None) -> DataFrame:
    """Drop rows that repeat the heading; NULLs stay."""
    return df.filter(~F.lower(col(column)).eqNullSafe((heading or column).lower()))


def add_constants(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def range_filter(df: DataFrame, ranges: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    """Keep rows inside every range whose column exists; NULL is outside."""
    for name, (low, high) in ranges.items():
        if name in df.columns:
            if low is not None:
                df = df.filter(col(name) >= low)
            if high is not None:
                df = df.filter(col(name) <= high)
    return df


def fill_zero(df: DataFrame, inputs: Mapping[str, frozenset[str]] | None = None) -> DataFrame:
    """Numeric NULLs become 0, except in groups for which the column (or an input of it) is absent."""
    names = numeric_columns(df)
    if ABSENT not in df.columns:
        return df.fillna(0, subset=names) if names else df

    def filled(name: str) -> Column:
        sources = F.array(*[F.lit(n) for n in sorted((inputs or {}).get(name, {name}))])
        return F.when(F.arrays_overlap(F.col(ABSENT), sources), col(name)).otherwise(F.coalesce(col(name), F.lit(0)))

    return df.withColumns({n: filled(n) for n in names})


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``. The rank limit is applied before the shuffle as well, so a hot
    key sends one row per input partition."""
    first = Window.partitionBy(*[col(k) for k in keys]).orderBy(*order)
    return df.withColumn("__nth", F.row_number().over(first)).filter(F.col("__nth") == 1).drop("__nth")


def group_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Per key, the first non-NULL value of each column on its own; NULL keys are dropped."""
    place = F.struct(*order)
    rest = [c for c in df.columns if c not in keys]
    picks = [F.min_by(col(c), F.when(col(c).isNotNull(), place)).alias(c) for c in rest]
    rows = known(df, keys)
    return rows.groupBy(*[col(k) for k in keys]).agg(*picks) if picks else rows.select(*[col(k) for k in keys]).distinct()


def reject_rows(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows): a bad row never stops the rest."""
    ok = F.coalesce(valid, F.lit(False))
    return df.filter(ok), df.filter(~ok)
