"""Sparse columns and gap filling, over the whole table or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.operators.clean import ABSENT
from valuekit.scale import attach, col, medians, modes


def column_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (``n_rows``) and non-NULL values per column, per group."""
    counts = [F.count(col(c)).alias(c) for c in columns]
    return df.groupBy(*[col(k) for k in by]).agg(F.count("*").alias("n_rows"), *counts)


def drop_sparse(
    df: DataFrame, min_share: float = 0.3, by: Sequence[str] = (), columns: Sequence[str] | None = None
) -> DataFrame:
    """Drop columns with fewer known values than ``floor(min_share * rows)``.

    With ``by`` the test is made per group: the column turns NULL in the groups where it is too sparse,
    and ``absent_columns`` lists those columns so that later fills leave them alone.
    """
    names = [c for c in (columns or df.columns) if c not in by]
    counts = column_counts(df, names, by)
    threshold = F.floor(F.lit(min_share) * F.col("n_rows"))
    sparse = F.array_compact(F.array(*[F.when(col(c) < threshold, F.lit(c)) for c in names]))
    if not by:
        return df.drop(*counts.select(sparse.alias("names")).first().names)
    marked = attach(df, counts.select(*[col(k) for k in by], sparse.alias(ABSENT)), by)
    masked = {c: F.when(~F.array_contains(ABSENT, c), col(c)) for c in names}
    return marked.withColumns(masked)


def impute(df: DataFrame, numeric: Sequence[str] = (), text: Sequence[str] = (), by: Sequence[str] = ()) -> DataFrame:
    """Fill numeric gaps with the median and text gaps with the mode, of the table or of the group.

    A column without any known value stays as it is.
    """
    for names, summary in ((list(numeric), medians), (list(text), modes)):
        if not names:
            continue
        values = summary(df, names, by)
        if not by:
            found = values.first()
            df = df.withColumns({c: F.coalesce(col(c), F.lit(found[c])) for c in names if found[c] is not None})
            continue
        stats = values.toDF(*by, *[f"__fill_{i}" for i in range(len(names))])
        filled = attach(df, stats, by)
        df = filled.withColumns({c: F.coalesce(col(c), F.col(f"__fill_{i}")) for i, c in enumerate(names)})
        df = df.drop(*[f"__fill_{i}" for i in range(len(names))])
    return df
