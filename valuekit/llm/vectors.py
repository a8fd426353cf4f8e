"""Packed vectors: which rows of a table of embeddings take part, and how they travel in blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components, and not all zero."""
    fits = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce(fits & F.exists(vector, lambda x: x != 0), F.lit(False))


def common_length(table: DataFrame, vector: str) -> int:
    """The most frequent vector length (ties: the shorter one); 0 for an empty table."""
    counted = table.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n"))
    top = counted.orderBy(F.desc("n"), "length").first()
    return top["length"] if top else 0


def stacked(column: pd.Series, length: int) -> np.ndarray:
    return np.array(column.tolist(), np.float64).reshape(len(column), length)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their norms, scaled first so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
