"""Column names, positions and types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.functions.numbers import no_nan, to_number
from valuekit.scale import col


def flatten_names(levels: Iterable[Sequence[str]]) -> list[str]:
    """Join the stripped, non-empty levels of every header with ``_``."""
    return [
        "_".join(str(part).strip() for part in level if part and str(part).lower() != "nan") for level in levels
    ]


def normalize_name(name: str) -> str:
    return name.lower().replace(" ", "_")


def normalize_names(df: DataFrame) -> DataFrame:
    return df.toDF(*map(normalize_name, df.columns))


def rename_if_absent(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new) if old in df.columns and new not in df.columns else df


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """First ``len(names)`` columns under new names; fewer columns are an error, extra ones are cut."""
    if len(df.columns) < len(names):
        raise ValueError(f"{len(df.columns)} columns, {len(names)} expected")
    # Positions, not names: the source may repeat a name.
    return df.toDF(*[f"__{i}" for i in range(len(df.columns))]).select(
        *[F.col(f"__{i}").alias(name) for i, name in enumerate(names)]
    )


def coerce_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Double columns in which everything that is not a number is NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def coerced(name: str) -> Column:
        return to_number(col(name)) if isinstance(types[name], T.StringType) else no_nan(col(name))

    return df.withColumns({c: coerced(c) for c in columns if c in types})


def numeric_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(skip)]


def text_columns(df: DataFrame, skip: Iterable[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in set(skip)]


def short_form(value: Column, size: int = 64) -> Column:
    """Text of at most ``size`` bytes to tell values apart: longer ones are replaced by their SHA-256."""
    text = value.cast("string")
    return F.when(F.octet_length(text) >= size, F.sha2(text, 256)).otherwise(text)


def low_cardinality(df: DataFrame, columns: Sequence[str] | None = None, share: float = 0.5) -> DataFrame:
    """Rows, distinct values and a flag per text column: distinct values below ``share`` of the rows."""
    names = list(columns) if columns is not None else text_columns(df)
    cells = F.array(*[F.struct(F.lit(n).alias("column_name"), short_form(col(n)).alias("value")) for n in names])
    # Counting per value first keeps every step combinable before its shuffle.
    per_value = df.select(F.inline(cells)).groupBy("column_name", "value").agg(F.count("*").alias("times"))
    sizes = per_value.groupBy("column_name").agg(
        F.count("value").alias("n_distinct"), F.sum("times").alias("n_rows")
    )
    return sizes.withColumn("is_category", F.col("n_distinct") < share * F.col("n_rows"))


def resolve_value_column(columns: Sequence[str]) -> str | None:
    """The value column: an exact name first, else the first that holds both words, else none."""
    lowered = {c.lower(): c for c in reversed(columns)}
    for name in ("market value", "market_value"):
        if name in lowered:
            return lowered[name]
    return next((c for c in columns if "market" in c.lower() and "value" in c.lower()), None)


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    missing = set(columns) - set(df.columns)
    if missing:
        raise ValueError(f"a table needs these columns too: {sorted(missing)}")
    return df
