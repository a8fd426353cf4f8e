"""Missing-value worklists and manual corrections."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.functions.numbers import is_missing, to_number
from valuekit.functions.paths import dataset_key
from valuekit.operators.schema import resolve_value_column
from valuekit.scale import attach, col, known, positions


def missing_worklist(df: DataFrame, value: str | None = None) -> DataFrame:
    """Rows without a value, in the form the correction step takes back.

    Needs ``league``, ``season`` and ``variant``; other columns fall back to a fixed text when absent.
    """
    value = value or resolve_value_column(df.columns)
    if value is None:
        raise ValueError("no value column")
    lowered = {c.lower(): c for c in df.columns}

    def text(name: str, default: str) -> Column:
        return col(lowered[name]).cast("string") if name in lowered else F.lit(default)

    rows = df.filter(is_missing(col(value)))
    return rows.select(
        dataset_key(F.col("league"), F.col("season"), F.col("variant")).alias("dataset"),
        F.col("season"),
        text("player", "Unknown").alias("player"),
        text("squad", "Unknown").alias("team"),
        text("closest_date", "N/A").alias("closest_date"),
        col(value).cast("string").alias("current_value"),
        F.col("variant").alias("fe_variant"),
    ).filter(F.col("dataset").isNotNull())


def shown_date(closest_date: Column, season_end_year: Column) -> Column:
    """The entry's date, or "Approx. <year>" when there is none."""
    return F.when(closest_date == "N/A", F.concat_ws(" ", F.lit("Approx."), season_end_year)).otherwise(closest_date)


def group_entries(df: DataFrame, by: Sequence[str], order: Sequence[Column], page_rows: int = 1000) -> DataFrame:
    """Entries grouped in order, in pages: (by, page, entries). A group of any size is a run of pages."""
    rest = [c for c in df.columns if c not in by]
    numbered = positions(df, by, order, "__nth").withColumn("page", F.floor((F.col("__nth") - 1) / page_rows))
    entry = F.struct(F.col("__nth"), *[col(c) for c in rest])
    pages = numbered.groupBy(*[col(k) for k in by], "page").agg(F.sort_array(F.collect_list(entry)).alias("__entries"))
    entries = F.transform("__entries", lambda e: F.struct(*[e[c].alias(c) for c in rest]))
    return pages.select(*[col(k) for k in by], "page", entries.alias("entries"))


def parse_updates(form: DataFrame, text: str, value: str) -> DataFrame:
    """Rows with a non-blank text, read as double; a text that is no number raises."""
    given = form.filter(F.coalesce(F.trim(col(text)), F.lit("")) != "")
    return given.withColumn(value, F.trim(col(text)).cast("double"))


def split_updates(form: DataFrame, text: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) rows with a non-blank text, for callers that go on past bad ones."""
    given = form.filter(F.coalesce(F.trim(col(text)), F.lit("")) != "").withColumn(value, to_number(col(text)))
    return given.filter(col(value).isNotNull()), given.filter(col(value).isNull()).drop(value)


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({f"__low_{i}": F.lower(col(k)) for i, k in enumerate(keys)})


def apply_corrections(
    df: DataFrame, updates: DataFrame, keys: Sequence[str], value: str, new_value: str, order: Column,
    exact: Sequence[str] = (),
) -> DataFrame:
    """Set ``value`` on all rows whose keys equal an update's, ignoring case (``exact`` keys: with case);
    the latest update wins. The column becomes a double; texts that are no number, such as the sentinels a worklist
    names, read as NULL."""
    low = [f"__low_{i}" for i in range(len(keys))]
    given = _keyed(known(updates, [*keys, *exact]), keys)
    latest = given.groupBy(*low, *[col(k) for k in exact]).agg(F.max_by(col(new_value), order).alias("__new"))
    marked = attach(_keyed(df, keys), latest, [*low, *exact])
    text = isinstance(df.schema[value].dataType, T.StringType)
    changed = F.coalesce(F.col("__new"), to_number(col(value)) if text else col(value).cast("double"))
    return marked.withColumn(value, changed).drop("__new", *low)


def unmatched(df: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Updates without a row to change."""
    low = [f"__low_{i}" for i in range(len(keys))]
    asked = _keyed(updates, keys)
    # Keys of the table that are asked for, each once: a semi join lets no other row into the shuffle.
    rows = _keyed(df.select(*[col(k) for k in keys]), keys).select(*low)
    present = rows.join(asked.select(*low).distinct(), low, "left_semi").distinct()
    return asked.join(present, low, "left_anti").drop(*low)
