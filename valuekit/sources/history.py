"""Nested value histories as flat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.functions.text import let, parse_date
from valuekit.scale import col

HISTORY = "array<struct<date:string,clubName:string,marketValue:double>>"


def explode_history(df: DataFrame, id: str, history: str, is_json: bool = True, keep_empty: bool = False) -> DataFrame:
    """(id, position, date, club, value) per history entry. Text that is no JSON array counts as empty;
    a single object counts as a list of one."""
    entries = col(history)
    if is_json:
        # Bound once: the column may be computed, and is used several times.
        entries = let(entries, lambda e: F.from_json(F.when(F.startswith(F.trim(e), F.lit("{")), F.concat(F.lit("["), e, F.lit("]"))).otherwise(e), HISTORY))
    explode = F.posexplode_outer if keep_empty else F.posexplode
    flat = df.select(col(id).alias("id"), explode(entries).alias("position", "entry"))
    return flat.select(
        "id", "position", parse_date(F.col("entry.date")).alias("date"),
        F.col("entry.clubName").alias("club"), F.col("entry.marketValue").alias("value"),
    )
