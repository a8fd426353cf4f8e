"""League, season, variant and model read from file paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Prediction folder -> model name.
MODEL_FOLDERS = {
    "linear_regression": "Linear Regression",
    "random_forest": "Random Forest",
    "xgboost": "XGBoost",
}


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def base_name(path: Column) -> Column:
    """File name up to its first dot (a leading dot belongs to the name)."""
    return F.regexp_extract(file_name(path), r"^(\.?[^.]*)", 1)


def updated_name(path: Column) -> Column:
    """``cleaned_x.ext`` and ``x.ext`` both become ``updated_x.ext``."""
    stem = F.regexp_replace(base_name(path), r"^(cleaned_)?", "updated_")
    return F.concat(stem, F.regexp_extract(file_name(path), r"[^.](\.[^.]+)$", 1))


def season_end_year(path: Column) -> Column:
    """Second year of ``yyyy-yyyy``; NULL when there is none."""
    return F.nullif(F.regexp_extract(path, r"(\d{4})-(\d{4})", 2), F.lit("")).cast("int")


def season_range(end_year: Column) -> tuple[Column, Column]:
    """First and last day of the season that ends in June of ``end_year``."""
    return F.make_date(end_year - 1, F.lit(7), F.lit(1)), F.make_date(end_year, F.lit(6), F.lit(30))


def season_of(day: Column) -> Column:
    """End year of the season a day falls in: July starts the next one."""
    return F.year(day) + F.when(F.month(day) >= 7, 1).otherwise(0)


def league_and_season(path: Column) -> tuple[Column, Column]:
    """Second and third ``_`` part of the file name; both NULL when there are fewer parts."""
    parts = F.split(base_name(path), "_")
    complete = F.size(parts) >= 3
    return F.when(complete, F.get(parts, F.lit(1))), F.when(complete, F.get(parts, F.lit(2)))


def dataset_key(league: Column, season: Column, variant: Column) -> Column:
    return F.when(league.isNotNull() & season.isNotNull(), F.concat_ws("_", league, season, variant))


def split_dataset_key(key: Column) -> tuple[Column, Column, Column]:
    """League, season and the rejoined variant; all NULL when the key is shorter."""
    parts = F.split(key, "_")
    complete = F.size(parts) >= 3
    variant = F.array_join(F.slice(parts, 3, F.greatest(F.size(parts) - 2, F.lit(0))), "_")
    return (
        F.when(complete, F.get(parts, F.lit(0))),
        F.when(complete, F.get(parts, F.lit(1))),
        F.when(complete, variant),
    )


def relative_path(path: Column, base: Column) -> Column:
    root = F.concat(F.rtrim(base, F.lit("/")), F.lit("/"))
    return F.when(F.startswith(path, root), F.substr(path, F.length(root) + 1)).otherwise(path)


def prediction_parts(path: Column) -> dict[str, Column]:
    """Model, variant and league_season of a prediction file."""
    folders = "|".join(MODEL_FOLDERS)
    anywhere = rf"(?:^|/)({folders})(?=/|$)"
    known = F.lit(None).cast("string")
    # The first name in the list wins when several appear in one path.
    for folder, model in reversed(MODEL_FOLDERS.items()):
        known = F.when(path.rlike(rf"(^|/){folder}(/|$)"), model).otherwise(known)
    variant = F.regexp_extract(path, rf"{anywhere}/([^/]+)", 2)
    name = F.regexp_replace(F.regexp_replace(file_name(path), r"^predicted_updated_", ""), r"\.parquet$", "")
    return {
        "model_name": F.coalesce(known, F.lit("Unknown Model")),
        "fe_variant": F.coalesce(F.nullif(variant, F.lit("")), F.lit("Unknown")),
        "league_season": name,
    }


def prediction_catalog(files: DataFrame, path: str = "path", base: str = "") -> DataFrame:
    """One row and link per (model, variant, league_season); the greatest link wins."""
    parts = prediction_parts(F.col(path))
    link = relative_path(F.col(path), F.lit(base)) if base else F.col(path)
    rows = files.select(*[c.alias(n) for n, c in parts.items()], link.alias("link"))
    return rows.groupBy(*parts).agg(F.max("link").alias("link"))
