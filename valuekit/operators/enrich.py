"""Attach the right entry of a dated value history to each entity and season."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from valuekit.functions.fuzzy import resembling
from valuekit.functions.paths import season_of
from valuekit.scale import attach, col, lookup, pair_off, settle


def in_season(history: DataFrame, season_end: int | None = None) -> DataFrame:
    """History entries with the season their date falls in; unparsable dates fall in none.

    Seasons run from July to June without gaps, so a date has exactly one and the interval test turns
    into an equality on ``season_end``.
    """
    dated = history.filter(F.col("date").isNotNull()).withColumn("season_end", season_of(F.col("date")))
    return dated if season_end is None else dated.filter(F.col("season_end") == season_end)


def pick_value(
    df: DataFrame, history: DataFrame, id: str = "id", team: str = "squad", season_end: str = "season_end",
    min_score: float = 80, keep: Sequence[str] = (),
) -> DataFrame:
    """Value per distinct (id, team, season): of the season's entries whose club resembles the team the one
    nearest to the season's end, else the earliest entry of the whole history.

    ``history`` is flat: (id, position, date, club, value). ``match_kind`` tells which rule applied; ``keep``
    names further columns of ``df`` to carry along.
    """
    keys = [id, team, season_end, *keep]
    wanted = settle(df.select(*[col(k) for k in keys]).filter(col(id).isNotNull()).distinct())
    last_day = F.make_date(F.col("season_end"), F.lit(6), F.lit(30))
    place = F.struct(F.datediff(last_day, "date").alias("days"), F.col("position").alias("position"))
    entry = F.struct(place.alias("place"), F.col("value").alias("value"))
    # One entry per club, season and id is enough: it is the nearest of its kind.
    clubs = (
        in_season(history)
        .withColumn("__club", F.coalesce("club", F.lit("")))
        .groupBy(F.col("id").alias(id), F.col("season_end").alias(season_end), "__club")
        .agg(F.min_by(entry, place).alias("entry"))
    )
    # Teams and clubs meet as distinct texts of an id and season, each club with its entry.
    teams = wanted.select(col(id), col(season_end), col(team).alias("__team")).distinct()
    met = pair_off(teams, clubs, [id, season_end], "__team", "__club")
    good = resembling(met, "__team", "__club", min_score, "__score")
    nearest = good.groupBy(col(id), col(season_end), "__team").agg(F.min_by("entry", F.col("entry.place")).alias("nearest"))
    far = F.make_date(F.lit(9999), F.lit(12), F.lit(31))
    age = F.struct(F.coalesce("date", far).alias("date"), F.col("position").alias("position"))
    earliest = history.groupBy(F.col("id").alias(id)).agg(
        F.min_by(F.struct(F.col("value").alias("value")), age).alias("earliest")
    )
    both = lookup(lookup(wanted, nearest.withColumnRenamed("__team", team), [id, season_end, team]), earliest, [id])
    found = F.col("nearest").isNotNull()
    return both.select(
        *[col(k) for k in keys],
        F.when(found, F.col("nearest.value")).otherwise(F.col("earliest.value")).alias("value"),
        F.when(found, "season_club").when(F.col("earliest").isNotNull(), "earliest").otherwise("none").alias("match_kind"),
    )


def enrich(
    df: DataFrame, matches: DataFrame, history: DataFrame, name: str = "player", team: str = "squad",
    season_end: str = "season_end", value: str = "Market Value",
) -> DataFrame:
    """Every row keeps its place and gets a value or NULL."""
    people = df.select(col(name), col(team), col(season_end)).distinct()
    known = lookup(people, matches.select(col(name), col(team), "id"), [name, team])
    keys = [name, team, season_end]
    picked = pick_value(known, history, "id", team, season_end, keep=[name])
    valued = picked.select(*[col(k) for k in keys], F.col("value").cast("double").alias(value), "match_kind")
    enriched = attach(df.drop(value, "match_kind"), valued, keys)
    return enriched.withColumn("match_kind", F.coalesce("match_kind", F.lit("none")))


def full_history(df: DataFrame, matches: DataFrame, history: DataFrame, name: str = "player", team: str = "squad") -> DataFrame:
    """All history entries of every matched (name, team), one row each."""
    people = df.select(col(name), col(team)).distinct()
    known = settle(people.join(matches.select(col(name), col(team), "id"), [name, team]))
    # Many people may have one id, and an id many entries: a heavy one is cut on both sides.
    return pair_off(known, settle(history), ["id"], name, "position")
