"""Match named entities to an index of ids: spelling cascade first, last name and club second."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.fuzzy import resembling
from valuekit.functions.text import cascade_keys, last_name, name_key, name_key_spaced, repair_mojibake
from valuekit.operators.clean import dedupe_first
from valuekit.scale import PAIRS_PER_TASK, attach, col, lookup, pair_off, settle


def join_on_name(
    left: DataFrame, right: DataFrame, name: str, take: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Left join on the normalised name; the right side's first row per key wins.

    Without the name column on either side the left table comes back unchanged.
    """
    if name not in left.columns or name not in right.columns:
        return left
    keyed = right.withColumn("__name", name_key(col(name)))
    first = dedupe_first(keyed, ["__name"], order).select("__name", *[col(c) for c in take])
    return attach(left.withColumn("__name", name_key(col(name))), first, ["__name"]).drop("__name")


def listed_under(index: DataFrame) -> DataFrame:
    """Best index entry per spelling: one with a value first, then in result order.

    The choice does not depend on who searches, so it is made before the join, which is then many-to-one.
    """
    name = F.col("name")
    spellings = F.array_distinct(F.array_compact(F.array(name, F.lower(name), name_key(name), name_key_spaced(name))))
    priced = F.coalesce(F.col("market_value") != 0, F.lit(False))
    return (
        index.select(F.explode(spellings).alias("key"), "id", (~priced).alias("unpriced"), "result_rank")
        .groupBy("key")
        .agg(F.min_by("id", F.struct("unpriced", "result_rank", "id")).alias("id"))
    )


def match_by_spelling(names: DataFrame, index: DataFrame, name: str) -> DataFrame:
    """``(name, id)`` for each distinct name whose spelling cascade hits the index; the first hit wins.

    Most names hit as they stand, so that one key is tried first; only the rest unfold into all spellings.
    """
    wanted = names.select(col(name)).filter(col(name).isNotNull()).distinct()
    listed = listed_under(index)
    literal = lookup(wanted.withColumn("key", repair_mojibake(col(name))), listed, ["key"]).drop("key").withColumnRenamed("id", "__literal")
    tries = F.when(F.col("__literal").isNull(), cascade_keys(col(name))).otherwise(F.array(F.lit(None).cast("string")))
    unfolded = literal.select(col(name), "__literal", F.posexplode(tries).alias("priority", "key"))
    # A name that hit as it stands has one empty try, which nothing is listed under.
    hits = lookup(unfolded, listed.filter("key IS NOT NULL"), ["key"]).withColumn("id", F.coalesce("__literal", "id"))
    return hits.filter(F.col("id").isNotNull()).groupBy(col(name)).agg(F.min_by("id", "priority").alias("id"))


def match_by_last_name(
    people: DataFrame, index: DataFrame, name: str, team: str, min_score: float = 80, pairs: int = PAIRS_PER_TASK
) -> DataFrame:
    """``(name, team, id, score)`` for the club most similar among index entries of the same last name.

    Only distinct (last name, team) and (last name, club) meet, in slices of about ``pairs`` pairs.
    """
    wanted = people.select(col(name), col(team)).distinct().withColumn("__last", last_name(col(name)))
    wanted = wanted.filter((F.col("__last") != "") & (col(team) != ""))
    teams = wanted.select("__last", col(team).alias("__team")).distinct()
    # Of entries with one club the first listed wins, as a later equal score never replaces an earlier one.
    clubs = (
        index.select(last_name(F.col("name")).alias("__last"), F.coalesce("club", F.lit("")).alias("__club"), "id", "result_rank")
        .filter(F.col("__last") != "")
        .groupBy("__last", "__club")
        .agg(F.min(F.struct("result_rank", "id")).alias("__entry"))
    )
    scored = resembling(pair_off(teams, clubs, ["__last"], "__team", "__club", pairs), "__team", "__club", min_score)
    best = scored.groupBy("__last", "__team").agg(
        F.max("score").alias("score"),
        F.min_by(F.col("__entry.id"), F.struct(-F.col("score"), F.col("__entry"))).alias("id"),
    )
    found = lookup(wanted, best.withColumnRenamed("__team", team), ["__last", team])
    return found.filter(F.col("id").isNotNull()).select(col(name), col(team), "id", "score")


def match_entities(df: DataFrame, index: DataFrame, name: str, team: str, min_score: float = 80) -> DataFrame:
    """``(name, team, id, found_by)`` for each distinct pair that has a match."""
    people = df.select(col(name), col(team)).filter(col(name).isNotNull()).distinct()
    spelled = settle(lookup(people, match_by_spelling(people, index, name), [name]))
    direct = spelled.filter(F.col("id").isNotNull()).withColumn("found_by", F.lit("spelling"))
    rest = spelled.filter(F.col("id").isNull()).select(col(name), col(team))
    fallback = match_by_last_name(rest, index, name, team, min_score)
    return direct.unionByName(fallback.drop("score").withColumn("found_by", F.lit("last_name")))
