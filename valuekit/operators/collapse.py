"""Collapse the rows of one entity and season into one."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from valuekit.functions.numbers import to_number
from valuekit.scale import col, known


def as_number(df: DataFrame, name: str) -> Column:
    return to_number(col(name)) if isinstance(df.schema[name].dataType, T.StringType) else col(name).cast("double")


def weighted_mean(value: Column, weight: Column, nulls: str = "propagate") -> Column:
    """Weighted mean; the plain mean of what is known when the weights sum to nothing.

    ``propagate``: one NULL value makes the mean NULL, whatever its weight. ``skip``: NULLs take no part.
    """
    load = F.sum(weight if nulls == "propagate" else F.when(value.isNotNull(), weight))
    mean = F.sum(value * weight) / load
    if nulls == "propagate":
        mean = F.when(F.count(value) == F.count("*"), mean)
    return F.when(load > 0, mean).otherwise(F.avg(value))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def distinct_join(name: str, separator: str = "/") -> Column:
    """Distinct values of a column, sorted and joined; empty text when there are none.

    The distinct aggregate meets in two steps: each value of a key once by (key, value), whichever key is hot, then lists of them per key.
    """
    return F.array_join(F.sort_array(F.expr(f"collect_list(DISTINCT CAST({_quoted(name)} AS STRING))")), separator)


def token_union(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], split_on: str = "[,/]", separator: str = ", "
) -> DataFrame:
    """Per key, the distinct tokens of each column, sorted and joined; empty text when there are none. Tokens part before they meet."""
    cells = [F.transform(F.split(col(c), split_on), lambda t: F.struct(F.lit(i).alias("place"), F.trim(t).alias("token"))) for i, c in enumerate(columns)]
    none = F.array().cast("array<struct<place:int,token:string>>")
    flat = df.select(*[col(k) for k in keys], F.explode_outer(F.concat(*[F.coalesce(c, none) for c in cells])).alias("__cell"))
    found = flat.select(*[col(k) for k in keys], *[F.when((F.col("__cell.place") == i) & (F.col("__cell.token") != ""), F.col("__cell.token")).alias(f"__token_{i}") for i in range(len(columns))])
    return found.groupBy(*[col(k) for k in keys]).agg(*[distinct_join(f"__token_{i}", separator).alias(c) for i, c in enumerate(columns)])


def collapse(
    df: DataFrame,
    keys: Sequence[str],
    weight: str | None,
    policy: Mapping[str, str],
    nulls: str = "propagate",
    order: Sequence[Column] = (),
) -> DataFrame:
    """One row per key (NULL keys dropped) in one aggregation whose partial sums and sets meet in steps; tokens have one of their own.

    ``policy`` names the rule per column: ``wmean`` weighted mean, ``wmean_or_join`` the same as text, or the distinct
    texts joined for a key that holds no number, ``sum``, ``join`` distinct texts (NULL
    when none), ``join_blank`` the same with empty text, ``tokens`` union of tokens, ``first`` by ``order``.
    The weight column itself is summed; without it every row weighs 1.
    """
    weighed = weight is not None and weight in df.columns
    load = F.coalesce(as_number(df, weight), F.lit(0.0)) if weighed else F.lit(1.0)

    def result(name: str, rule: str) -> Column:
        if name == weight:
            return F.sum(load)
        if rule == "wmean":
            return weighted_mean(as_number(df, name), load, nulls)
        if rule == "wmean_or_join":
            number = as_number(df, name)
            mean = weighted_mean(number, load, nulls).cast("string")
            return F.when(F.count(number) > 0, mean).otherwise(F.nullif(distinct_join(name), F.lit("")))
        if rule == "sum":
            return F.sum(as_number(df, name))
        if rule == "join":
            return F.nullif(distinct_join(name), F.lit(""))
        if rule == "join_blank":
            return distinct_join(name)
        if rule == "first":
            return F.min_by(col(name), F.when(col(name).isNotNull(), F.struct(*order)))
        raise ValueError(f"unknown rule {rule!r} for {name!r}")

    rules = {c: r for c, r in policy.items() if c in df.columns and c not in keys}
    tokens = [c for c, r in rules.items() if r == "tokens" and c != weight]
    rows, by = known(df, keys), [col(k) for k in keys]
    if len(tokens) == len(rules) and tokens:
        return token_union(rows, keys, tokens)
    plain = rows.groupBy(*by).agg(*[result(c, r).alias(c) for c, r in rules.items() if c not in tokens])
    if not tokens:
        return plain
    # Both sides have one row per key and lie parted by it.
    return plain.join(token_union(rows, keys, tokens), list(keys)).select(*by, *[col(c) for c in rules])
