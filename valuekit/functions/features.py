"""Feature formulas as small specs over column names; all of them land in one projection."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from valuekit.functions.numbers import safe_ratio
from valuekit.scale import col


@dataclass(frozen=True)
class Spec:
    needs: frozenset[str]
    build: Callable[[], Column]


def _spec(x: Spec | str) -> Spec:
    return x if isinstance(x, Spec) else Spec(frozenset({x}), lambda: col(x).cast("double"))


def ratio(top: Spec | str, bottom: Spec | str) -> Spec:
    a, b = _spec(top), _spec(bottom)
    return Spec(a.needs | b.needs, lambda: safe_ratio(a.build(), b.build()))


def diff(left: Spec | str, right: Spec | str) -> Spec:
    a, b = _spec(left), _spec(right)
    return Spec(a.needs | b.needs, lambda: a.build() - b.build())


def weighted(weights: Mapping[str, float]) -> Spec:
    def build() -> Column:
        terms = [col(c).cast("double") * F.lit(float(w)) if w != 1 else col(c).cast("double") for c, w in weights.items()]
        return sum(terms[1:], terms[0])

    return Spec(frozenset(weights), build)


def total(*columns: str) -> Spec:
    return weighted(dict.fromkeys(columns, 1))


def features(df: DataFrame, specs: Mapping[str, Spec]) -> DataFrame:
    """Add every feature whose inputs exist, replacing columns of the same name."""
    present = set(df.columns)
    return df.withColumns({name: s.build() for name, s in specs.items() if s.needs <= present})
