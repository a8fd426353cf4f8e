"""Numeric coercion, zero-safe arithmetic and missing-value tests as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^[+-]?(?i:inf|infinity)$"

# Texts that stand for a missing value.
MISSING_TEXTS = ("", "n/a", "na", "null", "none", "nan", "-")


def bare(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.trim(text, F.lit(" \t\n\r\x0b\x0c"))


def to_number(text: Column) -> Column:
    """Text to double; anything that is not a plain number becomes NULL (never NaN)."""
    trimmed = bare(text.cast("string"))
    return F.when(trimmed.rlike(NUMBER), trimmed.try_cast("double"))


def no_nan(number: Column) -> Column:
    return F.nanvl(number.cast("double"), F.lit(None).cast("double"))


def safe_ratio(top: Column, bottom: Column) -> Column:
    """NULL instead of an error when the denominator is zero."""
    return top / F.nullif(bottom, F.lit(0).cast("double"))


def round_half_even(number: Column, digits: int = 2) -> Column:
    """Scale, round to the nearest even integer, scale back."""
    scale = float(10**digits)
    return F.rint(number * scale) / scale


def log_target(target: Column) -> Column:
    return F.log1p(target)


def unlog_target(target: Column) -> Column:
    return F.expm1(target)


def is_missing(value: Column, texts: Sequence[str] = MISSING_TEXTS) -> Column:
    """True for NULL, NaN and the texts that mean "no value"."""
    text = F.lower(bare(value.cast("string")))
    return value.isNull() | text.isin(*texts)


def clean_code(text: Column, heading: str = "NATION") -> Column:
    """Last word in upper case; the heading itself and NULL give NULL."""
    last = F.upper(F.element_at(F.split(bare(text), r"\s+"), -1))
    return F.nullif(last, F.lit(heading))
