"""Risk class of a failure probability."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_half_even

# Class limits (lower bound inclusive) and rounding.
MEDIUM_FROM = 0.3
HIGH_FROM = 0.7
DIGITS = 3


def risk_level(p: Column) -> Column:
    """Class of the unrounded probability; NaN is HIGH, null stays null."""
    return F.when(p < MEDIUM_FROM, "LOW").when(p < HIGH_FROM, "MEDIUM").when(p.isNotNull(), "HIGH")


def shown_probability(p: Column) -> Column:
    return round_half_even(p, DIGITS)
