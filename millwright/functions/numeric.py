"""Arithmetic with the null and zero rules the features rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, floor: float | None = None) -> Column:
    """``numerator / max(denominator, floor)``; null when an input is null.

    Without a floor a zero denominator also gives null instead of an ANSI error.
    ``greatest`` skips nulls, so the null denominator is guarded explicitly.
    """
    if floor is None:
        return F.try_divide(numerator, denominator)
    return F.when(denominator.isNotNull(), numerator / F.greatest(denominator, F.lit(float(floor))))


def round_half_even(value: Column, digits: int) -> Column:
    return F.bround(value, digits)


def exact_text(value: Column) -> Column:
    """The shortest text that reads back as the same float: 0.1 stays 0.1, and no magnitude is lost.

    A decimal type of fixed scale would round small values and overflow on large ones; the writer
    of items builds its decimal from this text.
    """
    return value.cast("string")


def logistic(weights: dict[str, float], intercept: float) -> Column:
    z = F.lit(float(intercept))
    for name, weight in weights.items():
        z = z + F.col(name) * F.lit(float(weight))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def stable_bucket(*keys: Column, seed: int = 42, buckets: int = 10000) -> Column:
    """A bucket in ``[0, buckets)`` that depends on the key alone.

    md5 keeps the draw reproducible in any engine and independent of partitioning.
    """
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    head = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, F.lit(buckets)).cast("int")


HASH_BITS = 60


def stable_hash(*keys: Column, seed: int = 42) -> Column:
    """The first 60 bits of the MD5 of the keys and the seed, as a number that is never negative."""
    text = F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")
