"""Exploratory aggregates behind the usual charts. Results are small; inputs are not."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chart resolution.
BINS = 30


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), column)


def rate_by(df: DataFrame, part: Column, name: str) -> DataFrame:
    """Failure rate in percent per value of ``part``."""
    return df.groupBy(part.alias(name)).agg((F.avg("failure") * 100).alias("failure_rate"))


def dataset_stats(df: DataFrame, key: str, approximate: bool = False) -> DataFrame:
    distinct = F.approx_count_distinct(key) if approximate else F.countDistinct(key)
    return df.agg(F.count("*").alias("rows"), distinct.alias("machines"))


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*order).limit(n)


def _long(one_row: DataFrame, names: Sequence[tuple[str, ...]], labels: Sequence[str], value: str) -> DataFrame:
    """Turn the aggregates ``c0, c1, …`` of a single row into labelled rows."""
    entries = [
        F.struct(*[F.lit(t).alias(label) for label, t in zip(labels, name)], F.col(f"c{i}").alias(value))
        for i, name in enumerate(names)
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


_PAIR_SUMS = "i int, j int, n double, x double, y double, xx double, yy double, xy double"


def _gram(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairwise sums over rows where both columns are known, as matrix products per batch."""
    total = None
    for batch in batches:
        values = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])
        known = ~np.isnan(values)
        mask = known.astype(float)
        filled = np.where(known, values, 0.0)
        squares = filled * filled
        part = np.stack(
            [mask.T @ mask, filled.T @ mask, mask.T @ filled, squares.T @ mask, mask.T @ squares, filled.T @ filled]
        )
        total = part if total is None else total + part
    if total is None:
        return
    i, j = np.triu_indices(total.shape[1], 1)
    columns = [i.astype("int32"), j.astype("int32"), *[t[i, j] for t in total]]
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in _PAIR_SUMS.split(", ")])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of all pairs of ``columns`` (each once), in one pass.

    A pair uses the rows where both values are known; a constant column gives null.
    Built-in ``corr`` per pair runs outside generated code once there are dozens of
    pairs, so each task sums all pairs with a few matrix products on Arrow batches
    and sends one row per pair. Values are shifted by the column mean first, which
    keeps the sums well conditioned.
    """
    means = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).alias("m")).scalar()
    shifted = df.select(*[F.col(c).cast("double").alias(c) for c in columns], means.alias("_m")).select(
        *[(F.col(c) - F.col(f"_m.{c}")).alias(c) for c in columns]
    )
    sums = shifted.mapInArrow(_gram, _PAIR_SUMS).groupBy("i", "j").agg(
        *[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")]
    )

    def spread(square: str, plain: str) -> Column:
        rest = F.col(square) - F.try_divide(F.col(plain) * F.col(plain), F.col("n"))
        # What is left of a constant column is rounding only.
        return F.when(rest > F.col(square) * F.lit(1e-12), rest)

    shared = F.col("xy") - F.try_divide(F.col("x") * F.col("y"), F.col("n"))
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        names[F.col("i")].alias("left"),
        names[F.col("j")].alias("right"),
        (shared / F.sqrt(spread("xx", "x") * spread("yy", "y"))).alias("correlation"),
    )


def correlation_with(df: DataFrame, columns: Sequence[str], label: str) -> DataFrame:
    pairs = correlation_matrix(df, [*columns, label]).where(F.col("right") == label)
    return pairs.select(F.col("left").alias("feature"), "correlation")


def top_features(importances: DataFrame, n: int) -> DataFrame:
    """Largest importances; names break ties."""
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def melt(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    return df.select(*keys, *[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        list(keys), list(columns), name, value
    )


def _bin(value: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Bin number with shared edges; the upper edge belongs to the last bin."""
    step = (hi - lo) / F.lit(bins)
    return F.when(hi == lo, 0).otherwise(F.least(F.floor((value - lo) / step), F.lit(bins - 1))).cast("int")


def histograms(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Counts per feature, bin and class.

    Bounds have one row per feature (the column list), so they are broadcast.
    """
    values = melt(df, ["failure"], columns, "feature", "x").where(F.col("x").isNotNull())
    bounds = _per_column_bounds(df, columns)
    placed = values.join(F.broadcast(bounds), "feature")
    return placed.groupBy("feature", _bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin"), "failure").agg(
        F.count("*").alias("rows")
    )


def _per_column_bounds(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, lo, hi): one row per named column, from one narrow aggregate."""
    one = df.agg(
        *[
            F.struct(F.min(F.col(c).cast("double")).alias("lo"), F.max(F.col(c).cast("double")).alias("hi")).alias(
                f"c{i}"
            )
            for i, c in enumerate(columns)
        ]
    )
    return _long(one, [(c,) for c in columns], ("feature",), "b").select("feature", "b.lo", "b.hi")


def densities(df: DataFrame, columns: Sequence[str], points: int = BINS) -> DataFrame:
    """Gaussian kernel density per feature and class on a shared grid.

    Bandwidth follows Scott's rule (sample deviation times n^-1/5). All grid
    points are sums of one aggregation, so rows are never multiplied by the grid.
    """
    values = melt(df, ["failure"], columns, "feature", "x").where(F.col("x").isNotNull())
    spread = values.groupBy("feature", "failure").agg(
        F.count("*").alias("n"), (F.stddev_samp("x") * F.pow(F.count("*"), F.lit(-0.2))).alias("h")
    )
    # One row per (named column, class): bounded by the column list.
    shape = spread.join(F.broadcast(_per_column_bounds(df, columns)), "feature").where(F.col("h") > 0)
    joined = values.join(F.broadcast(shape), ["feature", "failure"])

    def at(i: int) -> Column:
        return F.col("lo") + (F.col("hi") - F.col("lo")) * F.lit(i) / F.lit(points - 1)

    def kernel(i: int) -> Column:
        u = (F.col("x") - at(i)) / F.col("h")
        return F.sum(F.exp(u * u * F.lit(-0.5)))

    sums = joined.groupBy("feature", "failure", "n", "h", "lo", "hi").agg(
        *[kernel(i).alias(f"k{i}") for i in range(points)]
    )
    grid = F.array(*[F.struct(F.lit(i).alias("point"), at(i).alias("x"), F.col(f"k{i}").alias("k")) for i in range(points)])
    scale = F.col("n") * F.col("h") * F.sqrt(F.lit(2.0) * F.pi())
    return sums.select("feature", "failure", "n", "h", F.explode(grid).alias("g")).select(
        "feature", "failure", F.col("g.point").alias("point"), F.col("g.x").alias("x"), (F.col("g.k") / scale).alias("density")
    )


def pair_densities(df: DataFrame, pairs: Sequence[tuple[str, str]], bins: int = BINS) -> DataFrame:
    """Binned counts of variable pairs by class."""
    columns = sorted({c for pair in pairs for c in pair})
    bounds = F.broadcast(_per_column_bounds(df, columns))
    entries = F.array(
        *[
            F.struct(
                F.lit(a).alias("x_name"),
                F.lit(b).alias("y_name"),
                F.col(a).cast("double").alias("x"),
                F.col(b).cast("double").alias("y"),
            )
            for a, b in pairs
        ]
    )
    values = df.select("failure", F.explode(entries).alias("e")).select("failure", "e.*")
    values = values.where(F.col("x").isNotNull() & F.col("y").isNotNull())
    x_side = bounds.toDF("x_name", "x_lo", "x_hi")
    y_side = bounds.toDF("y_name", "y_lo", "y_hi")
    placed = values.join(x_side, "x_name").join(y_side, "y_name")
    return placed.groupBy(
        "x_name",
        "y_name",
        _bin(F.col("x"), F.col("x_lo"), F.col("x_hi"), bins).alias("x_bin"),
        _bin(F.col("y"), F.col("y_lo"), F.col("y_hi"), bins).alias("y_bin"),
        "failure",
    ).agg(F.count("*").alias("rows"))


def standardize(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0.

    The moments are one row, read through scalar subqueries, so no join is needed.
    """
    moments = df.agg(
        F.struct(
            *[F.avg(c).alias(f"mean_{c}") for c in columns],
            *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
        ).alias("m")
    ).scalar()
    out = df.select(*keys, *columns, moments.alias("_m"))
    return out.select(
        *keys,
        *[
            (
                (F.col(c) - F.col(f"_m.mean_{c}"))
                / F.when(F.col(f"_m.std_{c}") == 0, 1.0).otherwise(F.col(f"_m.std_{c}"))
            ).alias(c)
            for c in columns
        ],
    )
