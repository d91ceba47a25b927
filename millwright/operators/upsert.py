"""Keyed upsert of a source frame into a target frame.

Update and insert run as two joins instead of one full outer join: the update is
a left join that Spark may broadcast or split on skew, and the insert is an anti
join on keys only. The source is written first, so its size is known when the
joins are planned: beside a daily source that Spark can broadcast, a large target isn't shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; counting combines before the shuffle."""
    return source.groupBy(*keys).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def latest_per_key(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``."""
    rest = [c for c in source.columns if c not in keys]
    picked = source.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return picked.select(*keys, "r.*").select(*source.columns)


def one_row_per_key(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source itself, failing at run time when a complete key repeats.

    Rows with a null in the key never match anything, so they may repeat.
    """
    rest = [c for c in source.columns if c not in keys]
    keyed, loose = _split_keyed(source, keys)
    grouped = keyed.groupBy(*keys).agg(F.count("*").alias("n"), F.first(F.struct(*rest)).alias("r"))
    text = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    checked = grouped.withColumn(
        "n", F.when(F.col("n") > 1, F.raise_error(F.concat(F.lit("several source rows for key "), text)).cast("long")).otherwise(F.col("n"))
    ).where(F.col("n") == 1)
    return checked.select(*keys, "r.*").select(*source.columns).unionByName(loose)


def _split_keyed(source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    complete: Column = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    return source.where(complete), source.where(~complete)


def resolve_duplicates(
    source: DataFrame, keys: Sequence[str], duplicates: str, order: Sequence[str] = ()
) -> DataFrame:
    if duplicates == "error":
        return one_row_per_key(source, keys)
    if duplicates == "merge":
        return source
    if duplicates == "latest":
        keyed, loose = _split_keyed(source, keys)
        return latest_per_key(keyed, keys, order).unionByName(loose)
    raise ValueError(f"unknown duplicate policy {duplicates!r}")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    updated: Sequence[str],
    duplicates: str = "merge",
    order: Sequence[str] = (),
) -> DataFrame:
    """Target with matching rows updated and unmatched source rows appended.

    Only ``updated`` columns change on a match. Null keys match nothing. The
    checked source is written once, so Spark plans the joins on its true size.
    Repeated source keys follow MERGE (``merge``): they fail when they match a target row, and are all
    appended when they don't. ``error`` fails on any repeat, ``latest`` keeps the greatest by ``order``.
    """
    clean = written(resolve_duplicates(source, keys, duplicates, order), "upsert-source")
    keyed, loose = _split_keyed(clean, keys)
    incoming = keyed.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.first(F.struct(*updated)).alias("_new"), F.count("*").alias("_copies")
    )
    # counted once and written, so that the join is planned on its true size
    incoming = written(incoming, "upsert-incoming")
    named = F.concat_ws(", ", *[F.col(f"_k_{k}").cast("string") for k in keys])
    repeated = F.raise_error(F.concat(F.lit("several source rows for key "), named))
    on: Column = F.lit(True)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_k_{k}"))
    replaced = target.join(incoming, on, "left").select(
        *[
            F.when(F.col("_copies") > 1, repeated.cast(target.schema[c].dataType))
            .when(F.col("_new").isNotNull(), F.col(f"_new.{c}"))
            .otherwise(F.col(c))
            .alias(c)
            if c in updated
            else F.col(c)
            for c in target.columns
        ]
    )
    # Few target keys survive this semi join; the anti join then never sees the whole target.
    known = target.select(*keys).join(keyed.select(*keys), list(keys), "left_semi")
    added = keyed.join(known, list(keys), "left_anti").unionByName(loose)
    return replaced.unionByName(added.select(*target.columns))


def merge_into_catalog(
    source: DataFrame, table: str, keys: Sequence[str], updated: Sequence[str], inserted: Sequence[str]
) -> None:
    """Native MERGE for catalogs whose tables take row-level operations."""
    on: Column = F.lit(True)
    for k in keys:
        on = on & (F.col(f"{table.split('.')[-1]}.{k}") == F.col(f"source.{k}"))
    (
        source.alias("source")
        .mergeInto(table, on)
        .whenMatched()
        .update({c: F.col(f"source.{c}") for c in updated})
        .whenNotMatched()
        .insert({c: F.col(f"source.{c}") for c in inserted})
        .merge()
    )
