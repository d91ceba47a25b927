"""Deterministic splits: plain draws that need no shuffle, and exact stratified ones.

The stratified split orders the rows of a class by a hash of their keys and cuts the order at exact places. The cuts are
order statistics, found by histograms: rows are counted by the leading bits of their hash, and the bins that hold a cut
are counted again by their next bits, until a cut lies between bins. No class is ever sorted or gathered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import HASH_BITS, stable_bucket, stable_hash
from ..session import written

# Split share, folds and seed.
TRAIN_SHARE = 0.75
FOLDS = 5
SEED = 42
BUCKETS = 10000


def split_column(keys: Sequence[str], share: float = TRAIN_SHARE, seed: int = SEED) -> Column:
    """True for training rows. The draw ignores the class, so every stratum keeps its share."""
    bucket = stable_bucket(*[F.col(k) for k in keys], seed=seed, buckets=BUCKETS)
    return bucket < F.lit(round(share * BUCKETS))


def train_test(df: DataFrame, keys: Sequence[str], share: float = TRAIN_SHARE) -> tuple[DataFrame, DataFrame]:
    train = split_column(keys, share)
    return df.where(train), df.where(~train)


def with_fold(df: DataFrame, keys: Sequence[str], folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", stable_bucket(*[F.col(k) for k in keys], seed=seed + 1, buckets=folds))


STEP = 12  # bits of the hash that a histogram resolves


def _class(label: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(label).cast("string")), F.lit(""))


def cuts(df: DataFrame, keys: Sequence[str], label: str, share: float = TRAIN_SHARE, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """(class, cuts): the largest hash of each fold's training rows, a row per class with rows to train on."""
    rows = written(df.select(_class(label).alias("class"), stable_hash(*[F.col(k) for k in keys], seed=seed).alias("hash")), "hashes")
    size = F.floor(F.count("*") * F.lit(share) + F.lit(0.5))  # training rows of a class
    at = rows.groupBy("class").agg(size.alias("size")).select("class", "size", F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold"))
    at = at.select("class", "fold", F.floor(F.col("size") * F.col("fold") / F.lit(folds)).alias("rank"), F.lit(0).cast("bigint").alias("bin"))
    at, shift = at.where("size > 0"), HASH_BITS
    while True:
        shift -= STEP
        inside = rows.withColumn("bin", F.shiftright("hash", shift + STEP)).join(at.select("class", "bin").distinct(), ["class", "bin"])
        counts = inside.groupBy("class", "bin", F.shiftright("hash", shift).alias("next")).agg(F.count("*").alias("n"))
        # over the at most 2 ** STEP parts of a bin, not over rows
        order = Window.partitionBy("class", "bin").orderBy("next")
        counts = counts.withColumn("upto", F.sum("n").over(order))
        found = at.join(counts, ["class", "bin"]).where("rank <= upto and rank > upto - n or rank = 0 and upto = n")
        at = written(found.select("class", "fold", (F.col("rank") - F.col("upto") + F.col("n")).alias("rank"), F.col("next").alias("bin"), "n"), "cuts")
        if shift == 0 or at.where("rank not in (0, n)").isEmpty():
            break
        at = at.drop("n")
    last = F.shiftleft(F.col("bin") + F.when(F.col("rank") > 0, 1).otherwise(0), shift) - 1
    ordered = at.groupBy("class").agg(F.array_sort(F.collect_list(F.struct("fold", last.alias("last")))).alias("of"))
    return ordered.select("class", F.col("of.last").alias("cuts"))


def stratified(df: DataFrame, keys: Sequence[str], label: str, share: float = TRAIN_SHARE, folds: int = FOLDS, seed: int = SEED) -> DataFrame:
    """``df`` with is_train and fold (null where not): in every class exactly the share and folds of equal size, give or take
    one row. ``keys`` tell rows apart; rows with the same keys stay together. A null label is a class of its own.
    """
    hashed = df.withColumns({"_class": _class(label), "_hash": stable_hash(*[F.col(k) for k in keys], seed=seed)})
    at = cuts(df, keys, label, share, folds, seed).withColumnRenamed("class", "_class")
    fold = F.size(F.filter("cuts", lambda c: F.col("_hash") > c))  # cuts that lie before the row
    sided = hashed.join(at, "_class", "left").withColumn("_fold", F.coalesce(fold, F.lit(folds)))
    sided = sided.withColumn("_fold", F.when(F.col("cuts").isNull(), folds).otherwise(F.col("_fold")))
    is_train = F.col("_fold") < folds
    return sided.withColumns({"is_train": is_train, "fold": F.when(is_train, F.col("_fold"))}).drop("_class", "_hash", "_fold", "cuts")


def stratum_shares(split: DataFrame, label: str) -> DataFrame:
    """Rows per class, side and fold of a split."""
    side = F.when(F.col("is_train"), "train").otherwise("test").alias("side")
    return split.groupBy(label, side, "fold").agg(F.count("*").alias("rows"))
