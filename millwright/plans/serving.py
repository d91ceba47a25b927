"""Trained models in the scoring stream: a folder of versions per family, the newest taken up between two batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting
from ..schemas import FAMILIES, Family
from ..session import exists, folders
from . import training

READY = "ready"
_USED = "family string, version long"


def latest_version(spark: SparkSession, root: str) -> int | None:
    """The newest complete version below a family's model folder."""
    numbers = sorted((int(n.split("=")[1]) for n in folders(spark, root) if n.startswith("version=")), reverse=True)
    return next((n for n in numbers if exists(spark, f"{root}/version={n}/{READY}/_SUCCESS")), None)


def publish(spark: SparkSession, model: training.Model, features: Sequence[str], root: str) -> int:
    """Save a model as the next version of a family. A version counts once it is whole."""
    version = (latest_version(spark, root) or 0) + 1
    path = f"{root}/version={version}"
    training.save_model(spark, model, features, path)
    spark.range(0).write.mode("overwrite").parquet(f"{path}/{READY}")
    return version


class Served:
    """The models that ``flows.score_stream`` uses: its hooks ``begin``, ``transform`` and ``probability``.

    A batch writes down the versions it uses before it scores, so a batch that is run again after a restart uses the
    same ones. A version is loaded by the batch that sees it first, and sent to the executors once.
    """

    def __init__(self, spark: SparkSession, root: str, out: str):
        self.spark, self.root, self.out = spark, root, out
        self.loaded: dict[str, tuple[int, training.Model, Column | None]] = {}

    def begin(self, batch_id: int) -> None:
        used = f"{self.out}/versions/batch_id={batch_id}"
        if not exists(self.spark, f"{used}/_SUCCESS"):
            newest = [(f, latest_version(self.spark, f"{self.root}/{f}")) for f in FAMILIES]
            self.spark.createDataFrame(newest, _USED).coalesce(1).write.mode("overwrite").parquet(used)
        for r in self.spark.read.schema(_USED).parquet(used).collect():  # a row per family
            if r.version is None:
                self.loaded.pop(r.family, None)
            elif r.family not in self.loaded or self.loaded[r.family][0] != r.version:
                model, _ = training.load(self.spark, f"{self.root}/{r.family}/version={r.version}")
                column = model.probability(self.spark.range(0)) if isinstance(model, training.OWN) else None
                self.loaded[r.family] = r.version, model, column

    def transform(self, frame: DataFrame, family: Family) -> DataFrame:
        if family.name not in self.loaded:
            return frame
        _, model, column = self.loaded[family.name]
        return model.transform(frame) if column is None else frame.withColumn("failure_p", column)

    def probability(self, family: Family) -> Column:
        """Null for a family without a model: its messages go to the rejects."""
        if family.name not in self.loaded:
            return F.lit(None).cast("double")
        return training.failure_probability(self.loaded[family.name][1])


def first_trees(rows: DataFrame, features: Sequence[str], weights: Sequence[int], rate: float) -> list[boosting.Boosted]:
    """A small model per positive weight: one tree of two levels on bins of equal width."""
    lanes = [boosting.Lane(depth=2, trees=1, rate=rate, positive_weight=w) for w in weights]
    return boosting.fit(rows, features, "failure", lanes, edges=boosting.width_edges(rows, features, 16))
