"""Model training and scoring as queries.

The searched grids take hours, so the queries fit one small setting per learner;
``training.settings`` holds the full grids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import iso_text
from ..operators import evaluate
from ..schemas import FAMILIES
from ..session import scratch_dir
from . import serving, training
from .explore_queries import complete
from .sensor_queries import serving_prev, train_features

ARM = FAMILIES["arm_robot"]

QUICK: dict[str, list[training.Setting]] = {
    "Random Forest": [{"n_estimators": 10, "max_depth": 5, "min_samples_split": 2}],
    "XGBoost": [{"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1, "scale_pos_weight": 5}],
    "Gradient Boosting": [{"n_estimators": 5, "max_depth": 3, "learning_rate": 0.1, "subsample": 0.8}],
}


def _trained(spark: SparkSession, sf_dir: str, grids: dict[str, list[training.Setting]]) -> training.Trained:
    rows = train_features(spark, sf_dir, ARM)
    return training.train_family(rows, ARM, ["event_id"], grids, folds=2)


def train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hold-out metrics of three learners trained on all labelled rows."""
    return _trained(spark, sf_dir, QUICK).metrics.select("model", *evaluate.METRICS)


def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-validated choice between two forest settings, and its importances."""
    grid = [
        {"n_estimators": 5, "max_depth": 3, "min_samples_split": 2},
        {"n_estimators": 5, "max_depth": 5, "min_samples_split": 5, "class_weight": "balanced"},
    ]
    trained = _trained(spark, sf_dir, {"Random Forest": grid})
    return training.importances(spark, trained.models[trained.best], ARM.feature_order, ARM.top_features)


def score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, load, then score every event with its look-back features."""
    path = scratch_dir(spark, "model")
    training.save(spark, _trained(spark, sf_dir, {"Random Forest": QUICK["Random Forest"]}), path)
    model, order = training.load(spark, path)
    rows = serving_prev(spark, sf_dir, ARM).withColumn("machine_type", F.lit(ARM.machine_type))
    framed = rows.select("event_id", "machine_id", "machine_type", *order)
    return training.score(model, framed, iso_text(F.current_timestamp()), "event_id")


def first_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first boosted tree of each searched positive weight over all complete rows, node by node."""
    rows = complete(spark, sf_dir, ARM)
    features = list(ARM.readings)
    models = serving.first_trees(rows, features, training.POSITIVE_WEIGHTS, 0.1)
    nodes, places = [], range(7)
    for w, model in zip(training.POSITIVE_WEIGHTS, models):
        tree = model.trees[0]
        grown = {0} | {c for k in places if tree.feature[k] >= 0 for c in (2 * k + 1, 2 * k + 2)}
        for k in sorted(grown):
            split = tree.feature[k] >= 0
            nodes.append((w, k, features[tree.feature[k]] if split else None, int(tree.bin[k]) if split else None, float(tree.value[k])))
    out = spark.createDataFrame(nodes, "positive_weight int, node int, feature string, bin int, weight double")
    return out.withColumn("weight", F.round("weight", 9))
