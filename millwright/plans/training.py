"""Train, tune, compare and apply failure models with MLlib."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import boosting, evaluate, explore, forest, sampling
from ..operators.scoring import risk_rows
from ..schemas import Family
from ..session import exists, written

# The searched settings of each learner, in listed order.
FOREST = {"n_estimators": (100, 200), "min_samples_split": (2, 5)}
FOREST_DEPTHS = {
    "arm_robot": (None, 10, 20),
    "cnc_machine": (None, 15, 25),
    "injection_molding": (None, 10, 20),
    "battery_assembly": (None, 15, 25),
}
WEIGHTED = ("cnc_machine", "battery_assembly")
CLASS_WEIGHTS = (None, "balanced")
POSITIVE_WEIGHTS = (1, 3, 5)
RATES = {
    "arm_robot": (0.1, 0.01),
    "cnc_machine": (0.1, 0.05),
    "injection_molding": (0.1, 0.01),
    "battery_assembly": (0.1, 0.05),
}
XGB_DEPTHS = {
    "arm_robot": (3, 6),
    "cnc_machine": (3, 6, 9),
    "injection_molding": (3, 6, 9),
    "battery_assembly": (3, 6, 9),
}
BOOST_DEPTHS = (3, 6)
BOOST_TREES = (100, 200)
SUBSAMPLES = (0.8, 1.0)
LEARNERS = ("Random Forest", "XGBoost", "Gradient Boosting")
SEED = 42
# End of fixed values.
BOOSTED, FOREST_AT = "boosted", "forest"

Setting = dict[str, object]
Model = PipelineModel | boosting.Boosted | forest.Forest
OWN = (boosting.Boosted, forest.Forest)


def settings(family: Family) -> dict[str, list[Setting]]:
    """Every setting of every learner searched for a family."""
    weighted = family.name in WEIGHTED
    forest = {**FOREST, "max_depth": FOREST_DEPTHS[family.name]}
    xgb = {"n_estimators": BOOST_TREES, "max_depth": XGB_DEPTHS[family.name], "learning_rate": RATES[family.name]}
    boost = {"n_estimators": BOOST_TREES, "learning_rate": RATES[family.name], "max_depth": BOOST_DEPTHS}
    if weighted:
        forest["class_weight"] = CLASS_WEIGHTS
        xgb["scale_pos_weight"] = POSITIVE_WEIGHTS
        boost["subsample"] = SUBSAMPLES
    return {
        name: [dict(zip(grid, values)) for values in product(*grid.values())]
        for name, grid in zip(LEARNERS, (forest, xgb, boost))
    }


def weight_column(setting: Setting) -> str:
    if setting.get("class_weight") == "balanced":
        return "weight_balanced"
    return f"weight_{setting.get('scale_pos_weight', 1)}"


def with_weights(train: DataFrame) -> DataFrame:
    """Row weights for every weighting rule. Class sizes are one row, read as a scalar."""
    sizes = train.agg(
        F.struct(F.count("*").alias("n"), F.sum("failure").alias("positive")).alias("s")
    ).scalar()
    label = F.col("failure")
    mine = F.when(label == 1, F.col("_s.positive")).otherwise(F.col("_s.n") - F.col("_s.positive"))
    return (
        train.withColumn("_s", sizes)
        .withColumns(
            {
                "weight_balanced": F.col("_s.n") / (F.lit(2.0) * mine),
                **{f"weight_{w}": F.when(label == 1, float(w)).otherwise(1.0) for w in POSITIVE_WEIGHTS},
            }
        )
        .drop("_s")
    )


def as_params(model: GBTClassifier, setting: Setting) -> dict:
    """A named setting as parameters of the MLlib learner."""
    return {
        model.maxDepth: setting["max_depth"],
        model.weightCol: weight_column(setting),
        model.maxIter: setting["n_estimators"],
        model.stepSize: setting["learning_rate"],
        model.subsamplingRate: setting.get("subsample", 1.0),
    }


def vector_stages(features: Sequence[str]) -> list:
    return [
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True),
    ]


def as_lane(setting: Setting, fold: int | None = None) -> boosting.Lane:
    """A setting of XGBoost; what isn't searched has that learner's own defaults."""
    return boosting.Lane(
        depth=setting["max_depth"],
        trees=setting["n_estimators"],
        rate=setting["learning_rate"],
        positive_weight=setting.get("scale_pos_weight", 1),
        without_fold=fold,
    )


def as_forest(setting: Setting, fold: int | None = None) -> forest.Lane:
    return forest.Lane(
        trees=setting["n_estimators"],
        min_samples_split=setting["min_samples_split"],
        depth=setting["max_depth"],
        balanced=setting.get("class_weight") == "balanced",
        without_fold=fold,
    )


def tune_side_by_side(train: DataFrame, family: Family, name: str, grid: Sequence[Setting], folds: int, keys: Sequence[str]) -> tuple[Model, Setting]:
    """Best setting by cross-validated F1 of failures. All settings and folds grow together over the same binned rows."""
    lane = as_lane if name == "XGBoost" else as_forest
    parts = range(folds) if len(grid) > 1 else ()
    judged = [lane(s, k) for s in grid for k in parts]
    lanes = judged + [lane(s) for s in grid]
    if name == "XGBoost":
        models = boosting.fit(train, family.feature_order, "failure", lanes, "fold")
        scores = boosting.judged(train, "failure", "fold", judged, models[: len(judged)]) if judged else []
    else:
        models = forest.fit(train, family.feature_order, "failure", lanes, keys, "fold")
        scores = forest.judged(train, "failure", "fold", judged, models[: len(judged)]) if judged else []
    place = max(range(len(grid)), key=lambda i: sum(scores[i * folds : (i + 1) * folds]))
    return models[len(judged) + place], grid[place]


def f1_of_failures() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(
        labelCol="failure", predictionCol="prediction", metricName="fMeasureByLabel", metricLabel=1.0
    )


@dataclass
class Trained:
    family: Family
    models: dict[str, Model] = field(default_factory=dict)
    chosen: dict[str, Setting] = field(default_factory=dict)
    metrics: DataFrame | None = None
    best: str | None = None


def tune(
    train: DataFrame, family: Family, name: str, grid: Sequence[Setting], folds: int, parallelism: int, keys: Sequence[str]
) -> tuple[Model, Setting]:
    """Best setting by cross-validated F1 of failures, refitted on all training rows."""
    if name != "Gradient Boosting":
        return tune_side_by_side(train, family, name, grid, folds, keys)
    model = GBTClassifier(featuresCol="scaled", labelCol="failure", seed=SEED)
    stages = vector_stages(family.feature_order)
    if len(grid) == 1:
        for param, value in as_params(model, grid[0]).items():
            model.set(param, value)
        return Pipeline(stages=[*stages, model]).fit(train), grid[0]
    search = CrossValidator(
        estimator=Pipeline(stages=[*stages, model]),
        estimatorParamMaps=[as_params(model, s) for s in grid],
        evaluator=f1_of_failures(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    fitted = search.fit(train)
    place = max(range(len(grid)), key=lambda i: fitted.avgMetrics[i])
    return fitted.bestModel, grid[place]


def train_family(
    rows: DataFrame,
    family: Family,
    keys: Sequence[str],
    grids: dict[str, list[Setting]] | None = None,
    folds: int = sampling.FOLDS,
    parallelism: int = 4,
) -> Trained:
    """Split, tune every learner, compare on the hold-out rows, pick the best."""
    grids = grids or settings(family)
    rows = written(rows, "labelled")  # the split reads them twice
    sided = written(sampling.stratified(rows, keys, "failure", folds=folds), "split")
    train, test = sided.where("is_train"), sided.where("not is_train")
    out = Trained(family)
    for name, grid in grids.items():
        # only MLlib takes weights from a column, and reads it many times
        seen = written(with_weights(train), "train") if name == "Gradient Boosting" else train
        out.models[name], out.chosen[name] = tune(seen, family, name, grid, folds, parallelism, keys)
    out.metrics = written(compare(test, out.models), "metrics")
    out.best = evaluate.best_model(out.metrics, family.selection_metric).first()["model"]
    return out


def compare(test: DataFrame, models: dict[str, Model]) -> DataFrame:
    """Hold-out metrics, one row per model."""
    judged = None
    for place, (name, model) in enumerate(models.items()):
        rows = model.transform(test).select(
            F.lit(name).alias("model"), F.lit(place).alias("place"), "failure", F.col("prediction").cast("int").alias("prediction")
        )
        judged = rows if judged is None else judged.unionByName(rows)
    return evaluate.binary_metrics(judged, ["model", "place"], "failure", "prediction")


def importances(spark: SparkSession, model: Model, features: Sequence[str], n: int) -> DataFrame:
    """The model's largest feature importances by name."""
    own = model.importances() if isinstance(model, OWN) else model.stages[-1].featureImportances.toArray()
    values = [float(v) for v in own]
    named = spark.createDataFrame(list(zip(features, values)), "feature string, importance double")
    return explore.top_features(named, n)


def save_model(spark: SparkSession, model: Model, features: Sequence[str], path: str) -> None:
    """A model and its feature order."""
    if isinstance(model, boosting.Boosted):
        spark.createDataFrame([(model.text(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{BOOSTED}")
    elif isinstance(model, forest.Forest):
        spark.createDataFrame([(model.settings(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/{FOREST_AT}")
        model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    else:
        model.write().overwrite().save(f"{path}/model")
    order = list(enumerate(features))
    spark.createDataFrame(order, "place int, feature string").coalesce(1).write.mode("overwrite").json(f"{path}/features")


def save(spark: SparkSession, trained: Trained, path: str) -> None:
    """Best model, its feature order and its metrics side by side."""
    save_model(spark, trained.models[trained.best], trained.family.feature_order, path)
    details = trained.metrics.where(F.col("model") == trained.best).withColumn(
        "best_params", F.lit(str(trained.chosen[trained.best]))
    )
    details.write.mode("overwrite").json(f"{path}/metrics")


def load(spark: SparkSession, path: str) -> tuple[Model, list[str]]:
    """A saved model and its feature order (a short list)."""
    names = spark.read.schema("place int, feature string").json(f"{path}/features").orderBy("place").collect()
    if exists(spark, f"{path}/{BOOSTED}"):
        model = boosting.Boosted.of_text(spark.read.text(f"{path}/{BOOSTED}").first()[0])
    elif exists(spark, f"{path}/{FOREST_AT}"):
        model = forest.Forest.of(spark.read.text(f"{path}/{FOREST_AT}").first()[0], spark.read.parquet(f"{path}/nodes"))
    else:
        model = PipelineModel.load(f"{path}/model")
    return model, [r["feature"].strip() for r in names]


def failure_probability(model: Model) -> Column:
    """Probability of failure; null where a feature is unknown."""
    known = F.lit(True)
    own = isinstance(model, OWN)
    for name in model.features if own else model.stages[0].getInputCols():
        known = known & F.col(name).isNotNull()
    return F.when(known, F.col("failure_p") if own else vector_to_array("probability")[1])


def score(model: Model, rows: DataFrame, at: Column, *keep: str) -> DataFrame:
    """Risk rows plus the model's own yes/no decision; incomplete rows have no risk."""
    p = failure_probability(model)
    scored = model.transform(rows).withColumn("failure_predicted", F.when(p.isNotNull(), F.col("prediction").cast("int")))
    return risk_rows(scored, p, at, *keep, "failure_predicted")
