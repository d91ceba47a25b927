from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from millwright.functions.timefn import iso_text
from millwright.operators import evaluate, explore, previous, sampling
from millwright.operators import features as feats
from millwright.plans import sensor_queries, training
from millwright.schemas import ARM_ROBOT, BATTERY_ASSEMBLY, CNC_MACHINE, FAMILIES, INJECTION_MOLDING


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(3)
    rows = [(rng.gauss(5, 2), rng.gauss(0, 1), 1.0, int(rng.random() < 0.3)) for _ in range(300)]
    rows += [(None, 1.0, 1.0, 0), (2.0, None, 1.0, 1)]
    return spark.createDataFrame(rows, "a double, b double, c double, failure int").persist(), rows


def test_correlation_skips_nulls_pairwise_and_survives_constants(points):
    df, rows = points
    got = {(r["left"], r["right"]): r["correlation"] for r in explore.correlation_matrix(df, ["a", "b", "c"]).collect()}
    xs = [(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None]
    ma, mb = (sum(v) / len(xs) for v in zip(*xs))
    cov = sum((x - ma) * (y - mb) for x, y in xs)
    expected = cov / math.sqrt(sum((x - ma) ** 2 for x, _ in xs) * sum((y - mb) ** 2 for _, y in xs))
    assert got["a", "b"] == pytest.approx(expected)
    assert got["a", "c"] is None and got["b", "c"] is None


def test_histogram_counts_every_value_once(points):
    df, rows = points
    out = explore.histograms(df, ["a", "c"]).collect()
    known = [r[0] for r in rows if r[0] is not None]
    assert sum(r["rows"] for r in out if r["feature"] == "a") == len(known)
    lo, hi = min(known), max(known)
    for r in (r for r in out if r["feature"] == "a"):
        inside = [
            v for v, f in ((x[0], x[3]) for x in rows if x[0] is not None)
            if f == r["failure"] and min(int((v - lo) / ((hi - lo) / 30)), 29) == r["bin"]
        ]
        assert len(inside) == r["rows"]
    assert {r["bin"] for r in out if r["feature"] == "c"} == {0}


def test_density_equals_brute_force(points):
    df, rows = points
    out = explore.densities(df, ["a"], points=7).where("failure = 1").orderBy("point").collect()
    mine = [r[0] for r in rows if r[0] is not None and r[3] == 1]
    known = [r[0] for r in rows if r[0] is not None]
    mean = sum(mine) / len(mine)
    h = math.sqrt(sum((v - mean) ** 2 for v in mine) / (len(mine) - 1)) * len(mine) ** -0.2
    assert len(out) == 7
    for i, r in enumerate(out):
        x = min(known) + (max(known) - min(known)) * i / 6
        k = sum(math.exp(-0.5 * ((v - x) / h) ** 2) for v in mine) / (len(mine) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(k)


def test_standardize(points):
    df, _ = points
    out = explore.standardize(df.where("a is not null"), ["failure"], ["a", "c"]).agg(
        F.avg("a").alias("m"), F.stddev_pop("a").alias("s"), F.max("c").alias("c")
    ).first()
    assert (out["m"], out["s"], out["c"]) == (pytest.approx(0, abs=1e-9), pytest.approx(1), 0.0)


def test_metrics_of_a_known_confusion(spark):
    cells = [(1, 1, 30), (0, 1, 10), (1, 0, 20), (0, 0, 40)]
    rows = [(y, p) for y, p, n in cells for _ in range(n)]
    df = spark.createDataFrame(rows, "y int, p int").withColumn("model", F.lit("m"))
    m = evaluate.binary_metrics(df, ["model"], "y", "p").first()
    assert (m["accuracy"], m["precision"], m["recall"]) == (0.7, 0.75, 0.6)
    assert m["f1_score"] == pytest.approx(2 / 3)
    report = {r["row"]: r for r in evaluate.classification_report(df, "y", "p").collect()}
    assert report["1"]["support"] == 50 and report["0"]["recall"] == 0.8
    assert report["accuracy"]["f1_score"] == 0.7
    assert report["macro avg"]["recall"] == pytest.approx(0.7)


def test_metrics_without_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int").withColumn("model", F.lit("m"))
    m = evaluate.binary_metrics(df, ["model"], "y", "p").first()
    assert (m["precision"], m["recall"], m["f1_score"]) == (0.0, 0.0, 0.0)


def test_first_model_wins_a_tie(spark):
    df = spark.createDataFrame([("x", 0, 0.5), ("y", 1, 0.5), ("z", 2, 0.4)], "model string, place int, f1_score double")
    assert evaluate.best_model(df, "f1_score").first()["model"] == "x"


def test_split_is_stable_and_keeps_shares(spark):
    df = spark.range(20_000).withColumn("failure", (F.col("id") % 5 == 0).cast("int"))
    train, test = sampling.train_test(df, ["id"])
    assert train.count() + test.count() == 20_000
    for label in (0, 1):
        share = train.where(F.col("failure") == label).count() / df.where(F.col("failure") == label).count()
        assert share == pytest.approx(0.75, abs=0.02)
    again, _ = sampling.train_test(df.repartition(7), ["id"])
    assert again.exceptAll(train).isEmpty()
    folds = sampling.with_fold(df, ["id"]).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(abs(r["count"] - 4000) < 300 for r in folds)


@pytest.mark.parametrize(("rows", "share", "folds"), [(1, 0.75, 5), (3, 0.5, 5), (97, 0.75, 5), (20_000, 0.75, 3)])
def test_stratified_split_is_exact(spark, rows, share, folds):
    df = spark.range(rows).withColumn("kind", F.when(F.col("id") % 7 == 3, None).when(F.col("id") % 7 < 3, "a").otherwise("b"))
    out = sampling.stratified(df, ["id"], "kind", share, folds).collect()
    assert sorted(r["id"] for r in out) == list(range(rows))
    for kind in (None, "a", "b"):
        mine = [r for r in out if r["kind"] == kind]
        train = [r["fold"] for r in mine if r["is_train"]]
        assert abs(len(train) - share * len(mine)) <= 1
        sizes = [train.count(k) for k in range(folds)]
        assert sum(sizes) == len(train) and max(sizes) - min(sizes) <= 1
    again = sampling.stratified(df.repartition(5), ["id"], "kind", share, folds)
    assert sorted(map(tuple, again.collect()), key=lambda r: r[0]) == sorted(map(tuple, out), key=lambda r: r[0])


def test_stratified_split_sorts_no_class(spark):
    df = spark.range(50_000).withColumn("kind", F.lit("all"))
    plan = sampling.stratified(df, ["id"], "kind")._jdf.queryExecution().toString()
    assert "Window" not in plan


def test_equal_keys_stay_together(spark):
    df = spark.range(400).select((F.col("id") % 40).alias("id"), F.lit(1).alias("kind"))
    out = sampling.stratified(df, ["id"], "kind").groupBy("id").agg(F.countDistinct(F.coalesce("fold", F.lit(9))).alias("n")).collect()
    assert {r["n"] for r in out} == {1}


def test_number_of_searched_settings():
    sizes = {name: [len(g) for g in training.settings(f).values()] for name, f in FAMILIES.items()}
    assert sizes == {
        "arm_robot": [12, 8, 8],
        "cnc_machine": [24, 36, 16],
        "injection_molding": [12, 12, 8],
        "battery_assembly": [24, 36, 16],
    }


@pytest.fixture(scope="module")
def labelled(spark):
    """Readings whose failures follow high temperature or vibration."""
    i = F.col("id")
    hot, shaky = F.pmod(F.hash(i), F.lit(5)) == 0, F.pmod(F.hash(i + 100_000), F.lit(4)) == 0
    rows = spark.range(1500).select(
        i.alias("event_id"),
        iso_text(F.timestamp_seconds(i * 600)).alias("timestamp"),
        F.concat(F.lit("M"), i % 4).alias("machine_id"),
        F.lit("ROBOTIC_ARM").alias("machine_type"),
        (F.lit(1200.0) + i % 7).alias("servo_motor_rpm"),
        (F.lit(2000.0) + i % 11).alias("hydraulic_pressure_psi"),
        F.when(hot, 85.0).otherwise(65.0).alias("temperature_celsius"),
        F.when(shaky, 1.5).otherwise(0.5).alias("vibration_mm_per_s"),
        (i % 168).cast("double").alias("operation_time_hours"),
        i.cast("int").alias("cycle_count"),
        (i % 100).cast("double").alias("joint_wear_percent"),
        F.when(hot | shaky, "FAILURE").otherwise("NORMAL").alias("status"),
        F.lit(3.0).alias("time_since_maintenance"),
    )
    return feats.training_features(rows, ARM_ROBOT, previous.HOUR * 24, "event_id").persist()


def test_train_choose_save_load_score(spark, labelled, tmp_path):
    grids = {
        "Random Forest": [
            {"n_estimators": 5, "max_depth": 2, "min_samples_split": 2},
            {"n_estimators": 5, "max_depth": 5, "min_samples_split": 5, "class_weight": "balanced"},
        ],
        "XGBoost": [{"n_estimators": 3, "max_depth": 3, "learning_rate": 0.1, "scale_pos_weight": 3}],
    }
    trained = training.train_family(labelled, ARM_ROBOT, ["event_id"], grids, folds=2)
    metrics = {r["model"]: r for r in trained.metrics.collect()}
    majority = 1 - labelled.agg(F.avg("failure")).first()[0]
    assert metrics[trained.best]["accuracy"] > max(majority, 1 - majority) + 0.1
    training.save(spark, trained, str(tmp_path / "m"))
    model, order = training.load(spark, str(tmp_path / "m"))
    assert order == ARM_ROBOT.feature_order
    assert spark.read.json(str(tmp_path / "m/metrics")).count() == 1
    top = training.importances(spark, trained.models["Random Forest"], order, 2).collect()
    signals = {"temperature_celsius", "vibration_mm_per_s", "pressure_temp_ratio", "rpm_vibration_ratio"}
    assert len(top) == 2 and {r["feature"] for r in top} <= signals
    gaps = labelled.withColumn("pressure_temp_ratio", F.when(F.col("event_id") > 10, F.col("pressure_temp_ratio")))
    rows = gaps.withColumn("machine_type", F.lit("ROBOTIC_ARM"))
    scored = training.score(model, rows, F.lit("now"), "event_id").persist()
    assert scored.count() == labelled.count()
    assert scored.where("event_id <= 10 and risk_level is not null").isEmpty()
    assert scored.where("event_id > 10 and (risk_level is null or failure_predicted is null)").isEmpty()


def test_training_rows_are_worked_out_once(spark, sf_dir, monkeypatch):
    """The split reads its rows twice, but the look back behind them is run once."""

    class Seen(Exception):
        pass

    def split(rows, *_, **__):
        raise Seen(rows._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(training.sampling, "stratified", split)
    rows = sensor_queries.train_features(spark, sf_dir, ARM_ROBOT)
    assert "Window" in rows._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(Seen) as plan:
        training.train_family(rows, ARM_ROBOT, ["event_id"], {}, folds=2)
    assert "Window" not in str(plan.value) and "parquet" in str(plan.value)


def test_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "failure int")
    rows = training.with_weights(df).orderBy(F.desc("failure")).collect()
    assert (rows[0]["weight_balanced"], rows[1]["weight_balanced"]) == (2.0, pytest.approx(4 / 6))
    assert (rows[0]["weight_5"], rows[1]["weight_5"]) == (5.0, 1.0)
    assert training.weight_column({"class_weight": "balanced"}) == "weight_balanced"
    assert training.weight_column({}) == "weight_1"


def test_key_feature_lists_exist():
    for family in (ARM_ROBOT, CNC_MACHINE, INJECTION_MOLDING, BATTERY_ASSEMBLY):
        assert set(family.key_features) <= set(family.feature_order)
        assert set(family.lagged) <= set(family.model_inputs) == set(family.readings)
