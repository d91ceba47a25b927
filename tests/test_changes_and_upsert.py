from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from millwright.operators import changes, upsert

ROW = {"id": 1, "name": "bolt", "stock": 5, "created_at": 1_735_689_600_000_000}


def classify(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    return changes.classify_changes(df), changes.rejected_changes(df)


@pytest.mark.parametrize(
    "before, after, flags, stock",
    [
        (None, ROW, (1, 0, 0), 5),
        (ROW, {**ROW, "stock": 9}, (0, 1, 0), 9),
        ({**ROW, "stock": 2}, None, (0, 0, 1), 2),
    ],
)
def test_change_kinds(spark, before, after, flags, stock):
    good, _ = classify(spark, json.dumps({"before": before, "after": after}))
    r = good.first()
    assert (r["is_created"], r["is_updated"], r["is_deleted"]) == flags
    assert (r["stock"], r["created_at"]) == (stock, "2025-01-01 00:00:00")
    assert changes.with_change_date(good).first()["date"] == "2025-01-01"


def test_unusable_changes_are_kept_apart(spark):
    good, bad = classify(
        spark, json.dumps({"before": None, "after": None}), "{}", "nonsense", json.dumps({"after": {"id": 1}}), json.dumps({"after": ROW})
    )
    assert good.count() == 1
    assert sorted(r["reason"] for r in bad.collect()) == ["malformed", "no_created_at", "no_image", "no_image"]


SCHEMA = "ts string, m string, kind string, x int"
KEYS = ["ts", "m"]


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_update_insert_keep(spark):
    target = frame(spark, ("1", "a", "old", 1), ("2", "a", "old", 2), (None, "a", "old", 3))
    source = frame(spark, ("2", "a", "new", 20), ("3", "a", "new", 30), (None, "a", "new", 40), (None, "a", "new", 40))
    merged = upsert.upsert(target, source, KEYS, ["x"])
    assert result(merged) == sorted(
        [
            ("1", "a", "old", 1),
            ("2", "a", "old", 20),
            ("3", "a", "new", 30),
            (None, "a", "old", 3),
            (None, "a", "new", 40),
            (None, "a", "new", 40),
        ],
        key=str,
    )


def test_update_to_null_wins(spark):
    merged = upsert.upsert(frame(spark, ("1", "a", "old", 1)), frame(spark, ("1", "a", "new", None)), KEYS, ["x"])
    assert result(merged) == [("1", "a", "old", None)]


def test_upsert_twice_is_upsert_once(spark):
    target = frame(spark, ("1", "a", "old", 1))
    source = frame(spark, ("1", "a", "new", 2), ("2", "b", "new", 3))
    once = upsert.upsert(target, source, KEYS, ["x"])
    assert result(upsert.upsert(once, source, KEYS, ["x"])) == result(once)


def test_several_target_rows_of_a_key_are_all_updated(spark):
    target = frame(spark, ("1", "a", "p", 1), ("1", "a", "q", 2))
    assert result(upsert.upsert(target, frame(spark, ("1", "a", "new", 9)), KEYS, ["x"])) == [("1", "a", "p", 9), ("1", "a", "q", 9)]


def test_repeated_source_key_is_an_error(spark):
    source = frame(spark, ("1", "a", "n", 1), ("1", "a", "n", 2))
    with pytest.raises(Exception, match="several source rows for key 1, a"):
        upsert.upsert(frame(spark, ("1", "a", "o", 0)), source, KEYS, ["x"]).collect()
    with pytest.raises(Exception, match="several source rows for key 1, a"):
        upsert.upsert(frame(spark), source, KEYS, ["x"], "error").collect()


def test_repeats_without_a_target_row_are_all_inserted(spark):
    source = frame(spark, ("1", "a", "n", 1), ("1", "a", "n", 2), ("2", "a", "n", 3))
    merged = upsert.upsert(frame(spark, ("2", "a", "o", 0)), source, KEYS, ["x"])
    assert result(merged) == [("1", "a", "n", 1), ("1", "a", "n", 2), ("2", "a", "o", 3)]


def test_latest_source_row_can_win(spark):
    source = frame(spark, ("1", "a", "n", 1), ("1", "a", "n", 2), ("1", None, "n", 3))
    merged = upsert.upsert(frame(spark, ("1", "a", "o", 0)), source, KEYS, ["x"], "latest", ["x"])
    assert result(merged) == sorted([("1", "a", "o", 2), ("1", None, "n", 3)], key=str)
    assert [r["copies"] for r in upsert.duplicate_keys(source, KEYS).collect()] == [2]


def test_small_source_never_shuffles_the_target(spark, tmp_path):
    spark.range(200_000).select(
        F.col("id").cast("string").alias("ts"), F.lit("a").alias("m"), F.lit("o").alias("kind"), F.col("id").cast("int").alias("x")
    ).write.parquet(str(tmp_path / "t"))
    target = spark.read.parquet(str(tmp_path / "t"))
    merged = upsert.upsert(target, frame(spark, ("7", "a", "n", 1)), KEYS, ["x"])
    assert merged.where("x = 1 and ts in ('7', '1')").count() == 2
    merged.collect()
    final = merged._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    wide = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
    assert "BroadcastHashJoin" in final and "SortMergeJoin" not in final and not wide
