"""State as merged runs: reads, repeats of a batch, merging, and what a batch writes."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from millwright.session import folders
from millwright.streaming.runs import Runs

SCHEMA = "k string, n long"


def summed(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


def runs_of(spark, path, **more):
    schema = spark.createDataFrame([], SCHEMA).schema
    return Runs(spark, str(path), schema, "k", summed, **more)


def frame(spark, **counts):
    return spark.createDataFrame(list(counts.items()), SCHEMA)


def state(df):
    return {r["k"]: r["n"] for r in df.collect()}


@pytest.mark.parametrize("buckets", [0, 4])
def test_every_batch_is_counted_once_however_runs_are_merged(spark, tmp_path, buckets):
    runs = runs_of(spark, tmp_path, fan=2, buckets=buckets)
    assert runs.before(0) is None and state(runs.current()) == {}
    for i in range(9):
        assert i == 0 or state(runs.before(i)) == {"a": i, f"b{i - 1}": 1} | {f"b{j}": 1 for j in range(i)}
        runs.add(frame(spark, **{"a": 1, f"b{i}": 1}), i)
    assert state(runs.current()) == {"a": 9} | {f"b{i}": 1 for i in range(9)}
    assert runs.spans() == [(0, 7), (8, 8)]


def test_a_batch_that_is_run_again_finds_and_leaves_the_same_state(spark, tmp_path):
    runs = runs_of(spark, tmp_path, fan=2)
    for i in range(4):
        for _ in range(3):
            assert i == 0 or state(runs.before(i)) == {"a": i}
            runs.add(frame(spark, a=1), i)
        runs = runs_of(spark, tmp_path, fan=2)  # as after a restart
    assert state(runs.current()) == {"a": 4}


def test_merged_folders_outlive_the_batch_that_merges_them(spark, tmp_path):
    runs = runs_of(spark, tmp_path, fan=2)
    for i in range(2):
        runs.add(frame(spark, a=1), i)
    reader = runs.current()  # lists the folders of batches 0 and 1
    runs.add(frame(spark, a=1), 2)
    assert state(reader) == {"a": 2} and len(folders(spark, str(tmp_path / "runs"))) == 4
    runs.add(frame(spark, a=1), 3)
    assert runs.spans() == [(0, 1), (2, 2), (3, 3)] and len(folders(spark, str(tmp_path / "runs"))) == 3


def test_a_draft_left_by_a_lost_run_is_no_state(spark, tmp_path):
    runs = runs_of(spark, tmp_path)
    runs.add(frame(spark, a=1), 0)
    frame(spark, a=100).write.parquet(str(tmp_path / "drafts/1-1"))
    assert state(runs.current()) == {"a": 1}
    runs.add(frame(spark, a=1), 1)
    assert state(runs.current()) == {"a": 2}


def test_a_batch_writes_its_own_keys_and_reads_their_buckets(spark, tmp_path):
    runs = runs_of(spark, tmp_path, buckets=16)
    runs.add(spark.range(2000).select(F.concat(F.lit("m"), "id").alias("k"), F.lit(1).cast("long").alias("n")), 0)
    runs.add(frame(spark, m7=1, new=1), 1)

    def size(first):
        top = tmp_path / "runs" / f"{first:012d}-{first:012d}"
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(top) for f in names if f.endswith(".parquet"))

    assert size(1) < size(0) / 4 and len(folders(spark, str(tmp_path / f"runs/{1:012d}-{1:012d}"))) <= 2
    found = runs.before(2, frame(spark, m7=0, m9=0, unknown=0))
    assert state(found) == {"m7": 2, "m9": 1}
    assert len({f.split("_bucket=")[1].split("/")[0] for f in found.inputFiles()}) <= 16
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_bucket" in plan and "PartitionFilters: [" in plan


def test_fan_of_one_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        runs_of(spark, tmp_path, fan=1)
