from __future__ import annotations

import json
import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from millwright.operators import flatten, marts
from millwright.operators.features import serving_history
from millwright.operators.previous import HOUR
from millwright.plans import jobs
from millwright.plans.sensor_queries import fixed_score
from millwright.schemas import ARM_ROBOT, CNC_MACHINE, FAMILIES, PREDICTION_SCHEMA
from millwright.sources import files
from millwright.sources.streams import message_stream
from millwright.streaming import flows, sinks
from test_features import message
from test_service_records import GOOD, changed


def land(folder, batches):
    """One file per batch, in time order."""
    folder.mkdir()
    for i, lines in enumerate(batches):
        path = folder / f"b{i}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def reading(machine, hour, rpm):
    return message(ARM_ROBOT, {"servo_motor_rpm": rpm, "joint_wear_percent": rpm / 10}, machine, f"2025-01-06T{hour:02d}:00:00")


def test_state_is_carried_across_batches_and_late_rows_do_not_replace_it(spark, tmp_path):
    source = land(
        tmp_path / "in",
        [
            [reading("A", 1, 10.0), reading("A", 3, 30.0), reading("B", 1, 100.0)],
            [reading("A", 2, 20.0), reading("A", 4, 40.0)],
            [reading("A", 5, 50.0), reading("B", 2, 200.0), reading("C", 1, 1.0)],
        ],
    )
    stream = message_stream(spark, "text", source, maxFilesPerTrigger="1")
    rows = flatten.sensor_rows(stream, ARM_ROBOT)
    flows.previous_stream(rows, ARM_ROBOT, str(tmp_path / "out"), str(tmp_path / "cp"), "timestamp", target_rows=1)
    out = spark.read.parquet(str(tmp_path / "out/rows"))
    got = {(r["machine_id"], r["servo_motor_rpm"]): r["servo_motor_rpm_prev"] for r in out.collect()}
    assert got == {
        ("A", 10.0): 10.0,
        ("A", 30.0): 10.0,
        ("B", 100.0): 100.0,
        ("A", 20.0): 20.0,  # late: nothing older is known any more
        ("A", 40.0): 30.0,  # the late row did not replace the state
        ("A", 50.0): 40.0,
        ("B", 200.0): 100.0,
        ("C", 1.0): 1.0,
    }


def test_ordered_stream_equals_batch(spark, tmp_path):
    lines = [[reading(m, h, float(h * 10 + ord(m))) for m in "AB"] for h in range(1, 6)]
    source = land(tmp_path / "in", lines)
    rows = flatten.sensor_rows(message_stream(spark, "text", source, maxFilesPerTrigger="1"), ARM_ROBOT)
    flows.previous_stream(rows, ARM_ROBOT, str(tmp_path / "out"), str(tmp_path / "cp"), "timestamp")
    batch = serving_history(flatten.sensor_rows(spark.read.text(source), ARM_ROBOT), ARM_ROBOT, HOUR, "timestamp")
    streamed = spark.read.parquet(str(tmp_path / "out/rows")).select(batch.columns)
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_scoring_stream_keeps_rejects(spark, tmp_path):
    good = message(CNC_MACHINE, {"tool_wear_percent": 60.0, "cutting_force_n": 10.0})
    source = land(tmp_path / "in", [[good, "broken", message(CNC_MACHINE, {})], [good]])
    stream = message_stream(spark, "text", source, maxFilesPerTrigger="1")

    def to_cnc(batch, family):
        return batch if family is CNC_MACHINE else batch.where(F.lit(False))

    flows.score_stream(stream, to_cnc, fixed_score, str(tmp_path / "out"), str(tmp_path / "cp"))
    predictions = spark.read.parquet(str(tmp_path / "out/predictions"))
    assert predictions.count() == 2
    assert predictions.where(F.to_timestamp("prediction_timestamp").isNull()).isEmpty()
    rejects = spark.read.parquet(str(tmp_path / "out/rejects"))
    assert sorted(r["reason"] for r in rejects.collect()) == ["malformed", "no_score"]


def test_running_counts_equal_batch_counts(spark, tmp_path):
    lines = [[reading(m, h, float(h)) for m in "AAB"] for h in range(1, 5)]
    source = land(tmp_path / "in", lines)

    def predictions(messages):
        rows = flatten.sensor_rows(messages, ARM_ROBOT)
        return rows.select(F.col("timestamp").alias("prediction_timestamp"), "machine_type", "machine_id", F.lit("LOW").alias("risk_level"))

    stream = predictions(message_stream(spark, "text", source, maxFilesPerTrigger="1"))
    flows.count_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
    now = flows.current_counts(spark.read.parquet(str(tmp_path / "out")))
    want = marts.daily_risk_counts(predictions(spark.read.text(source)))
    assert sorted(map(tuple, now.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    halves = marts.add_counts(want, want)
    assert sorted(r["risk_count"] for r in halves.collect()) == [8, 16]


def test_a_restart_adds_nothing_twice(spark, tmp_path):
    source = land(tmp_path / "in", [[reading("A", 1, 1.0)]])
    for _ in range(2):
        flows.lake_stream(message_stream(spark, "text", source), ARM_ROBOT, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        message_stream(spark, "carrier pigeon", "x")


# Jobs


def staged(spark, root, day, rows):
    schema = "timestamp string, machine_id string, machine_type string, servo_motor_rpm double, cycle_count bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{root}/{day}")


def test_daily_upsert(spark, tmp_path):
    staging, lake = str(tmp_path / "staging"), str(tmp_path / "lake")
    staged(spark, staging, "20250106", [("2025-01-05T01:00:00", "A", "t", 1.0, 1), ("2025-01-06T01:00:00", "A", "t", 2.0, 2)])
    staged(spark, staging, "20250107", [("2025-01-06T01:00:00", "A", "new", 20.0, 3), ("2025-01-06T02:00:00", "A", "t", 3.0, 4), ("soon", "B", "t", 9.0, 5)])
    assert jobs.upsert_day(spark, staging, lake, ARM_ROBOT, date(2025, 1, 6))
    assert jobs.upsert_day(spark, staging, lake, ARM_ROBOT, date(2025, 1, 7))
    assert jobs.upsert_day(spark, staging, lake, ARM_ROBOT, date(2025, 1, 7))  # a repeat changes nothing
    rows = spark.read.parquet(lake)
    got = sorted((r["timestamp"], r["machine_type"], r["servo_motor_rpm"], r["cycle_count"], str(r["event_date"])) for r in rows.collect())
    assert got == [
        ("2025-01-05T01:00:00", "t", 1.0, 1, "2025-01-05"),
        ("2025-01-06T01:00:00", "t", 20.0, 3, "2025-01-06"),
        ("2025-01-06T02:00:00", "t", 3.0, 4, "2025-01-06"),
        ("soon", "t", 9.0, 5, "unknown"),
    ]
    assert dict(rows.dtypes)["cycle_count"] == "int"


def test_empty_and_missing_days(spark, tmp_path):
    staged(spark, str(tmp_path), "20250106", [])
    assert jobs.upsert_day(spark, str(tmp_path), str(tmp_path / "lake"), ARM_ROBOT, date(2025, 1, 6)) is False
    with pytest.raises(files.SourceUnreadable):
        jobs.upsert_day(spark, str(tmp_path), str(tmp_path / "lake"), ARM_ROBOT, date(2025, 1, 9))


def test_every_family_is_upserted_in_turn(spark, tmp_path):
    for family in FAMILIES.values():
        spark.createDataFrame([("2025-01-06T01:00:00", "A")], "timestamp string, machine_id string").write.parquet(
            str(tmp_path / "staging" / family.lake_table / "20250106")
        )
    done = jobs.upsert_all_families(spark, str(tmp_path / "staging"), str(tmp_path / "lake"), date(2025, 1, 6))
    assert done == {name: True for name in FAMILIES}
    assert spark.read.parquet(str(tmp_path / "lake/cnc_machine_sensor")).count() == 1


def test_run_day():
    assert files.run_day("20250106") == files.run_day("2025-01-06") == date(2025, 1, 6)
    assert files.run_day(" ") == files.run_day()


def test_tables_are_created_once(spark):
    jobs.create_tables(spark, "lake_a")
    spark.sql("insert into lake_a.sensor_data values ('t', 'm', 'k', 0.5, 'MEDIUM')")
    jobs.create_tables(spark, "lake_a")
    assert spark.table("lake_a.sensor_data").count() == 1
    assert spark.table("lake_a.sensor_data").schema == PREDICTION_SCHEMA
    for family in FAMILIES.values():
        assert spark.table(f"lake_a.{family.lake_table}").schema == family.lake_schema
    jobs.create_tables(spark, "lake_a", replace=True)
    assert spark.table("lake_a.sensor_data").isEmpty()
    spark.sql("drop database lake_a cascade")


def test_compaction_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).select((F.col("id") % 2).cast("string").alias("day"), "id").repartition(20).write.partitionBy("day").parquet(path)
    def parts(day):
        return [f for f in os.listdir(f"{path}/day={day}") if f.endswith(".parquet")]
    other = parts(1)
    assert len(parts(0)) > 8
    jobs.compact(spark, path, "day", "0", ["id"])
    assert len(parts(0)) <= 4 and parts(1) == other
    assert spark.read.parquet(path).select(F.count("*"), F.countDistinct("id")).first() == (1000, 1000)


def test_rebuild_replaces_only_given_days(spark, tmp_path):
    path = str(tmp_path / "counts")
    def p(*days):
        return spark.createDataFrame([(f"{d}T01:00:00", "m", "k", "LOW") for d in days], "prediction_timestamp string, machine_id string, machine_type string, risk_level string")
    jobs.rebuild_risk_counts(p("2025-01-01", "2025-01-02", "2025-01-02"), path)
    jobs.rebuild_risk_counts(p("2025-01-02"), path)
    assert sorted((str(r["date"]), r["risk_count"]) for r in spark.read.parquet(path).collect()) == [("2025-01-01", 1), ("2025-01-02", 1)]


def raw_documents(spark, tmp_path):
    day = tmp_path / "raw/date=2025-11-21"
    day.mkdir(parents=True)
    (day / "a.json").write_text(json.dumps([GOOD, changed("service_record_id", "R2")]))
    (day / "b.json").write_text(json.dumps([GOOD, changed("service_details.total_cost", -1)]))
    return files.documents(spark, str(tmp_path / "raw"))


def test_documents_to_star_and_quarantine(spark, tmp_path):
    out = str(tmp_path / "out")
    jobs.process_documents(raw_documents(spark, tmp_path), out)
    def count(name):
        return spark.read.parquet(f"{out}/{name}").count()

    def texts(name):
        return spark.read.json(f"{out}/{name}").count()

    assert count("parquet_for_analytics/fact_service_records") == 2
    assert count("parquet_for_analytics/dim_dealer") == 1
    assert count("parquet_for_analytics/dim_parts_used") == 2 * len(GOOD["service_details"]["parts_used"])
    assert texts("json_for_dynamodb") == 2 and texts("error") == 2
    items = jobs.item_records(spark, out, date(2025, 11, 21))
    assert items.count() == 2 and jobs.item_records(spark, out, date(2025, 11, 22)).isEmpty()
    store = tmp_path / "items"
    store.mkdir()
    assert jobs.load_items(items, folder_writer(str(store))) == {"succeeded": 1, "failed": 0}
    assert sorted(os.listdir(store)) == ["R1", "R2"]
    assert any(d == "date=2025-11-21" for d in os.listdir(f"{out}/error"))


def some_documents(spark, *texts):
    """One document per text, all of one date; a text lists the ids of its records, one beginning with x is broken."""
    good = json.dumps(changed("service_record_id", "ID"))
    rows = [
        (f"date=2025-01-01/{doc}", i, good.replace('"ID"', f'"{r}"') if r[0] != "x" else "{broken")
        for doc, text in texts
        for i, r in enumerate(text.split())
    ]
    return spark.createDataFrame(rows, "doc_id string, pos long, raw string")


def kept_records(spark, root):
    facts = spark.read.schema("doc_id string, service_record_id string").parquet(f"{root}/parquet_for_analytics/fact_service_records").drop("date", "bucket")
    errors = spark.read.schema("doc_id string, raw string").json(f"{root}/error").groupBy("doc_id").count()
    return {tuple(r) for r in facts.collect()}, {r["doc_id"][-1]: r["count"] for r in errors.collect()}


def test_a_document_replaces_itself_and_nothing_else(spark, tmp_path):
    from millwright.plans import ledger

    root, name = str(tmp_path / "out"), "date=2025-01-01/"
    first = jobs.process_documents(some_documents(spark, ("a", "r1 r2 r3"), ("b", "r4")), root, buckets=1)  # they share partitions
    assert jobs.process_documents(some_documents(spark, ("a", "r1 r2 r3")).repartition(3), root) is None
    second = jobs.process_documents(some_documents(spark, ("a", "r1 r9"), ("c", "x1 r5")), root)
    assert kept_records(spark, root) == ({(f"{name}a", "r1"), (f"{name}a", "r9"), (f"{name}b", "r4")}, {"c": 2})
    jobs.process_documents(some_documents(spark, ("a", "x1"), ("c", "r5 r6")), root)
    assert kept_records(spark, root) == ({(f"{name}b", "r4"), (f"{name}c", "r5"), (f"{name}c", "r6")}, {"a": 1})
    jobs.process_documents(some_documents(spark, ("b", "x1"), ("c", "x1")), root)
    facts, errors = kept_records(spark, root)
    assert facts == set() and errors == {"a": 1, "b": 1, "c": 1}  # the partitions of the facts are empty now
    rows = {r["doc_id"][-1]: r for r in ledger.entries(spark, root).collect()}
    assert first < second < rows["c"]["commit"] and {d: r["records"] for d, r in rows.items()} == {"a": 1, "b": 1, "c": 1}


@pytest.mark.parametrize("outputs", [0, 6, 8])
def test_a_commit_that_breaks_off(spark, tmp_path, monkeypatch, outputs):
    """Before it is decided it is forgotten, afterwards the next call finishes it."""
    from millwright.plans import ledger

    root = str(tmp_path / "out")
    jobs.process_documents(some_documents(spark, ("a", "r1"), ("b", "r2")), root)
    step = "replace_folder" if outputs == 8 else "write_partitions"
    plain, left = getattr(ledger, step), [outputs // 2]

    def breaks(*args, **more):
        if not left[0]:
            raise OSError("lost")
        left[0] -= 1
        plain(*args, **more)

    with monkeypatch.context() as patch, pytest.raises(OSError):
        patch.setattr(ledger, step, breaks)
        jobs.process_documents(some_documents(spark, ("a", "r3 r4"), ("b", "x1")), root)
    jobs.process_documents(some_documents(spark, ("d", "r7")), root)
    facts, errors = kept_records(spark, root)
    old, new = {"r1", "r2"}, {"r3", "r4"}
    assert {r for _, r in facts} == (new if outputs == 8 else old) | {"r7"} and errors == ({"b": 1} if outputs == 8 else {})


def test_rejected_files_leave_the_landing_zone(spark, tmp_path):
    landing, root = tmp_path / "landing" / "date=2025-01-01", str(tmp_path / "out")
    landing.mkdir(parents=True)
    (landing / "good.json").write_text(json.dumps([changed("service_record_id", "r1")]))
    (landing / "bad.json").write_text("{broken")
    jobs.process_documents(files.documents(spark, str(tmp_path / "landing")), root)
    from millwright.plans import ledger

    assert ledger.rejected_sources(spark, root, str(tmp_path / "landing")) == 1
    assert [p.name for p in landing.iterdir() if p.suffix == ".json"] == ["good.json"]
    assert spark.read.schema("raw string").json(f"{root}/error").first()["raw"] == "{broken"


def folder_writer(folder):
    """Stands in for a key-value store: one small file per item. Local, so that workers need no test module."""

    class Writer:
        def put(self, batch):
            for item in batch:
                with open(os.path.join(folder, item["service_record_id"]), "w") as out:
                    out.write(str(item["service_details"]["total_cost"]))

        def close(self):
            pass

    return Writer


def test_items_are_loaded_and_failures_reported(spark, tmp_path):
    store = tmp_path / "store"
    store.mkdir()
    raw = raw_documents(spark, tmp_path)
    folder = str(store)
    assert jobs.load_items(raw, folder_writer(folder)) == {"succeeded": 2, "failed": 0}
    assert sorted(os.listdir(folder)) == ["R1", "R2"]
    assert (store / "R1").read_text().startswith("-1")  # the later document replaced the item
    (tmp_path / "raw/date=2025-11-21/c.json").write_text("oops")
    with pytest.raises(jobs.ItemsFailed, match="1 documents failed, 2 loaded"):
        jobs.load_items(files.documents(spark, str(tmp_path / "raw")), folder_writer(folder))


def test_posted_batches_land_whole(spark, tmp_path):
    raw = raw_documents(spark, tmp_path).withColumn("date", F.lit("2025-11-22"))
    bad = spark.createDataFrame([("z", 0, json.dumps(changed("vehicle.vin", None)), "2025-11-22")], raw.select("doc_id", "pos", "raw", "date").schema)
    seen = jobs.land_posted(raw.unionByName(bad), str(tmp_path / "landed"))
    assert seen.get["records"] == 4
    back = files.documents(spark, str(tmp_path / "landed"), date(2025, 11, 22))
    assert back.count() == 4 and back.select("doc_id").distinct().count() == 2


def test_crm_day(spark, tmp_path):
    (tmp_path / "crm.csv").write_text("Tanggal,customer,model,quantity\n06-01-2025,a,m,1\n07-01-2025,b,m,2\n")
    schema = "Tanggal string, customer string, model string, quantity int"
    for day in (date(2025, 1, 6), date(2025, 1, 7), date(2025, 1, 7)):
        jobs.crm_day(spark, str(tmp_path / "crm.csv"), str(tmp_path / "out"), day, schema)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((str(r["day"]), r["customer"]) for r in rows) == [("20250106", "a"), ("20250107", "b")]


def test_history_csv_round_trip(spark, tmp_path):
    from millwright.sources import shapes

    events = spark.createDataFrame([(1, "2025-01-06 10:00:00", 5, "error", 2.5, '{"k": 3}')], "event_id long, t string, user_id long, event_type string, value double, props string")
    history = shapes.labelled_history(events.withColumn("ts", F.to_timestamp_ntz("t")), ARM_ROBOT).drop("event_id")
    jobs.export_history(history, str(tmp_path / "csv"))
    back = files.sensor_history(spark, str(tmp_path / "csv"), ARM_ROBOT)
    assert back.schema == ARM_ROBOT.history_schema and back.collect() == history.collect()


def test_relational_sink_shapes_rows_and_retries(monkeypatch):
    """No database may run here, so the writer chain is replaced."""
    calls = []

    class Rows:
        def select(self, *c):
            calls.append(c)
            return self

        def withColumn(self, *c):
            return self

        @property
        def write(self):
            return self

        def option(self, *o):
            calls.append(o)
            return self

        def mode(self, m):
            return self

        def jdbc(self, *a, **k):
            calls.append("jdbc")
            if calls.count("jdbc") < 3:
                raise OSError("gone")

    monkeypatch.setattr(sinks.time, "sleep", lambda s: None)
    monkeypatch.setattr(sinks.F, "col", lambda c: type("C", (), {"cast": lambda self, t: t})())
    sinks.jdbc_appender("jdbc:x", "sensor_data")(Rows(), 0)
    assert calls.count("jdbc") == 3 and ("batchsize", 200) in calls


def test_stream_takes_up_a_new_model_and_equals_batch_scoring(spark, tmp_path):
    """A forest, then a pipeline of the library; a batch run again keeps the version it was given."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    from millwright.operators import features, forest, scoring
    from millwright.plans import serving, training
    from millwright.sources import shapes

    events = shapes.table(spark, "/root/testdata/sf0.001", "events")
    order, keep = ARM_ROBOT.feature_order, ("event_id", "timestamp", "machine_id", "machine_type")
    mine = shapes.routed(shapes.topic_messages(events), ARM_ROBOT)
    framed = features.serving_features(flatten.sensor_rows(mine, ARM_ROBOT, "event_id"), ARM_ROBOT, *keep).cache()
    known = framed.dropna().withColumn("failure", (F.col("event_id") % 3 == 0).cast("int"))
    first = forest.fit(known, order, "failure", [forest.Lane(trees=3, depth=4)], ["event_id"])[0]
    stages = [*training.vector_stages(order), GBTClassifier(featuresCol="scaled", labelCol="failure", maxIter=2, maxDepth=2)]
    second = Pipeline(stages=stages).fit(known)
    root, out, source = str(tmp_path / "models"), str(tmp_path / "out"), str(tmp_path / "in")
    used = []
    for k, model in enumerate((first, second)):
        assert serving.publish(spark, model, order, f"{root}/arm_robot") == k + 1
        os.makedirs(f"{root}/arm_robot/version={k + 5}")  # not whole: never taken up
        events.where(F.col("event_id") % 2 == k).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        served = serving.Served(spark, root, out)
        flows.score_stream(
            shapes.topic_messages(stream), shapes.routed, served.probability, out, str(tmp_path / "checkpoint"), F.lit("now"), ("event_id",), served.transform, served.begin
        )
        used.append(served.loaded["arm_robot"][0])
        again = serving.Served(spark, root, out)
        again.begin(0)
        assert again.loaded["arm_robot"][0] == 1
    assert used == [1, 2]
    got = spark.read.parquet(f"{out}/predictions").select("event_id", "failure_probability", "risk_level").collect()
    want = []
    for k, model in enumerate((first, second)):
        half = framed.where(F.col("event_id") % 2 == k)
        want += scoring.accepted(training.score(model, half, F.lit("now"), "event_id")).select("event_id", "failure_probability", "risk_level").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == known.count()
    others = spark.read.parquet(f"{out}/rejects").where("reason = 'no_score'")
    assert others.count() > 0  # families without a model
