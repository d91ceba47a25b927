"""What the service queries do as tables grow."""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from millwright import session
from millwright.operators import items, quality, star
from millwright.plans import jobs, service_queries
from millwright.session import written
from millwright.sources import files, shapes
from millwright.streaming import flows
from test_service_records import GOOD, changed, parsed


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def small_tables(spark, root, balance=10.0):
    """Two orders of one customer, with a line each."""
    day = datetime(1995, 7, 3)
    tables = {
        "nation": ([(1, "N", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(7, "C", 1, "AUTO", balance)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string, c_acctbal double"),
        "orders": ([(k, 7, 99.0, day, "2-HIGH") for k in (1, 2)], "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            [(k, 5, 6, 1, 3.0, 50.0, 0.1, 0.2, "R", "O", day) for k in (1, 2)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return str(root)


def test_f3_ingest_where_no_document_is_accepted(spark, tmp_path):
    got = service_queries.ingest_to_star(spark, small_tables(spark, tmp_path, balance=-1.0))
    assert [(r["table"], r["date"], r["rows"]) for r in got.collect()] == [("error", "1995-01-01", 2)]


def test_f2_a_stream_holds_no_batch_in_memory(spark, tmp_path, monkeypatch):
    from pyspark.sql import DataFrame

    def refused(*_):
        raise AssertionError("persist")

    monkeypatch.setattr(DataFrame, "persist", refused)
    rows = [("d", 0, json.dumps(GOOD)), ("e", 0, json.dumps(changed("service_details.total_cost", -1.0)))]
    spark.createDataFrame(rows, "doc_id string, pos long, raw string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("doc_id string, pos long, raw string").parquet(f"{tmp_path}/in")
    flows.record_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert [spark.read.parquet(f"{tmp_path}/out/{n}").count() for n in ("items", "error", "dim_parts_used")] == [1, 1, 4]


def test_f1_record_texts_are_compressed_and_scratch_is_removed(spark, tmp_path, monkeypatch):
    paths = []
    monkeypatch.setattr(jobs, "scratch_dir", lambda _, label: paths.append(f"{tmp_path}/{label}") or paths[-1])
    raw = spark.createDataFrame([("date=2025-01-06/d", 0, json.dumps(GOOD)), ("date=2025-01-06/e", 0, "{")], "doc_id string, pos long, raw string")
    jobs.process_documents(raw, f"{tmp_path}/out")
    files = [p for kind in ("json_for_dynamodb", "error") for p in (tmp_path / "out" / kind).rglob("part-*")]
    assert files and all(p.name.endswith(".json.gz") for p in files)
    assert paths and not (tmp_path / "parsed").exists()


def test_verdicts_sort_no_record_unless_a_vehicle_decides(spark):
    """Per document everything is summed in fixed space; the rule's rank stands for its name."""
    seen = quality.judged(parsed(spark, [GOOD])).groupBy("doc_id").agg(F.min("record_rule"), F.min("vehicle_rule"))
    assert "SortAggregate" not in plan_of(seen)
    assert "SortAggregate" not in plan_of(quality.judge_posted(parsed(spark, [GOOD])))


def test_every_name_a_record_can_get_has_a_rank(spark):
    ranked = quality._ranked_rules()
    assert len(ranked) == len(set(ranked)) and ranked[0] == "document: unreadable"
    wrong = [changed("vehicle.odometer_reading", "far"), changed("service_details.service_date", "soon"), changed("service_details.parts_used.0.quantity", 0)]
    names = [r["rule"] for r in quality.violation_counts(parsed(spark, wrong)).collect()]
    assert len(names) == 3 and set(names) <= set(ranked)


def test_a_null_document_keeps_its_vehicle_verdict(spark):
    """Only a vehicle's first record counts, also where the id is null."""
    bad, good = json.dumps(changed("vehicle.odometer_reading", None)), json.dumps(GOOD)
    rows = [(None, 0, bad), (None, 1, good), ("a", 0, good), ("a", 1, bad)]
    got = quality.judge_documents(quality.parse_records(spark.createDataFrame(rows, "doc_id string, pos long, raw string"))).collect()
    assert {(r["doc_id"], r["records"], r["rule"]) for r in got} == {(None, 2, "dim_vehicle.odometer_reading: not_null"), ("a", 2, None)}


def test_a_star_query_reads_its_texts_once(spark, tmp_path):
    assert "from_json" not in plan_of(service_queries.star_table(spark, small_tables(spark, tmp_path), "dim_dealer"))
    assert set(star.READS) == set(star.BUILDERS)


def test_texts_are_not_shuffled_to_find_the_last_of_a_key(spark):
    texts = ['{"k": "a", "v": 1}', '{"k": "a", "v": 2}', '{"k": "b", "v": 3}', '{"v": 4}']
    rows = spark.createDataFrame([("d", i, t) for i, t in enumerate(texts)] + [(None, 9, '{"k": "c"}')], "doc_id string, pos long, raw string")
    last = items.last_record_per_key(rows, "k", "doc_id", "pos")
    assert "SortMergeJoin" not in plan_of(last)
    assert sorted(tuple(r) for r in last.collect()) == [("a", texts[1]), ("b", texts[2])]


def test_f5_f6_f7_f9_lines_are_shuffled_once_in_parts_that_follow_their_splits(spark, tmp_path):
    root = small_tables(spark, tmp_path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(shapes.service_records(spark, root))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    parts = files.enough_parts(shapes.table(spark, root, "lineitem"))
    assert parts >= files.PARTS_PER_SPLIT and "hashpartitioning(l_orderkey" in plan and f", {parts}), REPARTITION_BY_NUM" in plan
    assert sum("Exchange hashpartitioning(l_" in line for line in plan.splitlines()) == 1


def test_f8_f10_parts_are_parsed_once(spark, tmp_path):
    got = service_queries.star_table(spark, small_tables(spark, tmp_path), "dim_parts_used")
    assert "from_json" not in plan_of(got)
    assert sorted((r["service_record_id"], r["part_name"], r["quantity"]) for r in got.collect()) == [
        (f"SRV-{k}-1-5-6", name, n) for k in (1, 2) for name, n in (("PART-5", 3), ("SEAL-6", 1))
    ]


def misfits(spark):
    from test_service_records import CASES

    odd = [changed("service_details.parts_used.1.quantity", "4", base=changed("vehicle.odometer_reading", "12.0")), {"vehicle": 7}, []]
    texts = [json.dumps(x) for x in (GOOD, *[changed(p, v, d) for p, v, d, _ in CASES], *odd)] + ["{broken", "oops", "", "null", None]
    return spark.createDataFrame([(f"d{i}", i, t) for i, t in enumerate(texts)], "doc_id string, pos long, raw string")


def rows_in_order(df, *drop):
    return sorted(map(repr, df.drop(*drop).collect()))


def test_f3_f4_f5_records_read_as_text_get_the_same_values_and_verdicts(spark):
    typed, texts = (quality.parse_records(misfits(spark), as_text=x) for x in (False, True))
    assert rows_in_order(typed, "text") == rows_in_order(texts, "text")
    for check in (quality.judge_documents, quality.judge_posted, quality.violation_counts):
        assert rows_in_order(check(typed)) == rows_in_order(check(texts))


def test_f3_f4_f5_records_that_do_not_fit_are_parsed_once(spark, tmp_path):
    raw = spark.createDataFrame([("d", 0, json.dumps(GOOD))], "doc_id string, pos long, raw string")
    assert plan_of(quality.judged(quality.parse_records(raw, as_text=True))).count("from_json(") == 1
    root = small_tables(spark, tmp_path)
    for query in (service_queries.violations, service_queries.posted_verdict):
        assert plan_of(query(spark, root)).count("from_json(") == 1


def test_f4_every_violation_of_a_record_is_counted(spark):
    bad = changed("dealer.dealer_id", None, base=changed("service_details.parts_used.0.quantity", 0, base=changed("service_details.parts_used.1.unit_cost", -1)))
    got = {r["rule"]: r["records"] for r in quality.violation_counts(parsed(spark, [bad, bad, GOOD])).collect()}
    assert got == {"dim_dealer.dealer_id: not_null": 2, "dim_parts_used.quantity: at_least_1": 2, "dim_parts_used.unit_cost: at_least_0": 2}


def test_f5_a_posted_verdict_builds_no_array(spark):
    raw = spark.createDataFrame([("d", 0, json.dumps(GOOD)), ("e", 0, json.dumps(changed("service_details.parts_used", "none")))], "doc_id string, pos long, raw string")
    judged = quality.judge_posted(quality.parse_records(raw, as_text=True))
    assert "transform(" not in plan_of(judged)
    assert {r["doc_id"]: r["rule"] for r in judged.collect()} == {"d": None, "e": "parts_used: array"}


def test_f6_few_repeated_keys_are_written_before_they_are_joined(spark, monkeypatch):
    seen = {}

    def spied(df, label, *args, **options):
        seen[label] = (written(df, label, *args, **options), options, plan_of(df))
        return seen[label][0]

    monkeypatch.setattr(items, "written", spied)
    rows = spark.createDataFrame([("d", i, f'{{"k": "k{i % 9}", "v": {i}}}') for i in range(10)], "doc_id string, pos long, raw string")
    last = items.last_record_per_key(rows, "k", "doc_id", "pos")
    assert [r["_key"] for r in seen["again"][0].collect()] == ["k0"]
    assert "count(" not in seen["replaced"][2].replace("rowcount", "")  # keys are not counted again, nor their rows shuffled for it
    assert all(f.endswith(".zstd.parquet") for f in seen["keyed"][0].inputFiles())
    assert {r["k"]: json.loads(r["raw"])["v"] for r in last.collect()} == {f"k{i}": i or 9 for i in range(9)}


def test_f6_a_write_leaves_no_shuffle_files_and_the_setting_is_put_back(spark):
    before = spark.conf.get(session._REMOVE, None)
    with session.shuffles_removed(spark):
        assert spark.conf.get(session._REMOVE) == "true"
        counts = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert spark.conf.get(session._REMOVE, None) == before and counts.count() == 7


def test_f7_a_stream_writes_texts_once_per_output_and_packed(spark, tmp_path, monkeypatch):
    kept = {}
    monkeypatch.setattr(flows, "written", lambda df, label, *a, **o: kept.update({label: df.columns}) or written(df, label, *a, **o))
    rows = [("d", 0, json.dumps(GOOD)), ("d", 1, json.dumps(GOOD)), ("e", 0, json.dumps(changed("service_details.total_cost", -1.0))), (None, 3, json.dumps(GOOD))]
    spark.createDataFrame(rows, "doc_id string, pos long, raw string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("doc_id string, pos long, raw string").parquet(f"{tmp_path}/in")
    flows.record_stream(stream, f"{tmp_path}/out", f"{tmp_path}/cp")
    assert "raw" not in kept["parsed"]
    items_, error = (spark.read.parquet(f"{tmp_path}/out/{n}") for n in ("items", "error"))
    assert all(f.endswith(".zstd.parquet") for f in items_.inputFiles() + error.inputFiles())
    assert {(r["doc_id"], r["pos"], r["raw"]) for r in items_.collect()} == {rows[0], rows[1], rows[3]}
    assert [(r["doc_id"], r["pos"], r["raw"], r["rule"]) for r in error.collect()] == [(*rows[2], "fact_service_records.total_cost: at_least_0")]


def test_f1_posted_batches_land_packed_and_are_parsed_once(spark, tmp_path, monkeypatch):
    paths, kept = [], {}
    monkeypatch.setattr(jobs, "scratch_dir", lambda _, label: paths.append(f"{tmp_path}/{label}") or paths[-1])
    monkeypatch.setattr(jobs, "written", lambda df, label, *a, **o: kept.update({label: plan_of(df)}) or written(df, label, *a, **o))
    second, bad = changed("service_record_id", "R2", base=changed("service_details.parts_used", drop=True)), changed("vehicle.vin", None)
    rows = [("a", 1, json.dumps(second)), ("a", 0, json.dumps(GOOD)), ("b", 0, json.dumps(GOOD)), ("b", 1, json.dumps(bad))]
    raw = spark.createDataFrame([(*r, "2025-11-22") for r in rows], "doc_id string, pos long, raw string, date string")
    for _ in range(2):  # a batch posted again replaces itself
        assert jobs.land_posted(raw, f"{tmp_path}/landed").get["records"] == 2
    landed = [p for p in (tmp_path / "landed").rglob("part-*")]
    assert len(landed) == 1 and landed[0].name.endswith(".txt.gz")
    assert "from_json" in kept["posted"] and not (tmp_path / "posted").exists()
    (text,) = spark.read.text(str(landed[0]), wholetext=True).first()
    assert [(r["service_record_id"], len(r["service_details"]["parts_used"])) for r in json.loads(text)] == [("R1", 4), ("R2", 0)]
    back = files.documents(spark, f"{tmp_path}/landed").orderBy("pos").collect()
    assert [json.loads(r["raw"])["service_record_id"] for r in back] == ["R1", "R2"] and len({r["doc_id"] for r in back}) == 1


def test_f1_f2_what_a_commit_writes_of_texts_is_packed(spark, tmp_path, monkeypatch):
    kept = {}

    def spied(df, label, *args, **options):
        kept[label] = written(df, label, *args, **options)
        files_ = kept[label].inputFiles()
        assert label != "parsed" or files_ and all(f.endswith(".zstd.parquet") for f in files_)
        return kept[label]

    monkeypatch.setattr(jobs, "written", spied)
    raw = spark.createDataFrame([("date=2025-01-06/d", 0, json.dumps(GOOD))], "doc_id string, pos long, raw string")
    before = spark.conf.get(session._REMOVE, None)
    assert jobs.process_documents(raw, f"{tmp_path}/out") and "parsed" in kept
    assert spark.conf.get(session._REMOVE, None) == before


def test_f1_blocks_that_overlap_put_the_setting_back(spark):
    before, other = spark.conf.get(session._REMOVE, None), spark.newSession()
    first, second, third = (session.shuffles_removed(s) for s in (spark, spark, other))
    for block in (first, second, third):
        block.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(session._REMOVE) == "true"
    for block in (second, third):
        block.__exit__(None, None, None)
    assert [s.conf.get(session._REMOVE, None) for s in (spark, other)] == [before, None] and not session._removing
