"""Documents that fail, and streams that run at an interval."""

from __future__ import annotations

import json
import os

import pytest

from millwright.plans import jobs, ledger
from millwright.sources import files
from millwright.sources.streams import message_stream
from millwright.streaming import retries, sinks
from test_service_records import changed


def land_document(folder, name, *records):
    """A document that becomes visible whole."""
    folder.mkdir(parents=True, exist_ok=True)
    draft = folder.parent / f"{name}.draft"
    draft.write_text(json.dumps(list(records)))
    os.replace(draft, folder / name)


def poisoned(log, *bad):
    """Work that fails on documents whose path ends in one of ``bad``, and notes those it has done."""

    def work(docs):
        names = [r["doc_id"].rsplit("/", 1)[1] for r in docs.select("doc_id").collect()]
        for name in names:
            if name in bad:
                raise ValueError(f"can't do {name}")
        log.extend(names)

    return work


def letters(spark, path):
    schema = "doc_id string, value string, attempts int, reason string"
    return {r["doc_id"].rsplit("/", 1)[1]: (r["attempts"], r["reason"]) for r in spark.read.schema(schema).parquet(path).collect()}


def test_a_poison_document_is_put_aside_after_its_tries_and_holds_up_no_other(spark, tmp_path):
    landing, root, done = tmp_path / "in", str(tmp_path / "out"), []
    waiting = []
    for k in range(4):  # every run is a restart
        land_document(landing, f"ok{k}.json", changed("service_record_id", f"R{k}"))
        if k == 0:
            land_document(landing, "bad.json", changed("service_record_id", "X"))
        stream = files.document_stream(spark, str(landing))
        jobs.follow_documents(stream, root, str(tmp_path / "cp"), tries=3, work=poisoned(done, "bad.json"))
        waiting.append(letters(spark, f"{root}/retries/waiting/batch_id={k}"))
    assert sorted(done) == [f"ok{k}.json" for k in range(4)]
    assert [w.get("bad.json", (0, ""))[0] for w in waiting] == [1, 2, 0, 0]
    dead = letters(spark, f"{root}/retries/dead")
    assert list(dead) == ["bad.json"] and dead["bad.json"][0] == 3 and "can't do bad.json" in dead["bad.json"][1]


def test_a_document_that_recovers_is_done_once(spark, tmp_path):
    landing, root, done = tmp_path / "in", str(tmp_path / "out"), []
    for k, bad in enumerate((["a.json"], [])):
        land_document(landing, "ab"[k] + ".json", changed("service_record_id", f"R{k}"))
        jobs.follow_documents(files.document_stream(spark, str(landing)), root, str(tmp_path / "cp"), work=poisoned(done, *bad))
    assert sorted(done) == ["a.json", "b.json"] and letters(spark, f"{root}/retries/dead") == {}


def test_an_outage_puts_nothing_aside(spark):
    docs = spark.createDataFrame([(f"in/{k}",) for k in range(8)], "doc_id string")

    def down(part):
        raise OSError("no store")

    with pytest.raises(retries.TooManyFailures):
        retries.failures(docs, down, "doc_id", most=3)
    found = retries.failures(docs, poisoned([], "2", "5"), "doc_id", most=3)
    assert found == {"in/2": "can't do 2", "in/5": "can't do 5"}


def test_streamed_documents_are_committed_whole(spark, tmp_path):
    landing, root = tmp_path / "in" / "date=2025-01-01", str(tmp_path / "out")
    for k in range(2):
        land_document(landing, "a.json", changed("service_record_id", "R1"), changed("service_record_id", "R2"))
        if k:
            land_document(landing, "b.json", changed("service_record_id", "R3"), changed("service_details.total_cost", -1))
        jobs.follow_documents(files.document_stream(spark, str(tmp_path / "in")), root, str(tmp_path / "cp"), buckets=1)
    facts = spark.read.parquet(f"{root}/parquet_for_analytics/fact_service_records")
    assert sorted(r["service_record_id"] for r in facts.collect()) == ["R1", "R2"]
    records = {r["doc_id"][-6:]: r["records"] for r in ledger.entries(spark, root).collect()}
    assert records == {"a.json": 2, "b.json": 2}


def test_an_interval_with_a_stop_equals_a_run_to_the_end(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for k in range(6):
        (source / f"{k}.txt").write_text(f"m{k}\n")
    sizes = []

    def batch(df, batch_id):
        sizes.append(df.count())
        sinks.write_batch(df, str(tmp_path / "out"), batch_id)

    stream = message_stream(spark, "text", str(source), maxFilesPerTrigger="2")
    run = sinks.at_interval("100 milliseconds", lambda: len(sizes) >= 1)
    run(stream.writeStream.foreachBatch(batch), str(tmp_path / "cp"))
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r["value"] for r in got.collect()) == [f"m{k}" for k in range(6)]
    assert max(sizes) <= 2


def test_an_error_ends_the_query_at_an_interval(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "0.txt").write_text("m\n")

    def batch(df, batch_id):
        raise ValueError("broken sink")

    stream = message_stream(spark, "text", str(source))
    with pytest.raises(Exception, match="broken sink"):
        sinks.at_interval("100 milliseconds", lambda: False)(stream.writeStream.foreachBatch(batch), str(tmp_path / "cp"))
