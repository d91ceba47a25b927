"""Row numbers must name the same rows when files are split anew between two scans."""

from __future__ import annotations

import pytest

import corpus_pipeline
from llm.test_duplicates import brute_repeats, repeat_cases
from millwright.llm import simhash, suffix
from millwright.llm.common import ROW, numbered

SPLIT = "spark.sql.files.maxPartitionBytes"


@pytest.fixture
def split_anew(spark):
    """Has Spark cut files otherwise from the next scan on, as it does when the number of cores changes."""
    yield lambda: spark.conf.set(SPLIT, "2000")
    spark.conf.unset(SPLIT)


def stored(spark, tmp_path, rows, files=3):
    spark.createDataFrame(rows, "doc_id long, text string").repartition(files).write.option("parquet.block.size", "2000").parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs"))


def test_numbers_stay_when_files_are_split_anew(spark, tmp_path, split_anew):
    docs = stored(spark, tmp_path, [(i, f"text {i}") for i in range(3000)])
    frames = [docs, docs.where("doc_id > 5"), docs.select("text"), docs.limit(0)]
    kept = [numbered(f) for f in frames]
    before = [sorted((r[ROW], r.text) for r in k.select(ROW, "text").collect()) for k in kept]
    split_anew()
    assert [sorted((r[ROW], r.text) for r in k.select(ROW, "text").collect()) for k in kept] == before
    assert [len({n for n, _ in b}) for b in before] == [3000, 2994, 3000, 0]


def test_near_dedup_drops_the_right_rows(spark, tmp_path, monkeypatch, split_anew):
    texts = [(i, f"machine {i} has gears of kind {i * 7919} and oil {i * 104729}") for i in range(400)]
    docs = stored(spark, tmp_path, texts + [(1000 + i, t) for i, t in texts])
    want = sorted(r.doc_id for r in simhash.one_of_each(docs, ("doc_id",)).collect())
    plain = simhash.one_of_each

    def then_split(*args):
        found = plain(*args)
        split_anew()
        return found

    monkeypatch.setattr(simhash, "one_of_each", then_split)
    assert sorted(r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()) == want


def test_repeats_are_cut_from_the_right_rows(spark, tmp_path, monkeypatch, split_anew):
    rows = repeat_cases()
    docs = stored(spark, tmp_path, rows)
    plain = suffix.written

    def then_split(frame, label):
        found = plain(frame, label)
        split_anew()
        return found

    monkeypatch.setattr(suffix, "written", then_split)
    got = sorted((tuple(r)[:5] for r in suffix.without_repeats(docs).collect()), key=str)
    assert got == brute_repeats(rows)
