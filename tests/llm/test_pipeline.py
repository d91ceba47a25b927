"""The corpus pipeline against a plain version of it."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from llm.cases import no_documents, odd_documents
from llm.test_duplicates import brute_contamination, brute_fingerprint, smallest_reachable
from millwright.llm.common import table

BENCH = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"), (2, "short benchmark item")]
TEXTS = [
    (50, "You are an idiot and a moron, you worthless scum."),
    (51, "A clean text about harvest machines and their oil, written by hand."),
    (52, "A clean text about harvest machines and their oil, written by hand."),
    (53, "intro words alpha beta gamma delta epsilon zeta eta theta iota kappa and more"),
    (54, "this is a Short, benchmark ITEM inside"),
    (55, "config: password = 'hunter2222' and nothing else"),
    (56, "Nothing to see here, only gears, belts and bearings."),
]


@pytest.fixture
def tables(spark, tmp_path):
    def write(docs):
        docs.write.parquet(f"{tmp_path}/documents.parquet")
        spark.createDataFrame(BENCH, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
        labels = spark.createDataFrame([(50, 0, 1), (51, 1, 0), (56, 1, 0)], "doc_id long, quality int, toxic int")
        labels.write.parquet(f"{tmp_path}/labels.parquet")
        return str(tmp_path)

    return write


def test_stages_equal_a_plain_version(spark, tables):
    docs = odd_documents(spark, TEXTS).coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id != 50]  # the toxic one goes
    fps = [brute_fingerprint(t) for _, t in rows]
    groups = smallest_reachable([d for d, _ in rows], fps)
    kept = {}
    for (d, t), g in sorted(zip(rows, groups), key=lambda x: (x[0][0] is not None, x[0][0] or 0)):
        kept.setdefault(g, (d, t))
    clean = {(d, n) for d, _, n, _ in brute_contamination(list(kept.values()), BENCH)}
    left = [(d, t) for d, t in kept.values() if (d, 0) in clean]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    want = []
    for d, t in left:
        t = (t or "").replace("password = 'hunter2222", "[REDACTED]")
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((d, ids, hashlib.sha256(text.encode()).hexdigest()))
    got = corpus_pipeline.run(spark, tables(docs)).collect()
    assert sorted(((r.doc_id, r.ids, r.decoded_sha256) for r in got), key=str) == sorted(want, key=str)
    ids = {r.doc_id for r in got}
    assert 50 not in ids and 53 not in ids and 54 not in ids and {51, 55, 56} <= ids and 52 not in ids


def test_stages_keep_the_columns_of_their_input(spark, tables):
    folder = tables(odd_documents(spark, TEXTS))
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).schema == docs.schema
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "bpe"]


def test_no_documents(spark, tables):
    assert corpus_pipeline.run(spark, tables(no_documents(spark))).count() == 0


def test_every_operator_is_registered():
    names = {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
    assert names == {f"op{n}" for n in range(1, 14)} and "pipeline" in entry.queries()


def test_components_that_share_their_smallest_id_stay_apart(spark, tables):
    texts = [(5, "gears turn in oil"), (5, "a letter about the harvest"), (None, "unknown text one"), (None, "some other words here"), (9, "gears turn in oil")]
    fps = [brute_fingerprint(t) for _, t in texts]
    folder = tables(spark.createDataFrame(texts, "doc_id long, text string").coalesce(1))
    component = smallest_reachable(list(range(len(texts))), fps)
    assert component == [0, 1, 2, 3, 0]
    got = corpus_pipeline.near_dedup(spark, table(spark, folder, "documents"), folder).collect()
    assert sorted(map(tuple, got), key=str) == sorted(texts[:4], key=str)
