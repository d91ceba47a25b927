"""Toxicity, quality and BPE."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm.cases import no_documents, no_labels, odd_documents
from millwright.llm import bpe, quality, toxicity
from millwright.llm.common import table

SF = "/root/testdata/sf0.01"


def held_out(spark, module, label):
    scored = module.classify(table(spark, SF, "documents"), table(spark, SF, "labels"))
    known = scored.where("held_out").join(table(spark, SF, "labels").select("doc_id", label), "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in known)
    right = sum(r.predicted == r[label] for r in known) / len(known)
    most = max(sum(r[label] for r in known), sum(1 - r[label] for r in known)) / len(known)
    return right, most


def test_quality_beats_the_majority_on_held_out_rows(spark):
    right, most = held_out(spark, quality, "quality")
    assert right >= 0.97 > most


def test_toxicity_beats_the_majority_on_held_out_rows(spark):
    right, most = held_out(spark, toxicity, "toxic")
    assert right >= 0.94 > most


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_rows_and_no_labels(spark, module):
    docs = odd_documents(spark)
    rows = module.classify(docs, no_labels(spark)).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert module.classify(no_documents(spark), no_labels(spark)).count() == 0
    labels = spark.createDataFrame([(1, None, None, "z"), (None, 1, 1, "z"), (7, 1, 0, "z"), (7, 0, 1, "z")], "doc_id long, quality int, toxic int, text string")
    assert module.classify(docs, labels).count() == docs.count()


def brute_quality(text, weights, bias):
    """Mean of the weights of all features, one feature at a time."""
    mask, step, mix = (1 << 64) - 1, int(quality._STEP), int(quality._MIX)
    bucket = lambda x: (((x * mix) & mask) >> 40) % quality.BUCKETS
    data = b"\n" + text + b"\n"
    space = b"\t\n\x0b\x0c\r "
    values = []
    for n in quality.GRAMS:
        for i in range(len(data) - n + 1):
            if not any(c in space for c in data[i + 1 : i + n - 1]):
                h = n
                for c in data[i : i + n]:
                    h = (h * step + c + 1) & mask
                values.append(weights[bucket(h)])
    words = text.split()
    for k, w in enumerate(words):
        values.append(weights[bucket(sum((c + 1) * pow(step, j + 1, 1 << 64) for j, c in enumerate(w)) & mask)])
        if k and w == words[k - 1]:
            values.append(weights[bucket(1)])
    return 1 / (1 + math.exp(-(sum(values) / max(1, len(values)) + bias)))


def test_quality_scores_equal_brute_force(spark):
    weights = np.random.default_rng(0).normal(0, 3, quality.BUCKETS)
    docs = odd_documents(spark, [(20, "a a a b"), (21, "tab\tand  two\n\nlines é"), (22, "ab")])
    docs = docs.withColumn("copy", F.col("text"))
    got = sorted((r.copy or "", r.score) for r in quality.score(docs, weights, 0.1, ("doc_id", "copy")).collect())
    for text, score in got:
        if len(text) < 1000:
            assert score == pytest.approx(brute_quality(text.encode(), weights, 0.1), abs=1e-9)


def test_label_model_finds_rates_and_correlation():
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.2
    rates = [(0.7, 0.01), (0.6, 0.01), (0.5, 0.02)]
    votes = np.stack([np.where(y, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates], axis=1)
    votes = np.concatenate([votes, votes[:, :1]], axis=1).astype(np.float32)  # the last repeats the first
    posterior, found = toxicity.label_model(votes, 0.2)
    assert np.mean((posterior > 0.5) == y) > 0.93
    assert found["correlation"][0, 3] > 0.95 and abs(found["correlation"][0, 1]) < 0.3
    assert all(abs(found["toxic"][i] - a) < 0.2 for i, (a, _) in enumerate(rates))


PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    found = Tokenizer.from_file(PATH)
    found.no_truncation()
    found.no_padding()
    return found


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as file:
        return bpe.Coder(file.read())


ODD_TEXTS = [
    "",
    "<|endoftext|>x <|startoftext|><|endoftext|>",
    "ΟΔΟΣ it's I'LL don’t 'S 'LLx",
    "a" * 5000,
    "ab" * 3000 + "é" * 100,
    "a\x1cb '\x1cs \x1f \x85   x",
    "🙂🙂👍🏽 abc123 4５ ²½ é İstanbul ﬁ",
]


def test_codes_equal_the_library(coder, library):
    rng = random.Random(1)
    parts = ["th", "e", "r", "in", "a", "n", "es", "ll", "oo", "ing", "s", "aa", "b", "é", "ß", "!", "zz", "'", " ", "5"]
    texts = ODD_TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randint(1, 30))) for _ in range(5000)]
    texts += [t.replace("</w>", "") for t in library.get_vocab()][::7]
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        ids = [i for code in coder.codes(text) for i in code[0]]
        assert ids == want.ids, text[:80]
        assert coder.decode(ids).decode() == library.decode(want.ids, skip_special_tokens=False)


def test_full_memories_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    with open(PATH, encoding="utf-8") as file:
        small = bpe.Coder(file.read())
    text = "the cats and the dogs; the birds, and the 12 fishes of the seas and rivers"
    assert [i for c in small.codes(text) for i in c[0]] == library.encode(text, add_special_tokens=False).ids


def test_query_digests_and_operators_agree(spark, library):
    docs = odd_documents(spark, list(enumerate(ODD_TEXTS, 30)))
    docs = docs.withColumn("copy", F.col("text"))
    coded = bpe.encode(docs, PATH, ("doc_id", "copy")).collect()
    digest = {(r.doc_id, r.copy): r for r in bpe.digests(docs, PATH, ("doc_id", "copy")).collect()}
    assert len(coded) == docs.count()
    for r in coded:
        want = library.encode(r.copy or "", add_special_tokens=False).ids
        text = library.decode(want, skip_special_tokens=False)
        d = digest[r.doc_id, r.copy]
        assert r.ids == want and r.decoded == text and d.n_tokens == len(want)
        assert d.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert d.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = bpe.decode(spark.createDataFrame([(1, [320, 49407]), (2, None), (3, [])], "doc_id long, ids array<int>"), PATH).collect()
    assert {r.doc_id: r.decoded for r in back} == {1: library.decode([320, 49407], skip_special_tokens=False), 2: "", 3: ""}
    assert bpe.digests(no_documents(spark), PATH).count() == 0
