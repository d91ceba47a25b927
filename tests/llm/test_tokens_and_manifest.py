"""Packing, alignment of two vocabularies, and the Merkle manifest, beside plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
import tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from llm.cases import no_documents, odd_documents
from millwright.llm import alignment, bytelevel, merkle, packing, queries
from millwright.llm.common import byte_slices, table
from parity import compare, reference

BYTES, PIECE = queries.vocabulary_path(queries.BYTE_LEVEL), queries.vocabulary_path(queries.PIECES)
PARTS = "foo| |  |\n| \n|\t|bar's|don't 12|é|漢字|  x|<|endoftext|>|　z|▁|<s>|</s>| <0x0A>|😀|\x1c|\x85|...|İ|\r\n|ſ|1٢| —x|“q”| ا|'s|​|Ω".split("|")
PARTS += ["<|endoftext|>", " ", "a" * 150]


def odd_texts(n: int) -> list[str]:
    draw = random.Random(3)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 12))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(BYTES)


@pytest.fixture(scope="module")
def plain_library():
    out = tokenizers.Tokenizer.from_file(BYTES)
    out.encode_special_tokens = True
    return out


@pytest.fixture(scope="module")
def piece_library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE)


@pytest.fixture
def documents(spark, sf_dir):
    odd = odd_documents(spark, [(100 + i, t) for i, t in enumerate(odd_texts(300))])
    return odd.select("doc_id", "text").unionByName(table(spark, sf_dir, "documents").select("doc_id", "text")).repartition(5)


def test_ids_equal_the_tokenizers_library(library, plain_library):
    with open(BYTES, encoding="utf-8") as file:
        source = file.read()
    special, plain = bytelevel.ByteLevel(source, True), bytelevel.ByteLevel(source, False)
    for t in odd_texts(4000):
        assert special.ids(t) == library.encode(t, add_special_tokens=False).ids, t
        assert plain.ids(t) == plain_library.encode(t, add_special_tokens=False).ids, t


def test_slices_hold_their_bytes_or_one_text():
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"text": ["a" * 5, None, "b" * 30, "", "c" * 4, "d" * 5, "e"]})
    slices = [x.column("text").to_pylist() for x in byte_slices([batch, batch.slice(0, 0)], limit=10)]
    assert sum(slices, []) == batch.column("text").to_pylist()
    assert all(len(s) == 1 or sum(len(t or "") for t in s) <= 10 for s in slices)


def plain_pieces(library, docs, size):
    out = Counter()
    for r in docs.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        borders = [0, *range((len(ids) - 1) % size + 1, len(ids) + 1, size)]
        for k, (a, b) in enumerate(zip(borders, borders[1:])):
            out[r.doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], dtype="<u4").tobytes())] += 1
    return out


@pytest.mark.parametrize(("size", "slack"), [(2048, 16), (64, 4)])
def test_packed_pieces(library, documents, size, slack):
    rows = packing.pack(documents, BYTES, size=size, slack=slack).collect()
    assert Counter(tuple(r)[:5] for r in rows) == plain_pieces(library, documents, size)
    held: dict[int, list] = {}
    for r in rows:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in held.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    least = -(-sum(r.length for r in rows) // size)
    assert len(held) <= least * 1.01 + 1


def test_rounds_merge_underfull_bins_of_many_partitions(spark):
    fills = [(i, 40 + i % 25) for i in range(4000)] + [(5000 + i, 20) for i in range(4000)]
    bins = spark.createDataFrame(fills, "bin long, fill long").repartition(7)
    moves = packing.rounds(bins, 64, 2, round_bins=700).collect()
    assert sorted(m.bin for m in moves) == sorted(b for b, _ in fills)
    size, spans = dict(fills), {}
    for m in moves:
        spans.setdefault(m.into, []).append((m.shift, size[m.bin]))
    for own in spans.values():
        at = 0
        for shift, fill in sorted(own):
            assert shift == at
            at += fill
        assert at <= 64
    _, _, best = packing.best_fit(np.array([f for _, f in fills]), 64)
    assert len(spans) <= 1.02 * len(best)


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=60, deadline=None)
def test_best_fit(sizes):
    bins, offsets, fills = packing.best_fit(np.array(sizes, dtype=np.int64), 20)
    free: list[int] = []
    for s in sorted(sizes, reverse=True):  # a plain best fit
        room = [(f, b) for b, f in enumerate(free) if f >= s]
        if room:
            free[min(room)[1]] -= s
        else:
            free.append(20 - s)
    assert len(fills) == len(free) and fills.sum() == sum(sizes)
    for b in range(len(fills)):
        own = sorted((offsets[k], sizes[k]) for k in np.flatnonzero(bins == b))
        assert [o for o, _ in own] == [sum(s for _, s in own[:i]) for i in range(len(own))]


def test_sequences_hold_the_ids(library, documents):
    packed = packing.pack(documents, BYTES, size=256, with_ids=True).cache()
    for r in packed.collect():
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids


def test_packing_of_no_rows_and_clashing_columns(spark):
    assert packing.pack(no_documents(spark), BYTES).count() == 0
    clash = odd_documents(spark).withColumn("bin", F.lit(1)).withColumn("fill", F.lit("x")).withColumn("piece", F.lit(2))
    assert packing.pack(clash, BYTES).where("piece = 0").count() == clash.count()


def plain_alignment(plain_library, pieces, docs):
    back = {c: b for b, c in enumerate(bytelevel.byte_characters())}
    a_bytes = {i: bytes(back[c] for c in s) for s, i in plain_library.get_vocab().items() if s != "<|endoftext|>"}
    b_bytes = lambda i: bytes([int(pieces.id_to_piece(i)[3:5], 16)]) if pieces.is_byte(i) else pieces.id_to_piece(i).replace("▁", " ").encode()
    rows, held = [], Counter()
    for r in docs.collect():
        text = r.text or ""
        a, b = plain_library.encode(" " + text, add_special_tokens=False).ids, pieces.encode(text)
        parts = [a_bytes[i] for i in a], [b_bytes(i) for i in b]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            rows.append((r.doc_id, None))
            continue
        ends = [np.cumsum([len(x) for x in p]).tolist() for p in parts]
        groups, i, j = [], 0, 0
        for end in sorted({*ends[0]} & {*ends[1]}):
            p, q = ends[0].index(end) + 1, ends[1].index(end) + 1
            groups.append((a[i:p], b[j:q]))
            i, j = p, q
        links = Counter((x, y) for p, q in groups for x in p for y in q)
        held.update(links.keys())
        spelled = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        rows.append((r.doc_id, (len(a), len(b), len(groups), links, spelled)))
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = Counter()
    for doc, found in rows:
        if found is None:
            out[doc, 0, 0, 0, 0, 0, 0, "", ""] += 1
            continue
        *n, links, spelled = found
        best = sum(k for x, k in links.items() if held[x] == most[x[0]])
        out[doc, *n, links.total(), best, sum(k * held[x] for x, k in links.items()), hashlib.sha256(spelled.encode()).hexdigest(), spelled] += 1
    return out, held, most


def test_alignment_equals_plain_version(plain_library, piece_library, documents, monkeypatch):
    docs = documents.where("length(text) < 30000 or text is null").cache()
    want, held, most = plain_alignment(plain_library, piece_library, docs)
    assert Counter(map(tuple, alignment.align(docs, BYTES, PIECE, with_groups=True).collect())) == want
    counts = alignment.link_counts(alignment.aligned(docs, BYTES, PIECE)).collect()
    assert {(r.a_id, r.b_id): (r.docs, r.best) for r in counts} == {x: (n, n == most[x[0]]) for x, n in held.items()}


def test_memory_of_windows_changes_no_result(spark):
    with open(BYTES, encoding="utf-8") as a, open(PIECE, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = odd_texts(200) + ["x" * 700 + " 1234567 " * 50, "", "漢字" * 400]
    first = aligner.align(texts, True)[0]
    again = aligner.align(texts, True)[0]
    aligner.forget()
    one_by_one = [aligner.align([t], True)[0] for t in texts]
    for k in (0, 1, 2, 3, 4, 7):
        assert list(first[k]) == list(again[k]) == [x[k][0] for x in one_by_one]


def test_new_windows_are_aligned_together(monkeypatch):
    """A slice's new windows take a call for many, not one each, however they are cut; groups of many pairs are among them."""
    with open(BYTES, encoding="utf-8") as a, open(PIECE, "rb") as b:
        aligner = alignment.Aligner(a.read(), b.read())
    texts = odd_texts(200) + ["x" * 700 + " 1234567 " * 50, "", "漢字" * 400]
    calls, learn = [], aligner.learn
    monkeypatch.setattr(aligner, "learn", lambda keys: (calls.append(len(keys)), learn(keys)))
    first = aligner.align(texts, True)
    assert len(calls) == 1 and calls[0] == len(aligner.windows) > 50
    aligner.align(texts, True)
    assert len(calls) == 1
    aligner.forget()
    monkeypatch.setattr(alignment, "LEARNT", 7)
    again = aligner.align(texts, True)
    assert len(calls) > 7
    for k in (0, 1, 2, 3, 4, 7):
        assert list(first[0][k]) == list(again[0][k])
    assert dict(zip(first[1].tolist(), first[2].tolist())) == dict(zip(again[1].tolist(), again[2].tolist()))


def test_alignment_of_odd_and_no_rows(spark):
    assert alignment.align(no_documents(spark), BYTES, PIECE).count() == 0
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [tuple(r) for r in alignment.align(empty, BYTES, PIECE).orderBy("doc_id").collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
    clash = odd_documents(spark).withColumn("chunk", F.lit("a")).withColumn("pair", F.lit(1))
    assert alignment.align(clash, BYTES, PIECE, ("doc_id", "chunk")).count() == clash.count()


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes, fanout):
    paths, members = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        parents, below = [], []
        for k in range(0, len(nodes), fanout):
            run = nodes[k : k + fanout]
            for j in range(len(run)):
                for m in members[k + j]:
                    paths[m].append(("".join(run[:j]), "".join(run[j + 1 :])))
            parents.append(digest("".join(run)))
            below.append(sum(members[k : k + fanout], []))
        nodes, members = parents, below
    return nodes[0], paths


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_proofs_equal_plain_tree(spark, fanout):
    rows = [(i, "ab\nc" if i % 3 else None, [None, "", "s", "é", "t"][min(i % 11, 4)], "x") for i in range(200)]
    rows += [(7, "ab\nc", "s", "x")] * 30 + [(None, "t", "s", "x"), (None, None, "alone", None)]
    docs = spark.createDataFrame(rows, "id long, body string, part string, item string").repartition(6)
    got = merkle.proofs(docs, ("id", "part"), ("id", "part", "body"), "part", "id", fanout=fanout).collect()
    spell = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaves: dict = {}
    for i, body, part, _ in rows:
        leaves.setdefault(part, []).append((i is not None, i or 0, digest(spell(i) + spell(part) + spell(body))))
    names = sorted(leaves, key=lambda p: (p is not None, (p or "").encode()))
    trees = {p: plain_tree([x[2] for x in sorted(leaves[p])], fanout) for p in names}
    root, above = plain_tree([trees[p][0] for p in names], fanout)
    want = Counter()
    for p, up in zip(names, above):
        for (known, i, leaf), path in zip(sorted(leaves[p]), trees[p][1]):
            want[i if known else None, p, leaf, trees[p][0], root, tuple(path + up)] += 1
    assert Counter((r.id, r.part, r.leaf, r.subroot, r.root, tuple(map(tuple, r.path))) for r in got) == want
    for r in got:
        x = r.leaf
        for before, after in r.path:
            x = digest(before + x + after)
        assert x == root


def test_manifest_equals_sql(spark, sf_dir):
    assert compare(spark, reference(sf_dir), queries.op13_merkle, queries.OP13_SQL, sf_dir) is None


def test_tampering_shows(spark):
    docs = odd_documents(spark, [(10 + i, "a\nb") for i in range(20)])
    rows = merkle.verified(docs).collect()
    assert len(rows) == docs.count() and len({r.root for r in rows}) == 1
    text = {r.doc_id: r.text for r in docs.where("doc_id != 7").collect()}
    for r in rows:
        if r.doc_id != 7:
            even = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0
            assert r.verified == (not (even and "\n" in (text[r.doc_id] or "")))
    assert merkle.verified(no_documents(spark)).count() == 0
    one = merkle.verified(odd_documents(spark).where("doc_id = 4")).first()
    assert one.leaf == one.subroot == one.root == one.folded_root and one.proof_sha256 == digest("") and one.verified
