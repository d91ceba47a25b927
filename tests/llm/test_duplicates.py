"""SimHash, suffix arrays and decontamination."""

from __future__ import annotations

import hashlib
import random
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash

from llm.cases import no_documents, odd_documents
from millwright.llm import decontaminate, induced, queries, simhash, suffix
from millwright.llm.common import table
from millwright.llm.components import components


def brute_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(ids, fps):
    parent = list(range(len(ids)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= 4:
            parent[find(j)] = find(i)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [least.get(find(i)) for i in range(len(ids))]


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    for docs in (odd_documents(spark, [(40, "ONE"), (41, "a b c d e"), (42, "a b c d f")]), table(spark, sf_dir, "documents")):
        rows = docs.select("doc_id", "text").collect()
        fps = [brute_fingerprint(r.text) for r in rows]
        want = sorted(zip([str(r.doc_id) for r in rows], ["%016x" % f for f in fps], smallest_reachable([r.doc_id for r in rows], fps)), key=str)
        got = simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id").collect()
        assert sorted(((str(a), b, c) for a, b, c in got), key=str) == want
    assert simhash.near_duplicates(no_documents(spark)).count() == 0


@pytest.mark.parametrize("part", [2048, 4])
def test_crowded_blocks_keep_all_links(spark, part):
    rng = random.Random(5)
    centres = [rng.getrandbits(64) for _ in range(6)]
    fps = {c ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))) for c in centres for _ in range(40)}
    fps |= {rng.getrandbits(64) for _ in range(60)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    links = simhash.fingerprint_links(nodes, part=part).collect()
    assert all(((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 for a, b in links)
    roots = dict(components(simhash.fingerprint_links(nodes, part=part)).collect())
    got = [roots.get(f, f) for f in signed]
    want = smallest_reachable(signed, [f & ((1 << 64) - 1) for f in signed])
    assert got == want


def test_components_of_chains_stars_and_nulls(spark):
    pairs = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (None, 3), (3, 2), (200, 201), (201, 200)]
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 140)} | {200: 200, 201: 200}


def brute_repeats(rows):
    first = {}
    ranked = [((1 << 63) - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    for d, t in ranked:
        for i in range(len(t) - 49):
            first[t[i : i + 50]] = min(first.get(t[i : i + 50], d), d)
    out = []
    for (given, _), (d, t) in zip(rows, ranked):
        gone = bytearray(len(t))
        for i in range(len(t) - 49):
            if first[t[i : i + 50]] < d:
                gone[i : i + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((given, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def repeat_cases():
    rng = random.Random(3)
    words = ["".join(rng.choice("abc ") for _ in range(70)) for _ in range(30)]
    rows = [
        (rng.choice([None, *range(150)]), "".join(rng.choice(words)[: rng.randint(20, 70)] for _ in range(rng.randint(0, 12))))
        for _ in range(200)
    ]
    return rows + [(1, None), (2, ""), (3, "x" * 300), (4, "x" * 400), (0, "y" * 200), (5, "\0" * 120), (6, "a" + "\0" * 90), (7, "é" * 60), (8, "z" + "é" * 60)]


@pytest.mark.parametrize("shard, sort, chunk", [(4 << 20, 2 << 20, 8 << 20), (2000, 3000, 64)])
def test_repeats_equal_brute_force(spark, monkeypatch, shard, sort, chunk):
    # patched values travel with the functions only where these are sent by value, so the shard logic is run here
    monkeypatch.setattr(suffix, "SORTED_BYTES", sort)
    monkeypatch.setattr(suffix, "_CHUNK", chunk)
    rows = repeat_cases()
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, start string, row long")
    got = sorted((tuple(r)[:5] for r in suffix.without_repeats(docs, shard).collect()), key=str)
    assert got == brute_repeats(rows)


def test_repeats_in_the_test_table(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = sorted(map(tuple, queries.op7_suffix(spark, sf_dir).collect()), key=str)
    assert got == brute_repeats(rows)
    assert suffix.without_repeats(no_documents(spark)).count() == 0


def test_induced_sorting_equals_plain_sorting():
    rng = np.random.default_rng(0)
    for _ in range(400):
        text = rng.integers(0, rng.integers(1, 5), rng.integers(0, 40)).astype(np.uint16)
        if rng.random() < 0.3:
            text = np.tile(text, 3)
        plain = text.tolist()
        array = induced.suffix_array(text, 6)
        assert array.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
        if len(plain) > 1:
            agree = induced.capped_prefixes(text, array, 7)
            for x, y in zip(array[1:].tolist(), array.tolist()):
                n = next((k for k in range(7) if plain[x + k : x + k + 1] != plain[y + k : y + k + 1] or x + k >= len(plain)), 7)
                assert agree[x] == n


def brute_contamination(docs, items):
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
    windows = []
    for item, text in items:
        w = words(text)
        if w:
            n = min(10, len(w))
            windows += [("" if item is None else str(item), tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for item, window in set(windows):
            for i in range(len(w) - len(window) + 1):
                if tuple(w[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found.add(item)
        out.append((doc, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def test_contamination_equals_brute_force(spark):
    rng = random.Random(6)
    word = lambda: rng.choice(["The", "the", "cat", "é", "x1", "dog-house", "of", "in"])
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([0, 1, 2, 3, 5, 9, 10, 11, 14, 25, 40])]
    items += [(3, "more of item three here than before one two three"), (None, "an item without id"), (12, None), (10, items[10][1])]
    texts = []
    for i in range(60):
        chosen = rng.choice(items)[1] or ""
        texts.append((100 + i, " ".join([*(word() for _ in range(rng.randint(0, 20))), chosen, *(word() for _ in range(rng.randint(0, 20)))])))
    docs = odd_documents(spark, texts)
    bench = spark.createDataFrame([(*r, "x", 1) for r in items], "item_id long, text string, window string, fp long")
    got = decontaminate.contamination(docs, bench).select("doc_id", "n_words", "n_hit", "items").collect()
    want = brute_contamination([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    assert sorted(map(tuple, got), key=str) == want


def test_empty_documents_and_benchmark(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = odd_documents(spark)
    assert {r.n_hit for r in decontaminate.contamination(docs, none).collect()} == {0}
    assert decontaminate.contamination(no_documents(spark), none).count() == 0


def test_every_shared_window_has_its_fingerprint():
    rng = random.Random(1)
    text = [str(rng.randint(0, 5)) for _ in range(300)]
    a = decontaminate.Words([" ".join(text).encode()])
    b = decontaminate.Words([" ".join(["z"] * 7 + text[50:75]).encode()])
    first, fp = a.windows(10)
    other, found = b.windows(10)
    assert set(fp[50:66].tolist()) <= set(found.tolist()) and len(first) == 291 and len(other) == 23


def test_prefixes_and_anchors_come_in_blocks(monkeypatch):
    """Common prefixes and anchors are worked out a block at a time, with the results of plain versions."""
    monkeypatch.setattr(induced, "BLOCK", 37)
    rng = np.random.default_rng(3)
    for n, alphabet in ((1, 2), (90, 1), (400, 3), (400, 257)):
        text = np.tile(rng.integers(0, alphabet, -(-n // 2)), 2)[:n].astype(np.uint16)
        array = induced.suffix_array(text, alphabet)
        for cap in (1, 7, 50):
            want = np.zeros(n, dtype=np.int32)
            for a, b in zip(array[:-1].tolist(), array[1:].tolist()):
                while want[b] < cap and max(a, b) + want[b] < n and text[a + want[b]] == text[b + want[b]]:
                    want[b] += 1
            assert induced.capped_prefixes(text, array, cap).tolist() == want.tolist()
    data = rng.integers(97, 100, 1000).astype(np.uint8)
    whole = suffix._anchors(data)
    monkeypatch.setattr(suffix, "_BLOCK", 64)
    for one, other in zip(whole, suffix._anchors(data)):
        assert one.tolist() == other.tolist()
    assert len(whole[0]) == 1000 - suffix.LENGTH + 1 and len(whole[1]) == 1000 - suffix.GRAM + 1


def segments_of(rows):
    """The segments of one slice of (doc_id, text), all of one shard."""
    doc, row = np.array([d for d, _ in rows]), np.arange(len(rows))
    (piece,) = suffix._pieces([t for _, t in rows])
    return suffix._Segments(doc, row, piece, 1)


def test_equal_segments_of_a_slice_take_part_once():
    """Of equal segments of one slice only those of the smallest id go on, wherever they stand in it."""
    rng = random.Random(8)
    passage = rng.randbytes(300)
    rows = [(rng.randint(0, 20), rng.randbytes(2000) + passage + rng.randbytes(rng.randint(0, 90))) for _ in range(40)]
    found = segments_of(rows)
    raw, least = found.data.tobytes(), {}
    each = [(raw[a : a + n], d, a) for a, n, d in zip(found.first.tolist(), found.size.tolist(), found.doc.tolist())]
    for text, d, _ in each:
        least[text] = min(d, least.get(text, d))
    found.drop_repeats()
    assert found.first.tolist() == [a for text, d, a in each if d == least[text]]
    assert len(found.first) < len(each) - 100


def test_only_segments_that_agree_beside_their_anchor_are_sorted(monkeypatch):
    """A common phrase too short to be a repeat is not sorted with its surroundings; repeats beside it are found."""
    rng = random.Random(9)
    phrase, passage, sizes = rng.randbytes(30), rng.randbytes(75), []
    plain = suffix.suffix_array
    monkeypatch.setattr(suffix, "suffix_array", lambda symbols, alphabet: sizes.append(len(symbols)) or plain(symbols, alphabet))
    rows = [(d, rng.randbytes(60) + phrase + rng.randbytes(60)) for d in range(60)]
    assert not list(suffix.shard_repeats([p for _, p in segments_of(rows).packed(True)])) and not sizes
    rows += [(d, rng.randbytes(60) + passage[k : k + 60] + rng.randbytes(60)) for d, k in ((100, 0), (101, 7), (102, 15))]
    (spans,) = [suffix._merged(*map(np.concatenate, zip(*suffix.shard_repeats([p for _, p in segments_of(rows).packed(True)]))))]
    assert list(zip(*(v.tolist() for v in spans))) == [(61, 60, 113), (62, 60, 112)]
    assert 0 < sum(sizes) < 3000
