"""Exact top-k search and WARC archives."""

from __future__ import annotations

import gzip
import hashlib
import random
from pathlib import Path

import numpy as np

from millwright.llm import topk, warc


def exact(rows, k, every):
    vectors = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        v = [int(np.floor(float(x) * 1024)) for x in v]
        vectors[i] = min(vectors.get(i, v), v)
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in vectors.items() if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k_equals_brute_force_over_blocks_and_ties(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [(7, [9.0] * 6), (None, [1.0] * 6), (301, None), (302, [1.0, None]), (303, [float("nan")] * 6), (304, [float("inf")] * 6), (305, [2.0] * 3), (306, [])]
    rows += [(400, [1e12] * 6), (401, [-1e12] * 6)]
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, v string, rank int")
    got = topk.top_k(frame, k=5, every=20, n_pivots=8, query_block=4, row_block=50)
    want = [(q, r, i, max(-(2**63) + 1, min(2**63 - 1, s))) for q, r, i, s in exact(rows, 5, 20)]
    assert sorted(tuple(r) for r in got.collect() if r.query_id != 400) == [w for w in want if w[0] != 400]


def test_pivots_leave_candidates_out():
    rng = np.random.default_rng(1)
    centres = rng.integers(-3000, 3000, (40, 8))
    rows = (centres[rng.integers(0, 40, 4000)] + rng.integers(-20, 20, (4000, 8))).astype(np.int64)
    ids = np.arange(4000)
    found = topk.search_block(ids[:5], rows[:5], ids, rows, ids[5:69], rows[5:69], 10)
    for q in range(5):
        scores = rows @ rows[q]
        best = np.lexsort((ids, -scores))
        assert [i for a, i, _ in found if a == q] == [i for i in best.tolist() if i != q][:10]


def test_few_and_no_vectors(spark):
    one = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in topk.top_k(one).collect()] == [(0, 1, 1, 2 * 1024 * 1024)]
    assert topk.top_k(one.limit(0)).count() == 0


PAGES = [
    (5, "http://a/\r\nX: y", "x" * 150),
    (3, "http://b", "x" * 150),
    (3, "http://b", "x" * 150),
    (9, None, "x" * 150),
    (4, "http://c", "short"),
    (6, "http://d", "short"),
    (7, "", None),
    (8, "http://e", ""),
    (None, "http://f", "é\r\n\r\n" * 40),
    (10, "http://g", "word \0 \r\n\r\n" * 30000),
]


def pages(spark):
    return spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, shard string")


def want():
    least = {}
    for i, _, html in PAGES:
        raw = (html or "").encode()
        if len(raw) >= 100:
            least[raw] = min(x for x in (least.get(raw), i) if x is not None) if (least.get(raw) is not None or i is not None) else None
    out = []
    for i, _, html in PAGES:
        raw = (html or "").encode()
        first = least.get(raw, i)
        out.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if first == i else "revisit", None if first == i else first))
    return sorted(out, key=str)


def test_archives_come_back_whole(spark, tmp_path):
    folder = f"file://{tmp_path}/w"
    warc.write_archives(pages(spark), folder, shard_bytes=1000, roll=200)
    got = warc.read_archives(spark, folder).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want()
    by_digest = {hashlib.sha256((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h in PAGES}
    for r in got:
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == by_digest[r.payload_digest]
    assert not (tmp_path / "w" / "_temporary").exists()


def test_archives_do_not_depend_on_partitions(spark, tmp_path):
    def files(name, frame):
        warc.write_archives(frame, f"file://{tmp_path}/{name}", shard_bytes=1000, roll=200)
        return {p.name: p.read_bytes() for p in Path(tmp_path, name).glob("*.warc.gz")}

    a, b = files("a", pages(spark).coalesce(1)), files("b", pages(spark).repartition(7))
    assert a == b and len(a) > 3
    first = gzip.decompress(next(iter(a.values())))
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: ") and b"\r\nX: y" not in b"".join(map(gzip.decompress, a.values()))


def test_no_pages(spark, tmp_path):
    folder = f"file://{tmp_path}/none"
    assert warc.write_archives(pages(spark).limit(0), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0
