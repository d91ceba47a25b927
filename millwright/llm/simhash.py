"""SimHash near-duplicates: pigeonhole blocks, Hamming check, connected components.

A 64-bit fingerprint is cut into ``BLOCKS`` blocks. Two fingerprints that differ in at most
``MAX_BITS`` bits agree on at least ``BLOCKS - MAX_BITS`` whole blocks, so they meet under one of
the block combinations of that size. Only combinations held by two or more distinct fingerprints
are compared. A crowded one is dealt into parts of about ``PART`` fingerprints, and every pair of
parts is one small task group, so no group grows with the data; from each group only a spanning
forest of the verified links leaves, which keeps all components.

More blocks make longer keys (fewer chance meetings) and more keys a fingerprint; results don't
depend on ``BLOCKS``. Six blocks give 15 keys of 20 to 22 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import arrow_type, field_ddl, text_slices, utf8
from millwright.llm.components import components
from millwright.session import written

SHINGLE, SEED, MAX_BITS, BLOCKS, PART = 4, 42, 4, 6, 2048
_BITS_AT_ONCE = 1 << 16


def fingerprint(text: bytes) -> int:
    """Bits set in over half the shingle hashes; words are split at ASCII white space after lower-casing A-Z."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= SHINGLE:
        spans = [(0, len(joined))]
    else:
        ends = list(accumulate(len(w) + 1 for w in words))
        spans = zip([0, *ends], (e - 1 for e in ends[SHINGLE - 1 :]))
    hashed = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], dtype=np.uint64)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashed), _BITS_AT_ONCE):
        part = hashed[at : at + _BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashed), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint's bits as a long) per row; a null text counts as empty."""
    frame = docs.select(*keys, F.col("text").cast("string").alias("text"))
    types = [arrow_type(frame, k) for k in keys]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            fps = np.array([fingerprint(t) for t in utf8(batch.column("text"))], dtype=np.uint64).view(np.int64)
            columns = [batch.column(k).cast(t) for k, t in zip(keys, types)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fps)], names=[*keys, "fp"])

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, fp bigint")


def block_masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """One mask per choice of ``blocks - max_bits`` blocks, as signed 64-bit numbers."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    single = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(single, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def forest(group: np.ndarray, fp: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Positions (i, j) of links that connect what any links within a group connect; equal groups are adjacent."""
    n = len(fp)
    label = np.arange(n)
    parent = list(range(n))

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    near, shift = np.arange(n), 0
    while True:
        shift += 1
        near = near[near < n - shift]
        near = near[group[near] == group[near + shift]]
        if not len(near):
            return np.array(out, dtype=np.int64).reshape(-1, 2)
        apart = near[label[near] != label[near + shift]]
        linked = apart[np.bitwise_count(fp[apart] ^ fp[apart + shift]) <= max_bits]
        for i in linked.tolist():
            a, b = find(i), find(i + shift)
            if a != b:
                parent[max(a, b)] = min(a, b)
                out.append((i, i + shift))
        if len(linked):
            roots = np.array(parent)
            while not np.array_equal(step := roots[roots], roots):
                roots = step
            label, parent = roots, roots.tolist()


def _verify(max_bits: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by group; the last, perhaps unfinished group of a batch waits for the next."""
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            change = np.any(rows[1:, :-1] != rows[:-1, :-1], axis=1)
            group, fp = np.concatenate([[0], np.cumsum(change)]), rows[:, -1].copy()
            found = forest(group, fp.view(np.uint64), max_bits)
            return pa.RecordBatch.from_arrays([pa.array(fp[found[:, 0]]), pa.array(fp[found[:, 1]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1)
            rows = np.concatenate([*held, rows])
            differ = np.flatnonzero(np.any(rows[:, :-1] != rows[-1, :-1], axis=1))
            whole = differ[-1] + 1 if len(differ) else 0
            if whole:
                yield links(rows[:whole])
            held = [rows[whole:]]
        if held:
            yield links(held[0])

    return run


def fingerprint_links(nodes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS, part: int = PART) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` whose components are those of all pairs within ``max_bits`` bits."""
    masks = F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in block_masks(blocks, max_bits)))
    keys = nodes.select("fp", F.posexplode(masks).alias("choice", "block"))
    shared = keys.groupBy("choice", "block").agg(F.count("*").alias("n")).where("n > 1")
    group = ["choice", "block", "low", "high"]
    dealt = (
        keys.join(shared, ["choice", "block"])
        .withColumn("parts", F.ceil(F.col("n") / part))
        .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select("choice", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "fp")
        .repartition(*group)
        .sortWithinPartitions(*group)
    )
    return dealt.mapInArrow(_verify(max_bits), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), max_bits: int = MAX_BITS, blocks: int = BLOCKS, part: int = PART
) -> DataFrame:
    """Per row of ``docs``: ``keys``, ``fp``, ``fingerprint`` (16 hex digits), ``root`` and ``component_id``.

    root is the smallest fingerprint of the row's component, and names it. component_id is the smallest value of the first key among all rows whose fingerprints can be reached
    over links of at most ``max_bits`` differing bits. Every row is kept: repeated rows appear as often as
    they come, a null text counts as empty (fingerprint zero, linked like any other), a null id keeps its
    row and is never the smallest, unless all are null. Other columns of ``docs`` play no part.
    """
    rows = written(fingerprints(docs, keys), "fingerprints")
    nodes = written(rows.groupBy("fp").agg(F.min(keys[0]).alias("least")), "nodes")
    roots = components(fingerprint_links(nodes, max_bits, blocks, part)).withColumnRenamed("node", "fp")
    rooted = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(rooted.join(ids, "root").select("fp", "root", "component_id"), "components")
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return rows.join(named, "fp").select(*keys, "fp", digits, "root", "component_id")


def one_of_each(docs: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys`` of the one row that stays of each group: the smallest doc_id, then the smallest further keys.

    Groups are told apart by root: components of repeated or null ids may share their smallest id.
    """
    found = near_duplicates(docs, keys)
    return found.groupBy("root").agg(F.min(F.struct(*keys)).alias("kept")).select("kept.*")
