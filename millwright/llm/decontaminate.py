"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into words and hashed by 5-grams. Of every window of 10 words the
smallest of its six 5-gram hashes (the leftmost of ties) is the fingerprint, so any shared span of 10 words
or more shares a fingerprint. Items of fewer words are one window, whose fingerprint is the hash of all of it.

Training and test fingerprints meet in two steps. A bitmap of fixed size over all test fingerprints goes to
the tasks and drops document windows that can't match. The rest leaves as runs of neighbouring windows; equal
runs of all documents become one row, and its windows are joined to the test windows by fingerprint and
compared word by word, so that chance hits of bitmap or hash have no effect. A larger benchmark fills the bitmap
and lets more rows through to the join, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import ROW, arrow_type, field_ddl, text_slices, utf8, with_row_id
from millwright.session import written

WINDOW, GRAM = 10, 5
BITMAP_WORDS = 1 << 18  # of 64 bits: 2 MB, whatever the size of the benchmark
SLICE = 1 << 20  # bytes of text whose words are hashed at once; the arrays take some 40 bytes for each

_STEP, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
_IN_WORD = (_BYTES >= 0x80) | ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
_BYTE_HASH = np.random.default_rng(9).integers(0, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of several texts: where they lie, whose they are, and their hashes."""

    def __init__(self, texts: list[bytes]):
        self.text = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), dtype=np.uint8)]
        inside = _IN_WORD[self.text]
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        self.start, self.end = edges[::2], edges[1::2]
        self.n = len(self.start)
        firsts = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        self.owner = np.searchsorted(firsts, self.start, side="right") - 1
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first_word = np.cumsum(self.counts) - self.counts
        self.hash = self._hashes(inside)
        self.raw = self.text.tobytes()

    def _hashes(self, inside: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(0, dtype=np.uint64)
        sizes = self.end - self.start
        first = np.cumsum(sizes) - sizes
        power = np.cumprod(np.full(sizes.max(), _STEP, dtype=np.uint64))
        within = np.arange(first[-1] + sizes[-1]) - np.repeat(first, sizes)
        return _mixed(np.add.reduceat(_BYTE_HASH[self.text[inside]] * power[within], first))

    def grams(self, size: int) -> np.ndarray:
        """A hash of the ``size`` words from each word on, also where they run on into the next text."""
        out = np.zeros(max(0, self.n - size + 1), dtype=np.uint64)
        for k in range(size):
            out = out * _STEP + self.hash[k : k + len(out)]
        return _mixed(out + np.uint64(size))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and fingerprints of the windows of ``size`` words that lie in one text."""
        whole = np.arange(max(0, self.n - size + 1))
        whole = whole[self.owner[whole] == self.owner[whole + size - 1]]
        if size < WINDOW:
            return whole, self.grams(size)[whole]
        gram = self.grams(GRAM)
        least = gram[whole]
        for k in range(1, size - GRAM + 1):
            least = np.minimum(least, gram[whole + k])
        return whole, least

    def spell(self, first: int, last: int) -> str:
        raw, start, end = self.raw, self.start, self.end
        return b" ".join([raw[start[i] : end[i]] for i in range(first, last)]).decode()


def benchmark_windows(items: DataFrame) -> DataFrame:
    """Distinct (fp, size, window, item) of a table item_id, text; a null item_id counts as the empty string."""
    frame = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, limit=SLICE):
            words, names = Words(utf8(batch.column("text"))), batch.column("item").to_pylist()
            rows = []
            for size in range(1, WINDOW + 1):
                first, fp = words.windows(size)
                counts = words.counts[words.owner[first]] if len(first) else first
                for i in np.flatnonzero((counts == size) | ((size == WINDOW) & (counts > size))).tolist():
                    at = int(first[i])
                    rows.append((fp[i].astype(np.int64), size, words.spell(at, at + size), names[words.owner[at]]))
            fps, sizes, texts, owners = zip(*rows) if rows else ([], [], [], [])
            arrays = [pa.array(fps, pa.int64()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string()), pa.array(owners, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["fp", "size", "window", "item"])

    return frame.mapInArrow(run, "fp bigint, size int, window string, item string").distinct()


def _bitmap(tests: DataFrame) -> np.ndarray:
    slot = F.shiftrightunsigned("fp", 6).bitwiseAND(F.lit(BITMAP_WORDS - 1))
    bit = F.expr("shiftleft(1L, int(fp & 63))")
    bits = np.zeros(BITMAP_WORDS, dtype=np.uint64)
    for at, value in tests.groupBy(slot.alias("at")).agg(F.bit_or(bit).alias("bits")).collect():  # BITMAP_WORDS rows at most
        bits[at] = np.int64(value).astype(np.uint64)
    return bits


def _candidate_runs(docs: DataFrame, keys: tuple[str, ...], bitmap: np.ndarray, sizes: list[int]) -> DataFrame:
    """``keys``, n_words and the runs of windows whose fingerprints the bitmap has."""
    frame = docs.select(*keys, F.col("text").cast("string").alias("text"))
    types = [arrow_type(frame, k) for k in keys]
    sent = docs.sparkSession.sparkContext.broadcast(bitmap)
    struct = pa.struct([("first", pa.int32()), ("size", pa.int32()), ("words", pa.string()), ("fps", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for batch in text_slices(batches, limit=SLICE):
            words = Words(utf8(batch.column("text")))
            runs: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for size in sizes:
                first, fp = words.windows(size)
                known = (bits[(fp >> np.uint64(6)) & np.uint64(BITMAP_WORDS - 1)] >> (fp & np.uint64(63))) & np.uint64(1)
                first, fp = first[known == 1], fp[known == 1].view(np.int64)
                owner = words.owner[first]
                apart = np.ones(len(first), dtype=bool)
                if size == WINDOW:
                    apart[1:] = (np.diff(first) != 1) | (np.diff(owner) != 0)
                cuts = [*np.flatnonzero(apart).tolist(), len(first)]
                for a, b in zip(cuts, cuts[1:]):
                    doc, at = int(owner[a]), int(first[a])
                    spelt = words.spell(at, int(first[b - 1]) + size)
                    runs[doc].append({"first": at - int(words.first_word[doc]), "size": size, "words": spelt, "fps": fp[a:b].tolist()})
            kept = [batch.column(k).cast(t) for k, t in zip(keys, types)]
            arrays = [*kept, pa.array(words.counts, pa.int64()), pa.array(runs, pa.list_(struct))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, "n_words", "runs"])

    ddl = "n_words bigint, runs array<struct<first:int,size:int,words:string,fps:array<bigint>>>"
    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, {ddl}")


def _covered(spans: Column) -> Column:
    """The number of words in the union of spans, an array of struct(first, size)."""
    start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(seen: Column, span: Column) -> Column:
        end = span["first"] + span["size"]
        new = F.greatest(F.lit(0), end - F.greatest(seen["end"], span["first"]))
        return F.struct(F.greatest(seen["end"], end).cast("bigint").alias("end"), (seen["n"] + new).cast("bigint").alias("n"))

    return F.aggregate(F.array_sort(spans), start, add, lambda seen: seen["n"])


def _hits(docs: DataFrame, items: DataFrame, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """All rows with ``keys`` and n_words, and ROW, spans and items of the rows that are hit."""
    tests = written(benchmark_windows(items), "test-windows")
    sizes = sorted({WINDOW, *(r[0] for r in tests.select("size").distinct().collect())})  # WINDOW values at most
    rows = written(_candidate_runs(docs, keys, _bitmap(tests.select("fp")), sizes), "runs")
    found = rows.where(F.size("runs") > 0).select(ROW, F.explode("runs").alias("run")).select(ROW, "run.*")

    texts = found.groupBy("size", "words").agg(F.first("fps").alias("fps"))
    word = F.split("words", " ")
    window = texts.select("size", "words", word.alias("all"), F.posexplode("fps").alias("skip", "fp"))
    window = window.withColumn("window", F.array_join(F.slice("all", F.col("skip") + 1, F.col("size")), " ")).drop("all")
    matched = window.join(tests, ["fp", "size", "window"])
    per_text = matched.groupBy("size", "words").agg(
        F.collect_set("skip").alias("skips"), F.collect_set("item").alias("found_items")
    )
    hits = found.join(per_text, ["size", "words"]).withColumn(
        "spans",
        F.transform("skips", lambda s: F.struct((F.col("first") + s).cast("bigint").alias("first"), F.col("size").cast("bigint").alias("size"))),
    )
    per_row = hits.groupBy(ROW).agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("found_items")))).alias("items"),
    )
    return rows.drop("runs"), per_row


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """ROW of the rows of ``docs``, numbered in ROW, in which a benchmark window occurs."""
    return _hits(docs, items, (ROW,))[1].select(ROW)


def contamination(docs: DataFrame, items: DataFrame, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Per row of ``docs``: ``keys``, n_words, n_hit, spans (first word and size of windows hit) and items (sorted ids).

    A word is hit if an occurrence of a benchmark window covers it. Every row gives one row, repeated rows too;
    null or empty texts have no words; with an empty benchmark nothing is hit. Repeated items count once.
    """
    docs = with_row_id(docs) if ROW not in docs.columns else docs
    rows, per_row = _hits(docs, items, tuple(dict.fromkeys((*keys, ROW))))
    none = F.array().cast("array<struct<first:bigint,size:bigint>>"), F.array().cast("array<string>")
    return (
        rows.join(per_row, ROW, "left")
        .withColumns({"spans": F.coalesce("spans", none[0]), "items": F.coalesce("items", none[1])})
        .select(*keys, "n_words", _covered(F.col("spans")).alias("n_hit"), "spans", "items")
    )
