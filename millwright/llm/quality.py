"""Quality classifier: supervised subword embeddings.

A text is a bag of words (strings between white space) and of byte n-grams that lie within a word, its borders
included, and of a mark for each word that repeats the one before. Every feature hashes to one of ``BUCKETS`` learned vectors; a text is the mean of its features' vectors,
and a softmax layer on it gives the classes. Vectors and layer are trained by stochastic gradient descent in numpy
on a bounded sample of labelled rows (``FIT_ROWS``). With the softmax linear in the mean, a trained model is one
number per bucket, and scoring is a lookup and a sum over the whole text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millwright.llm.common import arrow_type, field_ddl, text_slices, utf8
from millwright.llm.labelled import labelled_sample, remainder

FIT_ROWS, BUCKETS, WIDTH, EPOCHS, RATE = 4000, 1 << 17, 16, 12, 0.4
GRAMS = (3, 5)
MOD, HELD, THRESHOLD = 4, 2, 0.7

_STEP, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
_AGAIN = np.uint64(1)  # stands for a repeated word
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _buckets(x: np.ndarray) -> np.ndarray:
    return ((x * _MIX) >> np.uint64(40)).astype(np.int64) % BUCKETS


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, owner): the bucket of every feature occurrence and the number of its text."""
    data = np.frombuffer(b"\n" + b"\n".join([*texts, b""]), dtype=np.uint8)
    owner_of = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])  # of the byte after each position
    space = _SPACE[data]
    wide = data.astype(np.uint64) + np.uint64(1)
    out, owners = [], []
    for n in GRAMS:
        many = max(0, len(data) - n + 1)
        inner = np.zeros(many, dtype=bool)
        for k in range(1, n - 1):
            inner |= space[k : k + many]
        at = np.flatnonzero(~inner)
        hashed = np.full(len(at), n, dtype=np.uint64)
        for k in range(n):
            hashed = hashed * _STEP + wide[at + k]
        out.append(_buckets(hashed))
        owners.append(owner_of[at])  # the inside of an n-gram has no space, so it is in one text
    edges = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    if len(start):
        sizes = end - start
        first = np.cumsum(sizes) - sizes
        power = np.cumprod(np.full(sizes.max(), _STEP, dtype=np.uint64))
        within = np.arange(sizes.sum()) - np.repeat(first, sizes)
        word, of = np.add.reduceat(wide[~space] * power[within], first), owner_of[start - 1]
        again = of[1:][(word[1:] == word[:-1]) & (of[1:] == of[:-1])]
        out += [_buckets(word), _buckets(np.full(len(again), _AGAIN))]
        owners += [of, again]
    return np.concatenate(out), np.concatenate(owners)


def bags(sample: DataFrame) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(y, buckets, shares) of each sampled text that has features; the sample is bounded, and so is what comes here."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches):
            bucket, owner = features(utf8(batch.column("text")))
            pairs, counts = np.unique(owner * BUCKETS + bucket, return_counts=True)
            cuts = np.searchsorted(pairs, np.arange(batch.num_rows + 1) * BUCKETS).astype(np.int32)
            lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int32))) for v in (pairs % BUCKETS, counts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), batch.column("y"), *lists], names=["doc_id", "y", "b", "n"])

    frame = sample.select(F.col("doc_id").cast("bigint"), "y", "text")
    got = frame.mapInArrow(run, "doc_id bigint, y int, b array<int>, n array<int>").toArrow().sort_by("doc_id")
    out = []
    for y, b, n in zip(got["y"].to_pylist(), got["b"], got["n"]):
        b, n = b.values.to_numpy(), n.values.to_numpy().astype(np.float64)
        if len(b):
            out.append((y, b, n / n.sum()))
    return out


def train(examples: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 8) -> tuple[np.ndarray, float]:
    """(weight per bucket, bias) whose logistic is the probability of class 1; without both classes 0 and the base rate."""
    classes = np.array([y for y, _, _ in examples])
    base = (classes.sum() + 1) / (len(classes) + 2)
    if len(set(classes.tolist())) < 2:
        return np.zeros(BUCKETS), float(np.log(base / (1 - base)))
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 1 / WIDTH, (BUCKETS, WIDTH))
    layer, bias = rng.normal(0, 1 / WIDTH, (WIDTH, 2)), np.log([1 - base, base])
    of_class = [np.flatnonzero(classes == c) for c in (0, 1)]
    steps = EPOCHS * len(examples)
    for step in range(steps):
        # the classes take turns, so that a rare class is seen as often
        y, bucket, share = examples[rng.choice(of_class[step % 2])]
        mean = share @ vectors[bucket]
        logits = mean @ layer + bias
        p = np.exp(logits - logits.max())
        error = p / p.sum()
        error[y] -= 1
        rate = RATE * (1 - step / steps)
        back = layer @ error
        layer -= rate * np.outer(mean, error)
        bias -= rate * error
        # a mean of many features moves each one little: shares are scaled to the largest
        vectors[bucket] -= rate * np.outer(share / share.max(), back)
    return vectors @ (layer[:, 1] - layer[:, 0]), float(bias[1] - bias[0])


def score(docs: DataFrame, weights: np.ndarray, bias: float, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keys`` and ``score`` per row, from the whole text; a text without features scores by the bias alone."""
    frame = docs.select(*keys, F.col("text").cast("string").alias("text"))
    types = [arrow_type(frame, k) for k in keys]
    sent = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float64), bias))  # BUCKETS numbers

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weight, start = sent.value
        for batch in text_slices(batches):
            bucket, owner = features(utf8(batch.column("text")))
            n = np.bincount(owner, minlength=batch.num_rows)
            logit = np.bincount(owner, weights=weight[bucket], minlength=batch.num_rows) / np.maximum(n, 1) + start
            scores = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
            yield pa.RecordBatch.from_arrays([*(batch.column(k).cast(t) for k, t in zip(keys, types)), pa.array(scores)], names=[*keys, "score"])

    return frame.mapInArrow(run, f"{field_ddl(frame, keys)}, score double")


def classify(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted per row; one model fitted on a sample of ``labels.quality``.

    Every row gives one row, repeated rows too. Null and empty texts have no features. Only text enters a score.
    """
    weights, bias = train(bags(labelled_sample(docs, labels, "quality", MOD, HELD, fit_rows)))
    held = remainder(F.col("doc_id"), MOD) == HELD
    scored = score(docs, weights, bias)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
