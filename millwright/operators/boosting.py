"""Second-order boosted trees on binned rows: per tree level one aggregation of gradient and hessian sums.

Rows are binned once, a byte per feature. A pass over them adds up (gradient, hessian, rows) by (lane, node, feature, bin) in
every task; Spark sums the tasks' cells, and the best split of a node is found among its cells. All lanes, that is
settings and folds, share the bins and each pass. A row's margin is stored and renewed every few trees.

What reaches the driver is a row per open node, at most 2 ** depth per lane. A task's cells are bounded by ``CELL_BYTES``: lanes
that don't fit together take another pass. Leaf weights are -G / (H + l2), shrunk by the learning rate; a split must gain
in G * G / (H + l2) and leave ``min_child_weight`` of hessian on both sides. Null and NaN features go to the last bin.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

BINS, CELL_BYTES, RENEW = 64, 256 << 20, 8
LEAST_GAIN = 1e-6
_CELL = "lane int, node int, feature int, bin int, g double, h double, n bigint"


@dataclass
class Lane:
    """One model in the making: its settings, and the fold that it doesn't see."""

    depth: int = 6
    trees: int = 100
    rate: float = 0.3
    positive_weight: float = 1.0
    l2: float = 1.0
    min_child_weight: float = 1.0
    base: float = 0.5
    without_fold: int | None = None


@dataclass
class Tree:
    """Nodes of a heap: the children of k are 2k + 1 (bin at most ``bin``) and 2k + 2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        size = 2 ** (depth + 1) - 1
        return cls(np.full(size, -1, dtype=np.int32), np.zeros(size, dtype=np.int32), np.zeros(size), np.zeros(size))

    def node(self, bins: np.ndarray) -> np.ndarray:
        """The leaf, or the open node, of every row."""
        at = np.zeros(len(bins), dtype=np.int64)
        rows = np.arange(len(bins))
        for _ in range(int(np.log2(len(self.feature) + 1)) - 1):
            f = self.feature[at]
            down = 2 * at + 1 + (bins[rows, np.maximum(f, 0)] > self.bin[at])
            at = np.where(f < 0, at, down)
        return at


def binned(values: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """Number of edges at or below each value; NaN counts as above all."""
    return np.stack([np.searchsorted(e, values[:, k], side="right") for k, e in enumerate(edges)], axis=1).astype(np.uint8)


def packed(values: np.ndarray) -> pa.Array:
    """A binary value for each row of a two-dimensional array."""
    held = np.ascontiguousarray(values)
    width = held.shape[1] * held.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(held), [None, pa.py_buffer(held)]).cast(pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    """The bytes of a column of binary values without nulls, end to end."""
    held = column.cast(pa.large_binary())
    ends = np.frombuffer(held.buffers()[1], dtype=np.int64)[held.offset : held.offset + len(held) + 1]
    return np.frombuffer(held.buffers()[2] or b"", dtype=np.uint8)[ends[0] : ends[-1]]


@dataclass
class Boosted:
    """A trained model: edges of the features' bins, and trees whose values add up to the margin."""

    features: list[str]
    edges: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def margin(self, bins: np.ndarray) -> np.ndarray:
        out = np.full(len(bins), np.log(self.base / (1 - self.base)))
        for t in self.trees:
            out += t.value[t.node(bins)]
        return out

    def probability(self, frame: DataFrame) -> Column:
        """Probability of a failure by the row's features."""
        model = frame.sparkSession.sparkContext.broadcast(self)  # bounded by trees and depth

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            values = np.stack([c.to_numpy(dtype=np.float64) for c in columns], axis=1)
            return pd.Series(1 / (1 + np.exp(-model.value.margin(binned(values, model.value.edges)))))

        return score(*[F.col(f).cast("double") for f in self.features])

    def transform(self, frame: DataFrame) -> DataFrame:
        """``frame`` with failure_p and prediction (1 from a probability of 0.5)."""
        scored = frame.withColumn("failure_p", self.probability(frame))
        return scored.withColumn("prediction", (F.col("failure_p") >= 0.5).cast("double"))

    def importances(self) -> list[float]:
        """Mean gain of the splits on each feature, as shares of one."""
        means = []
        for f in range(len(self.features)):
            gains = [g for t in self.trees for g in t.gain[t.feature == f].tolist()]
            means.append(sum(gains) / len(gains) if gains else 0.0)
        return [m / (sum(means) or 1.0) for m in means]

    def text(self) -> str:
        trees = [[t.feature.tolist(), t.bin.tolist(), t.value.tolist(), t.gain.tolist()] for t in self.trees]
        return json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges], "base": self.base, "trees": trees})

    @classmethod
    def of_text(cls, text: str) -> Boosted:
        d = json.loads(text)
        trees = [Tree(np.array(f, dtype=np.int32), np.array(b, dtype=np.int32), np.array(v), np.array(g)) for f, b, v, g in d["trees"]]
        return cls(d["features"], [np.array(e) for e in d["edges"]], d["base"], trees)


def quantile_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Edges between bins of about equal size; a number per bin and feature."""
    found = rows.approxQuantile(list(features), [k / bins for k in range(1, bins)], 0.1 / bins)
    return [np.unique(np.array(e)) for e in found]


def width_edges(rows: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Edges between bins of equal width."""
    ends = rows.agg(*[f(c).alias(f"{n}_{c}") for c in features for n, f in (("lo", F.min), ("hi", F.max))]).first()
    low_high = [(ends[f"lo_{c}"] or 0.0, ends[f"hi_{c}"] or 0.0) for c in features]
    return [np.unique([lo + (hi - lo) * k / bins for k in range(1, bins)]) for lo, hi in low_high]


def _state(rows: DataFrame, features: Sequence[str], label: str, fold: str | None, edges: list[np.ndarray], lanes: list[Lane]) -> DataFrame:
    """(y, fold, bins, margins) per row: a byte per feature, a double per lane."""
    base = np.array([np.log(x.base / (1 - x.base)) for x in lanes])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(2, b.num_columns)], axis=1)
            held = packed(binned(values, edges)), packed(np.tile(base, (len(values), 1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *held], names=["y", "fold", "bins", "margins"])

    held = F.coalesce(F.col(fold), F.lit(-1)).cast("int") if fold else F.lit(-1)
    plain = rows.select(F.col(label).cast("int").alias("y"), held.alias("fold"), *[F.col(f).cast("double") for f in features]).where("y is not null")
    return written(plain.mapInArrow(run, "y int, fold int, bins binary, margins binary"), "boosting-rows")


def _arrays(b: pa.RecordBatch, recent: list[list[Tree]], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """y, fold, bins and the margins with the trees since they were stored."""
    n = b.num_rows
    bins = unpacked(b.column("bins")).reshape(n, -1)
    margins = np.frombuffer(unpacked(b.column("margins")).tobytes(), dtype=np.float64).reshape(n, lanes).copy()
    for k, trees in enumerate(recent):
        for t in trees:
            margins[:, k] += t.value[t.node(bins)]
    return b.column("y").to_numpy(), b.column("fold").to_numpy(), bins, margins


def _cells(state: DataFrame, lanes: list[Lane], growing: dict[int, Tree], recent: list[list[Tree]], level: int, bins: int) -> DataFrame:
    """Sums by (lane, node, feature, bin) of the open nodes on a level."""
    first, nodes = 2**level - 1, 2**level

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            if not b.num_rows:
                continue
            y, fold, codes, margins = _arrays(b, recent, len(lanes))
            for k, tree in growing.items():
                lane, at = lanes[k], tree.node(codes) - first
                seen = (at >= 0) & (fold != lane.without_fold if lane.without_fold is not None else True)
                p = 1 / (1 + np.exp(-margins[seen, k]))
                weight = np.where(y[seen] == 1, lane.positive_weight, 1.0)
                parts = weight * (p - y[seen]), weight * p * (1 - p), np.ones(len(p))
                total = sums.setdefault(k, np.zeros((3, codes.shape[1], nodes * bins)))
                for f in range(codes.shape[1]):
                    cell = at[seen] * bins + codes[seen, f]
                    for part, out in zip(parts, total[:, f]):
                        out += np.bincount(cell, weights=part, minlength=nodes * bins)
        for k, (g, h, n) in sums.items():
            feature, cell = np.nonzero(n)
            columns = [np.full(len(cell), k), first + cell // bins, feature, cell % bins]
            figures = [g[feature, cell], h[feature, cell], n[feature, cell].astype(np.int64)]
            yield from pa.table([*(pa.array(c, pa.int32()) for c in columns), *map(pa.array, figures)], names=[c.split()[0] for c in _CELL.split(", ")]).to_batches(10_000)

    return state.mapInArrow(run, _CELL)


def best_splits(cells: DataFrame, lanes: DataFrame) -> DataFrame:
    """(lane, node, g, h, gain, feature, bin) per open node; a null gain where no split is allowed.

    ``cells`` holds (lane, node, feature, bin, g, h, n) from any number of tasks, ``lanes`` (lane, l2, least_h). Of equal
    gains the smaller feature and bin win.
    """
    sums = cells.groupBy("lane", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
    own = Window.partitionBy("lane", "node", "feature")  # at most a row per bin
    left = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = sums.withColumns({"gl": F.sum("g").over(left), "hl": F.sum("h").over(left), "gt": F.sum("g").over(own), "ht": F.sum("h").over(own)}).join(lanes, "lane")
    score = lambda g, h: g * g / (h + F.col("l2"))
    right = F.col("ht") - F.col("hl")
    gain = score(F.col("gl"), F.col("hl")) + score(F.col("gt") - F.col("gl"), right) - score(F.col("gt"), F.col("ht"))
    allowed = (F.col("hl") >= F.col("least_h")) & (right >= F.col("least_h")) & (gain > LEAST_GAIN)
    split = F.when(allowed, F.struct(gain.alias("gain"), (-F.col("feature")).alias("f"), (-F.col("bin")).alias("b")))
    best = sums.groupBy("lane", "node").agg(F.min_by("gt", "feature").alias("g"), F.min_by("ht", "feature").alias("h"), F.max(split).alias("s"))
    return best.select("lane", "node", "g", "h", F.col("s.gain").alias("gain"), (-F.col("s.f")).alias("feature"), (-F.col("s.b")).alias("bin"))


def fit(rows: DataFrame, features: Sequence[str], label: str, lanes: Sequence[Lane], fold: str | None = None, edges: list[np.ndarray] | None = None) -> list[Boosted]:
    """A model per lane. Rows without a label are left out; a lane doesn't see the rows of its ``without_fold``."""
    spark, lanes = rows.sparkSession, list(lanes)
    edges = quantile_edges(rows, features) if edges is None else edges
    bins = max((len(e) for e in edges), default=0) + 1
    if bins > 256:
        raise ValueError("a bin must fit a byte")
    models = [Boosted(list(features), edges, x.base) for x in lanes]
    rules = spark.createDataFrame([(k, float(x.l2), float(x.min_child_weight)) for k, x in enumerate(lanes)], "lane int, l2 double, least_h double")
    state = _state(rows, features, label, fold, edges, lanes)
    recent: list[list[Tree]] = [[] for _ in lanes]
    for turn in range(max(x.trees for x in lanes)):
        growing = {k: Tree.empty(x.depth) for k, x in enumerate(lanes) if turn < x.trees}
        for level in range(max(lanes[k].depth for k in growing) + 1):
            active = [k for k in growing if level <= lanes[k].depth and (level == 0 or (growing[k].feature[2 ** (level - 1) - 1 : 2**level - 1] >= 0).any())]
            step = max(1, CELL_BYTES // (24 * 2**level * len(features) * bins))
            for group in (active[i : i + step] for i in range(0, len(active), step)):
                cells = _cells(state, lanes, {k: growing[k] for k in group}, recent, level, bins)
                for r in best_splits(cells, rules).collect():  # a row per open node
                    tree, lane = growing[r.lane], lanes[r.lane]
                    tree.value[r.node] = -r.g / (r.h + lane.l2) * lane.rate
                    if r.gain is not None and level < lane.depth:
                        tree.feature[r.node], tree.bin[r.node], tree.gain[r.node] = r.feature, r.bin, r.gain
        for k, tree in growing.items():
            models[k].trees.append(tree)
            recent[k].append(tree)
        if (turn + 1) % RENEW == 0:
            state, recent = _renewed(state, recent), [[] for _ in lanes]
    return models


def _renewed(state: DataFrame, recent: list[list[Tree]]) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                margins = packed(_arrays(b, recent, len(recent))[3])
                yield pa.RecordBatch.from_arrays([b.column("y"), b.column("fold"), b.column("bins"), margins], names=["y", "fold", "bins", "margins"])

    return written(state.mapInArrow(run, state.schema), "boosting-rows")


def judged(rows: DataFrame, label: str, fold: str, lanes: Sequence[Lane], models: Sequence[Boosted]) -> list[float]:
    """F1 of failures per lane on the rows of the fold that it didn't see, in one pass; 0 where there is nothing to count."""
    held = rows.sparkSession.sparkContext.broadcast((list(lanes), list(models)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lanes, models = held.value
        counts = np.zeros((3, len(lanes)), dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            values = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(2, b.num_columns)], axis=1)
            y, part, bins = b.column(0).to_numpy(), b.column(1).to_numpy(), binned(values, models[0].edges)
            for k, (lane, model) in enumerate(zip(lanes, models)):
                own = part == lane.without_fold
                guess = model.margin(bins[own]) >= 0
                counts[:, k] += [(guess & (y[own] == 1)).sum(), (guess & (y[own] == 0)).sum(), (~guess & (y[own] == 1)).sum()]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(lanes), dtype=np.int32)), *map(pa.array, counts)], names=["lane", "tp", "fp", "fn"])

    plain = rows.select(F.col(label).cast("int"), F.col(fold).cast("int"), *[F.col(f).cast("double") for f in models[0].features])
    sums = plain.dropna(subset=[label, fold]).mapInArrow(run, "lane int, tp bigint, fp bigint, fn bigint")
    sums = sums.groupBy("lane").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    found = {r.lane: 2 * r.tp / (2 * r.tp + r.fp + r.fn) if r.tp else 0.0 for r in sums.collect()}  # a row per lane
    return [found.get(k, 0.0) for k in range(len(lanes))]
