"""Random forests grown to the end: every node with ``min_samples_split`` rows that can be split is split, at any depth.

Rows are binned once, a byte per feature, and a group of trees of all lanes (settings and folds) grows together, level by
level. A pass over the rows follows each row down the splits found so far and adds up (rows, draws) by (node, feature, bin,
class) in every task; Spark sums the tasks' cells and finds the best splits. So no row is written or shuffled for a node of
more than ``SMALL`` rows. The rows of smaller nodes that can be split are dealt out once, at the end, and each is finished with
all its descendants inside one task, which holds ``SMALL`` rows of it at most.

What reaches the driver is a row per large node and child of one: the rows of a tree by ``SMALL`` on a level, times the trees of
a group, which is made smaller where that is much (``BROADCAST_NODES``). A task's cells are bounded by ``CELL_BYTES``: nodes that
don't fit together take another pass.

A row's weight in a tree is a Poisson draw by its hash, the large-sample form of drawing rows with replacement; a node's
rows are counted once each. A node looks at ``sqrt`` of the features, in an order drawn for it, and goes on to the first
feature that splits it when none of those does. Splits maximise the fall of Gini impurity; of equal ones the feature drawn
first and the smaller bin win. Draws follow from seed, tree and node alone, so any partitioning gives the same forest.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import stable_hash
from ..session import written
from .boosting import binned, packed, quantile_edges, unpacked

SMALL, BROADCAST_NODES = 4096, 2_000_000
GROUP, CELL_BYTES, WIDTH = 64, 64 << 20, 256  # trees grown together; cells of a task; bins a byte can tell apart
_NODE = "tree int, node string, feature int, bin int, rows bigint, w0 double, w1 double, gain double"
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 20)])).tolist()  # P(at most k) of a mean of one


@dataclass
class Lane:
    """A forest in the making; no depth means no limit."""

    trees: int = 100
    min_samples_split: int = 2
    depth: int | None = None
    balanced: bool = False
    without_fold: int | None = None
    bootstrap: bool = True


def draw(seed: int, tree: int, node: str, feature: int) -> int:
    return zlib.crc32(f"{seed}:{tree}:{node}:{feature}".encode())


def _order(seed: int, tree: int, node: str, features: int) -> list[int]:
    """The features in the order drawn for a node."""
    return sorted(range(features), key=lambda f: (draw(seed, tree, node, f), f))


def grow(tree: int, node: str, bins: np.ndarray, y: np.ndarray, w: np.ndarray, least: int, depth: int, look: int, seed: int) -> Iterator[tuple]:
    """The node and all its descendants as rows of the node table."""
    todo = [(node, np.arange(len(y)))]
    while todo:
        name, rows = todo.pop()
        own, label, weight = bins[rows], y[rows], w[rows]
        w1 = float(weight[label == 1].sum())
        w0 = float(weight[label == 0].sum())
        best = None
        if len(rows) >= least and w0 > 0 and w1 > 0 and len(name) < depth:
            for rank, f in enumerate(_order(seed, tree, name, bins.shape[1])):
                if rank >= look and best is not None:
                    break
                size = int(own[:, f].max()) + 1
                n = np.bincount(own[:, f], minlength=size).cumsum()
                l1 = np.bincount(own[:, f], weights=weight * label, minlength=size).cumsum()
                l0 = np.bincount(own[:, f], weights=weight * (1 - label), minlength=size).cumsum()
                at = np.flatnonzero((n > 0) & (n < len(rows)))
                at = at[np.diff(n[at], prepend=0) > 0]  # bins that hold rows
                if len(at):
                    a, b, c, d = l0[at], l1[at], w0 - l0[at], w1 - l1[at]
                    score = (a * a + b * b) / (a + b) + (c * c + d * d) / (c + d)
                    k = int(np.argmax(score))
                    if best is None or score[k] > best[0]:
                        best = float(score[k]), f, int(at[k])
        if best is None:
            yield tree, name, -1, 0, len(rows), w0, w1, 0.0
            continue
        yield tree, name, best[1], best[2], len(rows), w0, w1, best[0] - (w0 * w0 + w1 * w1) / (w0 + w1)
        left = own[:, best[1]] <= best[2]
        todo += [(name + "0", rows[left]), (name + "1", rows[~left])]


def _finished(rows: DataFrame, rules: DataFrame, features: int, look: int, seed: int) -> DataFrame:
    """The subtrees of small nodes, each grown inside one task."""

    def run(part: pa.Table) -> pa.Table:
        bins = np.frombuffer(b"".join(part["bins"].to_pylist()), dtype=np.uint8).reshape(-1, features).astype(np.int64)
        first = {c: part[c][0].as_py() for c in ("tree", "node", "least", "depth", "weight0", "weight1")}
        y = part["y"].to_numpy()
        w = part["times"].to_numpy() * np.where(y == 1, first["weight1"], first["weight0"])
        out = list(grow(first["tree"], first["node"], bins, y, w, first["least"], first["depth"], look, seed))
        kinds = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[c.split()[0] for c in _NODE.split(", ")])

    return rows.join(F.broadcast(rules), "tree").groupBy("tree", "node").applyInArrow(run, _NODE)  # a rule per tree


class _Level:
    """The nodes that may be split on a level, and where their rows go."""

    def __init__(self, size: int):
        self.feature, self.bin = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
        self.down = np.full(2 * size, _LEAF, dtype=np.int64)  # left and right child: node of the next level, leaf, or small


_LEAF = -1  # smaller numbers are small nodes: -2 is the first


def _followed(b: pa.RecordBatch, without: list[int | None], roots: list[int], levels: list[_Level]) -> Iterator[tuple]:
    """(tree, rows, nodes, draws, y, bins as one array) of the rows of a batch that are in a tree, below the levels given."""
    y, fold = (b.column(c).to_numpy() for c in ("y", "fold"))
    bins = unpacked(b.column("bins"))
    width = len(bins) // len(y)
    draws = unpacked(b.column("draws")).reshape(len(y), -1)
    for t, root in enumerate(roots):
        drawn = np.ascontiguousarray(draws[:, t])
        rows = np.flatnonzero(drawn > 0 if without[t] is None else (drawn > 0) & (fold != without[t]))
        at = np.full(len(rows), root, dtype=np.int64)
        below = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        for level in levels:
            open_ = at >= 0
            below = tuple(np.concatenate([x, v[at < _LEAF]]) for x, v in zip(below, (rows, at)))
            rows, at = rows[open_], at[open_]
            if not len(rows):
                break
            at = level.down[2 * at + (bins[rows * width + level.feature[at]] > level.bin[at])]
        rows, at = (np.concatenate([x, v]) for x, v in zip(below, (rows, at)))
        if len(rows):
            yield t, rows, at, drawn[rows], y[rows], bins


def _roots(base: DataFrame, without: list[int | None]) -> dict[int, np.ndarray]:
    """Per tree its rows and draws by class."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(without), 3), dtype=np.int64)
        for b in batches:
            if b.num_rows:
                for t, rows, _, times, y, _ in _followed(b, without, [0] * len(without), []):
                    sums[t] += [len(rows), times[y != 1].sum(dtype=np.int64), times[y == 1].sum(dtype=np.int64)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(without), dtype=np.int32)), *map(pa.array, sums.T.copy())], names=["tree", "n", "a", "b"])

    sums = base.mapInArrow(run, "tree int, n bigint, a bigint, b bigint").groupBy("tree").agg(*[F.sum(c).alias(c) for c in "nab"])
    return {r.tree: np.array([r.n, r.a, r.b]) for r in sums.collect()}  # a row per tree


def _cells(base: DataFrame, without: list[int | None], roots: list[int], levels: list[_Level], nodes: np.ndarray, picks: np.ndarray, even: np.ndarray) -> DataFrame:
    """Rows and draws by (node, feature, bin) of some nodes of the next level, for the features in their rows of ``picks``;
    ``even`` says whether a node's classes weigh the same."""
    ranks = picks.shape[1]
    held = base.sparkSession.sparkContext.broadcast((levels, nodes, picks, even))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, nodes, picks, even = held.value
        n, draws = (np.zeros(picks.size * WIDTH * 2, dtype=np.int64) for _ in "nw")
        places = np.full(int(nodes.max()) + 1, -1, dtype=np.int64)
        places[nodes] = np.arange(len(nodes))
        for batch in batches:
            if not batch.num_rows:
                continue
            for _, rows, at, times, y, bins in _followed(batch, without, roots, levels):
                own = np.flatnonzero((at >= 0) & (at < len(places)))
                own = own[places[at[own]] >= 0]
                place, width = places[at[own]], len(bins) // batch.num_rows
                first, label, times = rows[own] * width, (y[own] == 1).astype(np.int64), times[own].astype(np.int64)
                for r in range(ranks):
                    cell = ((place * ranks + r) * WIDTH + bins[first + picks[place, r]]) * 2 + label
                    np.add.at(n, cell, 1)
                    np.add.at(draws, cell, times)
        n, draws = n.reshape(-1, 2), draws.reshape(-1, 2)
        found = np.flatnonzero(n.any(axis=1))
        for k in range(0, len(found), 10_000):
            cell = found[k : k + 10_000]
            place, rank = np.divmod(cell // WIDTH, ranks)
            columns = [nodes[place], rank, picks[place, rank], cell % WIDTH, even[place], n[cell].sum(axis=1), *draws[cell].T.copy()]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=_CELL_NAMES)

    return base.mapInArrow(run, _CELL)


_CELL = "node bigint, rank bigint, feature bigint, bin bigint, even boolean, n bigint, a bigint, b bigint"
_CELL_NAMES = [c.split()[0] for c in _CELL.split(", ")]


def _best(cells: DataFrame, weights: tuple[float, float], first_rank: bool) -> DataFrame:
    """(node, gain, feature, bin, and the left child's n, a, b) of the nodes that a feature splits; by rank first, or by gain first.

    Counts are whole numbers up to here, so sums don't depend on their order; ``weights`` are those of the classes of a node
    that isn't ``even``.
    """
    cells = cells.groupBy("node", "rank", "feature", "bin", "even").agg(*[F.sum(c).alias(c) for c in "nab"])
    own = Window.partitionBy("node", "rank")  # at most a row per bin
    left = own.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    sums = cells.withColumns({f"{c}l": F.sum(c).over(left) for c in "nab"} | {f"{c}t": F.sum(c).over(own) for c in "nab"}).where("nl < nt")
    side = lambda a, b: (a * a + b * b) / (a + b)
    w0, w1 = (F.when(F.col("even"), 1.0).otherwise(float(w)) for w in weights)
    l0, l1, t0, t1 = F.col("al") * w0, F.col("bl") * w1, F.col("at") * w0, F.col("bt") * w1
    score = (side(l0, l1) + side(t0 - l0, t1 - l1)).alias("score")
    place = (-F.col("rank")).alias("place"), (-F.col("bin")).alias("low")
    key = F.struct(place[0], score, place[1]) if first_rank else F.struct(score, *place)
    best = sums.groupBy("node").agg(F.max_by(F.struct("feature", "bin", score, side(t0, t1).alias("whole"), "nl", "al", "bl"), key).alias("s"))
    return best.select("node", (F.col("s.score") - F.col("s.whole")).alias("gain"), "s.feature", "s.bin", "s.nl", "s.al", "s.bl")


def fit(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    lanes: Sequence[Lane],
    keys: Sequence[str],
    fold: str | None = None,
    edges: list[np.ndarray] | None = None,
    seed: int = 42,
    small: int = SMALL,
    look: int | None = None,
) -> list[Forest]:
    """A forest per lane. ``keys`` tell rows apart; rows without a label are left out."""
    spark, lanes = rows.sparkSession, list(lanes)
    edges = quantile_edges(rows, features) if edges is None else edges
    look = look or max(1, isqrt(len(features)))

    def coded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.float64) for k in range(3, b.num_columns)], axis=1)
            held = packed(binned(values, edges))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), held], names=["y", "fold", "hash", "bins"])

    part = F.coalesce(F.col(fold), F.lit(-1)).cast("int") if fold else F.lit(-1)
    plain = rows.select(F.col(label).cast("int").alias("y"), part.alias("fold"), stable_hash(*map(F.col, keys), seed=seed).alias("hash"), *[F.col(f).cast("double") for f in features])
    base = written(plain.where("y is not null").mapInArrow(coded, "y int, fold int, hash bigint, bins binary"), "forest-rows")
    sizes = base.agg(F.count("*").alias("n"), F.sum("y").alias("positive")).first()
    n, positive = sizes["n"], sizes["positive"] or 0
    balance = (n / (2.0 * max(1, n - positive)), n / (2.0 * max(1, positive)))
    plan = [(t, k, x) for t, (k, x) in enumerate((k, x) for k, x in enumerate(lanes) for _ in range(x.trees))]
    step = max(1, min(GROUP, BROADCAST_NODES // (1 + 4 * n // max(1, small)))) if n else len(plan)
    done = [f for i in range(0, len(plan) if n else 0, step) for f in _grown(base, plan[i : i + step], len(features), balance, seed, small, look)]
    table = written(reduce(DataFrame.unionByName, done), "forest") if done else spark.createDataFrame([], _NODE)
    return [Forest(list(features), edges, table.where(F.col("tree").isin([t for t, own, _ in plan if own == k])), x.trees) for k, x in enumerate(lanes)]


def _drawn(base: DataFrame, plan: Sequence[tuple[int, int, Lane]]) -> DataFrame:
    """``base`` with ``draws``: how often each tree of the plan takes a row, a byte per tree."""
    numbers = F.transform(F.sequence(F.lit(plan[0][0]), F.lit(plan[-1][0])), lambda t: F.xxhash64("hash", t))
    own = np.array([x.bootstrap for _, _, x in plan])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            share = (b.column("numbers").flatten().to_numpy() & ((1 << 52) - 1)).reshape(-1, len(own)) / float(1 << 52)
            times = np.where(own, np.searchsorted(_POISSON[:12], share, side="left"), 1).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("y", "fold", "bins")), packed(times)], names=["y", "fold", "bins", "draws"])

    return written(base.select("y", "fold", "bins", numbers.alias("numbers")).mapInArrow(run, "y int, fold int, bins binary, draws binary"), "forest-draws")


def _grown(base: DataFrame, plan: Sequence[tuple[int, int, Lane]], features: int, balance: tuple[float, float], seed: int, small: int, look: int) -> list[DataFrame]:
    """The node tables of a group of trees with consecutive numbers."""
    spark, numbers = base.sparkSession, [t for t, _, _ in plan]
    weights = [np.array(balance if x.balanced else (1.0, 1.0)) for _, _, x in plan]
    without, base = [x.without_fold for _, _, x in plan], _drawn(base, plan)
    done, levels, dealt, nodes = [], [], [], []  # dealt: (tree, name) of the small nodes to finish; nodes: (tree, name, counts) to split

    def told(t: int, name: str, counts: np.ndarray, feature: int = -1, cut: int = 0, gain: float = 0.0) -> tuple:
        return numbers[t], name, feature, cut, int(counts[0]), *(counts[1:] * weights[t]).tolist(), gain

    def place(t: int, name: str, counts: np.ndarray, leaves: list[tuple], opened: list[tuple]) -> int:
        """Where the rows of a node go; the node is a leaf, finished in a task, or split on the next level."""
        lane = plan[t][2]
        if counts[0] < lane.min_samples_split or not counts[1:].all() or (lane.depth is not None and len(name) >= lane.depth):
            leaves.append(told(t, name, counts))
            return _LEAF
        if counts[0] <= small:
            dealt.append((t, name))
            return _LEAF - len(dealt)
        opened.append((t, name, counts))
        return len(opened) - 1

    leaves: list[tuple] = []
    sizes = _roots(base, without)
    roots = [place(t, "", sizes[t], leaves, nodes) if sizes[t][0] else _LEAF for t in range(len(plan))]
    while nodes:
        level, opened = _Level(len(nodes)), []
        orders = np.array([_order(seed, numbers[t], name, features) for t, name, _ in nodes], dtype=np.int64)
        even = np.array([not plan[t][2].balanced for t, _, _ in nodes])
        found: dict[int, tuple] = {}
        for picks, first_rank in ((orders[:, :look], False), (orders[:, look:], True)):
            step = max(1, CELL_BYTES // (16 * WIDTH * 2 * max(1, picks.shape[1])))
            todo = np.array([k for k in range(len(nodes)) if k not in found], dtype=np.int64)
            for own in (todo[i : i + step] for i in range(0, len(todo) if picks.shape[1] else 0, step)):
                cells = _cells(base, without, roots, levels, own, picks[own], even[own])
                found |= {r.node: r for r in _best(cells, balance, first_rank).collect()}  # a row per large node
        for k, (t, name, counts) in enumerate(nodes):
            if k not in found:
                leaves.append(told(t, name, counts))
                continue
            r = found[k]
            leaves.append(told(t, name, counts, r.feature, r.bin, r.gain))
            level.feature[k], level.bin[k] = r.feature, r.bin
            left = np.array([r.nl, r.al, r.bl])
            for s, (c, own) in enumerate((("0", left), ("1", counts - left))):
                level.down[2 * k + s] = place(t, name + c, own, leaves, opened)
        done.append(spark.createDataFrame(leaves, _NODE))
        leaves, nodes = [], opened
        levels.append(level)
    if leaves:
        done.append(spark.createDataFrame(leaves, _NODE))
    if dealt:
        done.append(written(_finished(_dealt(base, numbers, without, roots, levels, dealt), _rules(spark, plan, balance), features, look, seed), "forest"))
    return done


def _rules(spark: SparkSession, plan: Sequence[tuple[int, int, Lane]], balance: tuple[float, float]) -> DataFrame:
    rules = [(t, x.min_samples_split, 2**30 if x.depth is None else x.depth, *(balance if x.balanced else (1.0, 1.0))) for t, _, x in plan]
    return spark.createDataFrame(rules, "tree int, least int, depth int, weight0 double, weight1 double")


def _dealt(base: DataFrame, numbers: list[int], without: list[int | None], roots: list[int], levels: list[_Level], dealt: list[tuple[int, str]]) -> DataFrame:
    """(tree, node, y, times, bins): the rows of the small nodes."""
    held = base.sparkSession.sparkContext.broadcast((levels, [name for _, name in dealt]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels, names = held.value
        names = pa.array(names, pa.string())
        for b in batches:
            if not b.num_rows:
                continue
            for t, rows, at, times, y, _ in _followed(b, without, roots, levels):
                own = np.flatnonzero(at < _LEAF)
                if len(own):
                    tree = pa.array(np.full(len(own), numbers[t], dtype=np.int32))
                    node, bins = names.take(pa.array(_LEAF - 1 - at[own])), b.column("bins").take(pa.array(rows[own]))
                    yield pa.RecordBatch.from_arrays([tree, node, pa.array(y[own]), pa.array(times[own].astype(np.int32)), bins], names=["tree", "node", "y", "times", "bins"])

    return base.mapInArrow(run, "tree int, node string, y int, times int, bins binary")


def _score(held: Broadcast) -> Callable[..., Column]:
    """The sum over a group of trees of the share of failures in a row's leaf."""

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        heaps, edges = held.value
        bins = binned(np.stack([c.to_numpy(dtype=np.float64) for c in columns], axis=1), edges)
        out, each = np.zeros(len(bins)), np.arange(len(bins))
        for root, feature, cut, down, value in heaps:
            at = np.full(len(bins), root)
            while (feature[at] >= 0).any():
                f = feature[at]
                step = down[at, (bins[each, np.maximum(f, 0)] > cut[at]).astype(int)]
                at = np.where(f < 0, at, step)
            out += value[at]
        return pd.Series(out)

    return score


@dataclass
class Forest:
    """A trained forest; its nodes are a table."""

    features: list[str]
    edges: list[np.ndarray]
    nodes: DataFrame
    trees: int

    def _groups(self) -> Iterator[list[int]]:
        """Trees that together have at most BROADCAST_NODES nodes, or one tree."""
        group, total = [], 0
        for r in self.nodes.groupBy("tree").agg(F.count("*").alias("n")).orderBy("tree").toLocalIterator():
            if group and total + r.n > BROADCAST_NODES:
                yield group
                group, total = [], 0
            group.append(r.tree)
            total += r.n
        if group:
            yield group

    def probability(self, frame: DataFrame) -> Column:
        """Mean over the trees of the share of failures in a row's leaf. Trees are broadcast in groups of bounded size."""
        total = F.lit(0.0)
        for group in self._groups():
            heaps = []
            found = self.nodes.where(F.col("tree").isin(group)).toPandas()
            for _, own in found.groupby("tree"):
                place = {name: i for i, name in enumerate(own["node"])}
                down = np.array([[place.get(x + "0", 0), place.get(x + "1", 0)] for x in own["node"]])
                heaps.append((place[""], own["feature"].to_numpy(), own["bin"].to_numpy(), down, (own["w1"] / (own["w0"] + own["w1"])).to_numpy()))
            held = frame.sparkSession.sparkContext.broadcast((heaps, self.edges))

            total = total + _score(held)(*[F.col(f).cast("double") for f in self.features])
        return total / F.lit(float(max(1, self.trees)))

    def settings(self) -> str:
        return json.dumps({"features": self.features, "edges": [e.tolist() for e in self.edges], "trees": self.trees})

    @classmethod
    def of(cls, settings: str, nodes: DataFrame) -> Forest:
        d = json.loads(settings)
        return cls(d["features"], [np.array(e) for e in d["edges"]], nodes, d["trees"])

    def transform(self, frame: DataFrame) -> DataFrame:
        """``frame`` with failure_p and prediction (1 above a probability of 0.5)."""
        scored = frame.withColumn("failure_p", self.probability(frame))
        return scored.withColumn("prediction", (F.col("failure_p") > 0.5).cast("double"))

    def importances(self) -> list[float]:
        """Mean over the trees of each feature's share in the fall of impurity."""
        gains = self.nodes.where("feature >= 0").groupBy("tree", "feature").agg(F.sum("gain").alias("gain"))
        whole = gains.groupBy("tree").agg(F.sum("gain").alias("whole"))
        shares = gains.join(whole, "tree").groupBy("feature").agg((F.sum(F.try_divide("gain", "whole")) / self.trees).alias("share"))
        found = {r["feature"]: r["share"] or 0.0 for r in shares.collect()}  # a row per feature
        return [found.get(f, 0.0) for f in range(len(self.features))]


def judged(rows: DataFrame, label: str, fold: str, lanes: Sequence[Lane], models: Sequence[Forest]) -> list[float]:
    """F1 of failures per lane on the rows of the fold that it didn't see, in one pass; 0 where there is nothing to count."""
    counts = []
    for k, (lane, model) in enumerate(zip(lanes, models)):
        guess, own, hit = model.probability(rows) > 0.5, F.col(fold) == lane.without_fold, F.col(label) == 1
        kinds = {"tp": guess & hit, "fp": guess & ~hit, "fn": ~guess & hit}
        counts += [F.count_if(own & of).alias(f"{c}{k}") for c, of in kinds.items()]
    r = rows.agg(*counts).first()
    return [2 * r[f"tp{k}"] / (2 * r[f"tp{k}"] + r[f"fp{k}"] + r[f"fn{k}"]) if r[f"tp{k}"] else 0.0 for k in range(len(lanes))]
