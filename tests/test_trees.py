"""Boosted trees and forests beside plain numpy versions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millwright.operators import boosting, forest

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 3)).round(2)
    y = ((x[:, 0] > 0.3) & (x[:, 1] < 0.5) | (rng.random(700) < 0.1)).astype(int)
    data = [(i, *map(float, r), int(v), i % 3) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(data, "id long, a double, b double, c double, y int, fold int").repartition(5).cache()


def plain_boosting(bins, y, lane):
    """Exact greedy second-order boosting, node by node."""
    margin = np.full(len(y), np.log(lane.base / (1 - lane.base)))
    weight = np.where(y == 1, lane.positive_weight, 1.0)
    for _ in range(lane.trees):
        p = 1 / (1 + np.exp(-margin))
        g, h, step = weight * (p - y), weight * p * (1 - p), np.zeros(len(y))

        def grow(rows, depth):
            total, mass, best = g[rows].sum(), h[rows].sum(), None
            for f in range(bins.shape[1]):
                for b in range(bins[:, f].max() + 1):
                    left = rows[bins[rows, f] <= b]
                    gl, hl = g[left].sum(), h[left].sum()
                    gr, hr = total - gl, mass - hl
                    if min(hl, hr) < lane.min_child_weight:
                        continue
                    gain = gl**2 / (hl + lane.l2) + gr**2 / (hr + lane.l2) - total**2 / (mass + lane.l2)
                    if gain > boosting.LEAST_GAIN and (best is None or gain > best[0] + 1e-9):
                        best = gain, f, b
            if best is None or depth == lane.depth:
                step[rows] = -total / (mass + lane.l2) * lane.rate
                return
            right = bins[rows, best[1]] > best[2]
            grow(rows[~right], depth + 1)
            grow(rows[right], depth + 1)

        grow(np.arange(len(y)), 0)
        margin += step
    return margin


def test_boosting_equals_plain_version(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "RENEW", 2)  # margins are stored and taken up again
    monkeypatch.setattr(boosting, "CELL_BYTES", 24 * 2 * 3 * 16)  # lanes take several passes
    lanes = [
        boosting.Lane(depth=3, trees=3, rate=0.3),
        boosting.Lane(depth=2, trees=5, rate=0.1, positive_weight=3.0, without_fold=1),
        boosting.Lane(depth=1, trees=1, rate=1.0, l2=0.0, min_child_weight=20.0, base=0.2),
    ]
    edges = boosting.quantile_edges(rows, FEATURES, 16)
    models = boosting.fit(rows, FEATURES, "y", lanes, "fold", edges)
    held = rows.orderBy("id").collect()
    x = np.array([[r[f] for f in FEATURES] for r in held])
    bins, y, fold = boosting.binned(x, edges), np.array([r["y"] for r in held]), np.array([r["fold"] for r in held])
    for lane, model in zip(lanes, models):
        seen = fold != lane.without_fold if lane.without_fold is not None else np.ones(len(y), dtype=bool)
        assert np.allclose(model.margin(bins[seen]), plain_boosting(bins[seen].astype(int), y[seen], lane), atol=1e-9)
        assert len(model.trees) == lane.trees
    again = boosting.Boosted.of_text(models[0].text())
    p = rows.select("id", again.probability(rows).alias("p")).orderBy("id").collect()
    assert np.allclose([r["p"] for r in p], 1 / (1 + np.exp(-models[0].margin(bins))))


def test_boosting_learns_and_takes_odd_rows(spark, rows):
    odd = rows.unionByName(spark.createDataFrame([(1000, None, float("nan"), 1.0, 1, None), (1001, 1.0, 1.0, 1.0, None, 1)], rows.schema))
    model = boosting.fit(odd, FEATURES, "y", [boosting.Lane(depth=3, trees=10)])[0]
    right = odd.where("y is not null").select(((model.probability(odd) >= 0.5).cast("int") == F.col("y")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right > 0.88
    nothing = boosting.fit(rows.limit(0), FEATURES, "y", [boosting.Lane(trees=1)])[0]
    assert np.allclose(nothing.margin(np.zeros((2, 3), dtype=np.uint8)), 0)


def test_splits_come_from_one_aggregation(spark, rows):
    lanes = [boosting.Lane(depth=1, trees=1)]
    edges = boosting.quantile_edges(rows, FEATURES, 8)
    state = boosting._state(rows, FEATURES, "y", None, edges, lanes)
    cells = boosting._cells(state, lanes, {0: boosting.Tree.empty(1)}, [[]], 0, 8)
    assert cells.agg(F.sum("n")).first()[0] == 3 * rows.count()
    rules = spark.createDataFrame([(0, 1.0, 1.0)], "lane int, l2 double, least_h double")
    assert boosting.best_splits(cells, rules).count() == 1


def plain_forest(bins, y, w, tree, least, depth, look, seed=42):
    """One tree, node by node, by the rules as they are stated."""
    out = {}

    def impurity(rows):
        a, b = w[rows][y[rows] == 0].sum(), w[rows][y[rows] == 1].sum()
        return (a + b) - (a * a + b * b) / (a + b) if a + b else 0.0

    def split(name, rows):
        best = None
        if len(rows) >= least and len(set(y[rows])) == 2 and (depth is None or len(name) < depth):
            order = sorted(range(bins.shape[1]), key=lambda f: (forest.draw(seed, tree, name, f), f))
            for rank, f in enumerate(order):
                if rank >= look and best is not None:
                    break
                for b in sorted(set(bins[rows, f]))[:-1]:
                    left = bins[rows, f] <= b
                    fall = impurity(rows) - impurity(rows[left]) - impurity(rows[~left])
                    if best is None or fall > best[0] + 1e-9:
                        best = fall, f, b
        out[name] = (len(rows), -1 if best is None else best[1], 0 if best is None else best[2])
        if best is not None:
            left = bins[rows, best[1]] <= best[2]
            split(name + "0", rows[left])
            split(name + "1", rows[~left])

    split("", np.arange(len(y)))
    return out


@pytest.mark.parametrize("small", [0, 40, 10_000])
def test_trees_equal_plain_version(rows, small):
    """Grown by aggregations alone, by both ways, and inside one task alone."""
    lanes = [
        forest.Lane(trees=1, min_samples_split=2 if small else 90, depth=None if small else 5, bootstrap=False),
        forest.Lane(trees=2, min_samples_split=60, depth=4, bootstrap=False, without_fold=1),
        forest.Lane(trees=1, min_samples_split=50, depth=3, bootstrap=False, balanced=True),
    ]
    edges = boosting.quantile_edges(rows, FEATURES, 12)
    models = forest.fit(rows, FEATURES, "y", lanes, ["id"], "fold", edges, small=small)
    held = rows.orderBy("id").collect()
    bins = boosting.binned(np.array([[r[f] for f in FEATURES] for r in held]), edges).astype(int)
    y, fold, tree = np.array([r["y"] for r in held]), np.array([r["fold"] for r in held]), 0
    for lane, model in zip(lanes, models):
        seen = fold != lane.without_fold if lane.without_fold is not None else np.ones(len(y), dtype=bool)
        w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum())) if lane.balanced else np.ones(len(y))
        for _ in range(lane.trees):
            got = {r["node"]: (r["rows"], r["feature"], r["bin"]) for r in model.nodes.where(F.col("tree") == tree).collect()}
            assert got == plain_forest(bins[seen], y[seen], w[seen], tree, lane.min_samples_split, lane.depth, 1)
            tree += 1


def test_no_node_breaks_the_rule(rows):
    lanes = [forest.Lane(trees=4, min_samples_split=20), forest.Lane(trees=4, min_samples_split=2)]
    for lane, model in zip(lanes, forest.fit(rows, FEATURES, "y", lanes, ["id"], small=60)):
        nodes = model.nodes.collect()
        assert len({r["tree"] for r in nodes}) == 4
        for r in nodes:
            if r["feature"] >= 0:
                assert r["rows"] >= lane.min_samples_split
        # a leaf is pure, too small, or of rows that no feature tells apart
        assert max(len(r["node"]) for r in nodes) > 6
        left = [r for r in nodes if r["feature"] < 0 and r["rows"] >= lane.min_samples_split and r["w0"] > 0 and r["w1"] > 0]
        assert sum(r["rows"] for r in left) < 0.02 * sum(r["rows"] for r in nodes if r["feature"] < 0)
        scored = model.transform(rows)
        assert scored.where(F.col("prediction") == F.col("y")).count() > 0.9 * rows.count()
        shares = model.importances()
        assert sum(shares) == pytest.approx(1.0) and shares[2] < min(shares[:2])


def test_draws_with_replacement(rows):
    model = forest.fit(rows, FEATURES, "y", [forest.Lane(trees=30, depth=0)], ["id"])[0]
    roots = model.nodes.agg(F.avg("rows").alias("rows"), F.avg(F.col("w0") + F.col("w1")).alias("weight")).first()
    assert roots["rows"] / rows.count() == pytest.approx(1 - np.exp(-1), abs=0.02)
    assert roots["weight"] / rows.count() == pytest.approx(1, abs=0.03)


def test_forest_of_no_rows(rows):
    model = forest.fit(rows.limit(0), FEATURES, "y", [forest.Lane(trees=2)], ["id"])[0]
    assert model.nodes.isEmpty()


@pytest.mark.parametrize("group, cell_bytes", [(64, 64 << 20), (2, 1)])
def test_forest_writes_no_row_per_tree(rows, monkeypatch, group, cell_bytes):
    """Rows are written once per group of trees, not per tree, and a leaf's rows aren't dealt out; groups and passes don't matter."""
    sizes, plain = [], forest.written
    lanes = [forest.Lane(trees=3, depth=2), forest.Lane(trees=1, depth=2, balanced=True, without_fold=1)]
    edges = boosting.quantile_edges(rows, FEATURES, 12)
    expected = [sorted(map(tuple, m.nodes.collect())) for m in forest.fit(rows, FEATURES, "y", lanes, ["id"], "fold", edges, small=50)]

    def counted(df, label):
        out = plain(df, label)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(forest, "written", counted)
    monkeypatch.setattr(forest, "GROUP", group)
    monkeypatch.setattr(forest, "CELL_BYTES", cell_bytes)
    models = forest.fit(rows, FEATURES, "y", lanes, ["id"], "fold", edges, small=50)
    assert max(sizes) <= rows.count()
    for want, model in zip(expected, models):
        got = sorted(map(tuple, model.nodes.collect()))
        assert [r[:5] for r in got] == [r[:5] for r in want]
        assert np.allclose([r[5:] for r in got], [r[5:] for r in want])


@pytest.mark.parametrize("kind", [np.uint8, np.float64])
def test_rows_are_packed_to_bytes_and_back(kind):
    values = np.arange(60).reshape(12, 5).astype(kind)
    held = boosting.packed(values.T.copy().T)  # columns first in memory
    assert held.equals(pa.array([x.tobytes() for x in values], pa.binary()))
    assert boosting.unpacked(held.slice(3, 4)).tobytes() == values[3:7].tobytes()
    assert not len(boosting.packed(values[:0])) and not len(boosting.unpacked(held[:0]))
