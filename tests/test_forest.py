"""The forest: its trees against plain ones, whatever the parts it is grown in."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import forest

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark):
    """900 rows: grid values, a constant, many copies of one row, noise in the label."""
    rng = np.random.default_rng(3)
    x = np.stack([rng.normal(size=900), rng.integers(0, 5, 900), np.full(900, 7.0), rng.normal(size=900)], axis=1)
    x[:200] = x[0]
    y = ((x[:, 0] + x[:, 1] / 2 > 1) ^ (rng.random(900) < 0.15)).astype(int)
    rows = [(i, *map(float, r), int(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["id", *NAMES, "label"]).repartition(5).checkpoint()


def _scores(model, rows):
    told = model.transform(rows).select("id", F.col("probability").cast("string").alias("p"), "prediction")
    return sorted(map(tuple, told.collect()))


def _plain(codes, weight, labels, seed, tree, place, levels):
    """A tree as nested tuples, by trying every split of the node's features."""
    ones, total = int(weight[labels == 1].sum()), int(weight.sum())
    leaf = round(forest.UNIT * (ones / total))
    if ones in (0, total) or levels == 0:
        return leaf
    bins = forest.bins_of(codes, len(NAMES))
    best = None
    for f in forest.some_features(seed, np.array([tree]), np.array([place]), len(NAMES))[0]:
        for cut in np.unique(bins[:, f])[:-1]:
            purity, left = 0.0, bins[:, f] <= cut
            l1, l = int(weight[left & (labels == 1)].sum()), int(weight[left].sum())
            if l1 * total == ones * l:
                continue
            purity = ((l - l1) ** 2 + l1**2) / l + ((total - l - ones + l1) ** 2 + (ones - l1) ** 2) / (total - l)
            if best is None or purity > best[0]:
                best = (purity, int(f), int(cut), left)
    if best is None:
        return leaf
    _, f, cut, left = best
    sides = [_plain(codes[s], weight[s], labels[s], seed, tree, 2 * place + i, levels - 1) for i, s in enumerate((left, ~left))]
    return (f, cut, *sides)


def _nested(nodes, at=0):
    test, child, value = nodes[at]
    return int(value) if test < 0 else (int(test // 32), int(test % 32), _nested(nodes, child), _nested(nodes, child + 1))


def test_trees_equal_plain_ones(points):
    model = forest.fit(points, NAMES, ["id"], "label", 4, 30, 42)
    coded = points.select(forest._coded(model.cuts, NAMES).alias("c"), F.xxhash64("id", F.lit(42)).alias("n"), "label").toPandas()
    codes, labels = coded["c"].to_numpy(), coded["label"].to_numpy()
    for row in model.cells.collect():
        weight = forest.weights(coded["n"].to_numpy().view(np.uint64), row.cell)
        used = weight > 0
        plain = _plain(codes[used], weight[used], labels[used], 42, row.cell, 1, 30)
        assert _nested(np.frombuffer(row.nodes, np.int64).reshape(-1, 3)) == plain


@pytest.mark.parametrize("depth", [30, 4])
def test_a_forest_does_not_depend_on_its_parts(points, monkeypatch, depth):
    whole = forest.fit(points, NAMES, ["id"], "label", 6, depth, 42)
    parts = forest.fit(points.repartition(3), NAMES, ["id"], "label", 6, depth, 42, cell_rows=60)
    assert len(parts.top.cells) > 6 * 5 and whole.top.made == 6
    told = _scores(whole, points)
    monkeypatch.setattr(forest, "ASKED_ROWS", 100)
    assert _scores(parts, points) == told


@pytest.mark.parametrize("size", [50, 500_000])  # all possible keys kept, or those that occur
def test_sums_by_key(size):
    rng = np.random.default_rng(1)
    keys, counts = rng.integers(0, size, (300, 3)), rng.integers(0, 4, (300, 2)) + [1, 0]
    found, sums = forest.summed(keys, counts, size)
    assert found.tolist() == sorted(set(keys.ravel().tolist()))
    for key, told in zip(found, sums, strict=True):
        assert told.tolist() == (counts * (keys == key).sum(axis=1)[:, None]).sum(axis=0).tolist()


def test_edges_of_a_forest(spark, points):
    one = points.limit(1).checkpoint()  # some trees draw no row
    assert {p for _, p, _ in _scores(forest.fit(one, NAMES, ["id"], "label", 8, 5, 1), points)} <= {"[1.0,0.0]", "[0.0,1.0]"}
    same = points.withColumn("label", F.lit(1)).checkpoint()  # large and pure
    assert {p for _, p, _ in _scores(forest.fit(same, NAMES, ["id"], "label", 3, 5, 1, cell_rows=100), points)} == {"[0.0,1.0]"}
    flat = points.withColumns({n: F.lit(0.0) for n in NAMES}).checkpoint()  # large, and nothing to split by
    assert len(set(p for _, p, _ in _scores(forest.fit(flat, NAMES, ["id"], "label", 3, 5, 1, cell_rows=100), flat))) == 1
    assert forest.fit(points.limit(0), NAMES, ["id"], "label", 3, 5, 1).transform(points).count() == 900


def test_deep_forest_keeps_no_nodes_on_the_driver_or_in_plans(points):
    model = forest.fit(points, NAMES, ["id"], "label", 10, 30, 42)
    assert len(model.top.nodes) == 10
    assert model.cells.agg(F.sum(F.length("nodes"))).first()[0] > 10 * 100 * 24
    scored = model.transform(points)
    assert scored.count() == 900 and scored.columns == [*points.columns, "probability", "prediction"]
    right = scored.where(F.col("prediction") == F.col("label")).count()
    assert right > 0.8 * 900
