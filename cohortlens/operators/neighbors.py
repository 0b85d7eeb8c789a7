"""Exact k-nearest-neighbor search without pairing every query with every point.

Points are cut into cells by a k-d tree: a cell with too many points is split at the median of its
widest feature, as seen in a bounded sample of the cell, until every cell is small. Each node of the
tree has the box around its points. A query is searched in its home cell first, which bounds the
distance of its k-th neighbor; then it walks down the tree, past every node whose box is not closer
than that bound, to the few cells that remain. Each search emits at most k rows per query and cell,
and none beyond the bound.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.ranking import last_n
from cohortlens.session import ensure_checkpoint_dir

#: Points of a cell, up to five hundred million points; with more of them cells grow instead of the
#: tree, which is broadcast and stays below MOST_CELLS leaves (200 bytes each at seven features).
CELL_ROWS = 1_000
MOST_CELLS = 500_000
#: Rows that one round of splitting looks at, in all large cells together.
SAMPLE_ROWS = 100_000
SEARCH_ROWS = 2_000  # queries searched by one task against one cell


class BoxTree:
    """A k-d tree as arrays over its nodes; leaves are cells, numbered by their node."""

    def __init__(self) -> None:
        self.dim, self.cut, self.child = [-1], [0.0], [-1]

    def grow(self, node: int, sample: np.ndarray, depth: int) -> None:
        """Split a leaf `depth` times at the medians of the widest features of its sample."""
        spread = np.ptp(sample, axis=0) if len(sample) else np.zeros(1)
        if depth == 0 or spread.max() == 0:
            return
        dim = int(spread.argmax())
        values = np.sort(sample[:, dim])
        cut = values[len(values) // 2]
        if cut == values[0]:  # more than half are the smallest
            cut = values[np.searchsorted(values, cut, side="right")]
        self.dim[node], self.cut[node], self.child[node] = dim, float(cut), len(self.dim)
        below = sample[:, dim] < cut
        for side in (below, ~below):
            self.dim.append(-1)
            self.cut.append(0.0)
            self.child.append(-1)
        first = self.child[node]
        self.grow(first, sample[below], depth - 1)
        self.grow(first + 1, sample[~below], depth - 1)

    def fixed(self) -> BoxTree:
        """The same with arrays, for use in tasks."""
        tree = BoxTree()
        tree.dim, tree.cut, tree.child = np.array(self.dim), np.array(self.cut), np.array(self.child)
        return tree

    def leaf_of(self, x: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each row, below the node it starts from."""
        node = np.zeros(len(x), np.int64) if start is None else start.copy()
        inner = np.flatnonzero(self.dim[node] >= 0)
        while len(inner):
            at = node[inner]
            node[inner] = self.child[at] + (x[inner, self.dim[at]] >= self.cut[at])
            inner = inner[self.dim[node[inner]] >= 0]
        return node

    def with_boxes(self, cells: np.ndarray, counts: np.ndarray, low: np.ndarray, high: np.ndarray) -> BoxTree:
        """Boxes and numbers of points of all nodes, from those of the leaves that have points."""
        nodes, width = len(self.dim), low.shape[1]
        self.low, self.high = np.full((nodes, width), np.inf), np.full((nodes, width), -np.inf)
        self.count, self.parent = np.zeros(nodes, np.int64), np.full(nodes, -1)
        self.low[cells], self.high[cells], self.count[cells] = low, high, counts
        for node in range(nodes - 1, -1, -1):  # children come after their parents
            if self.dim[node] >= 0:
                both = [self.child[node], self.child[node] + 1]
                self.low[node], self.high[node] = self.low[both].min(axis=0), self.high[both].max(axis=0)
                self.count[node] = self.count[both].sum()
                self.parent[both] = node
        return self

    def home_of(self, x: np.ndarray, k: int) -> np.ndarray:
        """The smallest node around each row's leaf that has k points, or the root."""
        node = self.leaf_of(x)
        small = np.flatnonzero((self.count[node] < k) & (self.parent[node] >= 0))
        while len(small):
            node[small] = self.parent[node[small]]
            small = small[(self.count[node[small]] < k) & (self.parent[node[small]] >= 0)]
        return node

    def distance(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distance from each row to the box of its node, added up feature by feature as for
        points, so that rounding never puts a box behind one of its points."""
        total = np.zeros(len(x))
        for j in range(x.shape[1]):
            gap = np.maximum(np.maximum(self.low[node, j] - x[:, j], x[:, j] - self.high[node, j]), 0.0)
            total += gap * gap
        return total

    def walk(self, x: np.ndarray, start: np.ndarray, bound: np.ndarray, passed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of the filled leaves below `start` whose boxes are within each row's bound,
        without the subtree of `passed`."""
        row, node = np.arange(len(x)), start.copy()
        found = []
        while len(row):
            open_ones = (self.count[node] > 0) & (node != passed[row])
            row, node = row[open_ones], node[open_ones]
            near = self.distance(x[row], node) <= bound[row]
            row, node = row[near], node[near]
            leaf = self.dim[node] < 0
            found.append((row[leaf], node[leaf]))
            row, node = row[~leaf], self.child[node[~leaf]]
            row, node = np.repeat(row, 2), np.repeat(node, 2) + np.tile([0, 1], len(node))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (row, node)


def _assign(points: DataFrame, features: list[str], tree: BoxTree) -> DataFrame:
    """Points with the leaf of each in `cell`."""
    held: Broadcast = points.sparkSession.sparkContext.broadcast(tree.fixed())

    @F.pandas_udf("bigint")
    def leaf(cell: pd.Series, x: pd.DataFrame) -> pd.Series:
        return pd.Series(held.value.leaf_of(x.to_numpy(float), cell.to_numpy(np.int64)))

    return points.withColumn("cell", leaf("cell", F.struct(*[F.col(f).cast("double").alias(f) for f in features])))


def _cut(points: DataFrame, features: list[str], key: list[str], copies: int, cell_rows: int) -> tuple[BoxTree, DataFrame]:
    """The tree and the points with their cells, none of which has more than `cell_rows` points; a
    vector occurs `copies` times at most, and fewer than `cell_rows`."""
    tree, placed = BoxTree(), points.withColumn("cell", F.lit(0).cast("bigint")).checkpoint()
    while True:
        sizes = placed.groupBy("cell").agg(F.count("*").alias("_n")).where(F.col("_n") > cell_rows)
        large = {r["cell"]: r["_n"] for r in sizes.collect()}  # fewer than points / cell_rows
        if not large:
            return tree, placed
        # More rows of each than a vector has copies, so that not all are equal.
        share = max(64, 2 * copies, SAMPLE_ROWS // len(large))
        in_cell = Window.partitionBy("cell").orderBy(F.xxhash64(*key), *key)
        some = (
            placed.join(F.broadcast(sizes.select("cell")), "cell", "left_semi")
            .withColumn("_place", F.row_number().over(in_cell))
            .where(F.col("_place") <= share)
            .select("cell", *[F.col(f).cast("double").alias(f) for f in features])
            .toPandas()
        )
        for cell, sample in some.groupby("cell"):
            # As deep as the points ask for and the sample can tell.
            depth = min(math.ceil(math.log2(large[cell] / cell_rows)), max(1, int(math.log2(len(sample) / 16))))
            tree.grow(int(cell), sample[features].to_numpy(float), max(1, depth))
        placed = _assign(placed, features, tree).checkpoint()


def _boxed(tree: BoxTree, points: DataFrame, features: list[str]) -> BoxTree:
    edges = [F.min(f).cast("double").alias(f"low_{f}") for f in features]
    edges += [F.max(f).cast("double").alias(f"high_{f}") for f in features]
    boxes = points.groupBy("cell").agg(F.count("*").alias("n"), *edges).toPandas()  # one row a cell
    low, high = (boxes[[f"{side}_{f}" for f in features]].to_numpy(float) for side in ("low", "high"))
    return tree.fixed().with_boxes(boxes["cell"].to_numpy(np.int64), boxes["n"].to_numpy(np.int64), low, high)


def _visits(queries: DataFrame, features: list[str], tree: Broadcast, k: int, home: bool) -> DataFrame:
    """(query, bound, cell) rows: the cells of the home node, with no bound, or all other cells inside
    the query's bound."""

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        boxes: BoxTree = tree.value
        for pdf in batches:
            for begin in range(0, len(pdf), 4_096):
                rows = pdf.iloc[begin : begin + 4_096]
                x = rows[features].to_numpy(float)
                own = boxes.home_of(x, k)
                if home:
                    everywhere = np.full(len(x), np.inf)
                    row, cell = boxes.walk(x, own, everywhere, np.full(len(x), -1))
                else:
                    row, cell = boxes.walk(x, np.zeros(len(x), np.int64), rows["bound"].to_numpy(float), own)
                yield rows.iloc[row].assign(cell=cell)

    columns = ", ".join(f"{f} double" for f in features) + ", bound double, cell bigint"
    bound = F.lit(float("inf")).alias("bound") if home else F.col("bound")
    return queries.select(*features, bound).mapInPandas(choose, columns)


def _search(visits: DataFrame, points: DataFrame, features: list[str], key: list[str], label: str, k: int) -> DataFrame:
    """The k nearest points of the visited cell per visit, as far as they are within its bound. A
    busy cell is shared out over several tasks, each with its own copy of the (size-limited) cell."""
    load = visits.groupBy("cell").agg(F.ceil(F.count("*") / SEARCH_ROWS).alias("_shares"))
    load = F.broadcast(load)  # one row per cell
    shared = visits.join(load, "cell").withColumn(
        "share", F.pmod(F.xxhash64(*features), F.col("_shares"))
    ).drop("_shares")
    copies = points.join(load, "cell").withColumn(
        "share", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_shares") - 1))
    ).drop("_shares")

    def nearest(q: pd.DataFrame, p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values(key, ignore_index=True)
        asked, known = q[features].to_numpy(float), p[features].to_numpy(float)
        bounds = q["bound"].to_numpy(float)
        rows, found, distances = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        for begin in range(0, len(q), 256):
            x, limit = asked[begin : begin + 256], bounds[begin : begin + 256, None]
            distance = np.zeros((len(x), len(p)))
            for j in range(len(features)):
                gap = x[:, j : j + 1] - known[None, :, j]
                distance += gap * gap
            near = distance <= limit
            if np.count_nonzero(near) > 4 * k * len(x):
                near = distance <= np.minimum(limit, np.partition(distance, min(k, len(p)) - 1, axis=1)[:, [min(k, len(p)) - 1]])
            row, at = np.nonzero(near)
            order = np.lexsort((distance[row, at], row))  # points are in the order of their keys
            row, at = row[order], at[order]
            kept = np.arange(len(row)) - np.searchsorted(row, row) < k
            row, at = row[kept], at[kept]
            rows.append(begin + row)
            found.append(at)
            distances.append(distance[row, at])
        rows, found = np.concatenate(rows), np.concatenate(found)
        result = q.iloc[rows][[*features, "cell"]].reset_index(drop=True)
        result["distance"] = np.concatenate(distances)
        hits = p.iloc[found][[*key, label]].reset_index(drop=True)
        return pd.concat([result, hits], axis=1)

    fields = [f"{f} double" for f in features] + ["cell bigint", "distance double"]
    fields += [f"{c} {points.schema[c].dataType.simpleString()}" for c in [*key, label]]
    return (
        shared.groupBy("cell", "share")
        .cogroup(copies.groupBy("cell", "share"))
        .applyInPandas(nearest, ", ".join(fields))
    )


def nearest_neighbors(
    train: DataFrame,
    queries: DataFrame,
    features: list[str],
    key: list[str],
    label: str,
    k: int = 5,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """For each distinct query vector the ``k`` nearest train rows; ties go to the lower key.

    Of equal train vectors only the first ``k`` by key can ever be among the nearest, so the
    others are left out, and equal query vectors are searched once: copies cost nothing.
    """
    ensure_checkpoint_dir(train.sparkSession)
    order = [F.asc(c) for c in key]
    unique = last_n(train.select(*features, *key, label), features, order, k).checkpoint()
    tree, points = _cut(unique, features, key, k, max(cell_rows, 2 * k, -(-unique.count() // MOST_CELLS)))
    held = train.sparkSession.sparkContext.broadcast(_boxed(tree, points, features))

    asked = queries.select(*[F.col(f).cast("double").alias(f) for f in features]).distinct()
    first = _search(_visits(asked, features, held, k, home=True), points, features, key, label, k).checkpoint()
    nearest = last_n(first.drop("cell"), features, [F.asc("distance"), *order], k).checkpoint()
    kth = F.when(F.count("*") >= k, F.max("distance")).otherwise(F.lit(float("inf")))
    others = _visits(nearest.groupBy(*features).agg(kth.alias("bound")), features, held, k, home=False)
    found = nearest.unionByName(_search(others, points, features, key, label, k).drop("cell"))
    return last_n(found, features, [F.asc("distance"), *order], k)


def votes(neighbors: DataFrame, features: list[str], label: str) -> DataFrame:
    share: Column = F.sum(label).cast("double") / F.count("*")
    return neighbors.groupBy(*features).agg(share.alias("probability"))
