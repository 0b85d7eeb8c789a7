"""Random forests of deep trees, grown and kept in parts that no single task or driver holds whole.

Features are cut into 32 bins at quantiles of a bounded sample. A row's weight in a tree follows from
its number, a node's features from its place, so a tree depends on nothing but the rows. As long as
a node has more than `cell_rows` rows it is split by counts over all partitions; those first nodes of
all trees are known to the driver. Below them the rows of each node, a cell, meet in one group, which
grows the rest of the tree level by level; cells are kept as rows of a checkpoint. Both ways choose
the same splits. To score, distinct rows of bins are dealt to their cell of each tree and the shares
found there are added up, as integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir, spread

#: Bins of a feature, and the bits one takes in a row's code; up to eleven features fit.
BINS, BITS = 32, 5
#: Rows, by weight, that one group grows a subtree of.
CELL_ROWS = 250_000
#: Rows the cuts of the bins are taken from, as many as Spark's own forest takes.
SAMPLE_ROWS = 10_000
#: Distinct rows that one group scores.
ASKED_ROWS = 2_000_000
MOST_TASKS = 1_000
#: Possible keys per key that sums are kept for; with more the keys that occur are sorted instead.
DENSE = 8
#: Shares of a leaf are kept as integers of this unit, so that sums do not depend on their order.
UNIT = 1_000_000_000
#: Chances that a Poisson number of mean 1 is at most 0, 1, ... 14; a weight takes four bits.
POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(15)])


def mixed(x: np.ndarray) -> np.ndarray:
    """Well-mixed 64 bits of each number (splitmix64)."""
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def weights(numbers: np.ndarray, tree: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    drawn = mixed(numbers ^ mixed(np.array([tree], np.uint64)))
    return np.searchsorted(POISSON, (drawn >> np.uint64(11)) / 2.0**53, side="right")


def some_features(seed: int, tree: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """The features that each node may be split by, about the root of their number."""
    own = mixed(mixed(tree.astype(np.uint64) + np.uint64(seed << 32)) ^ place.astype(np.uint64))
    drawn = mixed(own[:, None] ^ np.arange(1, width + 1, dtype=np.uint64) << np.uint64(40))
    return np.sort(np.argsort(drawn, axis=1)[:, : math.ceil(math.sqrt(width))], axis=1)


def cuts_of(values: np.ndarray) -> np.ndarray:
    """Up to BINS - 1 cuts between values: between all if they are few, else at quantiles."""
    distinct, values = np.unique(values), np.sort(values)
    if len(distinct) <= BINS:
        below = distinct[:-1]
    else:
        below = np.unique(values[np.arange(1, BINS) * len(values) // BINS])
        below = below[below < distinct[-1]]
    return (below + distinct[np.searchsorted(distinct, below, side="right")]) / 2 if len(below) else below


def bins_of(codes: np.ndarray, width: int) -> np.ndarray:
    return (codes[:, None] >> (BITS * np.arange(width))) & (BINS - 1)


def best_splits(part: np.ndarray, bins: np.ndarray, counts: np.ndarray, tried: int) -> tuple[np.ndarray, ...]:
    """(node, part, bin, counts on the left) of the split with the least Gini impurity of each node
    that some split improves; the first one of equals.

    Entries are counts of the two labels by part and bin, in this order; node n tries the features of
    the parts n * tried and following.
    """
    begin = np.flatnonzero(np.diff(part, prepend=-1))
    length = np.diff(np.append(begin, len(part)))
    running = np.cumsum(counts, axis=0)
    left = running - np.repeat(running[begin] - counts[begin], length, axis=0)
    total = np.repeat(np.add.reduceat(counts, begin, axis=0), length, axis=0)
    right = total - left
    # A split must part the rows and change the shares.
    kept = (right.sum(axis=1) > 0) & (left[:, 0] * total[:, 1] != left[:, 1] * total[:, 0])
    part, bins, left, right = part[kept], bins[kept], left[kept], right[kept]
    node = part // tried
    if not len(node):
        return node, part, bins, left
    purity = (left**2).sum(axis=1) / left.sum(axis=1) + (right**2).sum(axis=1) / right.sum(axis=1)
    begin = np.flatnonzero(np.diff(node, prepend=-1))
    most = np.repeat(np.maximum.reduceat(purity, begin), np.diff(np.append(begin, len(node))))
    best = np.flatnonzero(purity == most)
    best = best[np.unique(node[best], return_index=True)[1]]
    return node[best], part[best], bins[best], left[best]


def walk(nodes: np.ndarray, start: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The leaf of each row below the node it starts from; a node is (test, first child, value), its
    test is feature * BINS + bin, or -1 of a leaf."""
    node = start.copy()
    inner = np.flatnonzero(nodes[node, 0] >= 0)
    while len(inner):
        test, child, _ = nodes[node[inner]].T
        node[inner] = child + (bins[inner, test // BINS] > test % BINS)
        inner = inner[nodes[node[inner], 0] >= 0]
    return node


def summed(keys: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of `keys`, all below `size`, in order, and for each the sums of its counts of
    both labels; a row of `counts` belongs to all keys of the same row."""
    keys, times = keys.ravel(), keys.shape[1]
    known = np.arange(size) if size <= DENSE * len(keys) else None
    if known is None:  # no array of all possible keys where most do not occur
        known, keys = np.unique(keys, return_inverse=True)
    both = np.stack([np.bincount(keys, np.repeat(counts[:, i], times), len(known)) for i in (0, 1)], axis=1)
    some = np.flatnonzero(both.any(axis=1))
    return known[some], both[some].astype(np.int64)


def share(counts: np.ndarray) -> np.ndarray:
    return np.rint(UNIT * (counts[..., 1] / counts.sum(axis=-1))).astype(np.int64)


def grow(codes: np.ndarray, counts: np.ndarray, width: int, seed: int, tree: int, place: int, levels: int) -> np.ndarray:
    """The nodes below one place of a tree, from the distinct codes of its rows and their counts by
    label, level by level."""
    at = np.zeros(len(codes), np.int64)
    places, found, known = np.array([place], np.int64), [], 0
    while len(places):
        total = np.stack([np.bincount(at, counts[:, i], len(places)) for i in (0, 1)], axis=1).astype(np.int64)
        nodes = np.stack([np.full(len(places), -1), np.zeros(len(places), np.int64), share(total)], axis=1)
        known += len(places)
        found.append(nodes)
        open_ones = (total > 0).all(axis=1) & (levels > 0)
        kept = np.flatnonzero(open_ones[at])
        codes, counts, at = codes[kept], counts[kept], (np.cumsum(open_ones) - 1)[at[kept]]
        which = np.flatnonzero(open_ones)
        if not len(which):
            break
        features = some_features(seed, np.array([tree]), places[which], width)
        tried = features.shape[1]
        keys = (at[:, None] * tried + np.arange(tried)) * BINS + (codes[:, None] >> (BITS * features)[at] & (BINS - 1))
        keys, entries = summed(keys, counts, len(which) * tried * BINS)
        node, part, cut, _ = best_splits(keys // BINS, keys % BINS, entries, tried)
        feature = features[node, part % tried]
        nodes[which[node], 0] = feature * BINS + cut
        nodes[which[node], 1] = known + 2 * np.arange(len(node))
        new = np.full(len(which), -1)
        new[node] = np.arange(len(node))
        kept = np.flatnonzero(new[at] >= 0)
        codes, counts, at = codes[kept], counts[kept], new[at[kept]]
        at = 2 * at + ((codes >> (BITS * feature)[at] & (BINS - 1)) > cut[at])
        places = (2 * places[which[node]][:, None] + [0, 1]).ravel()
        levels -= 1
    return np.concatenate(found)


@dataclass(frozen=True)
class Cell:
    """A node that is not split by counts over all partitions; `leaf` is its share if it is a leaf."""

    tree: int
    place: int
    levels: int
    leaf: int | None = None


class Top:
    """The first nodes of all trees, the root of tree t being node t; the value of one that has no
    children here is its cell."""

    def __init__(self, trees: int, depth: int) -> None:
        self.nodes = [[-1, 0, t] for t in range(trees)]
        self.cells = {t: Cell(t, 1, depth) for t in range(trees)}
        self.trees, self.made = trees, trees
        self.of_cell = {t: t for t in range(trees)}

    def split(self, cell: int, test: int, sides: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Two cells in place of one; returns those that are no leaves, with their rows."""
        old, node = self.cells.pop(cell), self.of_cell.pop(cell)
        self.nodes[node] = [test, len(self.nodes), 0]
        open_ones = []
        for side, counts in enumerate(sides):
            new = self.made
            self.made += 1
            self.of_cell[new] = len(self.nodes)
            self.nodes.append([-1, 0, new])
            ends = min(counts) == 0 or old.levels == 1
            leaf = int(share(np.array(counts))) if ends else None
            self.cells[new] = Cell(old.tree, 2 * old.place + side, old.levels - 1, leaf)
            if not ends:
                open_ones.append((new, sum(counts)))
        return open_ones

    def end(self, cell: int, counts: tuple[int, int]) -> None:
        old = self.cells[cell]
        self.cells[cell] = Cell(old.tree, old.place, old.levels, int(share(np.array(counts))))


def _arrays(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(n).to_numpy(zero_copy_only=False) for n in names]


def _coded(cuts: list[np.ndarray], features: list[str]) -> Column:
    @F.pandas_udf("bigint")
    def code(x: pd.DataFrame) -> pd.Series:
        found = np.zeros(len(x), np.int64)
        for j, cut in enumerate(cuts):
            found |= np.searchsorted(cut, x.iloc[:, j].to_numpy(float), side="left") << (BITS * j)
        return pd.Series(found)

    return code(F.struct(*[F.col(f).cast("double").alias(f) for f in features]))


def _counted(rows: DataFrame, top: Top, large: list[int], width: int, seed: int) -> list:
    """The best split of each large cell with the counts of both sides, or -1 and its counts."""
    large = sorted(large, key=lambda c: (top.cells[c].tree, c))
    tree = np.array([top.cells[c].tree for c in large])
    features = some_features(seed, tree, np.array([top.cells[c].place for c in large]), width)
    tried = features.shape[1]
    held: Broadcast = rows.sparkSession.sparkContext.broadcast((np.array(top.nodes), np.array(large), tree, features, top.made))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, cells, tree, features, made = held.value
        slot = np.full(made, -1)
        slot[cells] = np.arange(len(cells))
        found = np.zeros((len(cells), tried * BINS * 2), np.int64)
        for batch in batches:
            codes, numbers, labels = _arrays(batch, "code", "number", "label")
            bins = bins_of(codes, width)
            for t in np.unique(tree):
                first, last = np.searchsorted(tree, [t, t + 1])
                weight = weights(numbers.view(np.uint64), t)
                at = slot[nodes[walk(nodes, np.full(len(codes), t), bins), 2]]
                used = np.flatnonzero((weight > 0) & (at >= 0))
                at = at[used]
                keys = ((at - first)[:, None] * tried + np.arange(tried)) * BINS
                keys = (keys + np.take_along_axis(bins[used], features[at], axis=1)) * 2 + labels[used][:, None]
                size = (last - first) * tried * BINS * 2
                new = np.bincount(keys.ravel(), np.repeat(weight[used], tried), size)
                found[first:last] += new.astype(np.int64).reshape(last - first, -1)
        entries = found.reshape(-1, 2)
        some = np.flatnonzero(entries.any(axis=1))
        for begin in range(0, len(some), 100_000):
            here = some[begin : begin + 100_000]
            columns = [here // (tried * BINS), here % (tried * BINS), *entries[here].T]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "entry", "zeros", "ones"])

    def best(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("entry")
        entry, counts = pdf["entry"].to_numpy(), pdf[["zeros", "ones"]].to_numpy()
        _, part, cut, left = best_splits(entry // BINS, entry % BINS, counts, tried)
        total = counts[entry < BINS].sum(axis=0)
        if not len(part):
            return pd.DataFrame([[key[0], -1, *total, 0, 0]], columns=names)
        test = features[key[0], part[0]] * BINS + cut[0]
        return pd.DataFrame([[key[0], test, *left[0], *(total - left[0])]], columns=names)

    names = ["slot", "test", "l0", "l1", "r0", "r1"]
    entries = rows.mapInArrow(count, "slot bigint, entry bigint, zeros bigint, ones bigint")
    summed = entries.groupBy("slot", "entry").agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"))
    chosen = summed.groupBy("slot").applyInPandas(best, ", ".join(f"{n} bigint" for n in names))
    return sorted((large[r.slot], *r[1:]) for r in chosen.collect())  # fewer than trees * rows / cell_rows


def _deal(cell: np.ndarray, values: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """The values of each cell."""
    order = np.argsort(cell, kind="stable")
    cell, values = cell[order], values[order]
    begin = np.flatnonzero(np.diff(cell, prepend=-1))
    for a, b in zip(begin, np.append(begin, len(cell))[1:], strict=True):
        yield int(cell[a]), values[a:b].tobytes()


@dataclass(frozen=True)
class Forest:
    """A fitted forest; `cells` has one row a cell, its nodes as 64-bit integers."""

    features: list[str]
    cuts: list[np.ndarray]
    top: Top
    cells: DataFrame

    def transform(self, rows: DataFrame) -> DataFrame:
        """Rows with the vector `probability` of both classes, the mean over the trees, and the
        `prediction`."""
        coded = rows.withColumn("_code", _coded(self.cuts, self.features))
        asked = coded.select("_code").distinct().checkpoint()
        shares = max(1, -(-asked.count() // ASKED_ROWS))
        width, trees = len(self.features), self.top.trees
        held: Broadcast = rows.sparkSession.sparkContext.broadcast(np.array(self.top.nodes))

        def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            nodes = held.value
            for batch in batches:
                (codes,) = _arrays(batch, "_code")
                bins, part = bins_of(codes, width), (mixed(codes.view(np.uint64)) % np.uint64(shares)).astype(np.int64)
                for t in range(trees):
                    cell = nodes[walk(nodes, np.full(len(codes), t), bins), 2]
                    dealt = list(_deal(cell * shares + part, codes))
                    yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in dealt], pa.int64()), pa.array([v for _, v in dealt], pa.binary())], ["visit", "codes"])

        def score(asked: pd.DataFrame, cell: pd.DataFrame) -> pd.DataFrame:
            if not len(asked) or not len(cell):  # a tree that no row was drawn for
                return pd.DataFrame({"_code": np.zeros(0, np.int64), "share": np.zeros(0, np.int64)})
            codes = np.frombuffer(b"".join(asked["codes"]), np.int64)
            nodes = np.frombuffer(cell["nodes"].iloc[0], np.int64).reshape(-1, 3)
            found = np.empty(len(codes), np.int64)
            for begin in range(0, len(codes), 100_000):
                here = codes[begin : begin + 100_000]
                found[begin : begin + len(here)] = nodes[walk(nodes, np.zeros(len(here), np.int64), bins_of(here, width)), 2]
            return pd.DataFrame({"_code": codes, "share": found})

        tasks = min(MOST_TASKS, len(self.top.cells) * shares)
        visits = asked.mapInArrow(visit, "visit bigint, codes binary").repartition(tasks, "visit")
        parts = F.explode(F.sequence(F.col("cell") * shares, F.col("cell") * shares + (shares - 1)))
        cells = self.cells.select(parts.alias("visit"), "nodes").repartition(tasks, "visit")
        found = visits.groupBy("visit").cogroup(cells.groupBy("visit")).applyInPandas(score, "_code bigint, share bigint")
        summed = found.groupBy("_code").agg(F.sum("share").alias("_sum"), F.count("*").alias("_trees"))
        p = F.coalesce(F.col("_sum") / (F.col("_trees") * UNIT), F.lit(0.0))
        return (
            coded.join(summed, "_code", "left")
            .withColumns({"probability": array_to_vector(F.array(1 - p, p)), "prediction": (p > 0.5).cast("double")})
            .drop("_code", "_sum", "_trees")
        )


def fit(
    train: DataFrame, features: list[str], key: list[str], label: str, trees: int, depth: int, seed: int, cell_rows: int = CELL_ROWS
) -> Forest:
    """A forest of `trees` trees of at most `depth` levels, each of all train rows drawn with a
    Poisson weight; every node tries the root of the number of features. A node that is pure, or
    that no split of the tried features improves, is a leaf.

    Labels are 0 or 1. Rows with equal keys are drawn together; `train` should be a checkpoint or a
    table, as it is read a few times.
    """
    spark, width = train.sparkSession, len(features)
    ensure_checkpoint_dir(spark)
    number = F.xxhash64(*key, F.lit(seed))
    sample = train.orderBy(number, *key).limit(SAMPLE_ROWS).select(*[F.col(f).cast("double").alias(f) for f in features])
    sample = sample.toPandas().to_numpy(float)
    cuts = [cuts_of(sample[:, j]) for j in range(width)]
    coded = [_coded(cuts, features).alias("code"), number.alias("number"), F.col(label).cast("bigint").alias("label")]
    rows = spread(train, *key).select(*coded).checkpoint()

    top = Top(trees, depth)
    large = list(top.cells) if depth > 0 and rows.count() > cell_rows else []
    while large:
        open_ones = []
        for cell, test, *counts in _counted(rows, top, large, width, seed):
            if test < 0:
                top.end(cell, tuple(counts[:2]))
            else:
                open_ones += top.split(cell, test, [tuple(counts[:2]), tuple(counts[2:])])
        large = [cell for cell, size in open_ones if size > cell_rows]

    held: Broadcast = spark.sparkContext.broadcast((np.array(top.nodes), top.cells))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, cells = held.value
        for batch in batches:
            codes, numbers, labels = _arrays(batch, "code", "number", "label")
            bins, packed = bins_of(codes, width), codes << 5 | labels << 4
            for t in range(trees):
                weight = weights(numbers.view(np.uint64), t)
                used = np.flatnonzero(weight)
                cell = nodes[walk(nodes, np.full(len(used), t), bins[used]), 2]
                dealt = [(c, v) for c, v in _deal(cell, packed[used] | weight[used]) if cells[c].leaf is None]
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in dealt], pa.int64()), pa.array([v for _, v in dealt], pa.binary())], ["cell", "rows"])

    def grown(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        cell = held.value[1][key[0]]
        packed = np.frombuffer(b"".join(pdf["rows"]), np.int64)
        codes, back = np.unique(packed >> 5, return_inverse=True)
        ones = packed >> 4 & 1
        counts = [np.bincount(back, (packed & 15) * (ones == i), len(codes)) for i in (0, 1)]
        nodes = grow(codes, np.stack(counts, axis=1).astype(np.int64), width, seed, cell.tree, cell.place, cell.levels)
        return pd.DataFrame({"cell": [key[0]], "nodes": [nodes.tobytes()]})

    schema = "cell bigint, nodes binary"
    dealt = rows.mapInArrow(deal, "cell bigint, rows binary").repartition(min(MOST_TASKS, len(top.cells)), "cell")
    cells = dealt.groupBy("cell").applyInPandas(grown, schema)
    leaves = [(c, np.array([-1, 0, x.leaf]).tobytes()) for c, x in top.cells.items() if x.leaf is not None]
    if leaves:
        cells = cells.unionByName(spark.createDataFrame(leaves, schema))
    return Forest(features, cuts, top, cells.checkpoint())
