"""Connected components of a graph given by its links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm import common
from cohortlens.session import remove_path, scratch_path

#: Rows of a file of the tables that rounds write.
FILE_ROWS = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some links, each with the smallest one that the links connect it with."""
    nodes, place = np.unique(np.stack([a, b]), return_inverse=True)
    x, y = place.reshape(2, -1)
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        further = label.copy()
        np.minimum.at(further, label[x], low)
        np.minimum.at(further, label[y], low)
        while not np.array_equal(further, jumped := further[further]):
            further = jumped
        if np.array_equal(label, further):
            break
        label = further
    inner = label != np.arange(len(nodes))
    return nodes[inner], nodes[label[inner]]


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each node of a partition's links with the smallest one the partition connects it with."""
    pairs = [np.stack([b.column(0).to_numpy(), b.column(1).to_numpy()]) for b in batches]
    if pairs:
        both = forest(*np.concatenate(pairs, axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], ["node", "other"])


def connect(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and component, its smallest node, for every node that has a link.

    Every node points to a smaller one, at first the smallest beside it. Each round, a node and the
    node it points to take the smallest second-next pointer around the node (FastSV), so that whole
    trees hook onto each other and the rounds grow with the logarithm of the longest path. Before
    the first round each partition replaces its links by stars that connect the same nodes. Only
    minima are aggregated and joined, so a node with very many links costs one row a task, and AQE
    splits its joins. Rounds are written tables in the shared folder, removed at the end: unlike a
    checkpoint, a table read again brings no partitioning that the optimizer would carry along,
    twice as long each round.
    """
    spark = links.sparkSession
    made: list[str] = []

    def table(df: DataFrame, files: int) -> DataFrame:
        made.append(scratch_path(spark, "components"))
        df.coalesce(files).write.parquet(made[-1])
        return spark.read.parquet(made[-1])

    known = common.checkpointed(links.select(F.col(a).alias("node"), F.col(b).alias("other")))
    # A few files, so that rounds over a small graph are a few tasks and Spark's own size check
    # can broadcast; a large one has as many as its rows need.
    files = 1 + 2 * known.count() // FILE_ROWS
    stars = known.coalesce(files).mapInArrow(_forest, "node long, other long")
    turned = stars.select(F.col("other").alias("node"), F.col("node").alias("other"))
    edges = table(stars.unionByName(turned), files)
    state = table(edges.groupBy("node").agg(F.least("node", F.min("other")).alias("component")), files)
    total = None
    while True:
        next_one = state.select(F.col("node").alias("component"), F.col("component").alias("beyond"))
        state = table(state.join(next_one, "component").select("node", "component", "beyond"), files)
        # A sum that falls until no pointer moves any more.
        wide = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("component", "beyond")]
        now = state.select(*wide).first()
        if now == total:
            break
        total = now
        seen = state.select(F.col("node").alias("other"), "beyond")
        near = edges.join(seen, "other").groupBy("node").agg(F.min("beyond").alias("near"))
        known = state.join(near, "node")
        offers = known.select("node", F.least("component", "beyond", "near").alias("c")).unionByName(
            known.select(F.col("component").alias("node"), F.col("near").alias("c"))
        )
        state = table(offers.groupBy("node").agg(F.min("c").alias("component")), files)
    found = common.checkpointed(state.select("node", "component"))
    for path in made:
        remove_path(spark, path)
    return found
