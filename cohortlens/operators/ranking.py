"""Row ranks inside a group and the early window, safe for groups of any size.

Ordinary groups are ranked by a window function: one exchange, which the following group
aggregation reuses. A group that holds a large share of all rows would put that share into a
single task, so such groups are found first (a narrow count) and ranked on a range-partitioned
sort that spreads one group over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir

# Groups above this many rows are ranked on the range-partitioned sort.
HEAVY_ROWS = 1_000_000
# A list of up to this many heavy groups is broadcast; a longer one is joined by shuffle.
BROADCAST_GROUPS = 10_000


def heavy_groups(df: DataFrame, keys: list[str], heavy_rows: int = HEAVY_ROWS) -> DataFrame | None:
    """All groups above ``heavy_rows`` rows, or None when there are none.

    The count reads only the key columns and combines before its shuffle. A short list becomes a
    broadcast frame after a look at its length; a longer one stays distributed, in a checkpoint.
    """
    ensure_checkpoint_dir(df.sparkSession)
    found = (
        df.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > heavy_rows)
        .select(*keys)
        .checkpoint()
    )
    first = found.limit(BROADCAST_GROUPS + 1).count()
    if not first:
        return None
    return F.broadcast(found) if first <= BROADCAST_GROUPS else found


def _same_group(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def split_heavy(
    df: DataFrame, keys: list[str], heavy: DataFrame | None
) -> tuple[DataFrame, DataFrame | None]:
    """(ordinary rows, heavy rows or None); ``heavy`` is a list made by ``heavy_groups``."""
    if heavy is None:
        return df, None
    same = _same_group(df, heavy, keys)
    return df.join(heavy, same, "left_anti"), df.join(heavy, same, "left_semi")


def rank_by_window(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Adds ``rn`` (1-based rank) and ``total_count`` with one exchange on the keys."""
    group = Window.partitionBy(*keys)
    return df.withColumn("rn", F.row_number().over(group.orderBy(*order)).cast("bigint")).withColumn(
        "total_count", F.count("*").over(group)
    )


def rank_by_range(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The same two columns from a range-partitioned sort, so no task holds a whole group.

    ``order`` must be unique within a group. Positions are frozen by a reliable checkpoint,
    because both uses below must see the same partition boundaries, also after a lost executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    columns = df.columns
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(k) for k in keys] + list(order)
    placed = (
        df.repartitionByRange(parts, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_pos", F.monotonically_increasing_id())
        .withColumn("_block", F.shiftright("_pos", 33))
        .checkpoint()
    )
    per_block = placed.groupBy(*keys, "_block").agg(
        F.count("*").alias("_n"), F.min("_pos").alias("_first")
    )
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    # One row per group and block; a block boundary cuts at most one group, so there are
    # fewer than groups + blocks rows. Spark's own size check decides on a broadcast.
    offsets = per_block.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_block").alias("_k_block"),
        "_first",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias("total_count"),
    )
    same = F.col("_block") == F.col("_k_block")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    rank = F.col("_before") + F.col("_pos") - F.col("_first") + 1
    return placed.join(offsets, same).select(*columns, rank.alias("rn"), "total_count")


def ranked_parts(
    df: DataFrame, keys: list[str], order: list[Column], heavy: DataFrame | None
) -> list[DataFrame]:
    """Ranked frames covering disjoint groups: the ordinary ones and, if any, the heavy ones.

    They stay apart so that a group aggregation can reuse the partitioning of the first.
    """
    ordinary, large = split_heavy(df, keys, heavy)
    parts = [rank_by_window(ordinary, keys, order)]
    if large is not None:
        parts.append(rank_by_range(large, keys, order))
    return parts


def union_all(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def early_cutoff(total: Column, numerator: int = 6, denominator: int = 10) -> Column:
    """ceil(total * numerator / denominator), at least 1, in integers."""
    share = F.call_function("div", total * numerator + (denominator - 1), F.lit(denominator))
    return F.greatest(F.lit(1).cast("bigint"), share)


def last_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group in ``order``.

    Spark limits each group to ``n`` rows per task before the shuffle (window group limit),
    so a heavy group costs ``n`` rows per task, not its size.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")
