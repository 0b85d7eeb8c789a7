"""Exactly the k rows of each stratum with the smallest numbers, without sorting all rows.

The k-th smallest number of a stratum is found by counting: rows are counted by the first bits of
their number, which tells the range that holds the k-th; only that range is counted again by the
next bits, until few rows are left in it. Those are ranked, ties by key, and the k-th row becomes
the cut: a row is chosen if it does not come after its stratum's cut. Every step is a grouped count
with partial aggregation, so no task sees a stratum, however large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.operators.ranking import rank_by_range
from cohortlens.session import ensure_checkpoint_dir

#: Bits of the numbers, and how many of them one round of counting looks at.
BITS, STEP = 60, 15
#: An open range of up to this many rows in every stratum is ranked at once.
OPEN_ROWS = 100_000


def uniform_bits(text: Column) -> Column:
    """A number of 60 bits from a text, the same in every engine that has md5."""
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def _same(strata: list[str]) -> Column:
    same = F.lit(True)
    for c in strata:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return same


def _small(df: DataFrame, strata: list[str]) -> DataFrame:
    """One row a stratum, for a join by `_same`."""
    return F.broadcast(df.withColumnsRenamed({c: f"_k_{c}" for c in strata}))


def cuts(
    rows: DataFrame, strata: list[str], number: str, keys: list[str], wanted: Column, open_rows: int = OPEN_ROWS
) -> DataFrame:
    """One row per stratum that has rows to choose: the strata columns and `_cut`, the (number, keys)
    of its last chosen row.

    `wanted` is the number of rows to choose, an expression over `size`, the rows of the stratum.
    Strata may be null. `number` holds BITS bits; keys must be unique in a stratum, or more rows
    than wanted may share the last place. There must be few strata: they are broadcast.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    if not strata:
        found = cuts(rows.withColumn("_all", F.lit(0)), ["_all"], number, keys, wanted, open_rows)
        return found.select("_cut")
    left = rows.select(*strata, number, *keys)
    shift, found = BITS, None
    while shift > 0:
        shift -= STEP
        part = F.shiftright(number, shift)
        counted = left.groupBy(*strata, part.alias("_part")).agg(F.count("*").alias("_rows"))
        # At most 2 ** STEP rows a stratum from here on.
        stratum = Window.partitionBy(*strata)
        before = F.sum("_rows").over(stratum.orderBy("_part")) - F.col("_rows")
        running = counted.withColumn("_before", before)
        if found is None:
            running = running.withColumn("size", F.sum("_rows").over(stratum)).withColumn("_k", wanted.cast("bigint"))
        else:
            running = running.join(_small(found, strata), _same(strata))
        rest = F.col("_k") - F.col("_before")
        hit = running.where((rest > 0) & (rest <= F.col("_rows")))
        found = hit.select(*strata, rest.alias("_k"), F.col("_part").alias("_open"), "_rows").checkpoint()
        inside = _small(found.select(*strata, "_open"), strata)
        left = left.join(inside, _same(strata) & (part == F.col("_open"))).select(*strata, number, *keys)
        found = found.drop("_open")
        most = found.agg(F.max("_rows")).first()[0]
        found = found.drop("_rows")
        if most is None or most <= open_rows:
            break
    order = [F.col(number), *[F.col(k) for k in keys]]
    if most is not None and most > open_rows:  # one number many times over
        ranked = rank_by_range(left, strata, order)
    else:
        ranked = left.withColumn("rn", F.row_number().over(Window.partitionBy(*strata).orderBy(*order)))
    last = ranked.join(_small(found, strata), _same(strata) & (F.col("rn") == F.col("_k")))
    return last.select(*strata, F.struct(number, *keys).alias("_cut")).checkpoint()


def smallest(
    rows: DataFrame, strata: list[str], number: str, keys: list[str], wanted: Column, chosen: str = "chosen", open_rows: int = OPEN_ROWS
) -> DataFrame:
    """Rows with the boolean `chosen`, true for the wanted number of rows of each stratum: those
    with the smallest numbers, ties by key. `rows` should be a checkpoint or a table, as it is
    counted a few times."""
    last = _small(cuts(rows, strata, number, keys, wanted, open_rows), strata)
    here = F.coalesce(F.struct(number, *keys) <= F.col("_cut"), F.lit(False))
    return rows.join(last, _same(strata), "left").select(*rows.columns, here.alias(chosen))
