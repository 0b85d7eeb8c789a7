"""Exact selection of the k smallest rows of each stratum."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import selection
from cohortlens.plans import learning


def _chosen(spark, rows, strata, share, **more):
    frame = spark.createDataFrame(rows, "g string, number bigint, key bigint, chosen_before string").repartition(7)
    wanted = F.floor(F.col("size") * share)
    got = selection.smallest(frame, strata, "number", ["key"], wanted, "mine", **more)
    assert got.columns == [*frame.columns, "mine"]
    return {r.key for r in got.collect() if r.mine}, got.count()


def _expected(rows, strata, share):
    groups = {}
    for g, number, key, _ in rows:
        groups.setdefault(g if strata else None, []).append((number, key))
    return {key for found in groups.values() for _, key in sorted(found)[: int(len(found) * share)]}


@pytest.mark.parametrize("share", [0.0, 0.001, 0.15, 0.5, 1.0])
@pytest.mark.parametrize("open_rows", [100_000, 3])
def test_chooses_exactly_the_smallest(spark, share, open_rows):
    draw = random.Random(9)
    rows = [(draw.choice(["a", "b", None]), draw.getrandbits(60), i, "x") for i in range(600)]
    rows += [("hot", draw.choice([5, 1 << 59]), i, "x") for i in range(600, 900)]
    for strata in ([], ["g"]):
        assert _chosen(spark, rows, strata, share, open_rows=open_rows) == (_expected(rows, strata, share), 900)


def test_edges(spark):
    assert _chosen(spark, [], ["g"], 0.5) == (set(), 0)
    assert _chosen(spark, [("a", 7, 1, "x")], [], 1.0) == ({1}, 1)
    # One number only: ties go by key.
    rows = [("a", 7, i, None) for i in range(50)]
    assert _chosen(spark, rows, ["g"], 0.3, open_rows=4)[0] == set(range(15))


def test_numbers_are_those_of_md5_anywhere(spark):
    got = spark.range(50).select(selection.uniform_bits(F.col("id").cast("string"))).collect()
    sql = "SELECT CAST('0x' || substr(md5(CAST(i AS VARCHAR)), 1, 15) AS BIGINT) FROM range(50) t(i) ORDER BY i"
    assert [r[0] for r in got] == [r[0] for r in duckdb.sql(sql).fetchall()]


def test_no_global_sort_or_single_partition_over_all_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 2).alias("label"), F.xxhash64("id").alias("n"), "id")
    rows = rows.withColumn("n", F.shiftrightunsigned("n", 4)).repartition(4).checkpoint()
    found = selection.smallest(rows, ["label"], "n", ["id"], F.floor(F.col("size") * 0.2))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange SinglePartition" not in plan and "rangepartitioning" not in plan and "Window" not in plan
    assert sorted(found.where("chosen").groupBy("label").count().collect()) == [(0, 100), (1, 100)]


def test_flips_and_test_rows_are_exact_in_each_label(spark):
    rows = spark.range(2003).select(
        F.col("id").alias("student_id"), (F.col("id") % 4).alias("course_id"), (F.col("id") % 10 < 3).cast("int").alias("label")
    )
    noisy = learning.with_label_noise(rows.checkpoint()).checkpoint()
    assert noisy.where("flipped").count() == int(0.15 * 2003) == noisy.where("label != noisy_label").count()
    split = learning.with_split(noisy)
    assert split.columns == [*noisy.columns, "is_test"]
    for r in split.groupBy("noisy_label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("k")).collect():
        assert r.k == int(0.2 * r.n + 0.5)
    # The same rows whatever the partitioning.
    again = learning.with_split(learning.with_label_noise(rows.repartition(3).checkpoint()))
    assert sorted(again.collect()) == sorted(split.collect())
