"""Streaming versions of the activity and trend reports."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortlens.functions import exprs as E
from cohortlens.plans.reports import weekly_trends_of
from cohortlens.session import scratch_path
from cohortlens.streaming import ledger

# Registers of a student sketch, as a power of two: a standard error of 0.8 %.
SKETCH_BITS = 14
HOURLY = "hour timestamp, submissions bigint, students binary"
WEEKLY = "week date, n bigint, late_n bigint, graded_n bigint, micros decimal(38,0)"


def activity_windows(
    submissions: DataFrame, late_by: str = "1 hour", span: str = "24 hours", step: str = "1 hour"
) -> DataFrame:
    """Submissions and approximate active students per sliding event-time window.

    For a sink that must never be revised: a window is emitted once, when the watermark has passed
    it, so the newest ones are not there yet. ``activity_rollup`` gives those too. The sketch
    merges partially, so a busy window does not gather its rows.
    """
    window = F.window("submitted_at", span, step)
    return (
        submissions.withWatermark("submitted_at", late_by)
        .groupBy(window)
        .agg(
            F.count("*").alias("submissions"),
            F.approx_count_distinct("student_id", 0.02).alias("active_students"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "submissions",
            "active_students",
        )
    )


def run_to_table(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Drain the available input into a Parquet folder and read it back."""
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", os.path.join(path, "data"))
        .option("checkpointLocation", os.path.join(path, "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(os.path.join(path, "data"))


def hourly_partials(batch: DataFrame) -> DataFrame:
    """Mergeable figures per hour of one micro-batch: rows and a sketch of the students."""
    return batch.groupBy(F.date_trunc("hour", "submitted_at").alias("hour")).agg(
        F.count("*").alias("submissions"),
        F.hll_sketch_agg("student_id", SKETCH_BITS).alias("students"),
    )


def merged_hours(partials: DataFrame) -> DataFrame:
    """One row per hour: the rows added up, the sketches united."""
    return partials.groupBy("hour").agg(
        F.sum("submissions").alias("submissions"), F.hll_union_agg("students").alias("students")
    )


def activity_rollup(submissions: DataFrame, path: str) -> StreamingQuery:
    """Fold new submissions into hourly partial figures under ``path``, one part a batch.

    Windows are built from them at read time, so the newest ones are there at once, and a late
    submission still counts.
    """
    return _fold_partials(submissions, hourly_partials, merged_hours, HOURLY, path)


def activity_report(spark: SparkSession, path: str, span_hours: int = 24) -> DataFrame:
    """Submissions and about how many active students in every window of ``span_hours`` that
    begins on an hour and holds a submission."""
    hours = merged_hours(ledger.snapshot(spark, path, HOURLY))
    back = F.sequence(F.lit(0), F.lit(span_hours - 1))
    start = F.col("hour") - F.make_dt_interval(F.lit(0), F.col("back"))
    return (
        hours.withColumn("back", F.explode(back))
        .groupBy(start.alias("window_start"))
        .agg(
            F.sum("submissions").alias("submissions"),
            F.hll_sketch_estimate(F.hll_union_agg("students")).alias("active_students"),
        )
        .select(
            "window_start",
            (F.col("window_start") + F.make_dt_interval(F.lit(0), F.lit(span_hours))).alias("window_end"),
            "submissions",
            "active_students",
        )
    )


def drain_activity(submissions: DataFrame) -> DataFrame:
    """Run the rollup over all available input in a fresh scratch folder and report."""
    path = scratch_path(submissions.sparkSession, "activity")
    activity_rollup(submissions, path).awaitTermination()
    return activity_report(submissions.sparkSession, path)


def weekly_partials(batch: DataFrame) -> DataFrame:
    """Mergeable sums per Monday week of one micro-batch."""
    # Event-time windows count from the epoch, a Thursday; four days later is a Monday.
    window = F.window("submitted_at", "7 days", startTime="4 days")
    return (
        batch.groupBy(window)
        .agg(
            F.count("*").alias("n"),
            F.count_if("late").alias("late_n"),
            F.count("grade").alias("graded_n"),
            F.sum(E.micros("grade")).cast(E.BIG).alias("micros"),
        )
        .select(F.to_date("window.start").alias("week"), "n", "late_n", "graded_n", "micros")
    )


def merged_weeks(partials: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("n", "late_n", "graded_n", "micros")]
    return partials.groupBy("week").agg(*sums)


def weekly_rollup(submissions: DataFrame, path: str) -> StreamingQuery:
    """Fold new submissions into partial sums under ``path``, one part a batch.

    A replayed batch is told by its id, so each submission counts once, however late it arrives.
    """
    return _fold_partials(submissions, weekly_partials, merged_weeks, WEEKLY, path)


def fold(rows: DataFrame, write: Callable[[DataFrame, int], None], path: str, mode: str = "append") -> StreamingQuery:
    """Start handing a stream's available batches to ``write``, with its progress under ``path``."""
    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", os.path.join(path, "state"))
        .trigger(availableNow=True)
        .start()
    )


def _fold_partials(
    rows: DataFrame, partials: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame], schema: str, path: str
) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        ledger.append(batch.sparkSession, path, batch_id, partials(batch), schema, merge)

    return fold(rows, write, path)


def weekly_report(spark: SparkSession, path: str) -> DataFrame:
    """Weekly trends from all partial sums published so far."""
    return weekly_trends_of(merged_weeks(ledger.snapshot(spark, path, WEEKLY)))


def drain_weekly(submissions: DataFrame) -> DataFrame:
    """Run the rollup over all available input in a fresh scratch folder and report."""
    path = scratch_path(submissions.sparkSession, "weekly")
    weekly_rollup(submissions, path).awaitTermination()
    return weekly_report(submissions.sparkSession, path)
