"""Pivots and histograms. Pivot values are passed in, so no extra job looks for them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.session import ensure_checkpoint_dir


def pivot_first(df: DataFrame, index: str, column: str, value: str, values: list) -> DataFrame:
    return df.groupBy(index).pivot(column, values).agg(F.first(value))


def course_pivot(course_summary: DataFrame, course_ids: list[int]) -> DataFrame:
    """Course name by course id, average grade in the cells."""
    wide = pivot_first(course_summary, "course_name", "course_id", "avg_grade", course_ids)
    return wide.select("course_name", *[F.col(str(c)).alias(f"course_{c}") for c in course_ids])


def risk_course_pivot(matrix: DataFrame, course_names: list[str]) -> DataFrame:
    """Risk bucket by course name, late ratio in the cells, missing cells as 0."""
    wide = pivot_first(matrix, "risk_bucket", "course_name", "late_ratio", course_names)
    return wide.na.fill(0.0).orderBy("risk_bucket")


def week_course_stack(averages: DataFrame, course_names: list[str]) -> DataFrame:
    """Weeks by courses, zero-filled, each layer with the running total over the course order."""
    wide = pivot_first(averages, "week", "course_name", "avg_grade", course_names).na.fill(0.0)
    layers, top = [], F.lit(0.0)
    for name in course_names:
        bottom, top = top, top + F.col(f"`{name}`")
        layers += [bottom.alias(f"{name}_from"), top.alias(f"{name}_to")]
    return wide.select("week", *layers).orderBy("week")


def equal_width_histogram(df: DataFrame, value: str, bins: int = 20) -> DataFrame:
    """Counts per equal-width bin over the observed range; the last bin is closed.

    Empty bins are kept. A constant column is shown in a range of one around its value. The column
    is written once, as range and counts both need it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    known = df.select(value).filter(F.col(value).isNotNull()).checkpoint()
    low, high = F.min(value), F.max(value)
    half = F.when(low == high, 0.5).otherwise(0.0)
    span = known.agg(F.struct((low - half).alias("low"), (high + half).alias("high"))).scalar()
    low, width = F.col("_span.low"), (F.col("_span.high") - F.col("_span.low")) / bins
    counts = (
        known.withColumn("_span", span)
        .groupBy(F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    return (
        df.sparkSession.range(bins)
        .withColumnRenamed("id", "bin")
        .join(counts, "bin", "left")
        .withColumn("_span", span)
        .select(
            "bin",
            (low + width * F.col("bin")).alias("bin_from"),
            (low + width * (F.col("bin") + 1)).alias("bin_to"),
            F.coalesce("count", F.lit(0)).alias("count"),
        )
        .orderBy("bin")
    )
