"""Distinct students from stored sketches: an approximate form of reports, chosen by the caller.

Submissions are reduced to one theta sketch of the students for every hour and course, kept as a
table. Any period and group of courses is a union of sketches, however many submissions it covers;
sketches also intersect and subtract, so that students who stayed or left are counted as well. Counts
below 2 ** SKETCH_BITS are exact but for rounding; above, the standard error is 2 ** (-SKETCH_BITS / 2)
of the union, 0.8 % here. The exact reports stay the default and are unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_BITS = 14
STANDARD_ERROR = 2 ** (-SKETCH_BITS / 2)


def hourly_sketches(facts: DataFrame) -> DataFrame:
    """hour, course_id, submissions, students (a sketch) and last_activity, one row an hour and course.

    Partial sketches meet after the shuffle, so a busy hour sends one row a task.
    """
    return facts.groupBy(F.date_trunc("hour", "submitted_at").alias("hour"), "course_id").agg(
        F.count("*").alias("submissions"),
        F.theta_sketch_agg("student_id", SKETCH_BITS).alias("students"),
        F.max("submitted_at").alias("last_activity"),
    )


def merged(sketches: DataFrame) -> DataFrame:
    """Rows of several batches as one row an hour and course, to keep a stored table small."""
    return sketches.groupBy("hour", "course_id").agg(
        F.sum("submissions").alias("submissions"),
        F.theta_union_agg("students", SKETCH_BITS).alias("students"),
        F.max("last_activity").alias("last_activity"),
    )


def _united() -> Column:
    """Estimate of the students of all rows of a group; 0 without rows."""
    return F.coalesce(F.theta_sketch_estimate(F.theta_union_agg("students", SKETCH_BITS)), F.lit(0)).cast("bigint")


def students_by_course(sketches: DataFrame) -> DataFrame:
    """Submissions, about how many students, and the last activity of each course."""
    return sketches.groupBy("course_id").agg(
        F.sum("submissions").alias("submissions"),
        _united().alias("students"),
        F.max("last_activity").alias("last_activity"),
    )


def recent_activity(sketches: DataFrame, facts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """The approximate form of the recent-activity report.

    Whole hours come from their sketches. Only the hour in which a period begins is read from the
    submissions, so the periods are those of the exact form and so are the numbers of submissions.
    """
    latest = sketches.agg(F.max("last_activity").alias("t")).select(F.coalesce("t", F.current_timestamp())).scalar()
    latest = latest if as_of is None else as_of
    told = []
    for hours in (24, 7 * 24):
        begin = latest - F.make_dt_interval(F.lit(0), F.lit(hours))
        # The first whole hour in the period.
        whole = F.date_trunc("hour", begin + F.expr("INTERVAL '59:59.999999' MINUTE TO SECOND"))
        edge = facts.where((F.col("submitted_at") >= begin) & (F.col("submitted_at") < whole))
        columns = ("submissions", "students")
        rows = sketches.where(F.col("hour") >= whole).select(*columns).unionByName(hourly_sketches(edge).select(*columns))
        told.append(rows.agg(F.coalesce(F.sum("submissions"), F.lit(0)).alias("n"), _united().alias("s")))
    day, week = told
    return day.select(F.col("n").alias("submissions_24h"), F.col("s").alias("active_students_24h")).crossJoin(
        F.broadcast(week.select(F.col("n").alias("submissions_7d"), F.col("s").alias("active_students_7d")))
    )


def stayed_and_left(sketches: DataFrame, earlier: tuple[Column, Column], later: tuple[Column, Column]) -> DataFrame:
    """Per course, about how many students were active in both periods, only in the earlier one
    and only in the later one. A period is (first hour, hour after its last)."""
    hour = F.col("hour")

    def united(period: tuple[Column, Column]) -> Column:
        return F.theta_union_agg(F.when((hour >= period[0]) & (hour < period[1]), F.col("students")), SKETCH_BITS)

    both = sketches.groupBy("course_id").agg(united(earlier).alias("a"), united(later).alias("b"))
    count = lambda x: F.coalesce(F.theta_sketch_estimate(x), F.lit(0)).cast("bigint")
    return both.select(
        "course_id",
        count(F.theta_intersection("a", "b")).alias("stayed"),
        count(F.theta_difference("a", "b")).alias("left"),
        count(F.theta_difference("b", "a")).alias("new"),
    )
