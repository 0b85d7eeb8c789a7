"""Early-behavior features for every (student, course) pair."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cohortlens.functions import exprs as E
from cohortlens.functions import tiers
from cohortlens.operators import ranking
from cohortlens.warehouse import PAIR, Warehouse


def latest_submission(facts: DataFrame) -> Column:
    """Newest submission as a scalar subquery; the current time when there is none."""
    newest = facts.agg(F.max("submitted_at").alias("latest")).select(
        F.coalesce("latest", F.current_timestamp()).alias("latest")
    )
    return newest.scalar()


def submissions_with_deadline(facts: DataFrame, assignments: DataFrame) -> DataFrame:
    """Left lookup of the deadline; the delay is in milliseconds, null without a deadline.

    A popular assignment skews this join; AQE splits it. A small dimension is broadcast by
    Spark's own size check.
    """
    due = assignments.select("assignment_id", "due_at")
    joined = facts.join(due, "assignment_id", "left")
    delay = F.unix_millis("submitted_at") - F.unix_millis("due_at")
    return joined.withColumn("delay_ms", delay)


def early_order(by: str) -> list[Column]:
    """``due``: deadline first, else hand-in time. ``submitted``: hand-in time only."""
    submitted = [F.col("submitted_at"), F.col("submission_id")]
    if by == "submitted":
        return submitted
    if by == "due":
        return [F.coalesce("due_at", "submitted_at")] + submitted
    raise ValueError(f"unknown early order {by!r}")


def ranked_submissions(
    wh: Warehouse, by: str = "due", fraction: tuple[int, int] = (6, 10)
) -> list[DataFrame]:
    """Submissions with rank, pair size and ``is_early``; the heavy pairs in a second frame."""
    rows = submissions_with_deadline(wh.facts, wh.assignments)
    parts = ranking.ranked_parts(rows, PAIR, early_order(by), wh.heavy_pairs)
    cutoff = ranking.early_cutoff(F.col("total_count"), *fraction)
    return [p.withColumn("is_early", F.col("rn") <= cutoff) for p in parts]


def _mark_first_rows(rows: DataFrame) -> DataFrame:
    """Flags the first early row of each week and the first row of each assignment of a pair.

    A row without a time belongs to no week, one without an assignment to none.

    Counting flags replaces two distinct counts, which would expand and reshuffle every row;
    these windows only sort inside the partitioning the rank already made.
    """
    in_week = Window.partitionBy(*PAIR, "is_early", "week").orderBy("rn")
    in_assignment = Window.partitionBy(*PAIR, "assignment_id").orderBy("rn")
    return rows.withColumns(
        {
            "new_week": F.col("is_early")
            & F.col("week").isNotNull()
            & (F.row_number().over(in_week) == 1),
            "new_assignment": F.col("assignment_id").isNotNull()
            & (F.row_number().over(in_assignment) == 1),
        }
    )


def _early_sums(early: Column) -> dict[str, Column]:
    """What is summed over the early rows of a pair."""
    one, grade = F.lit(1), E.micros("grade")
    early_grade = F.when(early, grade)
    # Measured from the newest submission: the slope is the same and the sums stay small.
    elapsed = F.unix_millis("submitted_at") - F.col("_origin")
    # Times of any year fit; sums and products beyond 38 digits are null, not an error.
    x = F.when(early & grade.isNotNull(), elapsed).cast("decimal(18,0)")
    delay = F.col("delay_ms").cast("decimal(18,0)")
    return {
        "early_n": F.count(F.when(early, one)),
        "early_late_n": F.count(F.when(early & F.col("late"), one)),
        "early_graded_n": F.count(early_grade),
        "early_micros": F.sum(early_grade),
        "early_squares": F.try_sum(F.try_multiply(early_grade, early_grade)),
        "sx": F.sum(x),
        "sxx": F.try_sum(F.try_multiply(x, x)),
        "sxy": F.try_sum(F.try_multiply(x, early_grade)),
        "early_due_n": F.count(F.when(early, F.col("delay_ms"))),
        "early_delay_ms": F.sum(F.when(early, F.greatest(delay, F.lit(0)))),
    }


def _whole_sums() -> dict[str, Column]:
    """What is summed over all rows of a pair."""
    one, delay = F.lit(1), F.col("delay_ms").cast("decimal(18,0)")
    return {
        "n": F.count("*"),
        "late_n": F.count_if("late"),
        "graded_n": F.count("grade"),
        "micros": F.sum(E.micros("grade")),
        "overdue_n": F.count_if(F.col("delay_ms") > 0),
        "overdue_ms": F.sum(F.when(F.col("delay_ms") > 0, delay)),
        "last_14d": F.count(F.when(F.col("submitted_at") >= F.col("_cut14"), one)),
        "last_30d": F.count(F.when(F.col("submitted_at") >= F.col("_cut30"), one)),
    }


def _per_pair(rows: DataFrame, latest: Column, sums: dict[str, Column]) -> DataFrame:
    """All per-pair sums in one aggregation; unused ones are pruned by the optimizer."""
    return (
        rows.withColumn("_latest", latest)
        .withColumns(
            {
                "_origin": F.unix_millis("_latest"),
                "_cut14": F.col("_latest") - F.make_dt_interval(F.lit(14)),
                "_cut30": F.col("_latest") - F.make_dt_interval(F.lit(30)),
            }
        )
        .groupBy(*PAIR)
        .agg(*[value.alias(name) for name, value in sums.items()])
    )


def _pair_statistics(
    rows: DataFrame, latest: Column, early_weeks: Column, assignments_done: Column
) -> DataFrame:
    sums = _whole_sums() | _early_sums(F.col("is_early"))
    return _per_pair(rows, latest, sums | {"early_weeks": early_weeks, "assignments_done": assignments_done})


def pair_statistics(
    wh: Warehouse,
    by: str = "due",
    fraction: tuple[int, int] = (6, 10),
    as_of: Column | None = None,
) -> DataFrame:
    """One row of sums per (student, course)."""
    latest = latest_submission(wh.facts) if as_of is None else as_of
    week = E.week_start(F.col("submitted_at"))
    ordinary, *heavy = [
        p.withColumn("week", week) for p in ranked_submissions(wh, by, fraction)
    ]
    stats = _pair_statistics(
        _mark_first_rows(ordinary), latest, F.count_if("new_week"), F.count_if("new_assignment")
    )
    for part in heavy:
        weeks = F.count_distinct(F.when(F.col("is_early"), F.col("week")))
        stats = stats.unionByName(_pair_statistics(part, latest, weeks, F.count_distinct("assignment_id")))
    return stats


#: What the dashboard table takes from the early window by hand-in time.
HANDED = ["early_n", "early_late_n", "early_graded_n", "early_micros", "early_weeks"]


def both_statistics(
    wh: Warehouse, fraction: tuple[int, int] = (6, 10), as_of: Column | None = None
) -> DataFrame:
    """``pair_statistics`` by deadline, and beside it the early window by hand-in time in columns
    ``handed_...``: one lookup of deadlines, one exchange and one aggregation for both."""
    latest = latest_submission(wh.facts) if as_of is None else as_of
    ordinary, heavy = ranking.split_heavy(wh.facts, PAIR, wh.heavy_pairs)
    pair = Window.partitionBy(*PAIR)
    cutoff = ranking.early_cutoff(F.count("*").over(pair), *fraction)
    rows = submissions_with_deadline(ordinary, wh.assignments).withColumns(
        {
            "rn": F.row_number().over(pair.orderBy(*early_order("due"))),
            "_rn_handed": F.row_number().over(pair.orderBy(*early_order("submitted"))),
            "_cutoff": cutoff,
            "week": E.week_start(F.col("submitted_at")),
        }
    )
    flagged = rows.withColumns({"is_early": F.col("rn") <= F.col("_cutoff"), "_handed": F.col("_rn_handed") <= F.col("_cutoff")})
    in_week = Window.partitionBy(*PAIR, "_handed", "week").orderBy("_rn_handed")
    new_week = F.col("_handed") & F.col("week").isNotNull() & (F.row_number().over(in_week) == 1)
    marked = _mark_first_rows(flagged).withColumn("_new_week_handed", new_week)
    by_hand = _early_sums(F.col("_handed")) | {"early_weeks": F.count_if("_new_week_handed")}
    sums = _whole_sums() | _early_sums(F.col("is_early"))
    sums |= {"early_weeks": F.count_if("new_week"), "assignments_done": F.count_if("new_assignment")}
    stats = _per_pair(marked, latest, sums | {f"handed_{c}": by_hand[c] for c in HANDED})
    if heavy is None:
        return stats
    some = replace(wh, facts=heavy, is_listed=True, listed=wh.heavy_pairs)
    due, handed = (pair_statistics(some, by, fraction, latest) for by in ("due", "submitted"))
    handed = handed.select(*[F.col(k).alias(f"_k_{k}") for k in PAIR], *[F.col(c).alias(f"handed_{c}") for c in HANDED])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in PAIR])
    return stats.unionByName(due.join(handed, same).select(*stats.columns))


def course_assignment_totals(assignments: DataFrame) -> DataFrame:
    return assignments.groupBy("course_id").agg(F.count("*").alias("total_assignments"))


def avg_delay_early() -> Column:
    """Hours: mean of max(delay, 0) over early rows that have a deadline."""
    return E.ratio(F.col("early_delay_ms"), F.col("early_due_n")) / E.MS_PER_HOUR


def avg_delay_strict() -> Column:
    """Hours: mean delay over the strictly overdue rows of the whole course."""
    return E.ratio(F.col("overdue_ms"), F.col("overdue_n")) / E.MS_PER_HOUR


def grade_trend() -> Column:
    return E.slope_of_micros(*[F.col(c) for c in ("early_graded_n", "sx", "early_micros", "sxx", "sxy")])


def early_stddev() -> Column:
    return E.stddev_pop_of_micros(
        F.col("early_graded_n"), F.col("early_micros"), F.col("early_squares")
    )


def completion_ratio() -> Column:
    total = F.coalesce("total_assignments", F.lit(0))
    return F.coalesce(E.ratio(F.col("assignments_done"), total), F.lit(0.0))


def _or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def _describe_pairs(stats: DataFrame, wh: Warehouse) -> DataFrame:
    """Attach student, course and assignment totals; all joins are at pair grain."""
    students = wh.students.select("student_id", "student_name", "student_email")
    courses = wh.courses.select("course_id", "course_name")
    totals = course_assignment_totals(wh.assignments)
    return (
        stats.join(students, "student_id")
        .join(courses, "course_id")
        .join(totals, "course_id", "left")
    )


def training_dataset(
    wh: Warehouse,
    fraction: tuple[int, int] = (6, 10),
    pass_mark: float = 5,
    as_of: Column | None = None,
    extra: dict[str, Column] | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Feature table with label, one row per (student, course); from ``both_statistics`` where they
    are at hand.

    ``course_load`` is the number of submissions of the student over all courses. It is a
    window over the pair rows: a student has at most one row per course.
    """
    stats = pair_statistics(wh, "due", fraction, as_of) if stats is None else stats
    of_student = Window.partitionBy("student_id")
    stats = stats.withColumn("course_load", F.sum("n").over(of_student))
    course_avg = E.avg_of_micros(F.col("micros"), F.col("graded_n"))
    return _describe_pairs(stats, wh).select(
        "student_id",
        "student_name",
        "student_email",
        "course_id",
        "course_name",
        "course_load",
        F.col("n").alias("course_submission_count"),
        _or_zero(E.ratio(F.col("late_n"), F.col("n"))).alias("course_late_ratio"),
        _or_zero(E.avg_of_micros(F.col("early_micros"), F.col("early_graded_n"))).alias("early_avg_grade"),
        F.col("early_n").alias("early_submission_count"),
        _or_zero(E.ratio(F.col("early_late_n"), F.col("early_n"))).alias("early_late_ratio"),
        F.col("early_weeks").alias("active_weeks_early"),
        _or_zero(early_stddev()).alias("early_grade_stddev"),
        _or_zero(grade_trend()).alias("early_grade_trend"),
        _or_zero(avg_delay_early()).alias("avg_delay_hours"),
        F.col("last_14d").alias("submissions_last_14d"),
        F.col("last_30d").alias("submissions_last_30d"),
        completion_ratio().alias("assignment_completion_ratio"),
        _or_zero(course_avg).alias("course_final_avg"),
        tiers.at_risk_label(course_avg, pass_mark).alias("is_at_risk"),
        *[c.alias(name) for name, c in (extra or {}).items()],
    )


def student_course_features(
    wh: Warehouse,
    student_features: DataFrame,
    fraction: tuple[int, int] = (6, 10),
    as_of: Column | None = None,
    stats: DataFrame | None = None,
) -> DataFrame:
    """Dashboard feature table: early window by hand-in time, risk taken from the student; from
    ``both_statistics`` where they are at hand."""
    if stats is None:
        stats = pair_statistics(wh, "submitted", fraction, as_of)
    else:
        stats = stats.drop(*HANDED).withColumnsRenamed({f"handed_{c}": c for c in HANDED})
    risk = student_features.select("student_id", "risk_probability", "risk_bucket", "predicted_at_risk")
    return (
        _describe_pairs(stats, wh)
        .join(risk, "student_id", "left")
        .select(
            "student_id",
            "student_name",
            "student_email",
            "course_id",
            "course_name",
            _or_zero(E.avg_of_micros(F.col("micros"), F.col("graded_n"))).alias("course_final_avg"),
            F.col("n").alias("course_submission_count"),
            _or_zero(E.ratio(F.col("late_n"), F.col("n"))).alias("course_late_ratio"),
            _or_zero(E.avg_of_micros(F.col("early_micros"), F.col("early_graded_n"))).alias("early_avg_grade"),
            F.col("early_n").alias("early_submission_count"),
            _or_zero(E.ratio(F.col("early_late_n"), F.col("early_n"))).alias("early_late_ratio"),
            F.col("early_weeks").alias("active_weeks_early"),
            _or_zero(avg_delay_strict()).alias("avg_delay_hours"),
            F.col("last_14d").alias("submissions_last_14d"),
            F.col("last_30d").alias("submissions_last_30d"),
            completion_ratio().alias("assignment_completion_ratio"),
            F.lit(1).alias("course_load"),
            _or_zero(F.col("risk_probability")).alias("risk_probability"),
            F.coalesce("risk_bucket", F.lit("low")).alias("risk_bucket"),
            F.coalesce("predicted_at_risk", F.lit(0)).alias("predicted_at_risk"),
        )
    )


def courses_enrolled(facts: DataFrame) -> DataFrame:
    """Number of courses a student has handed work in for."""
    return facts.groupBy("student_id").agg(F.count_distinct("course_id").alias("courses_enrolled"))


def score_by_average(graded_n: Column, micros: Column) -> Column:
    """Fixed scoring rule 1 - average / 10; null without any grade."""
    full = graded_n * (10 * E.UNIT)
    return E.ratio(full - F.coalesce(micros, F.lit(0)), full)


def scored_pairs(wh: Warehouse, **options) -> DataFrame:
    """Training rows scored by the fixed rule, shaped like the model output."""
    score = score_by_average(F.col("graded_n"), F.col("micros"))
    scored = training_dataset(wh, extra={"risk_probability": score}, **options)
    flag = F.when(F.col("risk_probability") >= 0.5, 1).otherwise(0)
    return scored.withColumn("predicted_at_risk", flag)


