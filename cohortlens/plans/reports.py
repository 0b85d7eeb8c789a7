"""Reporting queries over the warehouse tables and the published marts.

Fact-level reports aggregate before any join, so joins only meet rows at student, course or
pair grain and a popular key never travels at fact grain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions import exprs as E
from cohortlens.functions import tiers
from cohortlens.operators.ranking import last_n
from cohortlens.plans import marts
from cohortlens.plans.features import latest_submission, student_course_features
from cohortlens.session import ensure_checkpoint_dir
from cohortlens.warehouse import Warehouse


def _sums() -> list[Column]:
    return [
        F.count("*").alias("n"),
        F.count_if("late").alias("late_n"),
        F.count("grade").alias("graded_n"),
        F.sum(E.micros("grade")).alias("micros"),
    ]


def _avg() -> Column:
    return E.avg_of_micros(F.col("micros"), F.col("graded_n"))


def _late() -> Column:
    return E.ratio(F.col("late_n"), F.col("n"))


def _zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def _one_row(spark, **columns: DataFrame) -> DataFrame:
    """One row of scalar subqueries, each given as a one-cell frame."""
    return spark.range(1).select(*[df.scalar().alias(name) for name, df in columns.items()])


def _figures(*rows: DataFrame) -> DataFrame:
    """One-row frames side by side. Each is one scalar subquery, so one pass gives all its
    figures."""
    packed = [r.select(F.struct(*r.columns).alias("s")).scalar().alias(f"s{i}") for i, r in enumerate(rows)]
    return rows[0].sparkSession.range(1).select(*packed).select(*[f"s{i}.*" for i in range(len(rows))])


# -- summaries ------------------------------------------------------------------------------
def student_summary(wh: Warehouse) -> DataFrame:
    avg = _avg()
    return (
        wh.facts.groupBy("student_id")
        .agg(*_sums())
        .join(wh.students, "student_id")
        .select(
            "student_id",
            "student_name",
            "student_email",
            _zero(avg).alias("avg_grade"),
            F.col("n").alias("submission_count"),
            F.col("late_n").alias("late_count"),
            _zero(_late()).alias("late_ratio"),
            tiers.grade_two_level(avg).alias("risk_bucket"),
        )
    )


def overview_counts(wh: Warehouse) -> DataFrame:
    count = F.count("*").alias("n")
    return _one_row(
        wh.facts.sparkSession,
        total_students=wh.students.agg(count),
        total_courses=wh.courses.agg(count),
        total_submissions=wh.facts.agg(count),
    )


def course_students_count(facts: DataFrame) -> DataFrame:
    """Distinct students per course, deduplicated at pair grain before the course is met."""
    return (
        facts.groupBy("course_id", "student_id")
        .agg(F.count("*").alias("_n"))
        .groupBy("course_id")
        .agg(F.count("student_id").alias("student_count"))
    )


def _course_sums(facts: DataFrame) -> DataFrame:
    """Course sums and distinct students from one pass: pair grain first, then course."""
    pair = facts.groupBy("course_id", "student_id").agg(*_sums())
    return pair.groupBy("course_id").agg(
        *[F.sum(c).alias(c) for c in ("n", "late_n", "graded_n", "micros")],
        F.count("student_id").alias("student_count"),
    )


def course_summary(wh: Warehouse) -> DataFrame:
    return (
        _course_sums(wh.facts)
        .join(wh.courses.select("course_id", "course_name"), "course_id")
        .select(
            "course_id",
            "course_name",
            _zero(_avg()).alias("avg_grade"),
            _zero(_late()).alias("late_ratio"),
            "student_count",
            F.col("n").alias("submission_count"),
        )
        .orderBy("course_id")
    )


def _weekly(facts: DataFrame) -> DataFrame:
    return facts.groupBy(E.week_start(F.col("submitted_at")).alias("week")).agg(*_sums())


def weekly_trends_of(sums: DataFrame) -> DataFrame:
    """Weekly report from per-week sums (also the read side of the incremental version)."""
    return sums.select(
        "week",
        _zero(_avg()).alias("avg_grade"),
        _zero(_late()).alias("late_ratio"),
        F.col("n").alias("submissions"),
    ).orderBy("week")


def weekly_trends(facts: DataFrame) -> DataFrame:
    return weekly_trends_of(_weekly(facts))


def weekly_trends_rounded(facts: DataFrame) -> DataFrame:
    """Nulls are kept for weeks without any grade."""
    return (
        _weekly(facts)
        .select(
            "week",
            E.rounded_avg(F.col("micros"), F.col("graded_n")).alias("avg_grade"),
            E.rounded_ratio(F.col("late_n"), F.col("n")).alias("late_ratio"),
            F.col("n").alias("submissions"),
        )
        .orderBy("week")
    )


def course_risk_late_matrix(scores: DataFrame, courses: DataFrame) -> DataFrame:
    """Unweighted mean of the pairs' late ratios, which the scores hold, per course name and risk
    bucket."""
    return (
        scores.select("course_id", "risk_bucket", "course_late_ratio")
        .join(courses.select("course_id", "course_name"), "course_id")
        .groupBy("course_name", "risk_bucket")
        .agg(_zero(E.stable_mean(F.col("course_late_ratio"))).alias("late_ratio"))
        .orderBy("course_name", "risk_bucket")
    )


# -- overview and course reports ------------------------------------------------------------
def overview(student_features: DataFrame, courses: DataFrame, facts: DataFrame) -> DataFrame:
    recent = E.within_last(F.col("submitted_at"), F.col("_latest"), 7 * 24)
    seen = facts.withColumn("_latest", latest_submission(facts)).agg(
        F.count("*").alias("total_submissions"), F.count_if(recent).alias("submissions_last_7d")
    )
    row = _figures(
        student_features.agg(
            F.count("*").alias("total_students"),
            F.count_if(F.col("predicted_at_risk") == 1).alias("total_at_risk"),
        ),
        courses.agg(F.count("*").alias("total_courses")),
        seen,
    )
    share = E.ratio(F.col("total_at_risk"), F.col("total_students"))
    return row.withColumn("at_risk_ratio", F.coalesce(share, F.lit(0.0)))


def course_report(wh: Warehouse, risk_by_course: DataFrame) -> DataFrame:
    """Every course, also without submissions or predictions, with rounded figures."""
    risk = risk_by_course.select("course_id", "at_risk_students", "total_students", "at_risk_ratio")
    return (
        wh.courses.select("course_id", "course_name")
        .join(_course_sums(wh.facts), "course_id", "left")
        .join(risk, "course_id", "left")
        .select(
            "course_id",
            "course_name",
            _zero(E.rounded_avg(F.col("micros"), F.col("graded_n"))).alias("avg_grade"),
            _zero(E.rounded_ratio(F.col("late_n"), F.col("n"))).alias("late_ratio"),
            _zero(F.col("student_count")).alias("student_count"),
            _zero(F.col("n")).alias("total_submissions"),
            _zero(F.col("at_risk_students")).alias("at_risk_students"),
            _zero(F.col("total_students")).alias("total_students"),
            _zero(
                E.rounded_ratio(F.col("at_risk_students"), F.col("total_students"))
            ).alias("at_risk_ratio"),
        )
        .orderBy(F.asc_nulls_last("course_id"))
    )


def _riskiest(rows: DataFrame, keys: list[str], limit: int | None) -> DataFrame:
    """The first rows by risk; without a limit all of them, in no order."""
    return rows if limit is None else rows.orderBy(F.desc_nulls_first("risk_probability"), *keys).limit(limit)


def top_risk_students(student_features: DataFrame, limit: int | None = 20) -> DataFrame:
    return (
        _riskiest(student_features, ["student_id"], limit)
        .select(
            "student_id",
            "student_name",
            "student_email",
            E.rounded(F.col("avg_grade"), 2).alias("avg_grade"),
            "submission_count",
            E.rounded(F.col("late_submission_ratio"), 4).alias("late_submission_ratio"),
            "risk_probability",
            "risk_bucket",
            "predicted_at_risk",
        )
    )


# Places kept by the student list of a course.
_COURSE_STUDENT_DIGITS = {
    "course_final_avg": 2, "course_late_ratio": 4, "early_avg_grade": 2, "early_late_ratio": 4,
    "avg_delay_hours": 2, "assignment_completion_ratio": 4,
}


def course_students(
    student_courses: DataFrame, course_id: int | None = None, limit: int | None = None
) -> DataFrame:
    """Riskiest students of one course, or of all courses when no course is given."""
    rows = student_courses
    if course_id is not None:
        rows = rows.filter(F.col("course_id") == course_id)
    digits = _COURSE_STUDENT_DIGITS
    return (
        _riskiest(rows, ["student_id", "course_id"], limit)
        .withColumns({c: E.rounded(F.col(c), d) for c, d in digits.items()})
    )


def student_distribution(student_features: DataFrame) -> DataFrame:
    tier = tiers.grade_and_lateness(F.col("avg_grade"), F.col("late_submission_ratio"))
    return (
        student_features.groupBy(tier.alias("risk_bucket"))
        .agg(
            F.count("*").alias("count"),
            E.rounded(E.stable_mean(F.col("avg_grade")), 2).alias("avg_grade"),
        )
        .orderBy("risk_bucket")
    )


def late_heatmap(facts: DataFrame) -> DataFrame:
    ts = F.col("submitted_at")
    return (
        facts.filter(ts.isNotNull())
        .groupBy(E.day_of_week(ts).alias("day_of_week"), F.hour(ts).alias("hour"))
        .agg(E.rounded_ratio(F.count_if("late"), F.count("*")).alias("late_ratio"))
        .orderBy("day_of_week", "hour")
    )


def grade_histogram(student_features: DataFrame) -> DataFrame:
    bucket = E.grade_bucket(F.col("avg_grade"))
    return (
        student_features.groupBy(bucket.alias("bucket"))
        .agg(F.count("*").alias("count"))
        .select("bucket", E.grade_bucket_label(F.col("bucket")).alias("label"), "count")
        .orderBy("bucket")
    )


def assignment_completion(wh: Warehouse) -> DataFrame:
    """Share of graded submissions per course, with distinct assignments and students.

    The two distinct counts come from two reductions to (course, assignment) and
    (course, student), so no row is expanded and no course gathers its raw rows.
    """
    by_assignment = (
        wh.facts.groupBy("course_id", "assignment_id")
        .agg(F.count("*").alias("n"), F.count("grade").alias("graded_n"))
        .groupBy("course_id")
        .agg(
            F.count("assignment_id").alias("total_assignments"),
            F.sum("n").alias("total_submissions"),
            F.sum("graded_n").alias("graded_n"),
        )
    )
    students = course_students_count(wh.facts)
    return (
        wh.courses.select("course_name", "course_id")
        .join(by_assignment, "course_id", "left")
        .join(students, "course_id", "left")
        .select(
            "course_name",
            "course_id",
            _zero(F.col("total_assignments")).alias("total_assignments"),
            _zero(F.col("total_submissions")).alias("total_submissions"),
            _zero(F.col("student_count")).alias("total_students"),
            _zero(
                E.rounded_ratio(F.col("graded_n"), F.col("total_submissions"))
            ).alias("completion_rate"),
        )
        .orderBy("course_id")
    )


def student_trend(facts: DataFrame, student_id: int | None = None) -> DataFrame:
    """Weekly graded work of one student, or of every student in one pass."""
    rows = facts.filter(F.col("grade").isNotNull())
    if student_id is not None:
        rows = rows.filter(F.col("student_id") == student_id)
    return (
        rows.groupBy("student_id", E.week_start(F.col("submitted_at")).alias("week"))
        .agg(*_sums())
        .select(
            "student_id",
            "week",
            E.rounded_avg(F.col("micros"), F.col("graded_n")).alias("avg_grade"),
            F.col("n").alias("submissions"),
            F.col("late_n").alias("late_count"),
        )
        .orderBy("student_id", "week")
    )


def course_comparison(wh: Warehouse) -> DataFrame:
    """Grade metrics over graded rows, enrolment over all rows, every course kept."""
    graded = F.col("grade").isNotNull()
    grade = E.micros("grade")
    pair = wh.facts.groupBy("course_id", "student_id").agg(
        F.count("grade").alias("graded_n"),
        F.sum(grade).alias("micros"),
        F.try_sum(F.try_multiply(grade, grade)).alias("squares"),
        F.count_if(graded & F.col("late")).alias("late_n"),
        F.max(F.when(graded, F.col("submitted_at"))).alias("last_activity"),
    )
    sums = pair.groupBy("course_id").agg(
        *[F.sum(c).alias(c) for c in ("graded_n", "micros", "late_n")],
        F.try_sum("squares").alias("squares"),
        F.max("last_activity").alias("last_activity"),
        F.count("student_id").alias("enrolled_students"),
    )
    n, total = F.col("graded_n"), F.col("micros")
    spread = E.stddev_samp_of_micros(n, total, F.col("squares"))
    return (
        wh.courses.select("course_id", "course_name")
        .join(sums, "course_id", "left")
        .select(
            "course_id",
            "course_name",
            _zero(E.rounded_avg(total, n)).alias("avg_grade"),
            _zero(E.rounded(spread, 2)).alias("grade_stddev"),
            _zero(n).alias("total_submissions"),
            _zero(F.col("enrolled_students")).alias("enrolled_students"),
            _zero(E.rounded_ratio(F.col("late_n"), n)).alias("late_ratio"),
            "last_activity",
        )
        .orderBy("course_id")
    )


def top_performers(student_features: DataFrame, limit: int = 10) -> DataFrame:
    return (
        student_features.filter(F.col("avg_grade").isNotNull())
        .orderBy(F.desc("avg_grade"), F.desc("submission_count"), "student_id")
        .limit(limit)
        .select(
            "student_id",
            "student_name",
            "student_email",
            E.rounded(F.col("avg_grade"), 2).alias("avg_grade"),
            "submission_count",
            E.rounded(F.col("late_submission_ratio"), 4).alias("late_submission_ratio"),
            "risk_probability",
            "predicted_at_risk",
        )
    )


def recent_activity(facts: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Submissions and active students in the last 24 hours and 7 days.

    Reduced to one row per student first, so the distinct counts become plain counts.
    """
    latest = latest_submission(facts) if as_of is None else as_of
    ts = F.col("submitted_at")
    flagged = facts.withColumn("_latest", latest)
    per_student = flagged.groupBy("student_id").agg(
        F.count_if(E.within_last(ts, F.col("_latest"), 24)).alias("day"),
        F.count_if(E.within_last(ts, F.col("_latest"), 7 * 24)).alias("week"),
    )
    known = F.col("student_id").isNotNull()
    return per_student.agg(
        _zero(F.sum("day")).alias("submissions_24h"),
        _zero(F.sum("week")).alias("submissions_7d"),
        F.count_if(known & (F.col("day") > 0)).alias("active_students_24h"),
        F.count_if(known & (F.col("week") > 0)).alias("active_students_7d"),
    )


def activity_trend(activity: DataFrame) -> DataFrame:
    trend = E.activity_trend(F.col("submissions_24h"), F.col("submissions_7d"))
    return activity.withColumn("trend_percent", trend)


# -- one student, all students --------------------------------------------------------------
def student_course_vs_class(
    student_courses: DataFrame, facts: DataFrame, student_id: int | None = None
) -> DataFrame:
    """Each student-course row beside the class average, in no order."""
    class_avg = facts.groupBy("course_id").agg(*_sums())
    rows = student_courses
    if student_id is not None:
        rows = rows.filter(F.col("student_id") == student_id)
    student = E.rounded(F.col("course_final_avg"), 2)
    joined = rows.join(class_avg, "course_id", "left")
    klass = E.rounded_avg(F.col("micros"), F.col("graded_n"))
    return joined.select(
        "student_id",
        "course_id",
        E.course_name_or_default(F.col("course_name"), F.col("course_id")).alias("course_name"),
        student.alias("student_avg"),
        klass.alias("class_avg"),
        (F.floor((student - klass) * 100 + 0.5) / 100).alias("diff_to_class"),
        E.rounded(F.col("course_late_ratio"), 4).alias("student_late_ratio"),
        F.col("course_submission_count").alias("student_submissions"),
        "risk_probability",
        "risk_bucket",
        "predicted_at_risk",
    )


def worst_courses_first(vs_class: DataFrame) -> DataFrame:
    """For a reader: a distributed range sort, which no operator above should carry."""
    return vs_class.orderBy(F.asc_nulls_last("student_avg"), "student_id", "course_id")


def student_profile(student_features: DataFrame, student_id: int) -> DataFrame:
    return student_features.filter(F.col("student_id") == student_id).limit(1).select(
        "student_id", "student_name", "avg_grade", "late_submission_ratio", "submission_count",
        "risk_probability", "risk_bucket", "predicted_at_risk",
    )


def best_and_worst_course(vs_class: DataFrame) -> DataFrame:
    """Best and worst course of every student by average; ties go to the lower course id.

    ``max_by``/``min_by`` combine on the map side, so no student's rows are gathered.
    """
    avg, course = F.col("student_avg"), F.col("course_id")
    return (
        vs_class.filter(avg.isNotNull())
        .groupBy("student_id")
        .agg(
            F.max_by("course_name", F.struct(avg, -course)).alias("best_course"),
            F.max("student_avg").alias("best_avg"),
            F.min_by("course_name", F.struct(avg, course)).alias("worst_course"),
            F.min("student_avg").alias("worst_avg"),
            F.min_by("student_late_ratio", F.struct(avg, course)).alias("worst_late_ratio"),
        )
    )


def course_chart(vs_class: DataFrame, limit: int = 5, ascending: bool = False) -> DataFrame:
    """First ``limit`` courses per student by average, in either direction."""
    by = F.asc("student_avg") if ascending else F.desc("student_avg")
    rows = vs_class.filter(F.col("student_avg").isNotNull())
    return last_n(rows, ["student_id"], [by, F.asc("course_id")], limit).select(
        "student_id", "course_id", "course_name", "student_avg", "class_avg"
    )


def teacher_course_stats(
    courses: DataFrame, student_courses: DataFrame, teacher_id: int | None = None
) -> DataFrame:
    """Students and flagged students of each course a teacher runs."""
    own = courses.filter(F.col("teacher_id").isNotNull())
    if teacher_id is not None:
        own = courses.filter(F.col("teacher_id") == teacher_id)
    per_course = student_courses.groupBy("course_id").agg(
        F.count("student_id").alias("total_students"),
        F.count_if(F.col("predicted_at_risk") == 1).alias("at_risk_students"),
    )
    return (
        own.join(per_course, "course_id")
        .groupBy("teacher_id", "course_name")
        .agg(
            F.sum("total_students").alias("total_students"),
            F.sum("at_risk_students").alias("at_risk_students"),
        )
    )


def platform_counts(student_features: DataFrame, courses: DataFrame, facts: DataFrame) -> DataFrame:
    return _figures(
        student_features.agg(
            F.count("*").alias("total_students"),
            F.count_if(F.col("predicted_at_risk") == 1).alias("at_risk_students"),
        ),
        courses.agg(F.count("*").alias("total_courses")),
        facts.agg(F.count("*").alias("total_submissions")),
    )


# -- lists, filters and small metrics -------------------------------------------------------
def worst_pairs(scores: DataFrame, limit: int = 25) -> DataFrame:
    return (
        scores.orderBy(F.desc_nulls_first("risk_probability"), "student_id", "course_id")
        .limit(limit)
        .select(
            "student_id", "student_name", "student_email", "course_id", "course_name",
            "avg_grade", "course_final_avg", "submission_count", "late_submission_ratio",
            "risk_probability", "risk_bucket",
        )
    )


def scores_by_risk(scores: DataFrame) -> DataFrame:
    """The whole score table, riskiest first: a distributed range sort."""
    return scores.orderBy(F.desc_nulls_first("risk_probability"), "student_id", "course_id")


def top_by_grade(student_features: DataFrame, limit: int = 20) -> DataFrame:
    return (
        student_features.orderBy(F.desc_nulls_last("avg_grade"), "student_id")
        .limit(limit)
        .select("student_id", "student_name", "avg_grade", "risk_bucket")
    )


def top_pairs_by_risk(scores: DataFrame, limit: int = 10) -> DataFrame:
    label = F.concat("student_name", F.lit(" ("), "course_name", F.lit(")"))
    return (
        scores.orderBy(F.desc_nulls_last("risk_probability"), "student_id", "course_id")
        .limit(limit)
        .select(label.alias("label"), "risk_probability")
    )


def high_risk(rows: DataFrame, threshold: float = 0.7) -> DataFrame:
    return rows.filter(F.col("risk_probability") >= threshold)


def best_courses(course_report: DataFrame, limit: int = 3) -> DataFrame:
    return (
        course_report.orderBy(F.desc("avg_grade"), "course_id")
        .limit(limit)
        .select("course_id", "course_name", "avg_grade")
    )


def tier_by_grade_and_lateness() -> Column:
    """Tier of a student-course row; a missing value counts as 0."""
    grade = E.first_truthy(F.col("course_final_avg"))
    return tiers.grade_and_lateness(grade, E.first_truthy(F.col("course_late_ratio")))


def student_search(student_courses: DataFrame, term: str = "", tier: str = "all") -> DataFrame:
    """Case-insensitive substring of the name, and the tier unless it is ``all``."""
    name = F.lower(F.coalesce("student_name", F.lit("")))
    rows = student_courses.filter(name.contains(term.lower()))
    return rows if tier == "all" else rows.filter(tier_by_grade_and_lateness() == tier)


# Half-open risk ranges of the course search; a ratio of 1 matches none.
COURSE_RISK_RANGES = {"low": (0.0, 0.15), "medium": (0.15, 0.3), "high": (0.3, 1.0)}
COURSE_SORTS = {
    "name": [F.asc, "course_name"],
    "avg_grade": [F.desc, "avg_grade"],
    "student_count": [F.desc, "student_count"],
    "risk": [F.desc, "at_risk_ratio"],
}


def course_search(
    course_report: DataFrame, term: str = "", tier: str = "all", sort: str = "name"
) -> DataFrame:
    rows = course_report.filter(F.lower("course_name").contains(term.strip().lower()))
    risk = _zero(F.col("at_risk_ratio"))
    if tier != "all":
        low, high = COURSE_RISK_RANGES[tier]
        rows = rows.filter((risk >= low) & (risk < high))
    direction, column = COURSE_SORTS[sort]
    key = F.col(column) if sort == "name" else _zero(F.col(column))
    return rows.orderBy(direction(key), "course_id")


def progress_rates(comparison: DataFrame, per_student: int = 20) -> DataFrame:
    """Submissions per student against the expected number; bands use the uncapped rate."""
    rate = E.progress_rate(F.col("total_submissions"), F.col("enrolled_students"), per_student)
    return comparison.select(
        "course_id",
        "course_name",
        E.capped(rate).alias("progress_rate"),
        tiers.progress_band(rate).alias("band"),
        E.capped(F.col("avg_grade") * 10).alias("grade_bar"),
    )


def course_feature_means(student_courses: DataFrame) -> DataFrame:
    """Mean of eight features per course over all its students, a missing value as 0."""
    features = [
        "early_avg_grade", "early_submission_count", "early_late_ratio", "avg_delay_hours",
        "assignment_completion_ratio", "submissions_last_14d", "submissions_last_30d", "course_load",
    ]
    means = [E.stable_mean(_zero(F.col(c)).cast("double")).alias(c) for c in features]
    flagged = F.count_if(F.col("predicted_at_risk") == 1)
    return student_courses.groupBy("course_id").agg(
        F.count("*").alias("students"),
        *means,
        E.stable_mean(_zero(F.col("course_final_avg"))).alias("avg_grade"),
        E.ratio(flagged, F.count("*")).alias("at_risk_ratio"),
    )


def platform_means(wh: Warehouse, student_features: DataFrame) -> DataFrame:
    """Mean of course means, submissions per student and share of students not at risk.

    One pass over the submissions, reduced to courses, gives the first two.
    """
    sums = _course_sums(wh.facts)
    shown = wh.courses.select("course_id").join(sums, "course_id", "left")
    mean = _zero(E.rounded_avg(F.col("micros"), F.col("graded_n")))
    courses = shown.agg(_zero(E.stable_mean(mean)).alias("avg_of_course_avgs"))
    submissions = sums.agg(_zero(F.sum("n")).alias("submissions"))
    students = student_features.agg(
        F.count("*").alias("students"), F.count_if(F.col("predicted_at_risk") == 1).alias("at_risk")
    )
    at_risk = _zero(E.ratio(F.col("at_risk"), F.col("students")))
    return students.select(
        courses.scalar().alias("avg_of_course_avgs"),
        _zero(E.ratio(submissions.scalar(), F.col("students"))).alias("submissions_per_student"),
        ((1 - at_risk) * 100).alias("safe_percent"),
    )


def tier_counts(student_courses: DataFrame) -> DataFrame:
    """Students per tier and course, tiers without students as 0."""
    tier = tier_by_grade_and_lateness()
    return student_courses.groupBy("course_id").agg(
        *[F.count_if(tier == t).alias(t) for t in tiers.TIERS]
    )


def weekly_course_averages(facts: DataFrame, courses: DataFrame) -> DataFrame:
    """Average grade per week and course; 0 where nothing was graded."""
    return (
        facts.groupBy("course_id", E.week_start(F.col("submitted_at")).alias("week"))
        .agg(*_sums())
        .join(courses.select("course_id", "course_name"), "course_id")
        .select("week", "course_id", "course_name", _zero(_avg()).alias("avg_grade"))
    )


def dashboard_bundle(
    wh: Warehouse,
    scored: DataFrame,
    students_limit: int | None = None,
    pairs_limit: int | None = None,
    stats: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """All dashboard reports over marts that are computed once and kept in a checkpoint; ``stats``
    are the ``both_statistics`` of the facts, if at hand.

    The limits cut the two long lists to the first rows a page shows; None keeps all.
    """
    ensure_checkpoint_dir(scored.sparkSession)
    pairs = scored.checkpoint()
    students = marts.student_features(pairs).checkpoint()
    student_courses = student_course_features(wh, students, stats=stats).checkpoint()
    ranked = top_risk_students(students, students_limit)
    return {
        "overview": overview(students, wh.courses, wh.facts),
        "courses": course_report(wh, marts.risk_by_course(pairs)),
        "students": ranked,
        "course_students": course_students(student_courses, None, pairs_limit),
        "top_students": top_risk_students(students, 20),
        "distribution": student_distribution(students),
        "trends": weekly_trends_rounded(wh.facts),
        "heatmap": late_heatmap(wh.facts),
        "histogram": grade_histogram(students),
        "assignments": assignment_completion(wh),
        "course_comparison": course_comparison(wh),
        "top_performers": top_performers(students, 10),
        "recent_activity": recent_activity(wh.facts),
    }
