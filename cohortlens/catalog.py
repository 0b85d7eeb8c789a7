"""Named queries over a folder of test tables; each takes (data) and returns a frame."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property, partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import schemas
from cohortlens.functions import exprs as E
from cohortlens.functions import text as X
from cohortlens.functions import tiers
from cohortlens.operators import cleaning, ranking, reshape
from cohortlens.plans import features, learning, marts, reports, sessions, sketches
from cohortlens.session import ensure_checkpoint_dir, prepare, scratch_path, shuffles_freed
from cohortlens.sources import fixtures, landing, tables
from cohortlens.streaming import activity as streams
from cohortlens.streaming import sessions as session_streams
from cohortlens.warehouse import Warehouse

Query = Callable[[SparkSession, str], DataFrame]


class Inputs:
    """Frames of one test folder, each built once however many parts of a query use it."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    @cached_property
    def wh(self) -> Warehouse:
        return fixtures.coursework(self.spark, self.folder)

    def kept(self, rows: DataFrame, label: str) -> DataFrame:
        """Rows written once to the shared folder, for what reads some of their columns several times."""
        path = scratch_path(self.spark, label)
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    @cached_property
    def stored(self) -> Warehouse:
        """The warehouse with its facts in a table, so that their joins run once."""
        return replace(self.wh, facts=self.kept(self.wh.facts, "facts"))

    @cached_property
    def stored_training(self) -> DataFrame:
        return self.kept(features.training_dataset(self.stored), "training")

    @cached_property
    def prepared(self) -> learning.Prepared:
        return learning.prepare(self.stored_training)

    @cached_property
    def both(self) -> DataFrame:
        """Pair sums with both early windows, computed once for the two tables made of them."""
        ensure_checkpoint_dir(self.spark)
        return features.both_statistics(self.wh).checkpoint()

    @cached_property
    def scored(self) -> DataFrame:
        return features.scored_pairs(self.wh)

    @cached_property
    def scores(self) -> DataFrame:
        return marts.student_course_scores(self.scored)

    @cached_property
    def students(self) -> DataFrame:
        return marts.student_features(self.scored)

    @cached_property
    def student_courses(self) -> DataFrame:
        students = marts.student_features(features.scored_pairs(self.wh, stats=self.both))
        return features.student_course_features(self.wh, students, stats=self.both)

    @cached_property
    def pairs(self) -> DataFrame:
        return features.pair_statistics(self.wh)

    @cached_property
    def report(self) -> DataFrame:
        return reports.course_report(self.wh, marts.risk_by_course(self.scored))

    @cached_property
    def training(self) -> DataFrame:
        return features.training_dataset(self.wh)

    @cached_property
    def matrix(self) -> DataFrame:
        return learning.matrix(self.training)

    @cached_property
    def fixed_matrix(self) -> DataFrame:
        """The matrix in a checkpoint, for what counts it several times."""
        ensure_checkpoint_dir(self.spark)
        return self.matrix.checkpoint()


Build = Callable[[Inputs], DataFrame]
_REGISTRY: dict[str, Query] = {}

COURSE_IDS = [1, 2, 3, 4, 5, 6]
COURSE_NAMES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def _plain(df: DataFrame) -> DataFrame:
    """Dates and times as text, decimals as doubles and integers as bigint, for comparison."""
    columns = []
    for field in df.schema:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, T.ArrayType):
            column = F.array_join(column, ",")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def _register(name: str) -> Callable[[Build], Build]:
    def add(build: Build) -> Build:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return _plain(build(Inputs(prepare(spark), folder)))

        _REGISTRY[name] = run
        return build

    return add


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# -- features -------------------------------------------------------------------------------
@_register("p1_training_dataset")
def training_dataset(data):
    return data.training


@_register("p2_student_course_features")
def student_course_features(data):
    return data.student_courses


def _ranks(data, by):
    ranked = ranking.union_all(features.ranked_submissions(data.wh, by))
    return ranked.select("student_id", "course_id", "submission_id", "rn", "total_count", "is_early")


@_register("w1_early_rank")
def early_rank(data):
    return _ranks(data, "due").drop("is_early")


@_register("w2_early_rank_by_submit")
def early_rank_by_submit(data):
    return _ranks(data, "submitted").drop("is_early")


@_register("w5_early_window")
def early_window(data):
    return _ranks(data, "due").filter("is_early").drop("is_early")


@_register("j9_semi_early")
def early_by_submit(data):
    return _ranks(data, "submitted").filter("is_early").groupBy("student_id", "course_id").agg(
        F.count("*").alias("early_submission_count"), F.max("submission_id").alias("last_submission")
    )


@_register("a8_delay_early")
def delay_early(data):
    return data.pairs.select(
        "student_id", "course_id", features.avg_delay_early().alias("avg_delay_hours")
    )


@_register("a8_delay_strict")
def delay_strict(data):
    return data.pairs.select(
        "student_id", "course_id", features.avg_delay_strict().alias("avg_delay_hours")
    )


@_register("a9_stddev_pop")
def stddev_pop(data):
    return data.pairs.select(
        "student_id", "course_id", features.early_stddev().alias("early_grade_stddev")
    )


@_register("a11_grade_trend")
def grade_trend(data):
    return data.pairs.select(
        "student_id", "course_id", features.grade_trend().alias("early_grade_trend")
    )


@_register("f6_recency_14_30")
def recency(data):
    return data.pairs.select("student_id", "course_id", "last_14d", "last_30d")


@_register("a27_completion_ratio")
def completion(data):
    totals = features.course_assignment_totals(data.wh.assignments)
    return data.pairs.join(totals, "course_id", "left").select(
        "student_id", "course_id", "assignments_done",
        features.completion_ratio().alias("assignment_completion_ratio"),
    )


@_register("d1_courses_enrolled")
def courses_enrolled(data):
    return features.courses_enrolled(data.wh.facts)


@_register("j12_named_submissions")
def named_submissions(data):
    wh = data.wh
    return wh.facts.join(wh.students.select("student_id", "student_name"), "student_id", "left").select(
        "submission_id", "student_id", "course_id", "assignment_id", "late", "submitted_at",
        E.micros("grade").cast("bigint").alias("micros"), "student_name",
    )


@_register("f4_delay_hours")
def delay_hours(data):
    wh = data.wh
    due = wh.assignments.select("assignment_id", "due_at")
    ts = F.col("submitted_at")
    return wh.facts.join(due, "assignment_id", "left").select(
        "submission_id",
        E.hours_between(ts, F.col("due_at")).alias("hours_after_deadline"),
        E.epoch_seconds(ts).alias("epoch_seconds"),
        E.week_start(ts).alias("week"),
        E.day_of_week(ts).alias("day_of_week"),
        F.hour(ts).alias("hour"),
    )


# -- summaries ------------------------------------------------------------------------------
@_register("p8_student_summary")
def student_summary(data):
    return reports.student_summary(data.wh)


@_register("p8_full_precision")
def full_precision(data):
    """The student summary over grades with six places, many of them just below the pass mark."""
    return reports.student_summary(replace(data.wh, facts=fixtures.fine_grades(data.wh.facts)))


@_register("a9_full_precision")
def full_precision_spread(data):
    """Spread and slope over the same grades."""
    wh = replace(data.wh, facts=fixtures.fine_grades(data.wh.facts))
    return features.pair_statistics(wh).select(
        "student_id", "course_id", F.coalesce(features.early_stddev(), F.lit(0.0)).alias("early_grade_stddev"),
        F.coalesce(features.grade_trend(), F.lit(0.0)).alias("early_grade_trend"),
    )


@_register("p9_overview_counts")
def overview_counts(data):
    return reports.overview_counts(data.wh)


@_register("p10_course_summary")
def course_summary(data):
    return reports.course_summary(data.wh)


@_register("p11_weekly_trends")
def weekly_trends(data):
    return reports.weekly_trends(data.wh.facts)


@_register("p12_course_risk_late_matrix")
def course_risk_late_matrix(data):
    return reports.course_risk_late_matrix(data.scores, data.wh.courses)


@_register("p17_student_distribution")
def student_distribution(data):
    return reports.student_distribution(data.students)


@_register("p20_grade_histogram")
def grade_histogram(data):
    return reports.grade_histogram(data.students)


@_register("p21_assignment_completion")
def assignment_completion(data):
    return reports.assignment_completion(data.wh)


@_register("p23_course_comparison")
def course_comparison(data):
    return reports.course_comparison(data.wh)


@_register("a23_course_feature_means")
def course_feature_means(data):
    return reports.course_feature_means(data.student_courses)


@_register("a24_platform_means")
def platform_means(data):
    return reports.platform_means(data.wh, data.students)


@_register("a25_tier_counts")
def tier_counts(data):
    return reports.tier_counts(data.student_courses)


@_register("a26_equal_width_histogram")
def equal_width_histogram(data):
    return reshape.equal_width_histogram(data.students, "avg_grade")


# -- activity -------------------------------------------------------------------------------
@_register("p18_weekly_trends_rounded")
def weekly_trends_rounded(data):
    return reports.weekly_trends_rounded(fixtures.activity(data.spark, data.folder))


@_register("p11_weekly_trends_activity")
def weekly_trends_activity(data):
    return reports.weekly_trends(fixtures.activity(data.spark, data.folder))


@_register("p19_late_heatmap")
def late_heatmap(data):
    return reports.late_heatmap(fixtures.activity(data.spark, data.folder))


@_register("p25_recent_activity")
def recent_activity(data):
    return reports.recent_activity(fixtures.activity(data.spark, data.folder))


@_register("f12_activity_trend")
def activity_trend(data):
    return reports.activity_trend(reports.recent_activity(fixtures.activity(data.spark, data.folder)))


# -- per entity -----------------------------------------------------------------------------
@_register("p16_course_students")
def course_students(data):
    return reports.course_students(data.student_courses, course_id=1, limit=50)


@_register("p22_student_trend")
def student_trend(data):
    return reports.student_trend(data.wh.facts)


@_register("p24_top_performers")
def top_performers(data):
    return reports.top_performers(data.students, 10)


@_register("p27_student_course_vs_class")
def student_course_vs_class(data):
    return reports.student_course_vs_class(data.student_courses, data.wh.facts)


@_register("p28_student_profile")
def student_profile(data):
    return reports.student_profile(data.students, 7)


@_register("o7_top_by_grade")
def top_by_grade(data):
    return reports.top_by_grade(data.students)


@_register("o7_top_pairs_by_risk")
def top_pairs_by_risk(data):
    return reports.top_pairs_by_risk(data.scores)


@_register("o8_top3_courses")
def top3_courses(data):
    return reports.best_courses(data.report)


@_register("o10_best_worst_course")
def best_worst_course(data):
    return reports.best_and_worst_course(student_course_vs_class(data))


@_register("o10_course_chart")
def course_chart(data):
    return reports.course_chart(student_course_vs_class(data), limit=2)


@_register("c11_student_search")
def student_search(data):
    found = reports.student_search(data.student_courses, "cusTomer#00000000", "medium")
    return found.select("student_id", "course_id", "student_name", "course_final_avg", "course_late_ratio")


@_register("c12_course_search")
def course_search(data):
    return reports.course_search(data.report, "m", "high", "avg_grade")


@_register("o9_course_sorts")
def course_sorts(data):
    """The place of every course in each of the four sorts."""
    in_order = Window.orderBy("_place")
    places = [
        reports.course_search(data.report, sort=sort)
        .withColumn("_place", F.monotonically_increasing_id())
        .select(F.lit(sort).alias("sort"), "course_id", F.row_number().over(in_order).alias("place"))
        for sort in reports.COURSE_SORTS
    ]
    return reduce(DataFrame.unionByName, places)


@_register("c13_high_risk")
def high_risk(data):
    return reports.high_risk(data.students).select("student_id", "risk_probability")


@_register("f13_progress_rate")
def progress_rate(data):
    return reports.progress_rates(reports.course_comparison(data.wh))


# -- marts ----------------------------------------------------------------------------------
@_register("p3_student_course_scores_fixed")
def student_course_scores(data):
    return data.scores


@_register("p4_student_features")
def student_features(data):
    return data.students


@_register("p5_at_risk_rows")
def at_risk_rows(data):
    return marts.at_risk_rows(data.scores)


@_register("p6_risk_by_course")
def risk_by_course(data):
    return marts.risk_by_course(data.scored)


@_register("p13_overview")
def overview(data):
    wh = data.wh
    return reports.overview(data.students, wh.courses, wh.facts)


@_register("p14_course_report")
def course_report(data):
    return data.report


@_register("p15_top_risk")
def top_risk(data):
    return reports.top_risk_students(data.students, 20)


@_register("o5_scores_by_risk")
def scores_by_risk(data):
    return reports.scores_by_risk(data.scores).select(
        "student_id", "course_id", "risk_probability"
    )


@_register("o6_worst_25")
def worst_25(data):
    return reports.worst_pairs(data.scores)


@_register("p29_teacher_course_stats")
def teacher_course_stats(data):
    taught = data.wh.courses.withColumn("teacher_id", F.col("course_id") % 3)
    return reports.teacher_course_stats(taught, data.scores)


@_register("p30_platform_counts")
def platform_counts(data):
    wh = data.wh
    return reports.platform_counts(data.students, wh.courses, wh.facts)


@_register("p34_features_from_flagged")
def features_from_flagged(data):
    return marts.course_features_from_flagged(marts.at_risk_rows(data.scores))


@_register("a21_bucket_counts")
def bucket_counts(data):
    return marts.bucket_counts(data.students)


@_register("a22_risk_share")
def risk_share(data):
    return marts.risk_share(data.students)


def _number_sum(df: DataFrame) -> Column:
    """The sum over all number columns of a report, each value as whole ten-thousandths."""
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    total = reduce(lambda a, b: a + b, [F.coalesce(_ten_thousandths(F.col(c)), F.lit(0).cast("decimal(38,0)")) for c in numbers])
    return F.coalesce(F.sum(total), F.lit(0)).cast("double")


def _ten_thousandths(value: Column) -> Column:
    return F.floor(value.cast("double") * 10_000 + 0.5).cast("decimal(20,0)")


@_register("p26_dashboard_bundle")
def dashboard_bundle(data):
    """Rows of every result of the bundle, the sum of all their numbers and a digest of their texts,
    whatever their order."""
    told = []
    with shuffles_freed(data.spark):
        scored = features.scored_pairs(data.wh, stats=data.both)
        bundle = reports.dashboard_bundle(data.wh, scored, stats=data.both)
    for name, df in bundle.items():
        texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
        digest = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 8), 16, 10).cast("bigint")
        told.append(
            df.agg(
                F.lit(name).alias("report"),
                F.count("*").alias("rows"),
                _number_sum(df).alias("numbers"),
                (F.coalesce(F.sum(digest), F.lit(0)) if texts else F.lit(0)).cast("bigint").alias("texts"),
            )
        )
    return reduce(DataFrame.unionByName, told)


# -- pivots ---------------------------------------------------------------------------------
@_register("p31_course_pivot")
def course_pivot(data):
    return reshape.course_pivot(reports.course_summary(data.wh), COURSE_IDS)


@_register("p32_risk_course_pivot")
def risk_course_pivot(data):
    return reshape.risk_course_pivot(course_risk_late_matrix(data), COURSE_NAMES)


@_register("p33_week_course_stack")
def week_course_stack(data):
    wh = data.wh
    averages = reports.weekly_course_averages(wh.facts, wh.courses)
    return reshape.week_course_stack(averages, COURSE_NAMES)


# -- rules ----------------------------------------------------------------------------------
@_register("b_all_tiers")
def all_tiers(data):
    avg, late, p = (F.col(c) for c in ("course_final_avg", "course_late_ratio", "risk_probability"))
    return data.scores.select(
        "student_id",
        "course_id",
        tiers.grade_two_level(avg).alias("b1_grade"),
        tiers.probability_bins(p).alias("b2_bins"),
        tiers.grade_and_lateness(avg, late).alias("b3_grade_late"),
        tiers.course_ratio(late).alias("b4_ratio"),
        tiers.probability_display(p).alias("b5_display"),
        tiers.at_risk_label(avg).alias("b6_label"),
        tiers.tier_label(tiers.probability_bins(p)).alias("b2_display_label"),
    )


@_register("b7_risk_reasons")
def risk_reasons(data):
    columns = ("assignment_completion_ratio", "course_late_ratio", "early_grade_trend", "submissions_last_14d")
    reasons = tiers.risk_reasons(*[F.col(c) for c in columns])
    return data.scores.select("student_id", "course_id", reasons.alias("reasons"))


@_register("b8_study_tips")
def study_tips(data):
    students = data.students
    courses = reports.best_and_worst_course(student_course_vs_class(data))
    late, avg, p = (F.col(c) for c in ("late_submission_ratio", "avg_grade", "risk_probability"))
    focus = F.col("worst_course")
    tips = tiers.study_tips(late, avg, p, focus, F.col("worst_late_ratio"))
    return students.join(courses, "student_id", "left").select(
        "student_id",
        tips.alias("tips"),
        tiers.tips_for_intent(F.lit("lowest_course"), tips, focus).alias("lowest_course_tips"),
        tiers.tips_for_intent(F.lit("study_tips"), tips, focus).alias("study_tips"),
    )


@_register("c9_finite_features")
def finite_features(data):
    """The trend divided by the spread is null, NaN or infinite on many rows."""
    rows = data.pairs
    raw = features.grade_trend() / F.when(features.early_stddev() > 0, features.early_stddev()).otherwise(
        F.lit(float("nan"))
    )
    return rows.select("student_id", "course_id", E.finite_or_zero(raw).alias("relative_trend"))


@_register("c14_first_truthy")
def first_truthy(data):
    return data.scores.select(
        "student_id",
        "course_id",
        E.first_truthy(F.col("early_avg_grade"), F.col("course_final_avg")).alias("shown_grade"),
        E.first_truthy(F.col("early_late_ratio"), F.col("course_late_ratio")).alias("shown_late_ratio"),
    )


# -- landing and cleaning -------------------------------------------------------------------
@_register("c1_clean_students")
def clean_students(data):
    return cleaning.clean_students(fixtures.dirty_students(data.spark, data.folder))


@_register("c2_clean_assignments")
def clean_assignments(data):
    return cleaning.clean_assignments(fixtures.dirty_assignments(data.spark, data.folder))


@_register("c3_clean_submissions")
def clean_submissions(data):
    return cleaning.clean_submissions(fixtures.dirty_submissions(data.spark, data.folder))


@_register("c4_drop_reasons")
def drop_reasons(data):
    return cleaning.drop_reasons(fixtures.dirty_submissions(data.spark, data.folder))


@_register("c4_quarantine")
def quarantine(data):
    """Landed submissions read once, and what of them is kept and dropped, by reason."""
    path, name = scratch_path(data.spark, "submissions"), _table_name("outcomes")
    fixtures.landed_submissions(data.spark, data.folder).write.partitionBy("course_id").json(path)
    landed = landing.read_submissions(data.spark, path, told=True)
    tables.write_split(cleaning.submission_outcomes(landed), name, schemas.TYPED_SUBMISSIONS)
    kept = tables.read_table(data.spark, name).select("submission_id", F.lit("kept").alias("reason"))
    return kept.unionByName(tables.read_table(data.spark, f"{name}_rejects").select("submission_id", "reason"))


@_register("s1_read_courses")
def read_courses(data):
    path = scratch_path(data.spark, "courses")
    fixtures.landed_courses(data.spark, data.folder).write.json(path)
    return landing.read_courses(data.spark, path)


@_register("s2_read_students")
def read_students(data):
    path = scratch_path(data.spark, "students")
    fixtures.landed_students(data.spark, data.folder).write.json(path)
    return landing.read_students(data.spark, path).drop("ingest_seq")


@_register("s3_read_assignments")
def read_assignments(data):
    path = scratch_path(data.spark, "assignments")
    fixtures.landed_assignments(data.spark, data.folder).write.partitionBy("course_id").json(path)
    return landing.read_assignments(data.spark, path)


@_register("s4_read_submissions")
def read_submissions(data):
    path = scratch_path(data.spark, "submissions")
    fixtures.landed_submissions(data.spark, data.folder).write.partitionBy("course_id").json(path)
    return landing.missing_user_counts(landing.read_submissions(data.spark, path))


@_register("s4_flat_submissions")
def flat_submissions(data):
    path = scratch_path(data.spark, "submissions")
    fixtures.landed_submissions(data.spark, data.folder).write.partitionBy("course_id").json(path)
    return landing.read_submissions(data.spark, path)


def _table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


@_register("s8_refreshed_table")
def refreshed_table(data):
    """A table written, and then refreshed from its own rows."""
    name = _table_name("clean_submissions")
    typed = cleaning.clean_submissions(fixtures.dirty_submissions(data.spark, data.folder))
    tables.write_table(typed, name)
    tables.write_table(tables.read_table(data.spark, name), name)
    return tables.read_table(data.spark, name)


@_register("s9_replaced_table")
def replaced_table(data):
    """A table replaced by a query that reads it."""
    name = _table_name("clean_students")
    tables.create_or_replace_table(cleaning.clean_students(fixtures.dirty_students(data.spark, data.folder)), name)
    known = tables.read_table(data.spark, name)
    tables.create_or_replace_table(known.withColumn("name_length", F.length("student_name")), name)
    return tables.read_table(data.spark, name)


@_register("s10_exported_csv")
def exported_csv(data):
    """Clean assignments exported as CSV and read back."""
    folder = scratch_path(data.spark, "exports")
    rows = cleaning.clean_assignments(fixtures.dirty_assignments(data.spark, data.folder))
    path = tables.export_datasets({"assignments": rows.select("assignment_id", "course_id")}, folder)["assignments"]
    return data.spark.read.schema("assignment_id bigint, course_id bigint").csv(path, header=True)


@_register("s11_absent_table")
def absent_table(data):
    """A table that was never built reads as no rows beside one that was."""
    absent = tables.table_or_empty(data.spark, _table_name("absent"), schemas.DIM_STUDENTS)
    return cleaning.clean_students(fixtures.dirty_students(data.spark, data.folder)).unionByName(absent)


@_register("s5_page_guard")
def page_guard(data):
    pages = fixtures.landed_pages(data.spark, data.folder)
    return cleaning.pages_before_repeat(pages, "entity", "page_no", "payload").drop("payload")


@_register("s6_csv_round_trip")
def csv_round_trip(data):
    path = scratch_path(data.spark, "submissions-csv")
    landing.write_csv(fixtures.dirty_submissions(data.spark, data.folder), path, schemas.CSV_SUBMISSIONS)
    return cleaning.clean_submissions(landing.read_csv(data.spark, path, schemas.CSV_SUBMISSIONS))


# -- learning -------------------------------------------------------------------------------
@_register("m1_matrix")
def model_matrix(data):
    return data.matrix


@_register("m2_label_noise")
def label_noise(data):
    return learning.with_label_noise(data.fixed_matrix).select(
        *learning.KEY, "label", "flipped", "noisy_label"
    )


@_register("m3_split")
def split(data):
    noisy = learning.with_label_noise(data.fixed_matrix)
    return learning.with_split(noisy).select(*learning.KEY, "noisy_label", "is_test")


def _rounded_features(data: learning.Prepared) -> DataFrame:
    return data.rows.withColumns({c: F.round(c, 6) for c in schemas.FEATURE_COLUMNS})


@_register("m4_standardized")
def standardized(data):
    rows = _rounded_features(learning.prepare(data.training))
    return rows.select(*learning.KEY, *schemas.FEATURE_COLUMNS, "noisy_label", "is_test")


@_register("m9_knn")
def knn(data):
    rows = _rounded_features(learning.prepare(data.training))
    scored = learning.score_knn(rows.filter(~F.col("is_test")), rows.filter("is_test"))
    return scored.select(*learning.KEY, "risk_probability", "prediction")


def _rule_predictions(data: Inputs) -> DataFrame:
    """Labels with the predictions of fixed rules on early features."""
    rules: dict[str, Column] = {
        "early_avg_5": F.col("early_avg_grade") < 5,
        "early_avg_45": F.col("early_avg_grade") < 4.5,
        "early_avg_55": F.col("early_avg_grade") < 5.5,
        "late_40": F.col("early_late_ratio") > 0.4,
        "falling": F.col("early_grade_trend") < 0,
    }
    pairs = [v for name, rule in rules.items() for v in (F.lit(name), rule.cast("int"))]
    return data.matrix.select("label", F.explode(F.create_map(*pairs)).alias("model", "prediction"))


RULE_ORDER = ["falling", "late_40", "early_avg_45", "early_avg_5", "early_avg_55"]


@_register("m10_metrics")
def metrics(data):
    one = _rule_predictions(data).filter(F.col("model") == "early_avg_5")
    return learning.binary_metrics(one)


@_register("m11_class_report")
def class_report(data):
    one = _rule_predictions(data).filter(F.col("model") == "early_avg_5")
    return learning.class_report(one)


@_register("m12_comparison")
def model_comparison(data):
    return learning.comparison_long(learning.binary_metrics(_rule_predictions(data), ["model"]))


@_register("m12_best_model")
def best_model(data):
    compared = learning.binary_metrics(_rule_predictions(data), ["model"])
    return learning.best_model(compared, RULE_ORDER)


# What a fit must satisfy whatever it is, each a number computed from the fit and its bound.
BELOW_CONSTANT, RANKS, STATIONARY, EQUAL = 0.9, 0.75, 1e-4, 1e-9


def _told_of_fit(data: learning.Prepared, scorer: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The confusion counts of a fit, as far as they do not depend on the fit, and whether it is
    more often right than the larger class alone, ranks test rows by their clean label, and explains
    the train rows better than any constant."""
    scored = scorer(data.test).checkpoint()
    loss, constant = learning.log_loss(scorer(data.train))
    rows, positives = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"), F.col("tp") + F.col("fn")
    return learning.binary_metrics(scored, label="noisy_label").select(
        rows.alias("test_rows"),
        positives.alias("positives"),
        (F.col("accuracy") > F.greatest(positives, rows - positives) / rows).alias("beats_larger_class"),
        F.lit(learning.area_under_curve(scored) > RANKS).alias("ranks_by_label"),
        F.lit(loss < BELOW_CONSTANT * constant).alias("train_loss_below_constant"),
    )


def _test_metrics(model: str):
    def build(data):
        return _told_of_fit(data.prepared, learning.fit_with(model, data.prepared))

    return build


_register("m6_random_forest")(_test_metrics("Random Forest"))
_register("m7_gradient_boosting")(_test_metrics("Gradient Boosting"))
_register("m8_kernel_svm")(_test_metrics("SVM"))


@_register("m5_logistic_regression")
def logistic_regression(data):
    """The same, and whether the fit is where the penalized loss has no slope."""
    model = learning.fit_logistic(data.prepared.train)
    told = _told_of_fit(data.prepared, partial(learning.apply_model, model))
    slope = learning.logistic_gradient(model, data.prepared.train)
    return told.withColumn("stationary", F.lit(slope < STATIONARY))


def _is_near(column: str, expected: Column) -> Column:
    return F.coalesce(F.abs(F.col(column) - expected) < EQUAL, F.lit(False))


@_register("m13_score_all_pairs")
def score_all_pairs(data):
    """The mart's probability of every pair against the one that follows from the coefficients."""
    training = data.training
    prepared = learning.prepare(training)
    model = learning.fit_logistic(prepared.train)
    expected = prepared.rows.select(*learning.KEY, learning.linear_score(model).alias("expected"))
    scores = learning.apply_model(model, prepared.rows)
    mart = marts.student_course_scores(learning.attach_scores(training, scores)).join(expected, learning.KEY)
    flagged = F.col("predicted_at_risk") == (F.col("expected") > 0.5).cast("int")
    slope = learning.logistic_gradient(model, prepared.train)
    return mart.select(
        *learning.KEY,
        "course_submission_count",
        (_is_near("risk_probability", F.col("expected")) & flagged & F.lit(slope < STATIONARY)).alias("scored"),
    )


@_register("m14_saved_model")
def saved_model(data):
    spark, path = data.spark, scratch_path(data.spark, "model")
    prepared = data.prepared
    # Test rows, and whether the reloaded model and scaler score every raw row as the fit did.
    model = learning.fit_logistic(prepared.train)
    learning.save_model(model, prepared.scaler, path)
    again = learning.score_new(data.stored_training, *learning.load_model(spark, path))
    again = again.select(*learning.KEY, F.col("risk_probability").alias("again"))
    both = learning.apply_model(model, prepared.rows).join(again, learning.KEY)
    return both.agg(
        F.count_if("is_test").alias("test_rows"),
        F.every(F.col("risk_probability") == F.col("again")).alias("same_after_reload"),
    )


@_register("m15_single_model")
def single_model(data):
    """Each student's risk in the mart against the highest that follows from the coefficients; the
    fit is on clean labels."""
    training = data.stored_training
    prepared = learning.prepare(training, noise=0.0)
    model, scores = learning.train_single(training, prepared)
    mart = marts.student_features(learning.attach_scores(training, scores))
    pairs = prepared.rows.select("student_id", learning.linear_score(model).alias("p"))
    expected = pairs.groupBy("student_id").agg(F.max("p").alias("expected"))
    slope = learning.logistic_gradient(model, prepared.train)
    near = _is_near("risk_probability", F.col("expected"))
    return mart.join(expected, "student_id").select("student_id", (near & F.lit(slope < STATIONARY)).alias("scored"))


@_register("p7_model_evaluation")
def model_evaluation(data):
    """The best model's published metrics against those counted anew from the published scores."""
    prepared = learning.prepare(data.training)
    outcome = learning.compare_models(prepared)
    best = outcome.comparison.filter(F.col("model") == outcome.best)
    tested = outcome.scores.filter("is_test")
    hit = F.col("prediction") == F.col("noisy_label")
    wanted, told = F.col("noisy_label") == 1, F.col("prediction") == 1
    counted = tested.agg(
        (F.count_if(hit) / F.count("*")).alias("Accuracy"),
        (F.count_if(wanted & told) / F.count_if(told)).alias("Precision"),
        (F.count_if(wanted & told) / F.count_if(wanted)).alias("Recall"),
        (2 * F.count_if(wanted & told) / (F.count_if(wanted) + F.count_if(told))).alias("F1-Score"),
    ).unpivot([], ["Accuracy", "Precision", "Recall", "F1-Score"], "metric", "expected")
    top = outcome.comparison.agg(F.max("f1")).first()[0] == best.first()["f1"]
    ranks = learning.area_under_curve(tested) > RANKS
    sizes = tested.agg(F.count("*").alias("test_rows"), F.count_if(wanted).alias("positives"))
    rows = learning.evaluation_rows(best).join(counted, "metric").crossJoin(F.broadcast(sizes))
    return rows.select(
        "metric", "test_rows", "positives", (_is_near("score", F.col("expected")) & F.lit(top and ranks)).alias("scored")
    )


# -- sessions -------------------------------------------------------------------------------
@_register("f11_normalized_text")
def normalized_text(data):
    return fixtures.messages(data.spark, data.folder).select(
        "message_id", F.md5(X.normalize(F.col("text"))).alias("normalized_md5")
    )


@_register("t1_intents")
def intents(data):
    return sessions.tag_intents(fixtures.messages(data.spark, data.folder)).select("message_id", "intent")


@_register("t2_history")
def history(data):
    """Events as the messages of each user, the last 20 kept."""
    rows = fixtures.event_messages(data.spark, data.folder)
    return sessions.recent_history(rows)


@_register("t4_validation")
def validation(data):
    return sessions.validate(fixtures.messages(data.spark, data.folder)).select(
        "message_id", "reject_reason", "accepted"
    )


@_register("t3_rate_limit")
def rate_limit(data):
    rows = sessions.rate_limit(fixtures.dense_requests(data.spark, data.folder))
    return rows.select("session_id", "turn", "window_start", "admitted")


# -- sketches -------------------------------------------------------------------------------
def _within_error(estimate: str, exact: str) -> Column:
    off = F.abs(F.col(estimate) - F.col(exact))
    return off <= F.greatest(F.lit(1.0), 4 * sketches.STANDARD_ERROR * F.col(exact))


def _stored_sketches(data: Inputs, facts: DataFrame) -> DataFrame:
    name = _table_name("sketches")
    tables.write_table(sketches.hourly_sketches(facts), name)
    return tables.read_table(data.spark, name)


@_register("a3_sketched_students")
def sketched_students(data):
    """Students and last activity of each course from stored sketches, the estimate against the exact
    count."""
    facts = data.wh.facts
    told = sketches.students_by_course(_stored_sketches(data, facts))
    exact = reports.course_students_count(facts)
    return told.join(exact, "course_id").select(
        "course_id", "submissions", "student_count", "last_activity", _within_error("students", "student_count").alias("within_error")
    )


@_register("a4_sketched_activity")
def sketched_activity(data):
    """The recent-activity report from stored sketches, its estimates against the exact counts."""
    facts = fixtures.activity(data.spark, data.folder)
    told = sketches.recent_activity(_stored_sketches(data, facts), facts)
    exact = reports.recent_activity(facts).select(*[F.col(f"active_students_{p}").alias(f"exact_{p}") for p in ("24h", "7d")])
    return told.crossJoin(F.broadcast(exact)).select(
        "submissions_24h",
        "submissions_7d",
        *[_within_error(f"active_students_{p}", f"exact_{p}").alias(f"students_{p}_within_error") for p in ("24h", "7d")],
    )


@_register("a4_stayed_and_left")
def stayed_and_left(data):
    """Students of each course who were active in both halves of January, or in one only."""
    facts = fixtures.activity(data.spark, data.folder)
    middle = [F.lit(d).cast("timestamp") for d in ("2024-01-01", "2024-01-16", "2024-02-01")]
    told = sketches.stayed_and_left(_stored_sketches(data, facts), tuple(middle[:2]), tuple(middle[1:]))
    halves = facts.groupBy("course_id", "student_id").agg(
        *[F.max((F.col("submitted_at") >= a) & (F.col("submitted_at") < b)).alias(n) for a, b, n in ((*middle[:2], "a"), (*middle[1:], "b"))]
    )
    exact = halves.groupBy("course_id").agg(
        F.count_if(F.col("a") & F.col("b")).alias("in_both"),
        F.count_if(F.col("a") & ~F.col("b")).alias("in_first"),
        F.count_if(~F.col("a") & F.col("b")).alias("in_second"),
    )
    # The error of a difference is that of the union of both.
    size = F.col("in_both") + F.col("in_first") + F.col("in_second")
    near = [
        F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), 6 * sketches.STANDARD_ERROR * size)
        for a, b in (("stayed", "in_both"), ("left", "in_first"), ("new", "in_second"))
    ]
    columns = ("course_id", "in_both", "in_first", "in_second")
    return told.join(exact, "course_id").select(*columns, reduce(lambda a, b: a & b, near).alias("within_error"))


# -- streams --------------------------------------------------------------------------------
SLICES = 3


def _sliced_stream(rows: DataFrame, path: str) -> DataFrame:
    """Rows as a stream of several batches, in the order of their times."""
    fixtures.landed_in_slices(rows, "ts", path, SLICES)
    return rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@_register("t2_history_stream")
def history_stream(data):
    """The histories of t2, kept by a stream over several batches."""
    rows, path = fixtures.event_messages(data.spark, data.folder), scratch_path(data.spark, "messages")
    messages = _sliced_stream(rows, path)
    out = scratch_path(data.spark, "histories")
    session_streams.history_rollup(messages, out).awaitTermination()
    return session_streams.history_report(rows, out).drop("place")


@_register("t3_rate_limit_stream")
def rate_limit_stream(data):
    """The decisions of t3, made by a stream that ends and begins again from its state."""
    rows, path = fixtures.dense_requests(data.spark, data.folder), scratch_path(data.spark, "requests")
    messages, out = _sliced_stream(rows, path), scratch_path(data.spark, "decisions")
    decided = session_streams.limited(messages)
    streams.run_to_table(decided, out)
    # A request of a session of its own, a day later, lets the watermark pass all others.
    closing = rows.agg(F.lit(-1).cast("bigint").alias("session_id"), F.lit(0).cast("bigint").alias("turn"), F.max("ts").alias("ts"))
    later = closing.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY"))
    later.coalesce(1).write.mode("append").parquet(path)
    told = streams.run_to_table(decided, out)
    return told.select("session_id", "turn", "window_start", "admitted")


def _event_stream(data: Inputs) -> DataFrame:
    schema = fixtures.table(data.spark, data.folder, "events").schema
    reader = data.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    raw = reader.parquet(data.folder)
    return fixtures.activity_from(raw)


@_register("t5_activity_stream")
def activity_stream(data):
    """All windows; the estimate of active students is held against an exact count."""
    told = streams.drain_activity(_event_stream(data))
    hours = fixtures.activity(data.spark, data.folder).select(
        F.date_trunc("hour", "submitted_at").alias("hour"), "student_id"
    )
    start = F.col("hour") - F.make_dt_interval(F.lit(0), F.col("back"))
    exact = (
        hours.distinct()
        .withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(23))))
        .groupBy(start.alias("window_start"))
        .agg(F.count_distinct("student_id").alias("exact"))
    )
    off = F.abs(F.col("active_students") - F.col("exact"))
    return told.join(exact, "window_start").select(
        "window_start",
        "window_end",
        "submissions",
        (off <= F.greatest(F.lit(2), 0.05 * F.col("exact"))).alias("students_within_error"),
    )


@_register("t6_weekly_stream")
def weekly_stream(data):
    return streams.drain_weekly(_event_stream(data))
