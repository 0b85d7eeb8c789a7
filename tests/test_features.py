"""Edge rows, invariants and skew paths of the feature tables."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import ranking
from cohortlens.plans import features, reports
from cohortlens.sources.fixtures import coursework
from cohortlens.warehouse import Warehouse

FACT = (
    "submission_id string, student_id bigint, course_id bigint, assignment_id bigint, "
    "grade decimal(10,2), late boolean, submitted_at timestamp"
)


def ts(text):
    return dt.datetime.fromisoformat(text)


def warehouse(spark, facts, due=None):
    due = due or {}
    ids = {f[3] for f in facts} | set(due)
    assignments = [(i, 1, f"a{i}", due.get(i)) for i in sorted(ids)]
    return Warehouse(
        spark.createDataFrame(facts, FACT),
        spark.createDataFrame(
            [(i, f"S{i}", f"s{i}@x") for i in sorted({f[1] for f in facts} | {99})],
            "student_id bigint, student_name string, student_email string",
        ),
        spark.createDataFrame([(1, "One"), (2, "Empty")], "course_id bigint, course_name string"),
        spark.createDataFrame(
            assignments,
            "assignment_id bigint, course_id bigint, assignment_name string, due_at timestamp",
        ),
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_ungraded_pair(spark):
    wh = warehouse(spark, [("a", 1, 1, 1, None, True, ts("2025-01-01 10:00:00"))])
    row = one(features.training_dataset(wh))
    assert row.is_at_risk == 1 and row.early_avg_grade == 0 and row.course_final_avg == 0
    summary = one(reports.student_summary(wh))
    assert summary.risk_bucket == "low" and summary.avg_grade == 0 and summary.late_ratio == 1.0


def test_single_submission(spark):
    wh = warehouse(spark, [("a", 1, 1, 1, Decimal("7.50"), False, ts("2025-01-01 10:00:00"))])
    row = one(features.training_dataset(wh))
    assert (row.early_submission_count, row.early_grade_trend, row.early_grade_stddev) == (1, 0, 0)
    comparison = {r.course_id: r for r in reports.course_comparison(wh).collect()}
    assert comparison[1].grade_stddev == 0 and comparison[2].total_submissions == 0


def test_equal_times_have_no_slope(spark):
    same = ts("2025-01-01 10:00:00")
    facts = [(k, 1, 1, 1, Decimal(g), False, same) for k, g in (("b", "2.00"), ("a", "9.00"))]
    wh = warehouse(spark, facts)
    assert one(features.training_dataset(wh)).early_grade_trend == 0
    ranks = features.ranked_submissions(wh)[0].collect()
    assert {r.submission_id: r.rn for r in ranks} == {"a": 1, "b": 2}


def test_slope_is_points_per_second(spark):
    start = ts("2025-01-01 00:00:00")
    facts = [
        (str(i), 1, 1, i, Decimal(g), False, start + dt.timedelta(seconds=s))
        for i, (g, s) in enumerate([("1.00", 0), ("3.00", 10), ("4.00", 20), ("9.00", 30), ("2.00", 40)])
    ]
    row = one(features.training_dataset(warehouse(spark, facts)))
    assert row.early_submission_count == 3
    assert row.early_grade_trend == pytest.approx(0.15)


def test_delay_variants(spark):
    due = {1: ts("2025-01-01 12:00:00"), 2: ts("2025-01-02 12:00:00")}
    facts = [
        ("a", 1, 1, 1, Decimal("5"), False, ts("2025-01-01 10:00:00")),
        ("b", 1, 1, 2, Decimal("5"), True, ts("2025-01-02 18:00:00")),
        ("c", 1, 1, 3, Decimal("5"), False, ts("2025-01-03 00:00:00")),
    ]
    wh = warehouse(spark, facts, due)
    early = one(features.training_dataset(wh))
    assert early.avg_delay_hours == 3.0 and early.is_at_risk == 0
    students = spark.createDataFrame(
        [], "student_id bigint, risk_probability double, risk_bucket string, predicted_at_risk int"
    )
    strict = one(features.student_course_features(wh, students))
    assert strict.avg_delay_hours == 6.0
    assert (strict.risk_probability, strict.risk_bucket, strict.predicted_at_risk) == (0, "low", 0)


def test_recency_is_inclusive(spark):
    facts = [
        ("a", 1, 1, 1, None, False, ts("2025-01-01 00:00:00")),
        ("b", 1, 1, 2, None, False, ts("2024-12-31 23:59:59")),
        ("c", 1, 1, 3, None, False, ts("2025-01-15 00:00:00")),
    ]
    row = one(features.training_dataset(warehouse(spark, facts)))
    assert (row.submissions_last_14d, row.submissions_last_30d) == (2, 3)


def test_empty_facts(spark):
    wh = warehouse(spark, [])
    assert features.training_dataset(wh).count() == 0
    assert one(reports.recent_activity(wh.facts)).submissions_7d == 0
    assert one(reports.overview_counts(wh)).total_submissions == 0
    assert [r.total_submissions for r in reports.assignment_completion(wh).collect()] == [0, 0]


def test_null_course_counts_in_course_load_only(spark):
    facts = [
        ("a", 1, 1, 1, Decimal("5"), False, ts("2025-01-01 00:00:00")),
        ("b", 1, None, 1, Decimal("5"), False, ts("2025-01-02 00:00:00")),
    ]
    row = one(features.training_dataset(warehouse(spark, facts)))
    assert (row.course_load, row.course_submission_count) == (2, 1)


@pytest.mark.parametrize("by", ["due", "submitted"])
def test_heavy_path_gives_the_same_statistics(spark, data, by):
    wh = coursework(spark, data)
    plain = features.pair_statistics(wh, by)
    heavy = features.pair_statistics(replace(wh, heavy_rows=7), by)
    assert plain.exceptAll(heavy.select(plain.columns)).count() == 0
    assert plain.count() == heavy.count()


@pytest.mark.parametrize("heavy_rows", [ranking.HEAVY_ROWS, 2])
def test_a_missing_time_is_no_active_week(spark, heavy_rows):
    times = [None, "2025-01-06 00:00:00", "2025-01-14 00:00:00", "2025-01-14 01:00:00", None]
    facts = [(str(i), 1, 1, 1, Decimal("5"), False, ts(t) if t else None) for i, t in enumerate(times)]
    stats = features.pair_statistics(replace(warehouse(spark, facts), heavy_rows=heavy_rows), "submitted")
    assert one(stats).early_weeks == 1


def test_more_heavy_groups_than_a_broadcast_takes(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_GROUPS", 2)
    rows = spark.range(900).select((F.col("id") % 9).alias("g"), F.col("id").alias("o"))
    parts = ranking.ranked_parts(rows, ["g"], [F.col("o")], ranking.heavy_groups(rows, ["g"], 50))
    assert parts[0].count() == 0 and parts[1].count() == 900


def test_reports_carry_no_useless_sort_or_pass(spark, data):
    from cohortlens import catalog

    plan = lambda name: catalog.queries()[name](spark, data)._jdf.queryExecution().executedPlan().toString()
    for name in ("o10_best_worst_course", "o10_course_chart", "b8_study_tips"):
        assert "rangepartitioning" not in plan(name)
    assert plan("p13_overview").count("FileScan") <= 13


def test_one_group_with_most_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("g"),
        (F.xxhash64("id") % 1000).alias("o"),
        "id",
    )
    order = [F.col("o"), F.col("id")]
    heavy = ranking.heavy_groups(rows, ["g"], 5_000)
    parts = ranking.ranked_parts(rows, ["g"], order, heavy)
    assert len(parts) == 2
    expected = ranking.rank_by_window(rows, ["g"], order)
    assert expected.exceptAll(ranking.union_all(parts).select(expected.columns)).count() == 0
    assert parts[1].count() == 10_000


def test_heavy_null_group(spark):
    rows = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("g"), F.col("id").alias("o")
    )
    heavy = ranking.heavy_groups(rows, ["g"], 1_000)
    parts = ranking.ranked_parts(rows, ["g"], [F.col("o")], heavy)
    ranks = [r.rn for r in parts[1].select("rn").collect()]
    assert sorted(ranks) == list(range(1, 1_501)) and parts[0].count() == 1_500


def test_totals_agree(spark, data):
    wh = coursework(spark, data)
    total = wh.facts.count()
    by_student = reports.student_summary(wh).agg(F.sum("submission_count"), F.sum("late_count")).first()
    by_course = reports.course_summary(wh).agg(F.sum("submission_count")).first()[0]
    by_week = reports.weekly_trends(wh.facts).agg(F.sum("submissions")).first()[0]
    assert by_student[0] == by_course == by_week == total
    assert by_student[1] == wh.facts.filter("late").count()


def test_early_count_and_ratio_bounds(spark, data):
    rows = features.training_dataset(coursework(spark, data))
    cutoff = F.greatest(F.lit(1), F.ceil(F.col("course_submission_count") * 0.6))
    assert rows.filter(F.col("early_submission_count") != cutoff).count() == 0
    for name in ("course_late_ratio", "early_late_ratio", "assignment_completion_ratio"):
        assert rows.filter(~F.col(name).between(0, 1)).count() == 0
    assert rows.select("student_id", "course_id").distinct().count() == rows.count()


def test_result_does_not_depend_on_partitioning(spark, data):
    wh = coursework(spark, data)
    shuffled = Warehouse(wh.facts.repartition(5, "submitted_at"), wh.students, wh.courses, wh.assignments)
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        other = features.training_dataset(shuffled).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert sorted(other) == sorted(features.training_dataset(wh).collect())


def test_group_aggregation_reuses_the_rank_exchange(spark, data):
    wh = coursework(spark, data)
    plan = features.pair_statistics(wh)._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("hashpartitioning(student_id") == 1
    assert "Expand" not in initial


@pytest.mark.parametrize("heavy_rows", [1_000_000, 7])
def test_both_windows_at_once_equal_one_after_the_other(spark, data, heavy_rows):
    wh = replace(coursework(spark, data), heavy_rows=heavy_rows)
    both = features.both_statistics(wh).checkpoint()
    due, handed = features.pair_statistics(wh, "due"), features.pair_statistics(wh, "submitted")
    assert sorted(both.select(*due.columns).collect()) == sorted(due.collect())
    by_hand = both.select(*features.PAIR, *[f"handed_{c}" for c in features.HANDED]).collect()
    assert sorted(map(tuple, by_hand)) == sorted(map(tuple, handed.select(*features.PAIR, *features.HANDED).collect()))
    plan = features.both_statistics(coursework(spark, data))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(student_id") == 1
