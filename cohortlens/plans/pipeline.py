"""The whole refresh: landing files to warehouse tables, marts and exports."""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens import schemas
from cohortlens.operators import cleaning
from cohortlens.plans import features, learning, marts, reports
from cohortlens.sources import landing, tables
from cohortlens.warehouse import Warehouse, from_tables, publish_heavy_pairs


def load_warehouse(spark: SparkSession, folder: str, told: dict[str, int] | None = None) -> Warehouse:
    """Clean the landed ``courses``, ``students``, ``assignments`` and ``submissions`` folders
    and replace the four warehouse tables. Nothing is replaced when there is nothing to load.

    Each landed folder is read once: clean rows and what is dropped, with its text and the reason,
    go into one table split by reason (``load_outcomes``). ``told`` receives the number of
    submissions of each outcome and of broken records.
    """
    students = landing.read_students(spark, os.path.join(folder, "students"), told=True)
    submissions = landing.read_submissions(spark, os.path.join(folder, "submissions"), told=True)
    if not landing.has_rows(students, submissions):
        raise ValueError(f"no students or submissions landed in {folder}")
    courses = landing.read_courses(spark, os.path.join(folder, "courses"))
    assignments = landing.read_assignments(spark, os.path.join(folder, "assignments"), told=True)
    tables.write_table(cleaning.clean_courses(courses), "dim_courses", schemas.DIM_COURSES)
    tables.write_split(cleaning.student_outcomes(students), "landed_students", schemas.LANDED_STUDENTS)
    known = cleaning.first_students(tables.read_table(spark, "landed_students"))
    tables.write_table(known, "dim_students", schemas.DIM_STUDENTS)
    tables.write_split(cleaning.assignment_outcomes(assignments), "landed_assignments", schemas.DIM_ASSIGNMENTS)
    one_each = cleaning.one_assignment_each(tables.read_table(spark, "landed_assignments"))
    tables.write_table(one_each, "dim_assignments", schemas.DIM_ASSIGNMENTS)
    named = cleaning.submission_outcomes(submissions, tables.read_table(spark, "dim_students"))
    tables.write_split(named, "fact_submissions", schemas.FACT_SUBMISSIONS)
    publish_heavy_pairs(spark)
    if told is not None:
        reasons = {r["reason"]: r["rows"] for r in tables.reason_counts(spark, "fact_submissions").collect()}
        told.update({r: reasons.get(r, 0) for r in [*cleaning.REASONS, "broken"]})
    return from_tables(spark)


def load_outcomes(spark: SparkSession) -> DataFrame:
    """table, reason and rows of everything the last load read, kept or not."""
    names = {"students": "landed_students", "assignments": "landed_assignments", "submissions": "fact_submissions"}
    counts = [tables.reason_counts(spark, name).select(F.lit(label).alias("table"), "reason", "rows") for label, name in names.items()]
    return reduce(DataFrame.unionByName, counts)


def publish_marts(spark: SparkSession, wh: Warehouse, models: list[str] | None = None) -> learning.Outcome:
    """Train, score and replace every mart. Each mart is derived from the written one before it."""
    tables.write_table(features.training_dataset(wh), "training_dataset")
    training = tables.read_table(spark, "training_dataset")
    outcome = learning.compare_models(learning.prepare(training), models)
    scored = learning.attach_scores(training, outcome.scores)
    tables.write_table(marts.student_course_scores(scored), "student_course_scores")
    scores = tables.read_table(spark, "student_course_scores")
    tables.write_table(marts.student_features(scores), "student_features")
    tables.write_table(marts.at_risk_rows(scores), "at_risk_students")
    tables.write_table(marts.risk_by_course(scores), "risk_by_course")
    best = learning.best_model(outcome.comparison, models)
    tables.write_table(learning.evaluation_rows(best), "model_evaluation")
    students = tables.read_table(spark, "student_features")
    tables.write_table(features.student_course_features(wh, students), "student_course_features")
    return outcome


def exports(spark: SparkSession, wh: Warehouse, outcome: learning.Outcome) -> dict[str, DataFrame]:
    """The published data sets by name."""
    scores = tables.read_table(spark, "student_course_scores")
    return {
        "load_outcomes": load_outcomes(spark),
        "student_summary": reports.student_summary(wh),
        "course_summary": reports.course_summary(wh),
        "weekly_trends": reports.weekly_trends(wh.facts),
        "training_dataset": tables.read_table(spark, "training_dataset"),
        "overview_counts": reports.overview_counts(wh),
        "late_ratio_heatmap": reports.course_risk_late_matrix(scores, wh.courses),
        "top_at_risk_students": reports.worst_pairs(scores),
        "model_metrics": tables.read_table(spark, "model_evaluation"),
        "all_models_evaluation": learning.comparison_long(outcome.comparison),
        "confusion_counts": outcome.comparison.select("model", "tp", "fp", "fn", "tn"),
        "class_report": outcome.report,
    }


def refresh(spark: SparkSession, folder: str, output: str) -> dict[str, str]:
    """Load, publish and export in one run; returns export name to path."""
    wh = load_warehouse(spark, folder)
    outcome = publish_marts(spark, wh)
    return tables.export_datasets(exports(spark, wh, outcome), output)
