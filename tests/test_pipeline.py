"""Landing files to marts and exports in one run."""

import random

import pytest
from pyspark.sql import functions as F

from cohortlens import schemas
from cohortlens.plans import features, pipeline
from cohortlens.sources import tables
from cohortlens.warehouse import from_tables, publish_heavy_pairs
from test_sources import _lines


def _land(root, rng):
    students = [{"id": i, "name": f"S{i}", "login_id": f"s{i}"} for i in range(60)]
    _lines(root / "students", students + [{"id": 1, "name": "Copy", "login_id": "copy"}])
    _lines(root / "courses", [{"id": c, "name": f"C{c}", "course_code": str(c)} for c in (1, 2)])
    number = 0
    for course in (1, 2):
        _lines(
            root / "assignments" / f"course_id={course}",
            [{"id": course * 100 + a, "name": f"A{a}", "due_at": f"2025-10-{a + 1:02d}T12:00:00Z"} for a in range(10)],
        )
        rows = []
        for student in range(60):
            level = rng.uniform(2, 9)
            for a in range(10):
                number += 1
                grade = round(min(10, max(0, rng.gauss(level, 1))), 2)
                rows.append(
                    {"id": number, "user": {"id": student}, "assignment_id": course * 100 + a,
                     "submitted_at": f"2025-10-{a + 1:02d}T{rng.randrange(24):02d}:00:00Z",
                     "grade": str(grade), "late": rng.random() < 0.3}
                )
        rows.append({"id": 0, "assignment_id": 101})
        _lines(root / "submissions" / f"course_id={course}", rows)


def test_refresh(spark, tmp_path):
    _land(tmp_path / "in", random.Random(1))
    (tmp_path / "in" / "submissions" / "course_id=1" / "torn.json").write_text('{"id": 7, "user"\n')
    told = {}
    wh = pipeline.load_warehouse(spark, str(tmp_path / "in"), told)
    assert told == {"missing_student": 2, "never_submitted": 0, "bad_student_id": 0, "kept": 1200, "broken": 1}
    rejects = {(r.reason, r.record) for r in tables.read_table(spark, "fact_submissions_rejects").collect()}
    assert ("broken", '{"id": 7, "user"') in rejects and len(rejects) == 3
    outcomes = {(r.table, r.reason): r.rows for r in pipeline.load_outcomes(spark).collect()}
    assert outcomes == {
        ("students", "kept"): 61, ("assignments", "kept"): 20,
        ("submissions", "kept"): 1200, ("submissions", "missing_student"): 2, ("submissions", "broken"): 1,
    }
    assert wh.facts.count() == 1200 and wh.students.count() == 60 and wh.courses.count() == 2
    assert wh.students.filter("student_id = 1").first().student_name == "S1"
    outcome = pipeline.publish_marts(spark, wh, ["Logistic Regression", "KNN"])
    assert outcome.comparison.count() == 2
    scores = tables.read_table(spark, "student_course_scores")
    assert scores.columns == schemas.SCORE_COLUMNS and scores.count() == 120
    features = tables.read_table(spark, "student_course_features")
    assert features.columns == schemas.STUDENT_COURSE_COLUMNS and features.count() == 120
    flagged = tables.read_table(spark, "risk_by_course").agg(F.sum("at_risk_students")).first()[0]
    assert flagged == tables.read_table(spark, "at_risk_students").count()
    assert tables.read_table(spark, "model_evaluation").count() == 4
    paths = tables.export_datasets(pipeline.exports(spark, wh, outcome), str(tmp_path / "out"))
    back = {name: spark.read.csv(path, header=True).count() for name, path in paths.items()}
    assert back["student_summary"] == 60 and back["training_dataset"] == 120
    assert back["load_outcomes"] == 5 and back["confusion_counts"] == 2 and back["class_report"] == 4
    assert back["top_at_risk_students"] == 25 and back["all_models_evaluation"] == 8


@pytest.mark.parametrize("heavy_rows", [1_000_000, 8])
def test_plans_over_published_tables_begin_without_a_job(spark, tmp_path, heavy_rows):
    _land(tmp_path / "in", random.Random(2))
    wh = pipeline.load_warehouse(spark, str(tmp_path / "in"))
    expected = sorted(features.training_dataset(wh).collect())
    publish_heavy_pairs(spark, heavy_rows)
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    context.setJobGroup(f"plan {heavy_rows}", "planning")
    wh = from_tables(spark)
    # Pairs of ten submissions are all heavy or none is.
    assert wh.is_listed and (wh.heavy_pairs is None) == (heavy_rows > 10)
    if heavy_rows > 10:
        features.training_dataset(wh)
        assert list(tracker.getJobIdsForGroup(f"plan {heavy_rows}")) == []
    context._jsc.sc().clearJobGroup()
    assert sorted(features.training_dataset(wh).collect()) == expected
