"""Landing files, cleaners, tables and exports."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from cohortlens import catalog, schemas
from cohortlens.operators import cleaning
from cohortlens.sources import landing, tables


def _lines(path, rows):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, "part.json"), "w") as out:
        out.writelines(json.dumps(r) + "\n" for r in rows)


def test_courses(spark, tmp_path):
    _lines(
        tmp_path / "c",
        [{"id": 1, "name": "A", "course_code": "a", "workflow_state": "available"},
         {"id": 2, "workflow_state": "completed"}, {"name": "no id"}, {"id": 3, "name": "B"}],
    )
    got = landing.read_courses(spark, str(tmp_path / "c")).collect()
    assert sorted(r.course_id for r in got) == [1, 3]


def test_students_fall_back_to_email(spark, tmp_path):
    _lines(
        tmp_path / "s",
        [{"id": 1, "name": "A", "login_id": "", "email": "a@x"}, {"id": 2, "name": "B", "login_id": "b"}],
    )
    got = {r.id: r.login_id for r in landing.read_students(spark, str(tmp_path / "s")).collect()}
    assert got == {"1": "a@x", "2": "b"}


def test_submissions_flatten_user_and_course(spark, tmp_path):
    _lines(
        tmp_path / "f" / "course_id=7",
        [{"id": 1, "user": {"id": 5}, "assignment_id": 2, "grade": "8", "late": True}, {"id": 2, "assignment_id": 2}],
    )
    rows = landing.read_submissions(spark, str(tmp_path / "f"))
    assert {(r.id, r.user_id, r.course_id) for r in rows.collect()} == {("1", "5", "7"), ("2", None, "7")}
    assert landing.missing_user_counts(rows).first().missing_user == 1


RAW = "id string, user_id string, assignment_id string, submitted_at string, grade string, late string, course_id string"


def test_clean_submissions(spark):
    rows = [
        ("1", "10", "3", "2025-10-01T12:00:00Z", "8.5", "True", "1"),
        ("2", "10", "3", "2025-10-01T12:00:00Z", "A+", None, "1"),
        ("3", None, "3", "2025-10-01T12:00:00Z", "8", None, "1"),
        ("4", "10", "3", None, "8", None, "1"),
        ("5", "x", "3", "2025-10-01T12:00:00Z", "8", None, "1"),
        ("6", "10.0", "3", "2025-10-01T12:00:00Z", "8", "False", "bad"),
    ]
    raw = spark.createDataFrame(rows, RAW)
    names = spark.createDataFrame([(10, "Ten")], "student_id bigint, student_name string")
    got = {r.submission_id: r for r in cleaning.clean_submissions(raw, names).collect()}
    assert sorted(got) == [1, 2, 6]
    assert got[1].late and not got[2].late and got[2].grade is None
    assert got[6].course_id is None and got[6].student_name == "Ten"
    reasons = {r.reason: r["count"] for r in cleaning.drop_reasons(raw).collect()}
    assert reasons == {"kept": 3, "missing_student": 1, "never_submitted": 1, "bad_student_id": 1}
    typed = schemas.conform(cleaning.clean_submissions(raw, names), schemas.FACT_SUBMISSIONS)
    assert typed.dtypes == [(f.name, f.dataType.simpleString()) for f in schemas.FACT_SUBMISSIONS]


def test_outcomes_and_quarantine_from_one_scan(spark, tmp_path):
    _lines(
        tmp_path / "f" / "course_id=7",
        [{"id": 1, "user": {"id": 5}, "assignment_id": 2, "grade": "8", "submitted_at": "2025-10-01T12:00:00Z"},
         {"id": 2, "assignment_id": 2, "submitted_at": "2025-10-01T12:00:00Z"}, {"id": 3, "user": {"id": 5}},
         {"id": 4, "user": {"id": "x"}, "submitted_at": "2025-10-01T12:00:00Z"}],
    )
    (tmp_path / "f" / "course_id=7" / "torn.json").write_text('{"id": 5, "user": {"id"\nnot json\n')
    told = landing.read_submissions(spark, str(tmp_path / "f"), told=True)
    outcomes = cleaning.submission_outcomes(told)
    plan = outcomes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    students = spark.createDataFrame([(5, "Five")], "student_id bigint, student_name string")
    tables.write_split(cleaning.submission_outcomes(told, students), "split_t", schemas.FACT_SUBMISSIONS)
    kept = tables.read_table(spark, "split_t")
    assert [(r.submission_id, r.student_name) for r in kept.collect()] == [(1, "Five")]
    assert kept.columns == schemas.FACT_SUBMISSIONS.names
    rejects = {r.record if r.reason == "broken" else r.submission_id: (r.reason, r.record) for r in tables.read_table(spark, "split_t_rejects").collect()}
    assert {k: v[0] for k, v in rejects.items()} == {
        2: "missing_student", 3: "never_submitted", 4: "bad_student_id",
        '{"id": 5, "user": {"id"': "broken", "not json": "broken",
    }
    assert json.loads(rejects[4][1])["user_id"] == "x"
    counts = {r.reason: r.rows for r in tables.reason_counts(spark, "split_t").collect()}
    plain = {r.reason: r["count"] for r in cleaning.drop_reasons(landing.read_submissions(spark, str(tmp_path / "f"))).collect()}
    # Without the text of broken records, they pass for records without a student.
    assert plain.pop("missing_student") == counts.pop("missing_student") + counts.pop("broken")
    assert counts == plain
    # Readers of the clean rows do not read the quarantine's files.
    pruned = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(reason" in pruned
    # A later load replaces both.
    tables.write_split(cleaning.submission_outcomes(told.where("id = 1"), students), "split_t", schemas.FACT_SUBMISSIONS)
    assert tables.read_table(spark, "split_t_rejects").count() == 0 and tables.read_table(spark, "split_t").count() == 1


def test_student_and_assignment_outcomes(spark):
    rows = [("1", "A", None, 1), ("x", "B", "b", 2), (None, "C", "c", 3), ("1.0", "D", "d", 4)]
    raw = spark.createDataFrame(rows, "id string, name string, login_id string, ingest_seq bigint")
    told = cleaning.student_outcomes(raw)
    assert {(r.student_name, r.reason) for r in told.collect()} == {
        ("A", "kept"), ("B", "bad_student_id"), ("C", "missing_student"), ("D", "kept")
    }
    kept = told.where("reason = 'kept'").drop("record", "reason")
    assert cleaning.first_students(kept).collect() == cleaning.clean_students(raw).collect()
    landed = spark.createDataFrame([("1", "2"), ("?", "2"), (None, "2")], "assignment_id string, course_id string")
    told = cleaning.assignment_outcomes(landed).collect()
    assert sorted(r.reason for r in told) == ["bad_assignment_id", "kept", "missing_assignment"]
    assert all((r.record is None) == (r.reason == "kept") for r in told)


def test_submissions_without_a_user_column(spark):
    raw = spark.createDataFrame([("1", "2025-10-01")], "id string, submitted_at string")
    assert cleaning.clean_submissions(raw).count() == 0
    assert cleaning.drop_reasons(raw).first().reason == "missing_student"


def test_first_student_wins_before_coercion(spark):
    rows = [("1", "First", None, 1), ("1", "Second", "b", 2), ("x", "Bad", "c", 3), (None, "None", "d", 4)]
    raw = spark.createDataFrame(rows, "id string, name string, login_id string, ingest_seq bigint")
    got = cleaning.clean_students(raw).collect()
    assert [tuple(r) for r in got] == [(1, "First", "")]


def test_clean_assignments(spark):
    rows = [("1", "1", "A", "2025-10-01T00:00:00Z", "10", None), (None, "1", "B", None, None, None),
            ("2", "?", "C", "soon", "ten", None)]
    schema = ", ".join(f"{c} string" for c in schemas.CSV_ASSIGNMENTS)
    got = {r.assignment_id: r for r in cleaning.clean_assignments(spark.createDataFrame(rows, schema)).collect()}
    assert sorted(got) == [1, 2] and got[2].due_at is None and got[2].points_possible is None
    empty = cleaning.clean_assignments(spark.createDataFrame([], schema))
    assert empty.columns == schemas.CSV_ASSIGNMENTS and empty.count() == 0


def test_pages_stop_at_a_repeat(spark):
    rows = [("a", p, str(min(p, 3))) for p in range(1, 7)] + [("b", p, str(p)) for p in range(1, 250)]
    pages = spark.createDataFrame(rows, "entity string, page bigint, payload string")
    kept = cleaning.pages_before_repeat(pages, "entity", "page", "payload").groupBy("entity").count()
    assert {r.entity: r["count"] for r in kept.collect()} == {"a": 3, "b": 249}
    some = cleaning.pages_before_repeat(pages, "entity", "page", "payload", max_pages=200)
    assert some.where("entity = 'b'").count() == 200


def test_grades_keep_their_places_and_dimensions_one_row_an_id(spark):
    raw = spark.createDataFrame([("83.335",), ("123456789.5",), ("x",)], "g string")
    got = [r[0] for r in raw.select(cleaning.to_decimal(F.col("g"))).collect()]
    assert [None if v is None else float(v) for v in got] == [83.335, 123456789.5, None]
    students = spark.createDataFrame(
        [("12.0", "B", None, 2), ("12", "A", "a", 1), ("x", "C", None, 0)], "id string, name string, login_id string, ingest_seq int"
    )
    assert [tuple(r) for r in cleaning.clean_students(students).collect()] == [(12, "A", "a")]
    landed = spark.createDataFrame([("1", "2", "n")] * 2 + [("1.0", "2", "n")], "assignment_id string, course_id string, assignment_name string")
    assert cleaning.clean_assignments(landed).count() == 1
    courses = spark.createDataFrame([(1, "a", None), (1, "a", None)], "course_id long, course_name string, teacher_id long")
    assert cleaning.clean_courses(courses).collect() == [(1, "a", None)]


def test_csv_round_trip_and_gate(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "quoted", name', None)], "id string, name string, login_id string")
    landing.write_csv(df, str(tmp_path / "csv"), schemas.CSV_STUDENTS)
    back = landing.read_csv(spark, str(tmp_path / "csv"), schemas.CSV_STUDENTS)
    assert [tuple(r) for r in back.collect()] == [("1", 'a "quoted", name', None)]
    assert landing.has_rows(back) and not landing.has_rows(back, back.limit(0))


def test_table_writes(spark):
    schema = schemas.DIM_STUDENTS
    assert tables.table_or_empty(spark, "not_built", schema).count() == 0
    first = spark.createDataFrame([(1, "A", "a")], "student_id int, student_name string, student_email string")
    tables.write_table(first, "dim_students_t", schema)
    assert tables.read_table(spark, "dim_students_t").schema["student_id"].dataType.simpleString() == "bigint"
    own = tables.read_table(spark, "dim_students_t")
    tables.write_table(own.union(own), "dim_students_t", schema)
    assert tables.table_or_empty(spark, "dim_students_t", schema).count() == 2
    for _ in range(3):
        tables.write_table(first, "dim_students_t", schema)
    assert spark.sql("SHOW TABLES LIKE 'dim_students_t__*'").count() == 2
    with pytest.raises(ValueError):
        tables.write_table(first.drop("student_name"), "dim_students_t", schema)
    tables.create_or_replace_table(first, "plain_t")
    own = tables.read_table(spark, "plain_t")
    tables.create_or_replace_table(own.withColumn("extra", F.lit(1)), "plain_t")
    assert tables.read_table(spark, "plain_t").count() == 1
    first.write.saveAsTable("late_t")
    tables.write_table(tables.read_table(spark, "late_t"), "late_t")
    tables.write_table(first, "late_t__b")
    assert tables.read_table(spark, "late_t").count() == 1
    for _ in range(3):
        tables.write_table(first, "late_t")
    assert tables.read_table(spark, "late_t__b").count() == 1
    assert "extra" in tables.read_table(spark, "plain_t").columns
    tables.write_table(first, "plain_t", schema)
    assert tables.read_table(spark, "plain_t").columns == schema.names


def test_bucketed_table_joins_without_exchange(spark):
    rows = spark.range(1000).select((F.col("id") % 50).alias("student_id"), "id")
    tables.write_bucketed(rows, "bucketed_t", "student_id", 4)
    plan = spark.table("bucketed_t").groupBy("student_id").count()
    assert "Exchange hashpartitioning" not in plan._jdf.queryExecution().executedPlan().toString()


def test_export(spark, tmp_path):
    paths = tables.export_datasets({"a": spark.range(3).toDF("x")}, str(tmp_path))
    assert spark.read.csv(paths["a"], header=True).count() == 3


def test_the_bundle_leaves_no_shuffle_files_of_what_it_keeps(spark, data):
    """The marts are in checkpoints; the exchanges that made them need not stay until the driver's next garbage collection."""
    def shuffle_files():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        return {f for f in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in f}

    before, conf = shuffle_files(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    kept = catalog.queries()["p26_dashboard_bundle"](spark, data)
    for _ in range(100):  # files go in the background
        if not shuffle_files() - before:
            break
        time.sleep(0.1)
    assert not shuffle_files() - before
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == conf
    assert kept.count() == 13
