"""Fixed table schemas: raw landing records, warehouse tables and published marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Landed grades and points keep six places; sums are taken in hundredths.
GRADE = T.DecimalType(18, 6)


def _table(*fields: tuple) -> T.StructType:
    """Each field is (name, type) or (name, type, nullable)."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# -- raw landing records --------------------------------------------------------------------
RAW_COURSE = _table(
    ("id", T.LongType()),
    ("name", T.StringType()),
    ("course_code", T.StringType()),
    ("workflow_state", T.StringType()),
    ("teacher_id", T.LongType()),
)
RAW_STUDENT = _table(
    ("id", T.StringType()),
    ("name", T.StringType()),
    ("login_id", T.StringType()),
    ("email", T.StringType()),
)
RAW_ASSIGNMENT = _table(
    ("id", T.StringType()),
    ("name", T.StringType()),
    ("due_at", T.StringType()),
    ("points_possible", T.StringType()),
    ("created_at", T.StringType()),
)
RAW_SUBMISSION = _table(
    ("id", T.StringType()),
    ("user", _table(("id", T.StringType()))),
    ("assignment_id", T.StringType()),
    ("submitted_at", T.StringType()),
    ("grade", T.StringType()),
    ("late", T.StringType()),
)

#: Column with the text of a landed record that could not be read; null in all others.
BROKEN = "_broken"

# Column lists of the CSV landing files; every column is text.
CSV_STUDENTS = ["id", "name", "login_id"]
CSV_SUBMISSIONS = ["id", "user_id", "assignment_id", "submitted_at", "grade", "late", "course_id"]
CSV_ASSIGNMENTS = [
    "assignment_id", "course_id", "assignment_name", "due_at", "points_possible", "created_at",
]


def text_schema(columns: list[str]) -> T.StructType:
    return _table(*[(c, T.StringType()) for c in columns])


# -- warehouse ------------------------------------------------------------------------------
DIM_COURSES = _table(
    ("course_id", T.LongType()),
    ("course_name", T.StringType()),
    ("course_code", T.StringType()),
    ("teacher_id", T.LongType()),
)
DIM_STUDENTS = _table(
    ("student_id", T.LongType()),
    ("student_name", T.StringType()),
    ("student_email", T.StringType(), False),
)
#: Students as landed, one row a record, in the order of the files.
LANDED_STUDENTS = T.StructType(
    [
        *DIM_STUDENTS,
        T.StructField(
            "ingest_seq",
            _table(("file_path", T.StringType()), ("file_block_start", T.LongType()), ("place", T.LongType())),
        ),
    ]
)
DIM_ASSIGNMENTS = _table(
    ("assignment_id", T.LongType()),
    ("course_id", T.LongType()),
    ("assignment_name", T.StringType()),
    ("due_at", T.TimestampType()),
    ("points_possible", GRADE),
    ("created_at", T.TimestampType()),
)
FACT_SUBMISSIONS = _table(
    ("submission_id", T.LongType()),
    ("student_id", T.LongType()),
    ("assignment_id", T.LongType()),
    ("submitted_at", T.TimestampType(), False),
    ("grade", GRADE),
    ("late", T.BooleanType(), False),
    ("course_id", T.LongType()),
    ("student_name", T.StringType()),
)

#: Submissions before the student's name is looked up.
TYPED_SUBMISSIONS = T.StructType([f for f in FACT_SUBMISSIONS if f.name != "student_name"])
#: What a quarantine adds to the columns of its table: why a record is there, and its text.
OUTCOME = _table(("record", T.StringType()), ("reason", T.StringType(), False))

# -- marts ----------------------------------------------------------------------------------
TRAINING_COLUMNS = [
    "student_id", "student_name", "student_email", "course_id", "course_name", "course_load",
    "course_submission_count", "course_late_ratio", "early_avg_grade", "early_submission_count",
    "early_late_ratio", "active_weeks_early", "early_grade_stddev", "early_grade_trend",
    "avg_delay_hours", "submissions_last_14d", "submissions_last_30d",
    "assignment_completion_ratio", "course_final_avg", "is_at_risk",
]
STUDENT_COURSE_COLUMNS = [
    "student_id", "student_name", "student_email", "course_id", "course_name",
    "course_final_avg", "course_submission_count", "course_late_ratio", "early_avg_grade",
    "early_submission_count", "early_late_ratio", "active_weeks_early", "avg_delay_hours",
    "submissions_last_14d", "submissions_last_30d", "assignment_completion_ratio",
    "course_load", "risk_probability", "risk_bucket", "predicted_at_risk",
]
SCORE_COLUMNS = [
    "student_id", "student_name", "student_email", "course_id", "course_name", "avg_grade",
    "course_final_avg", "submission_count", "course_submission_count", "late_submission_ratio",
    "course_late_ratio", "course_load", "early_avg_grade", "early_submission_count",
    "early_late_ratio", "active_weeks_early", "early_grade_stddev", "early_grade_trend",
    "avg_delay_hours", "submissions_last_14d", "submissions_last_30d",
    "assignment_completion_ratio", "is_at_risk", "risk_probability", "predicted_at_risk",
    "risk_bucket",
]
STUDENT_COLUMNS = [
    "student_id", "student_name", "student_email", "avg_grade", "submission_count",
    "late_submission_ratio", "course_load", "courses_total", "courses_at_risk",
    "risk_probability", "predicted_at_risk", "risk_bucket",
]
RISK_BY_COURSE_COLUMNS = [
    "course_id", "course_name", "at_risk_students", "total_students", "at_risk_ratio",
]
FEATURE_COLUMNS = [
    "early_avg_grade", "early_submission_count", "early_late_ratio", "active_weeks_early",
    "avg_delay_hours", "early_grade_stddev", "early_grade_trend",
]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to ``schema`` (names, order and types); a missing column is an error."""
    absent = [f.name for f in schema if f.name not in df.columns]
    if absent:
        raise ValueError(f"columns missing for table write: {absent}")
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])
