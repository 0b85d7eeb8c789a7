"""Cleaning of landed text records into typed warehouse rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens import schemas


def to_long(value: Column) -> Column:
    """Whole number or null; a decimal spelling such as ``12.0`` is accepted."""
    number = value.try_cast("decimal(38,6)")
    return F.when(number == F.floor(number), number).try_cast("bigint")


def to_decimal(value: Column) -> Column:
    """Number at six places; null when it is none or has more than twelve digits before them."""
    return value.try_cast(schemas.GRADE.simpleString())


def to_bool(value: Column) -> Column:
    """Null is false; text spellings of false are false, any other text is true."""
    text = F.lower(F.trim(value.cast("string")))
    return F.coalesce(~text.isin("false", "0", "0.0", ""), F.lit(False))


def keep_present(df: DataFrame, needed: list[str]) -> DataFrame:
    """The needed columns that exist, in the needed order."""
    return df.select(*[c for c in needed if c in df.columns])


def with_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add absent columns as null text."""
    absent = {c: F.lit(None).cast("string") for c in columns if c not in df.columns}
    return df.withColumns(absent) if absent else df


def first_seen(df: DataFrame, key: str, order: str) -> DataFrame:
    """The first record of each key. ``min_by`` combines before the shuffle, so many copies
    of one key cost one row per task."""
    rest = [c for c in df.columns if c not in (key, order)]
    packed = F.min_by(F.struct(*rest), F.col(order)).alias("_first")
    return df.groupBy(key).agg(packed).select(key, *[F.col(f"_first.{c}").alias(c) for c in rest])


def _typed_students(raw: DataFrame, *kept: str) -> DataFrame:
    return raw.select(
        to_long(F.col("id")).alias("student_id"),
        F.col("name").alias("student_name"),
        F.coalesce("login_id", F.lit("")).alias("student_email"),
        F.col("id").isNull().alias("_no_id"),
        *kept,
    )


def clean_students(raw: DataFrame, order: str = "ingest_seq") -> DataFrame:
    """One row per student, the first seen; ``12`` and ``12.0`` are one id. Ids that are not
    numbers are dropped."""
    return first_students(_typed_students(raw, order).drop("_no_id"), order)


def first_students(typed: DataFrame, order: str = "ingest_seq") -> DataFrame:
    return first_seen(typed.filter(F.col("student_id").isNotNull()), "student_id", order)


def one_each(df: DataFrame, key: str) -> DataFrame:
    """One row of each key: records that landed again are equal, and of different ones the
    smallest is taken, which combines before the shuffle."""
    rest = [c for c in df.columns if c != key]
    packed = df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_one"))
    return packed.select(*[F.col(key) if c == key else F.col(f"_one.{c}").alias(c) for c in df.columns])


def _typed_assignments(raw: DataFrame, *kept: str) -> DataFrame:
    return with_missing(raw, schemas.CSV_ASSIGNMENTS).select(
        to_long(F.col("assignment_id")).alias("assignment_id"),
        to_long(F.col("course_id")).alias("course_id"),
        "assignment_name",
        F.try_to_timestamp(F.col("due_at")).alias("due_at"),
        to_decimal(F.col("points_possible")).alias("points_possible"),
        F.try_to_timestamp(F.col("created_at")).alias("created_at"),
        F.col("assignment_id").isNull().alias("_no_id"),
        *kept,
    )


def clean_assignments(raw: DataFrame) -> DataFrame:
    """Typed assignments, one row an id; rows without a numeric id are dropped. Absent columns
    become null."""
    return one_assignment_each(_typed_assignments(raw).drop("_no_id"))


def one_assignment_each(typed: DataFrame) -> DataFrame:
    return one_each(typed.filter(F.col("assignment_id").isNotNull()), "assignment_id")


def clean_courses(courses: DataFrame) -> DataFrame:
    """One row a course, however often it landed."""
    return one_each(courses, "course_id")


# Why a landed submission is dropped, in the order the checks run.
REASONS = ["missing_student", "never_submitted", "bad_student_id", "kept"]


def _typed_submissions(raw: DataFrame, *kept: str) -> DataFrame:
    full = with_missing(keep_present(raw, [*schemas.CSV_SUBMISSIONS, *kept]), schemas.CSV_SUBMISSIONS)
    return full.select(
        to_long(F.col("id")).alias("submission_id"),
        to_long(F.col("user_id")).alias("student_id"),
        to_long(F.col("assignment_id")).alias("assignment_id"),
        F.try_to_timestamp(F.col("submitted_at")).alias("submitted_at"),
        to_decimal(F.col("grade")).alias("grade"),
        to_bool(F.col("late")).alias("late"),
        to_long(F.col("course_id")).alias("course_id"),
        F.col("user_id").isNull().alias("_no_id"),
        *kept,
    )


def _reason() -> Column:
    return (
        F.when(F.col("_no_id"), "missing_student")
        .when(F.col("submitted_at").isNull(), "never_submitted")
        .when(F.col("student_id").isNull(), "bad_student_id")
        .otherwise("kept")
    )


def clean_submissions(raw: DataFrame, students: DataFrame | None = None) -> DataFrame:
    """Typed submissions that were handed in by a known id; a bad grade becomes null.

    With ``students`` the student name is attached by a left lookup.
    """
    typed = _typed_submissions(raw).filter(_reason() == "kept").drop("_no_id")
    if students is None:
        return typed
    return typed.join(students.select("student_id", "student_name"), "student_id", "left")


# -- outcomes: landed records typed, with why they are dropped, in one pass ------------------
def _told(raw: DataFrame) -> DataFrame:
    """Adds `_record`, the text of the landed record, and `_unread`, whether it could not be read."""
    unread = F.col(schemas.BROKEN) if schemas.BROKEN in raw.columns else F.lit(None).cast("string")
    landed = [c for c in raw.columns if c not in (schemas.BROKEN, "ingest_seq")]
    return raw.withColumns(
        {"_record": F.coalesce(unread, F.to_json(F.struct(*landed))), "_unread": unread.isNotNull()}
    )


def _outcome(typed: DataFrame, reason: Column) -> DataFrame:
    """The typed columns, `record` (null for a kept row) and `reason`, "kept" or why it is not."""
    named = typed.withColumn("reason", F.when(F.col("_unread"), "broken").otherwise(reason))
    record = F.when(F.col("reason") != "kept", F.col("_record"))
    return named.withColumn("record", record).select(
        *[c for c in typed.columns if c not in ("_no_id", "_record", "_unread")], "record", "reason"
    )


def _by_id(column: str, missing: str, bad: str) -> Column:
    return F.when(F.col("_no_id"), missing).when(F.col(column).isNull(), bad).otherwise("kept")


def student_outcomes(raw: DataFrame, order: str = "ingest_seq") -> DataFrame:
    typed = _typed_students(_told(raw), order, "_record", "_unread")
    return _outcome(typed, _by_id("student_id", "missing_student", "bad_student_id"))


def assignment_outcomes(raw: DataFrame) -> DataFrame:
    typed = _typed_assignments(_told(raw), "_record", "_unread")
    return _outcome(typed, _by_id("assignment_id", "missing_assignment", "bad_assignment_id"))


def submission_outcomes(raw: DataFrame, students: DataFrame | None = None) -> DataFrame:
    """Every landed submission: those of ``clean_submissions`` are kept, the others tell why not.

    Equal counts to ``drop_reasons``, but for records that could not be read, which are "broken".
    """
    told = _outcome(_typed_submissions(_told(raw), "_record", "_unread"), _reason())
    if students is None:
        return told
    return told.join(students.select("student_id", "student_name"), "student_id", "left")


def drop_reasons(raw: DataFrame) -> DataFrame:
    """Rows per outcome of ``clean_submissions``, from one scan."""
    return _typed_submissions(raw).groupBy(_reason().alias("reason")).agg(F.count("*").alias("count"))


def pages_before_repeat(
    pages: DataFrame, entity: str, page: str, payload: str, max_pages: int | None = None
) -> DataFrame:
    """Pages of each entity before the first one that equals its predecessor.

    Landed pages are finite, so all are read unless ``max_pages`` says otherwise. The comparison
    travels as a digest, not as the payload.
    """
    read = pages if max_pages is None else pages.filter(F.col(page) <= max_pages)
    numbered = read.withColumn("_digest", F.sha2(payload, 256))
    in_order = Window.partitionBy(entity).orderBy(page)
    repeat = (F.col("_digest") == F.lag("_digest").over(in_order)).cast("int")
    seen = F.max(F.coalesce("_repeat", F.lit(0))).over(
        in_order.rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        numbered.withColumn("_repeat", repeat)
        .withColumn("_stopped", seen)
        .filter(F.col("_stopped") == 0)
        .drop("_digest", "_repeat", "_stopped")
    )
