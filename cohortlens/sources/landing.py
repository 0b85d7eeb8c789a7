"""Readers and writers of the landing zone: JSON records of the source API and CSV files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import schemas


def read_courses(spark: SparkSession, path: str) -> DataFrame:
    """Available courses with an id; a record without a state counts as available."""
    raw = spark.read.schema(schemas.RAW_COURSE).json(path)
    state = F.coalesce("workflow_state", F.lit("available"))
    return raw.filter((state == "available") & (F.coalesce("id", F.lit(0)) != 0)).select(
        F.col("id").alias("course_id"),
        F.col("name").alias("course_name"),
        "course_code",
        "teacher_id",
    )


def _read(spark: SparkSession, path: str, schema: T.StructType, told: bool) -> DataFrame:
    """JSON records; with ``told``, broken ones bring their text in the column schemas.BROKEN."""
    if not told:
        return spark.read.schema(schema).json(path)
    kept = T.StructType([*schema.fields, T.StructField(schemas.BROKEN, T.StringType())])
    return spark.read.schema(kept).option("columnNameOfCorruptRecord", schemas.BROKEN).json(path)


def read_students(spark: SparkSession, path: str, told: bool = False) -> DataFrame:
    """Student records; an empty login falls back to the email.

    ``ingest_seq`` orders records as they lie in the files, however the files are split.
    """
    raw = _read(spark, path, schemas.RAW_STUDENT, told)
    login = F.coalesce(F.nullif("login_id", F.lit("")), "email")
    place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("place"))
    return raw.select("id", "name", login.alias("login_id"), place.alias("ingest_seq"), *[schemas.BROKEN] * told)


def read_assignments(spark: SparkSession, path: str, told: bool = False) -> DataFrame:
    """Assignment records under ``course_id=<id>`` folders; the course comes from the path."""
    raw = _read(spark, path, T.StructType([*schemas.RAW_ASSIGNMENT, T.StructField("course_id", T.StringType())]), told)
    return raw.withColumnsRenamed({"id": "assignment_id", "name": "assignment_name"}).select(
        *schemas.CSV_ASSIGNMENTS, *[schemas.BROKEN] * told
    )


def read_submissions(spark: SparkSession, path: str, told: bool = False) -> DataFrame:
    """Submission records under ``course_id=<id>`` folders, the nested user id flattened."""
    raw = _read(spark, path, T.StructType([*schemas.RAW_SUBMISSION, T.StructField("course_id", T.StringType())]), told)
    return raw.withColumn("user_id", F.col("user.id")).select(*schemas.CSV_SUBMISSIONS, *[schemas.BROKEN] * told)


def missing_user_counts(submissions: DataFrame) -> DataFrame:
    """Records without a user id per course and assignment."""
    return submissions.groupBy("course_id", "assignment_id").agg(
        F.count("*").alias("records"), F.count_if(F.col("user_id").isNull()).alias("missing_user")
    )


def write_csv(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").csv(path, header=True)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All columns as text; typing happens in the cleaners."""
    schema = schemas.text_schema(columns)
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False)


def has_rows(*frames: DataFrame) -> bool:
    """Gate before the transform step: true when every frame has at least one row."""
    return all(not df.isEmpty() for df in frames)
