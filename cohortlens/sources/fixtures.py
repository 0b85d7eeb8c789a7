"""Warehouse-shaped inputs derived from the supplied test tables (see FIXTURES.md)."""

from __future__ import annotations

import os
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schemas import GRADE
from cohortlens.session import spread
from cohortlens.warehouse import Warehouse


# Column types of the test tables; stating them saves the footer scan of schema inference.
_TABLES = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_discount double, l_returnflag string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "customer": "c_custkey bigint, c_name string",
    "supplier": "s_suppkey bigint, s_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "documents": "doc_id bigint, text string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _course_id(part_type: Column) -> Column:
    # Part type to course number; any other type is course 6.
    numbers = {"ECONOMY": 1, "LARGE": 2, "MEDIUM": 3, "PROMO": 4, "SMALL": 5}
    expr = F
    for name, number in numbers.items():
        expr = expr.when(part_type == name, number)
    return expr.otherwise(6).cast("bigint")


def _from_cents(value: Column) -> Column:
    return (value.cast("decimal(10,0)") * Decimal("0.01")).cast(GRADE)


def coursework(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Orders, line items, parts and customers as submissions, assignments and students."""
    items = spread(table(spark, sf_dir, "lineitem"), "l_orderkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = table(spark, sf_dir, "part")
    key = [F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    key.append(F.col("l_shipdate").cast("date").cast("string"))
    grade = F.when(F.col("l_discount") != 0.1, (F.col("l_quantity") * 20).cast("bigint"))
    facts = (
        items.join(orders, items.l_orderkey == orders.o_orderkey)
        .join(part.select("p_partkey", "p_type"), items.l_partkey == F.col("p_partkey"))
        .select(
            F.concat_ws("-", *key).alias("submission_id"),
            F.col("o_custkey").alias("student_id"),
            _course_id(F.col("p_type")).alias("course_id"),
            F.col("l_partkey").alias("assignment_id"),
            _from_cents(grade).alias("grade"),
            (F.col("l_returnflag") == "R").alias("late"),
            F.col("l_shipdate").cast("timestamp").alias("submitted_at"),
        )
    )
    name = F.col("c_name")
    email = F.concat(F.lower(F.replace(name, F.lit("#"), F.lit("."))), F.lit("@example.com"))
    students = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("student_id"),
        name.alias("student_name"),
        email.alias("student_email"),
    )
    course = _course_id(F.col("p_type"))
    courses = part.select(course.alias("course_id"), F.col("p_type").alias("course_name")).distinct()
    due = F.lit("1995-01-01").cast("timestamp") + F.make_dt_interval(F.col("p_size") * 50)
    assignments = part.select(
        F.col("p_partkey").alias("assignment_id"),
        course.alias("course_id"),
        F.col("p_name").alias("assignment_name"),
        due.alias("due_at"),
    )
    return Warehouse(facts, students, courses, assignments)


def _json_k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as submissions spread over 30 days with microsecond timestamps."""
    return activity_from(table(spark, sf_dir, "events"))


def activity_from(events: DataFrame) -> DataFrame:
    # Event type to course number; any other type is course 5.
    numbers = {"click": 1, "error": 2, "purchase": 3, "signup": 4}
    course = F
    for name, number in numbers.items():
        course = course.when(F.col("event_type") == name, number)
    graded = F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 101 * 10)
    return events.select(
        F.col("event_id").alias("submission_id"),
        F.col("user_id").alias("student_id"),
        course.otherwise(5).cast("bigint").alias("course_id"),
        _json_k().alias("assignment_id"),
        _from_cents(graded).alias("grade"),
        (_json_k() % 3 == 0).alias("late"),
        F.col("ts").cast("timestamp").alias("submitted_at"),
    )


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as chat messages, ten seconds apart."""
    start = F.lit("2024-01-01").cast("timestamp")
    offset = F.make_dt_interval(F.lit(0), F.col("conv_id").cast("int"), F.lit(0), F.col("turn") * 10)
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("session_id"), "turn", (start + offset).alias("ts"), "role", "text"
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns and whole documents as message texts for the text rules."""
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", F.lit("turn"), "conv_id", "turn").alias("message_id"), "text"
    )
    documents = spread(table(spark, sf_dir, "documents"), "doc_id").select(
        F.concat_ws("-", F.lit("doc"), "doc_id").alias("message_id"), "text"
    )
    return turns.unionByName(documents)


def dirty_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as raw landing text with missing and malformed fields."""
    event, k = F.col("event_id"), _json_k()
    user = (
        F.when(event % 89 == 0, F.lit(None))
        .when(event % 97 == 0, F.concat(F.lit("x"), F.col("user_id").cast("string")))
        .otherwise(F.col("user_id").cast("string"))
    )
    submitted = (
        F.when(event % 13 == 0, F.lit(None))
        .when(event % 101 == 0, F.lit("not-a-date"))
        .otherwise(F.col("ts").cast("string"))
    )
    grade = (
        F.when(event % 17 == 0, F.lit("A+"))
        .when(event % 11 == 0, F.lit(None))
        .otherwise((event % 101).cast("string"))
    )
    late = F.when(event % 7 == 0, F.lit(None)).when(k % 3 == 0, F.lit("True")).otherwise(F.lit("False"))
    return spread(table(spark, sf_dir, "events"), "event_id").select(
        event.cast("string").alias("id"),
        user.alias("user_id"),
        k.cast("string").alias("assignment_id"),
        submitted.alias("submitted_at"),
        grade.alias("grade"),
        late.alias("late"),
        F.lit("1").alias("course_id"),
    )


def dirty_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as raw students, with renamed copies of every seventh row and bad ids."""
    base = table(spark, sf_dir, "customer").select(
        F.when(F.col("c_custkey") % 41 == 0, F.concat(F.lit("s"), F.col("c_custkey").cast("string")))
        .otherwise(F.col("c_custkey").cast("string")).alias("id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_custkey") % 5 != 0, F.lower("c_name")).alias("login_id"),
        F.col("c_custkey").alias("ingest_seq"),
    )
    copies = base.filter(F.col("ingest_seq") % 7 == 0).select(
        "id",
        F.concat(F.lit("Copy of "), "name").alias("name"),
        "login_id",
        (F.col("ingest_seq") + 1_000_000_000).alias("ingest_seq"),
    )
    return base.unionByName(copies)


def dirty_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as raw assignments with missing ids, bad dates and bad points."""
    key = F.col("p_partkey")
    due = F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).cast("string")
    return table(spark, sf_dir, "part").select(
        F.when(key % 31 == 0, F.lit(None))
        .when(key % 37 == 0, F.lit("none"))
        .otherwise(key.cast("string")).alias("assignment_id"),
        F.when(key % 29 == 0, F.lit("?")).otherwise(_course_id(F.col("p_type")).cast("string"))
        .alias("course_id"),
        F.col("p_name").alias("assignment_name"),
        F.when(key % 19 == 0, F.lit("soon")).otherwise(due).alias("due_at"),
        F.when(key % 23 == 0, F.lit("ten")).otherwise((key % 20).cast("string"))
        .alias("points_possible"),
        F.lit("2023-12-01").alias("created_at"),
    )


def landed_courses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as course records of the source API, in three workflow states."""
    key = F.col("s_suppkey")
    state = F.when(key % 4 == 0, "completed").when(key % 4 == 1, F.lit(None)).otherwise("available")
    return table(spark, sf_dir, "supplier").select(
        F.when(key % 9 != 0, key).alias("id"),
        F.col("s_name").alias("name"),
        F.concat(F.lit("C"), key.cast("string")).alias("course_code"),
        state.alias("workflow_state"),
    )


def landed_students(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as student records: a login, an empty login or none, and an email."""
    key, name = F.col("c_custkey"), F.lower("c_name")
    login = F.when(key % 3 == 0, F.lit("")).when(key % 3 == 1, F.lit(None)).otherwise(name)
    email = F.when(key % 5 != 0, F.concat(name, F.lit("@example.com")))
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("id"), F.col("c_name").alias("name"),
        login.alias("login_id"), email.alias("email"),
    )


def landed_assignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as assignment records under course folders, some of which are no course."""
    raw = dirty_assignments(spark, sf_dir)
    return raw.withColumnsRenamed({"assignment_id": "id", "assignment_name": "name"})


def landed_submissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty submissions with the user id nested as the API sends it."""
    raw = dirty_submissions(spark, sf_dir)
    user = F.when(F.col("user_id").isNotNull(), F.struct(F.col("user_id").alias("id")))
    return raw.select("id", user.alias("user"), "assignment_id", "submitted_at", "grade", "late", "course_id")


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as numbered pages; the payload is a coarse text size, which repeats."""
    size = F.call_function("div", F.length("text"), F.lit(200))
    return table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("entity"),
        (F.col("turn") + 1).alias("page_no"),
        size.cast("string").alias("payload"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as chat messages: one session per user."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("session_id"),
        F.col("event_id").alias("turn"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("role"),
        F.col("props").alias("text"),
    )


def dense_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as requests of five busy sessions, with time running a thousand times faster."""
    start_ms = 1_704_067_200_000
    offset = F.floor((F.unix_micros(F.col("ts").cast("timestamp")) - start_ms * 1000) / 1_000_000)
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") % 5).alias("session_id"),
        F.col("event_id").alias("turn"),
        F.timestamp_millis(offset + start_ms).alias("ts"),
    )


def landed_in_slices(rows: DataFrame, ts: str, path: str, slices: int) -> None:
    """Rows as files that land one after the other, each a slice of their time span."""
    first, last = rows.agg(F.min(F.unix_micros(ts)), F.max(F.unix_micros(ts))).first()
    width = ((last or 0) - (first or 0)) // slices + 1
    place = F.floor((F.unix_micros(ts) - (first or 0)) / width)
    for number in range(slices):
        rows.where(place == number).coalesce(1).write.mode("append").parquet(path)


def fine_grades(facts: DataFrame) -> DataFrame:
    """Grades with six places: every second student is at 4.996, just below the pass mark, the
    others move by a third of a hundredth."""
    moved = F.col("grade") + F.lit(Decimal("0.003333"))
    just_below = F.when(F.col("grade").isNotNull(), F.lit(Decimal("4.996000")))
    return facts.withColumn("grade", F.when(F.col("student_id") % 2 == 0, just_below).otherwise(moved).cast(GRADE))
