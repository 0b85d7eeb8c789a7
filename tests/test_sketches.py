"""Reports from stored sketches against their exact forms."""

import datetime

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import reports, sketches

START = datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)


@pytest.fixture(scope="module")
def facts(spark):
    """Sixty thousand submissions of many students, every few seconds for ten days."""
    n = F.col("id")
    rows = spark.range(60_000).select(
        (F.pmod(F.xxhash64(n), F.lit(30_000))).alias("student_id"),
        (n % 3).alias("course_id"),
        F.timestamp_seconds(F.lit(int(START.timestamp())) + n * 14 + 1).alias("submitted_at"),
    )
    return rows.unionByName(rows.limit(5).withColumn("student_id", F.lit(None).cast("bigint"))).checkpoint()


def _near(estimate, exact):
    return abs(estimate - exact) <= max(1, 4 * sketches.STANDARD_ERROR * exact)


def test_students_by_course(facts):
    exact = {r.course_id: r for r in facts.groupBy("course_id").agg(
        F.count("*").alias("n"), F.count_distinct("student_id").alias("s"), F.max("submitted_at").alias("t")
    ).collect()}
    stored = sketches.hourly_sketches(facts)
    for rows in (stored, sketches.merged(stored.unionByName(stored.limit(0)))):
        told = sketches.students_by_course(rows).collect()
        assert {r.course_id: (r.submissions, r.last_activity) for r in told} == {c: (r.n, r.t) for c, r in exact.items()}
        assert all(_near(r.students, exact[r.course_id].s) for r in told)


@pytest.mark.parametrize("seconds", [0, 1, 1800, 3600, 90_000])
def test_recent_activity_counts_whole_periods(facts, seconds):
    """The submissions are exact wherever a period begins in its hour."""
    stored = sketches.hourly_sketches(facts).checkpoint()
    as_of = F.lit(START + datetime.timedelta(days=9, seconds=seconds))
    upto = facts.where(F.col("submitted_at") <= as_of)
    kept = sketches.hourly_sketches(upto)
    exact, told = reports.recent_activity(upto, as_of).first(), sketches.recent_activity(kept, upto, as_of).first()
    assert (told.submissions_24h, told.submissions_7d) == (exact.submissions_24h, exact.submissions_7d)
    assert _near(told.active_students_24h, exact.active_students_24h) and _near(told.active_students_7d, exact.active_students_7d)
    assert stored.count() == 3 * 234


def test_recent_activity_without_rows(facts):
    none = facts.limit(0)
    assert tuple(sketches.recent_activity(sketches.hourly_sketches(none), none).first()) == (0, 0, 0, 0)
    newest = sketches.recent_activity(sketches.hourly_sketches(facts), facts).first()
    assert newest.submissions_24h == reports.recent_activity(facts).first().submissions_24h


def test_who_stayed_and_who_left(facts):
    days = [F.lit(START + datetime.timedelta(days=d)) for d in (0, 4, 10)]
    told = sketches.stayed_and_left(sketches.hourly_sketches(facts), tuple(days[:2]), tuple(days[1:])).collect()
    sets = {}
    for r in facts.where("student_id IS NOT NULL").collect():
        late = r.submitted_at >= (START + datetime.timedelta(days=4)).replace(tzinfo=None)
        sets.setdefault(r.course_id, (set(), set()))[late].add(r.student_id)
    for r in told:
        a, b = sets[r.course_id]
        bound = max(1, 6 * sketches.STANDARD_ERROR * len(a | b))
        assert abs(r.stayed - len(a & b)) <= bound and abs(r.left - len(a - b)) <= bound and abs(r.new - len(b - a)) <= bound
