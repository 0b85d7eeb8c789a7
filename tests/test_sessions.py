"""History, rate limit and streams."""

import random

from pyspark.sql import functions as F

from cohortlens.plans import reports, sessions
from cohortlens.sources import fixtures
from cohortlens.streaming import activity as streams

BASE = 1_704_067_200_000


def _requests(spark, by_session):
    rows = [(s, i, BASE + t) for s, times in by_session.items() for i, t in enumerate(sorted(times))]
    frame = spark.createDataFrame(rows, "session_id bigint, turn bigint, t bigint")
    return rows, frame.select("session_id", "turn", F.timestamp_millis("t").alias("ts"))


def _expected(rows):
    state, admitted = {}, {}
    for session, turn, t in sorted(rows):
        if session not in state:
            state[session] = [t, 0]
            admitted[session, turn] = True
            continue
        window = state[session]
        if t - window[0] > 60_000:
            window[:] = [t, 0]
        admitted[session, turn] = window[1] < 30
        window[1] += admitted[session, turn]
    return admitted


def test_rate_limit_matches_a_sequential_run(spark):
    rng = random.Random(5)
    hour, day = 3_600_000, 86_400_000
    rows, frame = _requests(
        spark,
        {
            1: [0] * 33 + [61_000],
            2: [rng.randrange(3 * hour) for _ in range(2_000)],
            3: [rng.randrange(200 * day) for _ in range(300)],
            4: [i * 700 for i in range(9_000)],
            5: [i * 60_000 for i in range(100)],
            6: [i * 60_001 for i in range(100)],
            7: [0, 0, 59_999, 60_000, 60_001, 120_001, 120_002, 180_003],
            8: [rng.randrange(1, 9) * 100 * hour + rng.randrange(-90_000, 90_000) for _ in range(900)],
        },
    )
    got = {(r.session_id, r.turn): r.admitted for r in sessions.rate_limit(frame).collect()}
    expected = _expected(rows)
    assert got == expected
    assert sum(v for (s, _), v in got.items() if s == 1) == 32


def test_rate_limit_holds_before_1970_and_after_2084(spark):
    rng = random.Random(7)
    spread = sorted(rng.randrange(-BASE - 5_000_000, -BASE + 5_000_000) for _ in range(300))
    far = 3_700_000_000_000 - BASE
    rows, frame = _requests(spark, {1: spread, 2: [0, far - 30_000, far, far + 30_001, far + 30_002], 3: [5]})
    got = {(r.session_id, r.turn): r.admitted for r in sessions.rate_limit(frame, 30).collect()}
    assert got == _expected(rows)
    starts = {r.window_start for r in sessions.rate_limit(frame).where("session_id = 2").collect()}
    assert starts == {BASE, BASE + far - 30_000, BASE + far + 30_001}


def test_history_keeps_the_last_twenty(spark):
    _, frame = _requests(spark, {1: [i * 10_000 for i in range(25)], 2: [0, 1]})
    kept = sessions.recent_history(frame).groupBy("session_id").agg(F.min("turn"), F.count("*"))
    assert {tuple(r) for r in kept.collect()} == {(1, 5, 20), (2, 0, 2)}
    plan = sessions.recent_history(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def _event_files(spark, data, path, parts):
    """Files that land one after the other in time order. Written at once, their order would
    be arbitrary, and the watermark would drop the rows of a file that comes too late."""
    events = spark.read.parquet(f"{data}/events.parquet")
    schema = events.schema
    days = F.dayofmonth("ts")
    for part in range(parts):
        piece = events.filter(F.floor((days - 1) * parts / 31) == part)
        piece.coalesce(1).write.mode("append").parquet(path)
    raw = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    return fixtures.activity_from(raw)


def test_weekly_stream_equals_the_batch_report(spark, data, tmp_path):
    stream = _event_files(spark, data, str(tmp_path / "in"), 4)
    path = str(tmp_path / "weekly")
    streams.weekly_rollup(stream, path).awaitTermination()
    batch = reports.weekly_trends(fixtures.activity(spark, data)).collect()
    assert streams.weekly_report(spark, path).collect() == batch
    streams.weekly_rollup(stream, path).awaitTermination()
    assert streams.weekly_report(spark, path).collect() == batch


def test_activity_stream_counts(spark, data, tmp_path):
    stream = _event_files(spark, data, str(tmp_path / "in"), 4)
    windows = streams.run_to_table(streams.activity_windows(stream), str(tmp_path / "out"))
    batch = fixtures.activity(spark, data).groupBy(F.window("submitted_at", "24 hours", "1 hour")).agg(
        F.count("*").alias("n"), F.count_distinct("student_id").alias("s")
    )
    exact = batch.select(F.col("window.start").alias("window_start"), "n", "s")
    joined = windows.join(exact, "window_start").collect()
    assert len(joined) == windows.count() > 600
    assert all(r.submissions == r.n for r in joined)
    assert all(abs(r.active_students - r.s) <= max(1, 0.1 * r.s) for r in joined)


def test_activity_rollup_has_the_newest_windows_and_survives_a_replay(spark, data, tmp_path):
    stream = _event_files(spark, data, str(tmp_path / "in"), 4)
    path = str(tmp_path / "hours")
    batch = fixtures.activity(spark, data).groupBy(F.window("submitted_at", "24 hours", "1 hour")).agg(
        F.count("*").alias("n"), F.count_distinct("student_id").alias("s")
    )
    exact = {r.window.start: (r.n, r.s) for r in batch.collect()}
    for _ in range(2):
        streams.activity_rollup(stream, path).awaitTermination()
        got = streams.activity_report(spark, path).collect()
        assert {r.window_start: r.submissions for r in got} == {w: n for w, (n, _) in exact.items()}
        assert all(abs(r.active_students - exact[r.window_start][1]) <= max(2, 0.05 * exact[r.window_start][1]) for r in got)
