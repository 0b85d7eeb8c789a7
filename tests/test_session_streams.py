"""Rate limit and history over streams against their batch forms."""

import os
import random
import subprocess
import sys
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cohortlens.plans import sessions
from cohortlens.streaming import ledger
from cohortlens.streaming import sessions as streams
from test_sessions import BASE, _expected

SCHEMA = "session_id bigint, turn bigint, ts timestamp, role string, text string"


def _land(spark, path, rows):
    """One more file of rows (session, turn, ms or None)."""
    frame = spark.createDataFrame(
        [(s, n, t, "user" if n is None or n % 2 else "bot", f"{s}-{n}") for s, n, t in rows],
        "session_id bigint, turn bigint, t bigint, role string, text string",
    ).withColumn("ts", F.timestamp_millis("t"))
    frame.select(*[f.split()[0] for f in SCHEMA.split(", ")]).coalesce(1).write.mode("append").parquet(path)
    time.sleep(0.02)  # files are read in the order of their times


def _stream(spark, path):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


def _decisions(spark, path, out, **more):
    """Run over what has landed, and read all decisions so far."""
    decided = streams.limited(_stream(spark, path), **more)
    query = (
        decided.writeStream.outputMode("append").format("parquet").option("path", os.path.join(out, "data"))
        .option("checkpointLocation", os.path.join(out, "state")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    rows = spark.read.schema(decided.schema).parquet(os.path.join(out, "data")).collect()
    return rows, query


def _late(rows, draw, most):
    """Rows in the order in which they arrive, each up to `most` ms late."""
    return sorted(rows, key=lambda r: r[2] + draw.randrange(most))


@pytest.mark.parametrize("late", [1, 50_000])
def test_limiter_equals_the_batch_form_over_several_runs(spark, tmp_path, late):
    draw = random.Random(3)
    by_session = {
        1: [0] * 33 + [61_000],
        2: [draw.randrange(600_000) for _ in range(700)],
        3: [i * 60_000 for i in range(12)],
        4: [i * 60_001 for i in range(12)],
        5: [0, 0, 59_999, 60_000, 60_001, 120_001, 120_002, 180_003],
        None: [draw.randrange(400_000) for _ in range(90)],
    }
    rows = [(s, i, BASE + t) for s, times in by_session.items() for i, t in enumerate(sorted(times))]
    arriving = _late(rows, draw, late)
    # What closes the stream: a session of its own, far ahead, so that all others are decided.
    closing = (99, 0, BASE + 10_000_000)
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(5):
        _land(spark, src, arriving[part::5] if late == 1 and part < 0 else arriving[len(arriving) * part // 5 : len(arriving) * (part + 1) // 5])
        if part in (1, 3):  # ended and begun again from its state
            _decisions(spark, src, out)
    _land(spark, src, [closing])
    got, _ = _decisions(spark, src, out)
    batch = sessions.rate_limit(spark.read.schema(SCHEMA).parquet(src).where("session_id IS NOT NULL AND session_id < 99"))
    expected = {(r.session_id, r.turn): (r.window_start, r.admitted) for r in batch.collect()}
    found = {(r.session_id, r.turn): (r.window_start, r.admitted) for r in got}
    assert len(got) == len(found) == len(rows)
    assert {k: v for k, v in found.items() if k[0] is not None} == expected
    plain = _expected([(0, n, t) for s, n, t in rows if s is None])
    assert {k[1]: v[1] for k, v in found.items() if k[0] is None} == {n: v for (_, n), v in plain.items()}
    assert {(r.session_id, r.turn): r.ts for r in got} == {
        (r.session_id, r.turn): r.ts for r in spark.read.schema(SCHEMA).parquet(src).where("turn >= 0 AND coalesce(session_id, 0) < 99").collect()
    }


def test_a_silent_session_is_forgotten(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    again = 10_000_000
    _land(spark, src, [(1, i, BASE + i) for i in range(40)])
    _land(spark, src, [(2, 0, BASE + 5_000_000)])
    _decisions(spark, src, out, forget_ms=1_000_000)
    _land(spark, src, [(1, 100 + i, BASE + again + i) for i in range(40)])
    _land(spark, src, [(2, 1, BASE + 20_000_000)])
    got, query = _decisions(spark, src, out, forget_ms=1_000_000)
    # Its first request is uncounted again, so 31 pass once more.
    passed = sum(r.admitted for r in got if r.session_id == 1 and r.turn >= 100)
    assert passed == 31
    assert sum(r.admitted for r in got if r.session_id == 1 and r.turn < 100) == 31


def test_too_late_requests_are_dropped_and_nulls_left_out(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _land(spark, src, [(1, 0, BASE), (1, 1, None), (1, None, BASE + 5)])
    _land(spark, src, [(2, 0, BASE + 1_000_000)])
    _land(spark, src, [(1, 2, BASE + 1), (2, 1, BASE + 1_000_001)])
    _land(spark, src, [(9, 0, BASE + 9_000_000)])
    got, _ = _decisions(spark, src, out)
    assert sorted((r.session_id, r.turn) for r in got) == [(1, 0), (2, 0), (2, 1)]


def test_admit_follows_one_request_after_the_other():
    draw = random.Random(8)
    times = np.sort([draw.randrange(900_000) for _ in range(900)])
    plain = _expected([(1, i, int(t)) for i, t in enumerate(times)])
    state, found, done = (None, 0), [], 0
    while done < len(times):
        some = times[done : done + draw.randrange(1, 60)]
        _, admitted, *state = streams.admit(*state, some, 30)
        found += admitted.tolist()
        done += len(some)
    assert found == [plain[1, i] for i in range(len(times))]


def test_history_equals_the_batch_form(spark, tmp_path):
    draw = random.Random(4)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), i, BASE + draw.randrange(10**7)) for i in range(500)]
    rows += [(4, i, BASE) for i in range(30)] + [(5, 1, None), (5, 2, BASE), (5, 3, None), (6, None, None)]
    draw.shuffle(rows)  # in no order of time at all
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(4):
        _land(spark, src, rows[part::4])
        if part != 2:
            streams.history_rollup(_stream(spark, src), out).awaitTermination()
    landed = spark.read.schema(SCHEMA).parquet(src)
    got = streams.history_report(landed, out)
    batch = sessions.recent_history(landed).select("session_id", "ts", "turn", "role", "text")
    assert sorted(map(str, got.drop("place").collect())) == sorted(map(str, batch.collect()))
    assert got.groupBy("session_id").count().where("count > 20").count() == 0
    newest = got.where("place = 1 AND session_id < 5").collect()
    assert all(r.ts == max(x.ts for x in batch.collect() if x.session_id == r.session_id) for r in newest)
    # Run again without anything new: nothing changes.
    streams.history_rollup(_stream(spark, src), out).awaitTermination()
    assert sorted(map(str, streams.history_report(landed, out).collect())) == sorted(map(str, got.collect()))


def test_history_state_is_bounded(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _land(spark, src, [(i % 2, i, BASE + i) for i in range(5_000)])
    query = streams.history_rollup(_stream(spark, src), out)
    query.awaitTermination()
    assert sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]) <= 2 * sessions.HISTORY
    assert len(ledger._Folder(spark, out).current().parts) == 1


def test_streams_run_from_any_folder(tmp_path, data):
    """As a driver does that is started elsewhere and finds the package by its own path only."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {str(tmp_path / "shared")!r}).getOrCreate())
from cohortlens import catalog
queries = catalog.queries()
print("rows", queries["t2_history_stream"](spark, {data!r}).count(), queries["t3_rate_limit_stream"](spark, {data!r}).count())
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=240)
    assert "rows" in done.stdout, done.stderr[-2000:]


class _Handle:
    """State and timers of one session, as a processor sees them."""

    def __init__(self):
        self.of, self.timers = {}, []

    def getMapState(self, name, *schemas):
        return self.of.setdefault(name, _Map())

    def getValueState(self, name, schema):
        return self.of.setdefault(name, _Value())

    getListState = getValueState

    def listTimers(self):
        return list(self.timers)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def registerTimer(self, at):
        self.timers.append(at)


class _Map(dict):
    def updateValue(self, key, value):
        self[key] = value

    getValue, removeKey = dict.__getitem__, dict.__delitem__


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value or []

    def update(self, value):
        self.value = value

    put = update


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def test_limiter_handles_a_busy_session_in_parts(monkeypatch):
    monkeypatch.setattr(streams, "PART_ROWS", 100)
    draw, handle = random.Random(5), _Handle()
    limiter = streams.Limiter(30, None)
    limiter.init(handle)
    rows = [(draw.randrange(300_000_000), n) for n in range(3_000)]
    chunks = [pd.DataFrame(rows[a : a + 250], columns=["us", "turn"]) for a in range(0, 3_000, 250)]
    assert list(limiter.handleInputRows(("=1",), iter(chunks), _Clock(0))) == []
    # What waits is never in one piece, and neither is what is told.
    assert handle.of["waiting"] and all(len(v[1]) <= 100 * 16 for v in handle.of["waiting"].values())
    told = list(limiter.handleExpiredTimer(("=1",), _Clock(200_000), None))
    assert handle.timers == [min(us for us, _ in rows if us >= 200_000_000) // 1000 + 1]
    told += limiter.handleExpiredTimer(("=1",), _Clock(400_000), None)
    assert max(map(len, told)) <= 100 and not handle.of["waiting"] and not handle.timers
    both = pd.concat(told)
    rows.sort()
    assert list(zip(both["us"], both["turn"], strict=True)) == rows
    window, admitted, *_ = streams.admit(None, 0, np.array([us // 1000 for us, _ in rows]), 30)
    assert both["window_start"].tolist() == window.tolist() and both["admitted"].tolist() == admitted.tolist()


def test_history_builds_one_frame_a_session(monkeypatch):
    handle, history = _Handle(), streams.History(3)
    history.init(handle)
    chunks = [pd.DataFrame({"timed": [True] * 2, "us": [a, a], "turned": [True, False], "turn": [a, 0], "role": ["user", None], "text": ["x", None]}) for a in (5, 9, 7)]
    for _ in range(2):
        built, real = [], pd.DataFrame
        with monkeypatch.context() as m:
            m.setattr(streams.pd, "DataFrame", lambda *a, **k: built.append(1) or real(*a, **k))
            m.setattr(streams.pd, "concat", lambda *a, **k: built.extend([1, 1]))
            (told,) = history.handleInputRows(("=1",), iter(chunks), None)
        assert len(built) == 1
    assert told[["us", "turned", "place"]].values.tolist() == [[9, True, 1], [9, True, 2], [9, False, 3]]
