"""Session operators over a stream of messages, with their state in Spark's state store.

State is kept by session, so the messages of one session and micro-batch are handled by one task; a
micro-batch bounds how many that are. The session must use the RocksDB state store (`use_state_store`).
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from cohortlens.plans.sessions import HISTORY, PER_WINDOW, WINDOW_MS
from cohortlens.streaming import ledger
from cohortlens.streaming.activity import fold

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Waiting requests are kept in parts of so many at most, each of one minute.
PART_ROWS, MINUTE_US = 100_000, 60_000_000


def _key() -> Column:
    """The session as a text that is never null: a null key would come to Python row by row."""
    return F.coalesce(F.concat(F.lit("="), F.col("session_id").cast("string")), F.lit("")).alias("session")


def _session(kind: str) -> Column:
    named = F.col("session") != ""
    return F.when(named, F.substring("session", 2, 2**31 - 1).cast(kind)).alias("session_id")


def use_state_store(spark: SparkSession) -> SparkSession:
    """Stateful processors need the state store that keeps its rows on disk.

    They travel with their code: the process that Spark starts beside the driver to set them up does
    not get the package that the executors were sent.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    return spark


# -- rate limit -----------------------------------------------------------------------------
def admit(opened: int | None, counted: int, times: np.ndarray, per_window: int) -> tuple[np.ndarray, np.ndarray, int, int]:
    """Decide requests of one session, in order of their times (ms), after an earlier state.

    Returns the window each belongs to, whether it is admitted, and the state after them. A
    session's very first request opens a window and is not counted.
    """
    window, admitted = np.empty(len(times), np.int64), np.zeros(len(times), bool)
    done = 0
    if opened is None:
        opened, counted, done = int(times[0]), 0, 1
        window[0], admitted[0] = opened, True
    while done < len(times):
        if times[done] - opened > WINDOW_MS:
            opened, counted = int(times[done]), 0
        until = int(np.searchsorted(times, opened + WINDOW_MS, side="right"))
        window[done:until] = opened
        room = min(per_window - counted, until - done)
        admitted[done : done + room] = True
        counted, done = counted + room, until
    return window, admitted, opened, counted


class Limiter(StatefulProcessor):
    """Decides requests in the order of their times, once the watermark has passed them.

    Requests that wait are a map state: packed parts of at most PART_ROWS requests, each of one minute,
    so that Python holds the requests of a session's minute at a time and never all that wait. The
    window and its count are a value state. An event timer wakes a session when its earliest waiting
    request is due, or, with `forget_ms`, when it has been silent so long that its state can
    go, as it would begin anew.
    """

    def __init__(self, per_window: int, forget_ms: int | None) -> None:
        self.per_window, self.forget_ms = per_window, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.window = handle.getValueState("window", "opened bigint, counted int, last bigint")
        self.waiting = handle.getMapState("waiting", "minute bigint, part string", "first bigint, requests binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        held, n = [], 0
        for chunk in rows:
            # Spark lets a row pass that came late by the newest watermark; its turn is over.
            timely = chunk.loc[chunk["us"] // 1000 >= watermark, ["us", "turn"]].to_numpy(np.int64)
            held, n = [*held, timely], n + len(timely)
            if n >= PART_ROWS:
                self._keep(np.concatenate(held))
                held, n = [], 0
        if n:
            self._keep(np.concatenate(held))
        yield from self._decide(key, watermark)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._decide(key, timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _keep(self, requests: np.ndarray) -> None:
        """Add requests (us, turn) to those that wait, as parts of one minute."""
        requests = requests[np.argsort(requests[:, 0], kind="stable")]
        minutes = requests[:, 0] // MINUTE_US
        begins = np.flatnonzero(np.diff(minutes, prepend=minutes[0] - 1))
        for a, b in zip(begins, [*begins[1:], len(requests)], strict=True):
            for at in range(a, b, PART_ROWS):
                part = requests[at : min(at + PART_ROWS, b)]
                self.waiting.updateValue((int(minutes[a]), uuid.uuid4().hex), (int(part[0, 0]), part.tobytes()))

    def _decide(self, key, watermark: int) -> Iterator[pd.DataFrame]:
        parts = {}
        for minute, name in list(self.waiting.keys()):
            parts.setdefault(minute, []).append((minute, name))
        # All requests up to the watermark's millisecond, that one left out, have arrived.
        until = watermark * 1000
        opened, counted, last = self.window.get() if self.window.exists() else (None, 0, None)
        first, decided = None, False
        for minute in sorted(parts):
            if minute * MINUTE_US >= until:
                first = min(self.waiting.getValue(p)[0] for p in parts[minute])
                break
            read = [np.frombuffer(self.waiting.getValue(p)[1], np.int64).reshape(-1, 2) for p in parts[minute]]
            known = np.concatenate(read)
            known = known[np.lexsort((known[:, 1], known[:, 0]))]
            n_due = int(np.searchsorted(known[:, 0], until, side="left"))
            if n_due:
                for p in parts[minute]:
                    self.waiting.removeKey(p)
                if n_due < len(known):
                    self._keep(known[n_due:])
                us, turn = known[:n_due].T
                times = us // 1000
                # After a silence that is long enough the session begins anew.
                gaps = np.diff(times, prepend=times[0] if last is None else last)
                begins = np.flatnonzero(gaps > self.forget_ms) if self.forget_ms is not None else np.zeros(0, np.int64)
                for a, b in zip([0, *begins], [*begins, len(times)], strict=True):
                    if a in begins:
                        opened, counted = None, 0
                    if b > a:
                        window, admitted, opened, counted = admit(opened, counted, times[a:b], self.per_window)
                        for at in range(a, b, PART_ROWS):
                            to = min(at + PART_ROWS, b)
                            columns = {"us": us[at:to], "turn": turn[at:to], "window_start": window[at - a : to - a]}
                            told = pd.DataFrame({"session": [key[0]] * (to - at), **columns})
                            yield told.assign(admitted=admitted[at - a : to - a])
                last, decided = int(times[-1]), True
            if n_due < len(known):
                first = int(known[n_due, 0])
                break
        if decided:
            self.window.update((opened, counted, last))
        elif first is None and last is not None and self.forget_ms is not None and last + self.forget_ms < watermark:
            self.window.clear()
            last = None
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        if first is not None:
            self.handle.registerTimer(first // 1000 + 1)
        elif last is not None and self.forget_ms is not None:
            self.handle.registerTimer(last + self.forget_ms + 1)


def limited(
    messages: DataFrame, late_by: str = "1 minute", per_window: int = PER_WINDOW, forget_ms: int | None = None
) -> DataFrame:
    """session_id, turn, ts, window_start (epoch ms) and admitted for each request of a stream.

    Decisions are those of the batch form over the same requests, in whatever order they arrive
    within ``late_by``; what comes later still is dropped. A decision is told when the watermark has
    passed its request. With ``forget_ms`` a request after more silence than that counts as the first
    of its session, and idle state goes; without it state is kept for every session ever seen.
    Requests without a session share one; those without a time or turn cannot be ordered and are
    left out, and so are those before 1970, where watermarks begin.
    """
    use_state_store(messages.sparkSession)
    kind = messages.schema["session_id"].dataType.simpleString()
    turn_kind = messages.schema["turn"].dataType.simpleString()
    given = (
        messages.where(F.col("ts").isNotNull() & F.col("turn").isNotNull())
        .withWatermark("ts", late_by)
        .select(_key(), "ts", F.unix_micros("ts").alias("us"), F.col("turn").cast("bigint").alias("turn"))
    )
    decided = given.groupBy("session").transformWithStateInPandas(
        Limiter(per_window, forget_ms),
        "session string, us bigint, turn bigint, window_start bigint, admitted boolean",
        "Append",
        "EventTime",
    )
    return decided.select(
        _session(kind), F.col("turn").cast(turn_kind).alias("turn"), F.timestamp_micros("us").alias("ts"), "window_start", "admitted"
    )


# -- history --------------------------------------------------------------------------------
_ORDER = ["timed", "us", "turned", "turn"]
_MESSAGE = "timed boolean, us bigint, turned boolean, turn bigint, role string, text string"


class History(StatefulProcessor):
    """The last messages of each session, in a list state of that many rows at most.

    A message that arrives late takes its place among them, or none if all kept ones are newer.
    """

    def __init__(self, size: int) -> None:
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getListState("kept", _MESSAGE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        columns = [f.split()[0] for f in _MESSAGE.split(", ")]
        # Plain rows: a session has few of them, and a frame costs more than sorting them.
        best = [tuple(r) for r in self.kept.get()]
        for chunk in rows:
            values = [chunk[c].tolist() if c in _ORDER else [v if isinstance(v, str) else None for v in chunk[c]] for c in columns]
            best = sorted([*best, *zip(*values, strict=True)], key=lambda r: r[: len(_ORDER)], reverse=True)[: self.size]
        self.kept.put(best)
        yield pd.DataFrame(best, columns=columns).assign(session=key[0], place=range(1, len(best) + 1))

    def close(self) -> None:
        pass


def histories(messages: DataFrame, size: int = HISTORY) -> DataFrame:
    """For every session with a message in a micro-batch its last ``size`` messages, place 1 the
    newest: session_id, place, ts, turn, role, text. Those without a time count as the oldest."""
    use_state_store(messages.sparkSession)
    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("session_id", "turn")}
    given = messages.select(
        _key(),
        F.col("ts").isNotNull().alias("timed"),
        F.coalesce(F.unix_micros("ts"), F.lit(0)).alias("us"),
        F.col("turn").isNotNull().alias("turned"),
        F.coalesce(F.col("turn").cast("bigint"), F.lit(0)).alias("turn"),
        "role",
        "text",
    )
    told = given.groupBy("session").transformWithStateInPandas(
        History(size), f"session string, place int, {_MESSAGE}", "Update", "None"
    )
    return told.select(
        _session(kinds["session_id"]),
        "place",
        F.when(F.col("timed"), F.timestamp_micros("us")).alias("ts"),
        F.when(F.col("turned"), F.col("turn")).cast(kinds["turn"]).alias("turn"),
        "role",
        "text",
    )


def _newest(rows: DataFrame) -> DataFrame:
    """Of each session what its last batch told."""
    session = Window.partitionBy("session_id")
    return rows.withColumn("_last", F.max("batch").over(session)).where("batch = _last").drop("_last")


def _schema(messages: DataFrame) -> str:
    kinds = {c: messages.schema[c].dataType.simpleString() for c in ("session_id", "ts", "turn")}
    fields = f"session_id {kinds['session_id']}, place int, ts {kinds['ts']}, turn {kinds['turn']}"
    return f"{fields}, role string, text string, batch bigint"


def history_rollup(messages: DataFrame, path: str, size: int = HISTORY) -> StreamingQuery:
    """Keep the last messages of all sessions of a stream in the ledger under ``path``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        told = batch.withColumn("batch", F.lit(batch_id).cast("bigint"))
        ledger.append(batch.sparkSession, path, batch_id, told, schema, _newest)

    schema = _schema(messages)
    return fold(histories(messages, size), write, path, "update")


def history_report(messages: DataFrame, path: str) -> DataFrame:
    """The last messages of each session as of the last batch; ``messages`` tells the types."""
    rows = ledger.snapshot(messages.sparkSession, path, _schema(messages))
    return _newest(rows).drop("batch")
