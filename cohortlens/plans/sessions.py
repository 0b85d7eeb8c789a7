"""Chat-session operators over a message table (session_id, ts, turn, role, text)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions import text as X
from cohortlens.operators.ranking import last_n
from cohortlens.session import ensure_checkpoint_dir

HISTORY = 20
WINDOW_MS = 60_000
PER_WINDOW = 30


def tag_intents(messages: DataFrame, fold_d: bool = False) -> DataFrame:
    return messages.withColumn("normalized", X.normalize(F.col("text"), fold_d)).withColumn(
        "intent", X.intent(F.col("normalized"))
    )


def validate(messages: DataFrame) -> DataFrame:
    reason = X.reject_reason(F.col("text"))
    return messages.withColumn("reject_reason", reason).withColumn("accepted", reason.isNull())


def recent_history(messages: DataFrame, n: int = HISTORY) -> DataFrame:
    """Last ``n`` messages of each session."""
    return last_n(messages, ["session_id"], [F.desc("ts"), F.desc("turn")], n)


# -- rate limit -----------------------------------------------------------------------------
# A window opens at a session's first request and reopens at the first request later than
# window + 60 s; 30 counted requests pass per window, and the session's very first request is
# not counted. Which request opens a window depends on the opening before it, so the openings
# form a chain. To follow it without gathering a session in one task:
#   1. requests are reduced to distinct milliseconds per session;
#   2. for every hour, each request an earlier window can lead to (those of the first 60 s and
#      the first one after) is mapped to the last opening of the hour it leads to;
#   3. maps of FAN_IN neighboring spans are merged, level by level;
#   4. on the way back every span learns the opening it starts from.
# A map has at most 60,001 rows, so every group below has a fixed bound. Times count from each
# session's first request, and there are as many levels as the longest session needs.
HOUR_MS = 3_600_000
FAN_IN = 100


def _pass_through(spans: list, opened: np.ndarray) -> np.ndarray:
    """Last opening after walking through the spans, for each opening before them."""
    for entry, last in spans:
        at = np.searchsorted(entry, opened + WINDOW_MS, side="right")
        opened = np.where(at < len(entry), last[np.minimum(at, len(entry) - 1)], opened)
    return opened


def _reachable(times: np.ndarray, start: int) -> np.ndarray:
    """Requests an earlier window can lead to."""
    return times[: int(np.searchsorted(times, start + WINDOW_MS, side="left")) + 1]


def _hour_map(times: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    following = np.searchsorted(times, times + WINDOW_MS, side="right")
    # Pointer doubling: each step takes every request twice as far along its chain.
    ahead = np.append(np.where(following < len(times), following, np.arange(len(times))), len(times))
    while not np.array_equal(ahead, further := ahead[ahead]):
        ahead = further
    last = times[ahead[:-1]]
    entry = _reachable(times, start)
    return entry, last[: len(entry)]


def _spans(pdf: pd.DataFrame) -> tuple[list, list]:
    ordered = pdf.sort_values(["span", "entry"]).groupby("span", sort=True)
    numbers, maps = [], []
    for number, rows in ordered:
        numbers.append(number)
        maps.append((rows["entry"].to_numpy(), rows["last"].to_numpy()))
    return numbers, maps


def _map_hours(times: DataFrame, session_type: str) -> DataFrame:
    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        entry, last = _hour_map(np.sort(pdf["t"].to_numpy()), int(key[1]) * HOUR_MS)
        return pd.DataFrame({"session_id": key[0], "span": key[1], "entry": entry, "last": last})

    schema = f"session_id {session_type}, span bigint, entry bigint, last bigint"
    hours = times.withColumn("span", _parent("t", HOUR_MS))
    return hours.groupBy("session_id", "span").applyInPandas(build, schema)


def _merge_spans(maps: DataFrame, level: int) -> DataFrame:
    def merge(key, pdf: pd.DataFrame) -> pd.DataFrame:
        _, spans = _spans(pdf)
        start = int(key[1]) * HOUR_MS * FAN_IN**level
        entry = _reachable(np.concatenate([e for e, _ in spans]), start)
        # An opening 60.001 s before a request leads to exactly that request.
        last = _pass_through(spans, entry - WINDOW_MS - 1)
        return pd.DataFrame({"session_id": key[0], "span": key[1], "entry": entry, "last": last})

    parents = maps.withColumn("parent", _parent("span", FAN_IN)).groupBy("session_id", "parent")
    return parents.applyInPandas(merge, maps.schema)


def _hand_down(maps: DataFrame, incoming: DataFrame | None) -> DataFrame:
    """Opening each span starts from, given the one its parent starts from."""
    session_type = maps.schema["session_id"].dataType.simpleString()

    def walk(key, pdf: pd.DataFrame) -> pd.DataFrame:
        numbers, spans = _spans(pdf)
        opened, states = np.array([pdf["opened"].iloc[0]]), []
        for span in spans:
            states.append(opened[0])
            opened = _pass_through([span], opened)
        return pd.DataFrame({"session_id": key[0], "span": numbers, "opened": states})

    rows = maps.withColumn("parent", _parent("span", FAN_IN))
    if incoming is None:
        rows = rows.withColumn("opened", F.lit(-WINDOW_MS - 1).cast("bigint"))
    else:
        rows = rows.join(incoming.withColumnRenamed("span", "parent"), ["session_id", "parent"])
    schema = f"session_id {session_type}, span bigint, opened bigint"
    return rows.groupBy("session_id", "parent").applyInPandas(walk, schema)


def _parent(column: str, size: int) -> Column:
    return F.floor(F.col(column) / size).cast("bigint")


def _openings(times: DataFrame, incoming: DataFrame, session_type: str) -> DataFrame:
    """The window each distinct request time belongs to."""

    def walk(key, pdf: pd.DataFrame) -> pd.DataFrame:
        t = np.sort(pdf["t"].to_numpy())
        opened = np.empty(len(t), dtype="int64")
        current, done = int(pdf["opened"].iloc[0]), 0
        while done < len(t):
            until = int(np.searchsorted(t, current + WINDOW_MS, side="right"))
            opened[done:until] = current
            if until < len(t):
                current = int(t[until])
            done = until
        return pd.DataFrame({"session_id": key[0], "t": t, "opened": opened})

    rows = times.withColumn("span", _parent("t", HOUR_MS)).join(incoming, ["session_id", "span"])
    schema = f"session_id {session_type}, t bigint, opened bigint"
    return rows.groupBy("session_id", "span").applyInPandas(walk, schema)


def rate_limit(messages: DataFrame, per_window: int = PER_WINDOW) -> DataFrame:
    """Flags each request with ``window_start`` (epoch ms) and ``admitted``."""
    ensure_checkpoint_dir(messages.sparkSession)
    session_type = messages.schema["session_id"].dataType.simpleString()
    begins = messages.groupBy("session_id").agg(F.min(F.unix_millis("ts")).alias("_origin"))
    requests = messages.join(begins, "session_id").withColumn("t", F.unix_millis("ts") - F.col("_origin"))
    times = requests.groupBy("session_id", "t").agg(F.count("*").alias("n")).checkpoint()

    maps = [_map_hours(times, session_type).checkpoint()]
    longest = times.agg(F.max("t")).first()[0] or 0
    levels = 1
    while FAN_IN**levels * HOUR_MS <= longest:
        levels += 1
    for level in range(1, levels):
        maps.append(_merge_spans(maps[-1], level).checkpoint())
    incoming = None
    for level_maps in reversed(maps):
        incoming = _hand_down(level_maps, incoming)
    openings = _openings(times, incoming, session_type)

    # A window has at most one row per millisecond of 60 s.
    in_window = Window.partitionBy("session_id", "opened").orderBy("t")
    before = F.sum("n").over(in_window.rowsBetween(Window.unboundedPreceding, -1))
    quota = (
        openings.join(times, ["session_id", "t"])
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .select("session_id", "t", "opened", "_before")
    )
    first = openings.groupBy("session_id").agg(F.min("opened").alias("_first"))
    allowed = F.lit(per_window) + (F.col("opened") == F.col("_first")).cast("int") - F.col("_before")
    quota = quota.join(first, "session_id").select(
        "session_id", "t", F.col("opened").alias("window_start"), allowed.alias("_allowed")
    )
    # Only the first requests of a millisecond can pass; the group limit runs before the shuffle.
    by_turn = Window.partitionBy("session_id", "t").orderBy("turn")
    early = (
        requests.select("session_id", "t", "turn")
        .withColumn("_rank", F.row_number().over(by_turn))
        .filter(F.col("_rank") <= per_window + 1)
        .join(quota, ["session_id", "t"])
        .filter(F.col("_rank") <= F.col("_allowed"))
        .select("session_id", "t", "turn", F.lit(True).alias("_pass"))
    )
    return (
        requests.join(quota.select("session_id", "t", "window_start"), ["session_id", "t"])
        .withColumn("window_start", F.col("window_start") + F.col("_origin"))
        .join(early, ["session_id", "t", "turn"], "left")
        .withColumn("admitted", F.coalesce("_pass", F.lit(False)))
        .drop("t", "_origin", "_pass")
    )
