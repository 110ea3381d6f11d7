"""Behavioural-event operators in batch form (ST3 batch, F4-F7, J3).

Sessionisation never sorts the events of a user.  Time is cut into slices as
wide as the session gap, so all events of one (user, slice) belong to one
session, and a hash aggregate with map-side combine reduces them to one
summary row, however many there are.  Sessions are then found on the
summaries, whose number per user is bounded by the time span.  A missing
user is a visitor of its own (null keys compare equal); an event without a
time belongs to no session.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import broadcast_if_small

def epoch_micros(ts: Column | str) -> Column:
    """Microseconds since 1970 for a TIMESTAMP_NTZ (``unix_micros`` rejects NTZ)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", epoch, c.cast("timestamp_ntz"))


def micros_to_ntz(us: Column | str) -> Column:
    """Microseconds since 1970 -> TIMESTAMP_NTZ (UTC wall clock), independent of the session time zone."""
    c = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", c, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def ntz_to_instant(ts: Column | str) -> Column:
    """TIMESTAMP_NTZ -> TIMESTAMP read as UTC, independent of the session time zone."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts: Column | str) -> Column:
    """TIMESTAMP -> its UTC wall-clock time as TIMESTAMP_NTZ, independent of the session time zone."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return micros_to_ntz(F.unix_micros(c))


def _sliced(events: DataFrame, user: str, ts: str, gap_seconds: int) -> DataFrame:
    """Add ``__u`` (the user as a struct, so null users compare equal in joins too), ``__us`` and the slice ``__b``."""
    width = max(gap_seconds * 1_000_000, 1)
    ev = events.withColumns({"__u": F.struct(F.col(user).alias("id")), "__us": epoch_micros(ts)})
    return ev.withColumn("__b", F.col("__us") - F.pmod(F.col("__us"), F.lit(width)))


def _summaries(ev: DataFrame, gap_seconds: int, keys: list[str], aggs: dict[str, Column]) -> DataFrame:
    """One row per (user, slice, *keys) with its first and last time, its count, ``aggs`` and the start of its session.

    A row lies in one session, so a session starts where a row's first time is more than the gap after the
    latest time of all earlier rows.
    """
    part = ev.where(F.col("__us").isNotNull()).groupBy("__u", "__b", *keys).agg(
        F.min("__us").alias("__fs"), F.max("__us").alias("__fe"), F.count(F.lit(1)).alias("__n"),
        *[c.alias(n) for n, c in aggs.items()])
    return _with_heads(part, gap_seconds)


def _with_heads(part: DataFrame, gap_seconds: int) -> DataFrame:
    """Slice summaries with the start of the session that each lies in."""
    w = Window.partitionBy("__u").orderBy("__fs")
    before = F.max("__fe").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = before.isNull() | ((F.col("__fs") - before) > gap_seconds * 1_000_000)
    part = part.withColumn("__open", F.when(opens, F.col("__fs")))
    head = F.last("__open", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return part.withColumn("__head", head).drop("__open")


def sessions_of_slices(slices: DataFrame, user: str = "user_id", gap_seconds: int = 1800,
                       closed_before: str | None = None) -> DataFrame:
    """Sessions from slice summaries (user, first_ts, last_ts, n_events), as ``sessionize`` gives them from the events.

    A summary covers events of one user in a slice no wider than the gap; one slice may come in several rows.  With
    ``closed_before`` only sessions that no event at or after that time can still join.
    """
    part = slices.select(F.struct(F.col(user).alias("id")).alias("__u"), epoch_micros("first_ts").alias("__fs"),
                         epoch_micros("last_ts").alias("__fe"), F.col("n_events").alias("__n"))
    out = _with_heads(part, gap_seconds).groupBy("__u", "__head").agg(F.max("__fe").alias("__end"), F.sum("__n").alias("n_events"))
    out = out.select(F.col("__u.id").alias(user), micros_to_ntz("__head").alias("session_start"), micros_to_ntz("__end").alias("session_end"),
                     "n_events", F.floor((F.col("__end") - F.col("__head")) / 1000).cast("bigint").alias("duration_ms"))
    if closed_before is not None:
        out = out.where(F.timestamp_add("SECOND", F.lit(gap_seconds), "session_end") < F.lit(closed_before).cast("timestamp_ntz"))
    return out


def _label(ev: DataFrame, summaries: DataFrame, *extra: str) -> DataFrame:
    """Join each event to the start of its session (null for an event without a time)."""
    out = ev.join(summaries.select("__u", "__b", "__head", *extra), ["__u", "__b"], "left")
    return out.withColumn("session_start", micros_to_ntz("__head")).drop("__u", "__us", "__b", "__head")


def assign_sessions(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """ST3 (batch): add ``session_start`` to every event - a new session starts after a gap > ``gap_seconds``."""
    ev = _sliced(events, user, ts, gap_seconds)
    out = _label(ev, _summaries(ev, gap_seconds, [], {}))
    return out.select(*events.columns, "session_start")


def session_groups(events: DataFrame, keys: list[str], aggs: dict[str, tuple[Column, Callable[[Column], Column]]],
                   user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """Aggregates per (user, session, *keys) in one pass over the events, without a join.

    ``aggs`` maps an output name to (aggregate over events, merge over slices),
    e.g. ``{"max_depth": (F.max("depth"), F.max)}``.  Events without a time are in no session.
    """
    part = _summaries(_sliced(events, user, ts, gap_seconds), gap_seconds, keys, {n: a for n, (a, _) in aggs.items()})
    merged = part.groupBy("__u", "__head", *keys).agg(
        F.max("__fe").alias("__end"), F.sum("__n").alias("n_events"), *[m(F.col(n)).alias(n) for n, (_, m) in aggs.items()])
    return merged.select(F.col("__u.id").alias(user), *keys, micros_to_ntz("__head").alias("session_start"),
                         micros_to_ntz("__end").alias("session_end"), "n_events", *aggs)


def sessions_from_events(assigned: DataFrame, user: str = "user_id", ts: str = "ts") -> DataFrame:
    """Per-session summary of events that carry ``session_start``."""
    return (assigned.groupBy(user, "session_start")
            .agg(F.max(ts).alias("session_end"), F.count(F.lit(1)).alias("n_events"))
            .withColumn("duration_ms", F.timestamp_diff("MILLISECOND", F.col("session_start"), F.col("session_end"))))


def sessionize(events: DataFrame, user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800) -> DataFrame:
    """ST3 (batch): one row per session - user, start, end, event count, duration in ms."""
    s = session_groups(events, [], {}, user, ts, gap_seconds)
    return s.withColumn("duration_ms", F.timestamp_diff("MILLISECOND", F.col("session_start"), F.col("session_end")))


def consent_filter(events: DataFrame, consent: DataFrame, on: list[str] | str) -> DataFrame:
    """keep only events of visitors present in the consent table (left semi join)."""
    return events.join(consent, on, "left_semi")


def bot_filter(events: DataFrame, depth: str, user: str = "user_id", ts: str = "ts", gap_seconds: int = 1800,
               min_duration_ms: int = 2000) -> DataFrame:
    """sessionise, then drop events of sessions shorter than ``min_duration_ms`` whose deepest scroll is 0.

    Sessions are judged on the summaries and events are joined to the verdict once.  Returns the kept
    events with ``session_start``; an event without a time is in no session and is kept.
    """
    ev = _sliced(events, user, ts, gap_seconds)
    ws = Window.partitionBy("__u", "__head")
    end, deepest = F.max("__fe").over(ws), F.coalesce(F.max("__dmax").over(ws), F.lit(0))
    judged = _summaries(ev, gap_seconds, [], {"__dmax": F.max(depth)}).withColumn(
        "__bot", ((end - F.col("__head")) < min_duration_ms * 1000) & (deepest == 0))
    return _label(ev, judged, "__bot").where(~F.coalesce("__bot", F.lit(False))).select(*events.columns, "session_start")


def _cutoff(as_of: str, days: int) -> Column:
    """``as_of - days`` as a TIMESTAMP_NTZ literal, so the comparison is pushed into the scan."""
    t = _dt.datetime.fromisoformat(as_of) - _dt.timedelta(days=days)
    return F.lit(t.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def retention(events: DataFrame, as_of: str, days: int = 90, ts: str = "ts") -> DataFrame:
    """keep raw events newer than ``as_of - days``; pushed down to the scan / partition filter."""
    return events.filter(F.col(ts) >= _cutoff(as_of, days))


def suggestion_expiry(df: DataFrame, as_of: str, days: int = 30, status: str = "status",
                      created: str = "created_at") -> DataFrame:
    """pending items older than ``days`` become 'archived'."""
    st = F.col(status)
    return df.withColumn(status, F.when((st == "pending") & (F.col(created) < _cutoff(as_of, days)),
                                        F.lit("archived")).otherwise(st))


def known_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Keep rows whose value is in an allow-list (semi join; the list is broadcast when small)."""
    allow = df.sparkSession.createDataFrame([(v,) for v in allowed], "__v string")
    return df.join(broadcast_if_small(allow, known_rows=len(allowed)), F.col(column) == F.col("__v"), "left_semi")
