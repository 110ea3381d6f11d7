"""Sessionisation against a brute-force pandas reference, including chains that cross many buckets
and one hot user holding most of the events."""

import datetime as dt

import pandas as pd
import pytest

from dossier.operators import events as EV

GAP = 1800


def brute_sessions(pdf: pd.DataFrame, gap: int = GAP) -> set:
    out = set()
    for user, g in pdf.sort_values(["ts", "event_id"]).groupby("user_id"):
        start = prev = None
        n = 0
        for ts in g["ts"]:
            if prev is None or (ts - prev).total_seconds() > gap:
                if start is not None:
                    out.add((user, start, prev, n))
                start, n = ts, 0
            prev = ts
            n += 1
        out.add((user, start, prev, n))
    return out


def spark_sessions(df, gap=GAP):
    s = EV.sessionize(df, gap_seconds=gap)
    return {(r["user_id"], pd.Timestamp(r["session_start"]), pd.Timestamp(r["session_end"]), r["n_events"])
            for r in s.collect()}


@pytest.mark.parametrize("gap", [0, 60, 1800, 24 * 3600])
def test_sessionize_matches_brute_force_on_events(spark, gap):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    assert spark_sessions(ev, gap) == brute_sessions(ev.select("event_id", "user_id", "ts").toPandas(), gap)


def test_long_chain_and_hot_user(spark):
    base = dt.datetime(2024, 1, 1)
    rows = []
    eid = 0
    # user 1: one event every 20 minutes for three days -> one session crossing every bucket
    for i in range(3 * 72):
        rows.append((eid, base + dt.timedelta(minutes=20 * i), 1)); eid += 1
    # user 2 (hot): bursts with gaps of exactly 30 min (same session) and 31 min (new session)
    t = base
    for i in range(2000):
        t += dt.timedelta(minutes=30 if i % 7 else 31, seconds=0)
        rows.append((eid, t, 2)); eid += 1
    # user 3: duplicates at the same instant
    rows += [(eid, base, 3), (eid + 1, base, 3)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint").repartition(7)
    expected = brute_sessions(df.toPandas())
    assert spark_sessions(df) == expected
    assert len([s for s in expected if s[0] == 1]) == 1


def test_assign_sessions_keeps_every_event(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = EV.assign_sessions(ev)
    assert a.count() == ev.count()
    assert a.filter("session_start IS NULL OR session_start > ts").count() == 0


def test_filters(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    kept = EV.retention(ev, "2024-02-15", 30)
    assert kept.filter("ts < TIMESTAMP_NTZ'2024-01-16 00:00:00'").count() == 0
    consent = spark.createDataFrame([(ev.first()["user_id"],)], "user_id bigint")
    assert EV.consent_filter(ev, consent, "user_id").select("user_id").distinct().count() == 1
    df = spark.createDataFrame([("pending", dt.datetime(2020, 1, 1)), ("pending", dt.datetime(2020, 3, 1)),
                                ("accepted", dt.datetime(2019, 1, 1))], "status string, created_at timestamp_ntz")
    got = [r[0] for r in EV.suggestion_expiry(df, "2020-03-15", 30).collect()]
    assert got == ["archived", "pending", "accepted"]


def test_sessions_do_not_depend_on_session_time_zone(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    utc = spark_sessions(ev)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        other = spark_sessions(ev)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert other == utc


def test_session_groups_match_labelled_events(spark):
    from pyspark.sql import functions as F
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    g = EV.session_groups(ev, ["event_type"], {"vmax": (F.max("value"), F.max)})
    a = EV.assign_sessions(ev).groupBy("user_id", "session_start", "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("value").alias("vmax"))
    cols = ["user_id", "session_start", "event_type", "n_events", "vmax"]
    assert sorted(map(tuple, g.select(*cols).collect())) == sorted(map(tuple, a.select(*cols).collect()))


def test_cold_start_gate_approx_close_to_exact(spark):
    from dossier.operators.metrics import cold_start_gate
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    g = EV.session_groups(ev, ["event_type"], {})
    exact = {r["event_type"]: r["n_sessions"] for r in cold_start_gate(g, ["event_type"], ["user_id", "session_start"]).collect()}
    approx = {r["event_type"]: r["n_sessions"] for r in
              cold_start_gate(g, ["event_type"], ["user_id", "session_start"], approx=0.01).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(approx[k] - exact[k]) <= 0.05 * exact[k] for k in exact)


def test_missing_users_and_times_are_kept(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, t, None, 0), (2, t + dt.timedelta(minutes=5), None, 50), (3, None, 7, 0), (4, t, 7, 0), (5, t, None, 25)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, depth int")
    got = {r["event_id"]: r["session_start"] for r in EV.assign_sessions(df).collect()}
    assert got == {1: t, 2: t, 3: None, 4: t, 5: t}
    assert {(r["user_id"], r["n_events"]) for r in EV.sessionize(df).collect()} == {(None, 3), (7, 1)}
    assert sorted(r["event_id"] for r in EV.bot_filter(df, "depth").collect()) == [1, 2, 3, 5]


def test_small_values_are_not_rounded_away(spark):
    from pyspark.sql import functions as F
    from dossier.operators.metrics import section_engagement, section_heatmap
    df = spark.range(1000).select(F.lit("view").alias("event_type"), F.lit(0.004).alias("value"), F.lit("skills").alias("section"))
    assert section_engagement(df, ["section"]).first()["view_time"] == 4.0
    assert section_heatmap(df, F.lit(1), "section", F.col("value"), ["skills"]).first()["skills"] == 4.0
