"""Streaming queries (ST1-ST6).

Each query writes its input files with Spark from the driver's tables into a
fresh folder under ``spark.checkpoint.dir``, runs the stream to completion
with an ``availableNow`` trigger, and returns the sink read back as a batch
DataFrame.  Where the closed stream equals a batch query, the oracle is that
batch SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.events import instant_to_ntz, sessions_of_slices
from ..session import scratch_path
from ..sources.store import ChangeLog
from ..streaming import events as SE
from .base import register, sql_on_tables, table
from .events_plans import K_SPARK, SECTION_OF_K, SESS_CTE, EV_CTE
from .keyed_plans import CHANGES


#: Events a flush holds at most, and buffer files that a trigger takes at most (so a million events).
FLUSH_EVENTS, FILES_PER_TRIGGER = 1000, 1000


def _write_event_files(spark: SparkSession, d: str, root: str, copies: int = 1,
                       max_events_per_file: int = 1000) -> str:
    """Events as a file buffer: one folder per day, files of at most ``max_events_per_file`` events."""
    ev = table(spark, d, "events")
    src = f"{root}/source"
    for c in range(copies):
        day = ev.withColumn("__day", F.date_format("ts", "yyyy-MM-dd")).repartition("__day")
        SE.write_buffer(day, src, max_events_per_file, ["__day"])
    return src


def _read_stream(spark, src, schema_df: DataFrame, max_files: int | None = None) -> DataFrame:
    return SE.event_source(spark, src, schema_df.schema, max_files_per_trigger=max_files, recursive=True)


def _events_back(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[instant_to_ntz(c).alias(c) if c == "ts" else F.col(c) for c in cols])


@register("event_ingest", "SELECT * FROM events")
def q_event_ingest(spark, d):
    root = scratch_path(spark, "ingest")
    src = _write_event_files(spark, d, root)
    ev = table(spark, d, "events")
    q = SE.ingest(_read_stream(spark, src, ev), f"{root}/sink", f"{root}/ckpt")
    q.awaitTermination()
    return _events_back(spark.read.parquet(f"{root}/sink"), ev.columns)


@register("micro_batch_flush", "SELECT * FROM events")
def q_micro_batch_flush(spark, d):
    """ST2: flushes of at most 1000 events: buffer files and appended files hold at most 1000, and a trigger appends
    many at once, so a backlog drains in few triggers; the sink equals the input.  In production the trigger is
    ``processingTime='60 seconds'``."""
    root = scratch_path(spark, "flush")
    ev = table(spark, d, "events")
    src = f"{root}/source"
    SE.write_buffer(ev, src, max_events_per_file=FLUSH_EVENTS)
    q = SE.ingest(_read_stream(spark, src, ev, max_files=FILES_PER_TRIGGER), f"{root}/sink", f"{root}/ckpt",
                  max_events_per_flush=FLUSH_EVENTS)
    q.awaitTermination()
    return _events_back(spark.read.parquet(f"{root}/sink"), ev.columns)


@register("stream_dedup", "SELECT * FROM events")
def q_stream_dedup(spark, d):
    """ST4: every event delivered twice (client retries); the stream keeps one of each."""
    root = scratch_path(spark, "dedup")
    src = _write_event_files(spark, d, root, copies=2)
    ev = table(spark, d, "events")
    dedup = SE.stream_dedup(_read_stream(spark, src, ev), ["event_id"], "ts", "1 hour")
    q = SE.ingest(dedup, f"{root}/sink", f"{root}/ckpt")
    q.awaitTermination()
    return _events_back(spark.read.parquet(f"{root}/sink"), ev.columns)


@register("windowed_engagement", f"""WITH {EV_CTE}
SELECT date_trunc('day', ts) AS window_start, section, CAST(count_if(event_type = 'view') AS BIGINT) AS views,
  CAST(coalesce(sum(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS view_time,
  CAST(count_if(event_type = 'click') AS BIGINT) AS interactions,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'error' THEN -1 ELSE 0 END) AS BIGINT) AS feedback
FROM ev2 GROUP BY 1, 2""")
def q_windowed_engagement(spark, d):
    """ST5: daily engagement per section in append mode: each (day, section) is written once, when the
    watermark passes the day; the input is closed with end-of-input markers (see ``_close``)."""
    root = scratch_path(spark, "engagement")
    src = _write_event_files(spark, d, root)
    ev = table(spark, d, "events")

    def run():
        stream = _read_stream(spark, src, ev).withColumn("k", F.expr(K_SPARK)).withColumn(
            "section", F.when(F.col("user_id") == -1, F.lit(_MARKER)).otherwise(F.expr(SECTION_OF_K)))
        agg = SE.windowed_engagement(stream, ["section"], "ts", "1 day", "1 hour")
        SE.ingest(agg, f"{root}/sink", f"{root}/ckpt").awaitTermination()

    _close(run, ev, src)
    return spark.read.parquet(f"{root}/sink").filter(F.col("section") != _MARKER)


_MARKER = "end-of-input"


def _close(run, ev: DataFrame, src: str) -> None:
    """Run a checkpointed stream to the end of its input files, then close it.

    Append-mode windows are emitted once the watermark passes them, and the
    watermark a batch uses is the one reached by the batch before.  So after
    the real files, two end-of-input marker events (user -1, two and four days
    after the last real event) are appended, restarting the same checkpointed
    query after each; the markers are not part of any result.
    """
    run()
    last = ev.agg(F.max("ts").alias("m"))
    for days in (2, 4):
        marker = last.select(
            F.lit(-1).cast("bigint").alias("event_id"), (F.col("m") + F.expr(f"INTERVAL {days} DAYS")).alias("ts"),
            F.lit(-1).cast("bigint").alias("user_id"), F.lit("end-of-input").alias("event_type"),
            F.lit(0.0).alias("value"), F.lit("{}").alias("props"))
        marker.select(*ev.columns).write.mode("append").parquet(f"{src}/end-marker-{days}")
        run()


@register("stream_sessions", f"WITH {SESS_CTE} SELECT user_id, session_start, max(ts) AS session_end, count(*) AS n_events, "
                             "date_sub('millisecond', session_start, max(ts)) AS duration_ms FROM a "
                             "GROUP BY user_id, session_start")
def q_stream_sessions(spark, d):
    """ST3 (stream): slices of users are summed up with bounded state and written once closed, sessions are made of the
    slices; the input is closed with end-of-input markers (see ``_close``)."""
    root = scratch_path(spark, "sessions")
    src = _write_event_files(spark, d, root)
    ev = table(spark, d, "events")

    def run():
        slices = SE.stream_slices(_read_stream(spark, src, ev), "user_id", "ts", "30 minutes", "1 hour")
        SE.ingest(slices, f"{root}/sink", f"{root}/ckpt").awaitTermination()

    _close(run, ev, src)
    slices = spark.read.parquet(f"{root}/sink").filter(~F.col("user_id").eqNullSafe(F.lit(-1)))
    return sessions_of_slices(slices, "user_id", 1800)


@register("event_ingest_json", "SELECT *, (SELECT count(*) FROM events WHERE event_id % 11 = 0) AS n_quarantined FROM events WHERE event_id % 11 <> 0")
def q_event_ingest_json(spark, d):
    """ST1 from JSON lines, every eleventh cut short: those go to the quarantine, all others to the sink."""
    root = scratch_path(spark, "ingest-json")
    ev = table(spark, d, "events")
    times = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    line = F.to_json(F.struct(*ev.columns), times)
    cut = F.substring(line, F.lit(1), F.length(line) - 5)
    ev.select(F.when(F.col("event_id") % 11 == 0, cut).otherwise(line).alias("value")).write.text(f"{root}/source")
    stream = SE.event_source(spark, f"{root}/source", ev.schema, fmt="json", options=times)
    SE.ingest_checked(stream, f"{root}/sink", f"{root}/bad", f"{root}/ckpt").awaitTermination()
    bad = spark.read.parquet(f"{root}/bad").select(F.count(F.lit(1))).scalar()
    return _events_back(spark.read.parquet(f"{root}/sink"), ev.columns).withColumn("n_quarantined", bad)


@register("stream_upsert", f"""
WITH src AS ({CHANGES})
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM src""")
def q_stream_upsert(spark, d):
    """ST6: refreshed rows arrive as a stream and are appended batch by batch; the read merges them."""
    root = scratch_path(spark, "upsert")
    orders = table(spark, d, "orders")
    target = ChangeLog(spark, f"{root}/table", "o_orderkey", orders.schema)
    target.upsert(orders, batch=-1)  # what is stored before the stream begins
    changes = sql_on_tables(spark, d, CHANGES)
    changes.write.parquet(f"{root}/changes")
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/changes")
    q = SE.run_foreach_batch(stream, SE.upsert_sink(target), f"{root}/ckpt", output_mode="append")
    q.awaitTermination()
    return target.read()
