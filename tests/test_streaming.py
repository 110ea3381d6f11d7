"""Streaming: bounded micro-batches, watermark dedup across batches, idempotent foreachBatch upsert."""

import datetime as dt

from pyspark.sql import functions as F

from dossier.session import scratch_path
from dossier.sources.store import ChangeLog
from dossier.streaming import events as SE

SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _files(spark, root, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/src/b{i}")


def test_dedup_across_batches(spark):
    root = scratch_path(spark, "t-dedup")
    t0 = dt.datetime(2024, 1, 1)
    b1 = [(i, t0 + dt.timedelta(minutes=i), 1, "view", 1.0, "{}") for i in range(5)]
    b2 = [(i, t0 + dt.timedelta(minutes=i), 1, "view", 1.0, "{}") for i in range(3, 8)]  # retries of 3, 4
    _files(spark, root, [b1, b2])
    src = spark.createDataFrame([], SCHEMA).schema
    stream = SE.event_source(spark, f"{root}/src/*", src, max_files_per_trigger=1)
    q = SE.ingest(SE.stream_dedup(stream, ["event_id"], "ts", "1 hour"), f"{root}/sink", f"{root}/ckpt")
    q.awaitTermination()
    assert q.lastProgress is not None
    ids = sorted(r[0] for r in spark.read.parquet(f"{root}/sink").select("event_id").collect())
    assert ids == list(range(8))


def test_stream_upsert_row_by_row(spark):
    """Late, repeated and cross-profile rows over several micro-batches; each batch adds its own rows and no more."""
    root = scratch_path(spark, "t-upsert")
    schema = "profile_id string, id int, v string, ts int"
    batches = [[("p1", 1, "a", 1), ("p2", 1, "b", 1)], [("p1", 1, "a2", 3), ("p1", 1, "a2", 3), ("p1", 2, "c", 1)],
               [("p1", 1, "late", 2), ("p2", 1, "b2", 2)]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/src/b{i}")
    log = ChangeLog(spark, f"{root}/t", ["profile_id", "id"], order="ts")
    sizes = []

    def sink(batch, batch_id):
        SE.upsert_sink(log)(batch, batch_id)
        SE.upsert_sink(log)(batch, batch_id)  # a replay
        sizes.append(log.changes().count())

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/src/*")
    SE.run_foreach_batch(stream, sink, f"{root}/ckpt", output_mode="append").awaitTermination()
    assert sorted(tuple(r) for r in log.read().collect()) == [("p1", 1, "a2", 3), ("p1", 2, "c", 1), ("p2", 1, "b2", 2)]
    assert len(sizes) == 3 and sizes[-1] == 12  # twice two rows of each batch


def test_windowed_engagement_stream(spark):
    root = scratch_path(spark, "t-window")
    t0 = dt.datetime(2024, 1, 1, 10)
    rows = [(1, t0, 1, "view", 2.5, "{}"), (2, t0, 1, "click", 0.0, "{}"), (3, t0 + dt.timedelta(days=1), 1, "purchase", 9.0, "{}")]
    _files(spark, root, [rows])
    src = spark.createDataFrame([], SCHEMA).schema
    stream = SE.event_source(spark, f"{root}/src/*", src).withColumn("section", F.lit("skills"))
    agg = SE.windowed_engagement(stream, ["section"])
    sink = ChangeLog(spark, f"{root}/t", ["window_start", "section"])
    SE.run_foreach_batch(agg, SE.upsert_sink(sink), f"{root}/ckpt").awaitTermination()
    got = sorted((r["window_start"].day, r["views"], r["view_time"], r["interactions"], r["feedback"])
                 for r in sink.read().collect())
    assert got == [(1, 1, 2.5, 1, 0), (2, 0, 0.0, 0, 1)]


def test_flush_bounded_to_1000_events(spark):
    root = scratch_path(spark, "t-flush")
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    SE.write_buffer(ev.repartition(3), f"{root}/src", max_events_per_file=1000)
    q = SE.ingest(SE.event_source(spark, f"{root}/src", ev.schema, max_files_per_trigger=1), f"{root}/sink", f"{root}/ckpt")
    q.awaitTermination()
    sizes = [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]]
    assert sum(sizes) == ev.count() and max(sizes) <= 1000 and len(sizes) >= 10


def test_restart_from_checkpoint_is_exactly_once(spark):
    root = scratch_path(spark, "t-restart")
    t0 = dt.datetime(2024, 1, 1)
    _files(spark, root, [[(i, t0 + dt.timedelta(minutes=i), 1, "view", 1.0, "{}") for i in range(5)]])
    src = spark.createDataFrame([], SCHEMA).schema
    SE.ingest(SE.event_source(spark, f"{root}/src/*", src), f"{root}/sink", f"{root}/ckpt").awaitTermination()
    # more files arrive; the restarted query (same checkpoint) reads only the new ones
    spark.createDataFrame([(i, t0 + dt.timedelta(minutes=i), 1, "view", 1.0, "{}") for i in range(5, 9)], SCHEMA) \
        .coalesce(1).write.parquet(f"{root}/src/b9")
    SE.ingest(SE.event_source(spark, f"{root}/src/*", src), f"{root}/sink", f"{root}/ckpt").awaitTermination()
    ids = sorted(r[0] for r in spark.read.parquet(f"{root}/sink").select("event_id").collect())
    assert ids == list(range(9))


def test_text_buffers_keep_every_line(spark):
    root = scratch_path(spark, "t-text")
    lines = {"json": ['{"event_id": 1, "user_id": 7, "value": 2.5}', '{"event_id": 2, "user_id"', '{"event_id": "x"}', "plain", '{"event_id": 3}'],
             "csv": ["1,2024-01-01T00:00:00,7,view,2.5,{}", "x,2024-01-01T00:00:00,7,view,1,{}", "3,,,,,", "4,2024-01-01T00:00:00,7,view,1,{},more"]}
    want = {"json": ([1, 3], 3), "csv": ([1, 3], 2)}
    schema = spark.createDataFrame([], SCHEMA).schema
    for fmt, text in lines.items():
        spark.createDataFrame([(x,) for x in text], "value string").coalesce(1).write.text(f"{root}/{fmt}")
        stream = SE.event_source(spark, f"{root}/{fmt}", schema, fmt=fmt)
        SE.ingest_checked(stream, f"{root}/{fmt}-good", f"{root}/{fmt}-bad", f"{root}/{fmt}-ckpt").awaitTermination()
        good = sorted(r["event_id"] for r in spark.read.parquet(f"{root}/{fmt}-good").collect())
        bad = [r[SE.BAD_LINE] for r in spark.read.parquet(f"{root}/{fmt}-bad").collect()]
        assert (good, len(bad)) == want[fmt] and set(bad) <= set(text)


def test_stream_slices_are_few_and_give_the_batch_sessions(spark):
    import random
    from dossier.operators.events import sessionize, sessions_of_slices
    rng, root, t0 = random.Random(5), scratch_path(spark, "t-slices"), dt.datetime(2024, 1, 1)
    hot = [(i, t0 + dt.timedelta(seconds=i * 3), 1, "view", 1.0, "{}") for i in range(4000)]
    rest = [(10_000 + i, t0 + dt.timedelta(seconds=rng.randrange(20_000)), rng.choice([2, 3, None]), "view", 1.0, "{}") for i in range(300)]
    rows = hot + rest
    rng.shuffle(rows)
    last = max(r[1] for r in rows)
    _files(spark, root, [rows[:2000], rows[2000:], [(-1, last + dt.timedelta(days=2), -1, "end", 0.0, "{}")], [(-2, last + dt.timedelta(days=4), -1, "end", 0.0, "{}")]])
    schema = spark.createDataFrame([], SCHEMA).schema
    for i in range(4):  # a restarted query for each delivery
        SE.ingest(SE.stream_slices(SE.event_source(spark, f"{root}/src/b[0-{i}]", schema), delay="12 hours"), f"{root}/sink", f"{root}/ckpt").awaitTermination()
    slices = spark.read.parquet(f"{root}/sink").where("user_id is null or user_id > 0")
    assert slices.where("user_id = 1").count() <= 8
    got = {tuple(r) for r in sessions_of_slices(slices).collect()}
    events = spark.createDataFrame(rows, SCHEMA)
    want = sessionize(events)
    assert got == {tuple(r) for r in want.select("user_id", "session_start", "session_end", "n_events", "duration_ms").collect()}
    closed = sessions_of_slices(slices, closed_before=str(last))
    assert closed.count() < len(got) and closed.where(F.col("session_end") >= F.lit(str(last - dt.timedelta(minutes=30))).cast("timestamp_ntz")).count() == 0


def test_micro_batch_flush_drains_a_backlog_in_few_triggers(spark, monkeypatch, tmp_path):
    """60 buffer files: flushes keep their bound, but not one trigger is spent on each."""
    from dossier.plans import stream_plans
    monkeypatch.setattr(stream_plans, "FLUSH_EVENTS", 10, raising=False)
    monkeypatch.setattr(stream_plans, "FILES_PER_TRIGGER", 25, raising=False)
    root = scratch_path(spark, "t-backlog")
    monkeypatch.setattr(stream_plans, "scratch_path", lambda *_: root)
    write = SE.write_buffer
    monkeypatch.setattr(SE, "write_buffer", lambda ev, path, max_events_per_file: write(ev, path, 10))
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(seconds=i % 7), i % 3, "view", 1.0, None if i % 5 else "{}") for i in range(595)]
    spark.createDataFrame([*rows, *rows[:5]], SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    got = stream_plans.q_micro_batch_flush(spark, str(tmp_path))
    assert sorted(r["event_id"] for r in got.collect()) == sorted([*range(595), *range(5)])
    sizes = [r["count"] for r in got.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 60 and max(sizes) <= 10
    batches = spark.read.text(f"{root}/ckpt/commits").select(F.input_file_name()).distinct().count()
    assert batches == 3
