"""Structured Streaming versions of the event operators (ST1-ST6).

Event time in files is TIMESTAMP_NTZ; ``withWatermark`` needs TIMESTAMP, so
streams convert on the way in and back on the way out through epoch
microseconds (UTC), never through the session time zone.
Every sink has a checkpoint under the shared ``spark.checkpoint.dir`` so a
restarted query (lost executor, lost driver) resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics as M
from ..operators.events import instant_to_ntz, ntz_to_instant
from ..sources.store import ChangeLog


#: Column that holds a line which could not be read with the declared schema.
BAD_LINE = "_bad_line"


def event_source(spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int | None = None,
                 ts: str = "ts", max_bytes_per_trigger: int | None = None, recursive: bool = False,
                 fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """ST1/ST2: a file-buffer event stream with a declared schema; ``ts`` becomes TIMESTAMP.

    A micro-batch takes at most ``max_files_per_trigger`` files / ``max_bytes_per_trigger``
    bytes; with buffer files written at most N events each (``write_buffer``), that bounds
    its events.  Flushes are bounded in the sink (``ingest``), so a trigger may take many files.  Text buffers (``fmt`` json or csv) are read permissively: a line that
    does not fit the schema comes as it is in ``BAD_LINE`` (see ``ingest_checked``), no line is lost.
    """
    r = spark.readStream.options(**(options or {}))
    if fmt == "parquet":
        r = r.schema(schema)
    else:
        r = r.schema(T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])).option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", BAD_LINE)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        r = r.option("maxBytesPerTrigger", max_bytes_per_trigger)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    return r.format(fmt).load(path).withColumn(ts, ntz_to_instant(ts))


def write_buffer(events: DataFrame, path: str, max_events_per_file: int = 1000, partition_by: list[str] | None = None):
    """Append events to the file buffer, at most ``max_events_per_file`` per file."""
    w = events.write.mode("append").option("maxRecordsPerFile", max_events_per_file)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def _trigger(w, trigger: str | None):
    if trigger is None or trigger == "availableNow":
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger)


def ingest(stream: DataFrame, sink: str, checkpoint: str, trigger: str | None = None,
           partition_by: list[str] | None = None, max_events_per_flush: int | None = None) -> StreamingQuery:
    """ST1: append typed events to a Parquet table (exactly once through the checkpoint).

    ST2: with ``max_events_per_flush`` no file is appended with more events than that, however many a trigger takes.
    """
    w = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if max_events_per_flush:
        w = w.option("maxRecordsPerFile", max_events_per_flush)
    if partition_by:
        w = w.partitionBy(*partition_by)
    return _trigger(w, trigger).start(sink)


def ingest_checked(stream: DataFrame, sink: str, quarantine: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """ST1 for text buffers: good events go to ``sink``, lines that could not be read to ``quarantine`` with what could
    be made of them.  Both are written in a folder for each micro-batch, so a batch that is replayed replaces itself."""
    def split(batch: DataFrame, batch_id: int) -> None:
        good = F.col(BAD_LINE).isNull()
        batch.where(good).drop(BAD_LINE).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")
        batch.where(~good).write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")

    return run_foreach_batch(stream, split, checkpoint, trigger, "append")


def stream_dedup(stream: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """ST4: drop client retries - same key seen again within the watermark delay."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_engagement(stream: DataFrame, group: list[str], ts: str = "ts", window: str = "1 day",
                        delay: str = "1 hour") -> DataFrame:
    """ST5: A4 per tumbling window and group.

    In append mode each window is emitted once, when the watermark passes its
    end, and its state is dropped; the sink is append-only.  (Filter rows out
    after this, not before: Spark pushes a filter that does not touch the event
    time below the watermark, so removed rows would not advance it.)
    """
    w = stream.withWatermark(ts, delay)
    keyed = w.withColumn("__w", F.window(ts, window))
    agg = M.section_engagement(keyed, ["__w", *group])
    return agg.select(instant_to_ntz(F.col("__w.start")).alias("window_start"), *group,
                      "views", "view_time", "interactions", "feedback")


def stream_slices(stream: DataFrame, user: str = "user_id", ts: str = "ts", gap: str = "30 minutes", delay: str = "1 hour") -> DataFrame:
    """ST3 (stream): one summary for each user and slice of time as wide as the session gap, once the slice is closed.

    State is a small row for each open (user, slice): a user with a third of all events has as many as anyone else who
    was there as long, and they lie on as many tasks.  All events of a slice are in one session, so
    ``operators.events.sessions_of_slices`` joins the written slices to sessions.
    """
    out = stream.withWatermark(ts, delay).groupBy(user, F.window(ts, gap).alias("__w")).agg(
        F.min(ts).alias("__first"), F.max(ts).alias("__last"), F.count(F.lit(1)).alias("n_events"))
    return out.select(user, instant_to_ntz("__first").alias("first_ts"), instant_to_ntz("__last").alias("last_ts"), "n_events")


def upsert_sink(table: ChangeLog) -> Callable[[DataFrame, int], None]:
    """ST6: ``foreachBatch`` body - append each micro-batch, and nothing else, to the change log of a keyed table.

    The batch id numbers the change rows, so a batch that is replayed after a failure adds rows that the merge on
    read already knows.  Late rows lose by the table's ``order`` column where it has one.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch, batch_id)
    return apply


def run_foreach_batch(stream: DataFrame, fn: Callable[[DataFrame, int], None], checkpoint: str,
                      trigger: str | None = None, output_mode: str = "update") -> StreamingQuery:
    w = stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).outputMode(output_mode)
    return _trigger(w, trigger).start()
