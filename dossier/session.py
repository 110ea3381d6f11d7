"""SparkSession helpers.

Library code never creates its own session; these helpers are for tests,
the bench and the entry point.  The scratch location for lineage cuts and
stream state is always taken from ``spark.checkpoint.dir`` when the cluster
sets it; only when it is unset (local tests) do we pick a folder ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "dossier", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster this is set by the operator and points at shared storage; an
    unset value on a non-local master is an error.  Only in local mode (tests)
    is a local folder created and set when it is unset.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getCheckpointDir()  # set with sc.setCheckpointDir
    if not conf_dir:
        master = spark.sparkContext.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster "
                               "(checkpoints, stream state and scratch tables live there)")
        conf_dir = tempfile.mkdtemp(prefix="dossier-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job's outputs."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def planned_bytes(df) -> int:
    """Catalyst's size estimate of a frame (exact for file relations); -1 when unknown."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no access to the optimised plan
        return -1


MAX_CONSTANT_ROWS = 100_000


def broadcast_if_small(df, max_bytes: int | None = None, known_rows: int | None = None):
    """Mark ``df`` for broadcast only when its size is known to be small; otherwise leave
    the join strategy to Catalyst / AQE (which still broadcasts after measuring).

    ``known_rows`` is for frames built on the driver from a Python list, whose row
    count is the bound (Spark has no statistics for them); other frames are checked
    against their planned size and ``max_bytes`` (default: the session's
    ``spark.sql.autoBroadcastJoinThreshold``)."""
    from pyspark.sql import functions as F
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= MAX_CONSTANT_ROWS else df
    if max_bytes is None:
        conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
        max_bytes = int(str(conf).lower().replace("b", "")) if str(conf).lower().rstrip("b").isdigit() else 10 << 20
    return F.broadcast(df) if 0 <= planned_bytes(df) <= max_bytes else df


def materialize(df, name: str, rows_per_file: int | None = None):
    """Cut lineage by writing ``df`` as a Parquet table in the shared checkpoint folder and reading it back.
    With ``rows_per_file`` files hold at most so many rows, so a reader spreads them over its tasks.

    Columnar and compressed, and the read-back carries file statistics the planner
    uses (e.g. to broadcast a small result); a lost executor re-reads the files
    instead of recomputing the plan.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**({"maxRecordsPerFile": rows_per_file} if rows_per_file else {})).parquet(path)
    return df.sparkSession.read.parquet(path)
