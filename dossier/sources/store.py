"""Keyed section tables: conform, upsert, filtered and ordered reads, reports.

A stored table is a log of change rows: plain Parquet that Spark appends to, each row with the number of the batch
that brought it.  An upsert writes its own rows and nothing else; a read takes the newest row of each key (W2).  Rows
of a batch become visible together when Spark commits the write, a batch that is written again changes nothing, and
``compact`` writes the merged rows as a new log when the old one has grown.
"""

from __future__ import annotations

import datetime as _dt
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import extract_year
from ..functions.numbers import try_cast_fast
from ..functions.text import and_all
from ..operators.dedup import dedup_keep
from ..operators.quality import safe_column
from ..schemas import SERVE_ORDER, STORED, validate_section
from ..session import materialize


# --------------------------------------------------------------------------- S1
def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty table."""
    return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the contract's fields in order, ``try_cast`` each, add missing ones as typed nulls."""
    cols = []
    source = {fld.name: fld.dataType for fld in df.schema.fields}
    for f in schema.fields:
        if f.name in df.columns:
            src = source[f.name]
            c = F.col(f.name) if src == f.dataType else try_cast_fast(f.name, f.dataType, src)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def typed_read(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
               options: dict | None = None) -> DataFrame:
    """Read with a declared contract (no inference) and conform to it.

    Parquet keeps its own types and is conformed column by column; text formats
    (JSON, CSV) are read with every contract field as text and then conformed, so
    a quoted "3.5" becomes 3.5 and a bad value becomes null instead of failing
    the reader.
    """
    if fmt == "parquet":
        return conform(spark.read.options(**(options or {})).parquet(path), schema)
    as_text = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    return conform(spark.read.schema(as_text).options(**(options or {})).format(fmt).load(path), schema)


# --------------------------------------------------------------------------- S6, J2, U1
def append_by_name(target: DataFrame, source: DataFrame) -> DataFrame:
    """Union by column name; the source is conformed to the target's schema first."""
    return target.unionByName(conform(source, target.schema), allowMissingColumns=True)


def upsert(target: DataFrame, source: DataFrame, key: list[str] | str = "id") -> DataFrame:
    """Rows of ``target`` whose key is not in ``source`` (J2, left anti) plus all of ``source``.

    The anti join reads only the key columns of the source.  Catalyst/AQE
    pick broadcast when the source's measured size is under the broadcast
    threshold (daily change sets) and a sort-merge join otherwise; nothing
    is forced.  An empty source returns the target unchanged.
    """
    key = [key] if isinstance(key, str) else list(key)
    keep = target.join(source.select(*key), key, "left_anti")
    return append_by_name(keep, source)


BATCH = "_batch"


class ChangeLog:
    """A keyed table as an append-only log of change rows, merged on read.

    The newest row of a key wins: the one with the largest ``order`` column where the table has one, then the one of
    the latest batch, then the largest by its other columns.  Batches are numbered by their writer (a stream's batch
    id) or by the largest number stored plus one; one table has one writer.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str] | str = "id", schema: T.StructType | None = None,
                 order: str | None = None):
        self.spark, self.path, self.schema, self.order = spark, path.rstrip("/"), schema, order
        self.key = [key] if isinstance(key, str) else list(key)

    def create(self) -> None:
        """An empty table with its schema where there is none; an existing one is left alone."""
        rows = empty_frame(self.spark, self.schema).withColumn(BATCH, F.lit(0).cast("long"))
        rows.write.mode("ignore").parquet(self.path)

    def changes(self) -> DataFrame | None:
        """All change rows with their batch number; None where nothing has been written."""
        reader = self.spark.read
        if self.schema is not None:
            reader = reader.schema(T.StructType([*self.schema.fields, T.StructField(BATCH, T.LongType())]))
        try:
            return reader.parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def _merged(self) -> DataFrame | None:
        rows = self.changes()
        if rows is None:
            return None
        newest = [F.col(self.order).desc_nulls_last()] if self.order else []
        return dedup_keep(rows, self.key, [*newest, F.col(BATCH).desc()], keep="last")

    def read(self) -> DataFrame:
        """The table: one row for each key.  A filter on key columns reaches the scan, below the merge."""
        rows = self._merged()
        if rows is not None:
            return rows.drop(BATCH)
        if self.schema is None:
            raise FileNotFoundError(self.path)
        return empty_frame(self.spark, self.schema)

    def keys(self) -> DataFrame:
        """The keys of ``read``, one row for each; only key columns are read, and no rows are merged."""
        rows = self.changes()
        return (self.read() if rows is None else rows).select(*self.key).distinct()

    def upsert(self, source: DataFrame, batch: int | None = None, reject_repeats: bool = False) -> dict[str, int]:
        """Append the rows of ``source``, one for each of its keys; returns what was counted on the way.

        The batch is written once to the shared scratch folder and counted in that same pass (Q3): rows without a
        value in the key stop the upsert, and so do repeated keys if ``reject_repeats`` is set; else the newest row
        of a key goes on.  An empty batch changes nothing.
        """
        if self.schema is not None:
            source = conform(source, self.schema)
        came, went = Observation("came"), Observation("went")
        blank = F.lit(False)
        for k in self.key:
            blank = blank | F.col(k).isNull()
        counted = source.observe(came, F.count(F.lit(1)).alias("rows"), F.count_if(blank).alias("null_keys"))
        newest = [F.col(self.order).desc_nulls_last()] if self.order else []
        rows = dedup_keep(counted, self.key, newest, keep="last").observe(went, F.count(F.lit(1)).alias("rows"))
        staged = materialize(rows, "changes")
        if staged.isEmpty():  # Spark leaves the counts out of a plan it knows to be empty
            return {"rows": 0, "null_keys": 0, "repeats": 0}
        found = {"rows": came.get["rows"], "null_keys": came.get["null_keys"], "repeats": came.get["rows"] - went.get["rows"]}
        if found["null_keys"]:
            raise ValueError(f"{found['null_keys']} of {found['rows']} rows have no value in the key ({', '.join(self.key)})")
        if reject_repeats and found["repeats"]:
            raise ValueError(f"{found['repeats']} of {found['rows']} rows repeat a key ({', '.join(self.key)})")
        if batch is None:
            held = self.changes()
            batch = 1 + ((held.agg(F.max(BATCH)).first()[0] or 0) if held is not None else 0)
        staged.withColumn(BATCH, F.lit(batch).cast("long")).write.mode("append").parquet(self.path)
        return found

    def compact(self, path: str) -> ChangeLog:
        """Write the merged rows as a new log at ``path`` and return it.  Every row takes the latest batch's number, so
        later batches win over it and a batch that is delivered again does not."""
        rows = self._merged()
        if rows is None:
            raise FileNotFoundError(self.path)
        last = rows.agg(F.max(BATCH)).first()[0] or 0
        rows.withColumn(BATCH, F.lit(last).cast("long")).write.mode("errorifexists").parquet(path)
        return ChangeLog(self.spark, path, self.key, self.schema, self.order)


class SectionStore:
    """Keyed section tables under one root (S6-S9, F1), by (profile_id, id): an id may repeat across profiles.

    ``order`` names, by section, the column whose newest value wins, whichever batch brings it."""

    def __init__(self, spark: SparkSession, root: str, order: dict[str, str] | None = None):
        self.spark, self.root, self.order = spark, root.rstrip("/"), order or {}

    def table(self, section: str) -> ChangeLog:
        validate_section(section)
        key = [c for c in ("profile_id", "id") if c in STORED[section].names]
        return ChangeLog(self.spark, f"{self.root}/{section}", key, STORED[section], self.order.get(section))

    def create_sections(self, sections=None) -> None:
        """An empty table for each section that has none; can be run again."""
        for s in sections or sorted(STORED):
            self.table(s).create()

    def read(self, section: str) -> DataFrame:
        return self.table(section).read()

    def keys(self, section: str) -> DataFrame:
        return self.table(section).keys()

    def upsert(self, section: str, source: DataFrame, batch: int | None = None) -> dict[str, int]:
        """S6 persisted.  An empty source changes nothing."""
        return self.table(section).upsert(source, batch)

    def query(self, section: str, filters: dict | None = None) -> DataFrame:
        """F1 over a stored section."""
        return filter_eq(self.read(section), filters)

    def load_section(self, section: str, defaults: DataFrame | None = None, profile_id: str | None = None) -> DataFrame:
        """S8 over a stored section, of one profile if asked; a section that was never written, or has no rows, gives
        ``defaults``.  Any other failure is the caller's to see."""
        return load_section(self.read(section), section, defaults, profile_id)


# --------------------------------------------------------------------------- F1, F2
def filter_eq(df: DataFrame, filters: dict | None = None) -> DataFrame:
    """AND of equalities with literal values; ``col = NULL`` matches nothing; no filters -> all rows."""
    if not filters:
        return df
    conds = []
    for c, v in filters.items():
        safe_column(df, c)
        conds.append(F.col(c) == F.lit(v))
    return df.filter(and_all(conds))


def drop_unnamed(df: DataFrame, name_col: str) -> DataFrame:
    """drop rows without a name (null or blank)."""
    return df.filter(F.col(name_col).isNotNull() & (F.trim(F.col(name_col)) != ""))


# --------------------------------------------------------------------------- O1, S8, S9
def section_order(df: DataFrame, section: str, tie: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """O1: serving order - newest/largest first, nulls last, ties by id.

    With ``by`` (a profile) the order is that within each group, as a ``position`` column: one exchange by the group
    and no sort of the whole table.  Without, the rows themselves are sorted, which suits the rows of one profile.
    """
    tie = tie if tie is not None else [c for c in ("id",) if c in df.columns]
    order = [F.col(SERVE_ORDER[section]).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in tie]]
    if by:
        return df.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return df.orderBy(*order)


def with_years(df: DataFrame) -> DataFrame:
    """E9 on a section with dates: ``start_year`` and ``end_year`` as text, where they can be had and are not there yet."""
    years = {f"{end}_year": extract_year(f"{end}_date") for end in ("start", "end") if f"{end}_date" in df.columns}
    return df.withColumns({name: year for name, year in years.items() if name not in df.columns})


def load_section(df: DataFrame, section: str, defaults: DataFrame | None = None, profile_id: str | None = None) -> DataFrame:
    """Section read in serving order, of one profile (the filter reaches the scan) or of all, numbered within each.

    No rows at all give ``defaults`` (the probe reads at most one row).  Education gains year columns.
    """
    validate_section(section)
    if profile_id is not None:
        df = filter_eq(df, {"profile_id": profile_id})
    if defaults is not None and df.isEmpty():
        return defaults
    if section == "education":
        df = with_years(df)
    if section not in SERVE_ORDER:
        return df
    return section_order(df, section, by=["profile_id"] if profile_id is None and "profile_id" in df.columns else None)


def first_row(df: DataFrame, order: list[Column]) -> DataFrame:
    """The first row under an explicit order (``LIMIT 1`` made deterministic)."""
    return df.orderBy(*order).limit(1)


def load_profile(df: DataFrame, order: list[Column] | None = None,
                 default_summary: str = "", defaults: DataFrame | None = None) -> DataFrame:
    """The first profile row under a deterministic order; adds ``summary`` if missing;
    an empty table falls back to ``defaults`` (the probe reads at most one row)."""
    if defaults is not None and df.isEmpty():
        return defaults
    if "summary" not in df.columns:
        df = df.withColumn("summary", F.lit(default_summary))
    order = order or [F.col("scraped_at").desc_nulls_last(), F.col("profile_id").asc_nulls_last()]
    return first_row(df, order)


# --------------------------------------------------------------------------- S5, S10, S11
def stamp_batch(df: DataFrame, run_ts: str | _dt.datetime, col: str = "scraped_at") -> DataFrame:
    """One collection stamp for the whole batch, passed in (never the wall clock inside a plan)."""
    ts = run_ts if isinstance(run_ts, str) else run_ts.strftime("%Y-%m-%d %H:%M:%S")
    return df.withColumn(col, F.lit(ts).cast("timestamp_ntz"))


def write_snapshot(df: DataFrame, root: str, scrape_date: str, run_id: str) -> None:
    """Add one dated raw snapshot, a folder for each run.  What a run has written is never touched again: a second
    run of a date lies beside the first, and writing one run twice is an error."""
    df.write.mode("errorifexists").parquet(f"{root.rstrip('/')}/scrape_date={scrape_date}/run_id={run_id}")


def snapshot_runs(spark: SparkSession, root: str) -> DataFrame:
    """scrape_date, run_id of the snapshots under a root (partition values only, no column is read)."""
    return spark.read.parquet(root).select("scrape_date", "run_id").distinct()


def read_latest_snapshot(spark: SparkSession, root: str, scrape_date: str | None = None) -> DataFrame:
    """The last run of the newest date (or of ``scrape_date``), read from its own folder only."""
    rows = spark.read.parquet(root)
    if scrape_date is not None:
        rows = rows.where(F.col("scrape_date").cast("string") == scrape_date)
    last = rows.agg(F.max(F.struct("scrape_date", "run_id")).alias("last")).first()["last"]
    if last is None:
        raise FileNotFoundError(f"no snapshots of {scrape_date or 'any date'} under {root}")
    rows = rows.where((F.col("scrape_date") == F.lit(last["scrape_date"])) & (F.col("run_id") == F.lit(last["run_id"])))
    return rows.withColumns({c: F.col(c).cast("string") for c in ("scrape_date", "run_id")})


def run_report(frames: dict[str, DataFrame], sections: list[str]) -> DataFrame:
    """Rows per section; sections without rows report 'no data'."""
    spark = next(iter(frames.values())).sparkSession
    counts = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("section"), "n_rows")
        counts = c if counts is None else counts.unionByName(c)
    names = spark.createDataFrame([(s,) for s in sections], "section string")
    out = names.join(counts, "section", "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0).cast("bigint"))
    return out.select("section", n.alias("n_rows"),
                      F.when(n > 0, F.concat(n.cast("string"), F.lit(" rows"))).otherwise(F.lit("no data")).alias("status"))
