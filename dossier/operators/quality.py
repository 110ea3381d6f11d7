"""Data-quality checks (Q1-Q4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numbers import try_cast_fast
from ..schemas import validate_section  # noqa: F401  (Q1, re-exported)
from ..session import broadcast_if_small


def safe_column(df: DataFrame, column: str) -> str:
    """Q2: a filter column must exist in the frame."""
    if column not in df.columns:
        raise ValueError(f"no column named {column!r} to filter on")
    return column


def check_key(df: DataFrame, keys: list[str] | str = "id") -> DataFrame:
    """Q3: key violations - null keys and keys that occur more than once.

    One hash aggregate with map-side combine: a hot key costs one partial
    count per map task, not a task full of its rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .filter((F.col("n") > 1) | any_null)
            .withColumn("problem", F.when(any_null, F.lit("null key")).otherwise(F.lit("duplicate key"))))


def schema_drift(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Q4: expected vs actual field types, plus per field how many values do not fit.

    Returns one row per contract field and per unexpected field:
    field, expected, actual, problem, n_bad (rows whose non-null value
    cannot be cast to the expected type; computed in one aggregate pass).
    """
    actual = {f.name: f.dataType for f in df.schema.fields}
    checks, meta = [], []
    for f in contract.fields:
        exp = f.dataType.simpleString()
        if f.name not in actual:
            meta.append((f.name, exp, None, "missing"))
            continue
        act = actual[f.name].simpleString()
        c = F.col(f.name)
        # try_cast_fast skips the cast for digit-free text (slow failure path on a drifted column)
        fails = try_cast_fast(c, f.dataType, actual[f.name]).isNull()
        bad = F.sum(F.when(c.isNotNull() & fails, 1).otherwise(0)).cast("bigint")
        checks.append(bad.alias(f.name))
        meta.append((f.name, exp, act, "ok" if exp == act else "type"))
    known = {f.name for f in contract.fields}
    for name, dt in actual.items():
        if name not in known:
            meta.append((name, None, dt.simpleString(), "unexpected"))
    spark = df.sparkSession
    info = spark.createDataFrame(meta, "field string, expected string, actual string, problem string")
    if not checks:
        return info.withColumn("n_bad", F.lit(0).cast("bigint"))
    counted = [m[0] for m in meta if m[3] in ("ok", "type")]
    bad = df.agg(*checks).unpivot([], counted, "field", "n_bad")
    # one row per contract field: bounded by the contract, not by the data
    bad = broadcast_if_small(bad, known_rows=len(counted))
    return info.join(bad, "field", "left").withColumn("n_bad", F.coalesce("n_bad", F.lit(0).cast("bigint")))
