"""Deterministic first/last/newest per key (W1, W2) and best/worst n.

Rows have no order in Spark, so every operator takes explicit order columns
and breaks ties on all remaining columns.  The ``row_number() = 1`` /
``<= n`` filters sit right after the window so Catalyst inserts a partial
WindowGroupLimit *before* the shuffle: a hot key sends at most n rows per
map task across the network, whatever its size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sort_cols(df: DataFrame, keys: list[str], order: list[Column | str], descending: bool) -> list[Column]:
    cols: list[Column] = []
    named = set(keys)
    for o in order:
        if isinstance(o, str):
            named.add(o)
            c = F.col(o)
            cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
        else:
            cols.append(o)
    # tie-break on every other column so the choice never depends on input order
    for name, dtype in df.dtypes:
        if name in named:
            continue
        c = F.to_json(F.col(name)) if "map<" in dtype or "variant" in dtype else F.col(name)  # maps have no order of their own
        cols.append(c.desc_nulls_last() if descending else c.asc_nulls_last())
    return cols


def dedup_keep(df: DataFrame, keys: list[str] | None, order: list[Column | str] | None = None,
               keep: str = "first") -> DataFrame:
    """One row per key; ``keep='first'`` takes the smallest in ``order``, 'last' the largest.

    ``keys=None`` means whole-row duplicates (``dropDuplicates()``, which
    aggregates map-side).  Nulls in key columns compare equal.
    """
    if keys is None:
        return df.dropDuplicates()
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    w = Window.partitionBy(*keys).orderBy(*_sort_cols(df, keys, list(order or []), keep == "last"))
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(df: DataFrame, keys: list[str], ts_col: str) -> DataFrame:
    """Newest ``ts_col`` per key, nulls last, ties broken on the other columns."""
    return dedup_keep(df, keys, [F.col(ts_col).desc_nulls_last()], keep="first")


def top_bottom_n(df: DataFrame, group: list[str], score: str, n: int, tie: list[str] | None = None) -> DataFrame:
    """The n best and n worst rows per group, tagged 'top'/'bottom' with their rank.

    Two separately limited windows (each gets its partial WindowGroupLimit)
    rather than one window with an OR filter, which would defeat the limit.
    """
    tie = tie or []
    best = Window.partitionBy(*group).orderBy(F.col(score).desc_nulls_last(), *[F.col(t).asc() for t in tie])
    worst = Window.partitionBy(*group).orderBy(F.col(score).asc_nulls_last(), *[F.col(t).asc() for t in tie])
    top = (df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
           .withColumn("side", F.lit("top")))
    bottom = (df.withColumn("rank", F.row_number().over(worst)).filter(F.col("rank") <= n)
              .withColumn("side", F.lit("bottom")))
    return top.unionByName(bottom)
