"""Aggregations (A1-A11) and the ordered reads around them (O1-O3).

A global maximum over a big frame is a scalar subquery (``DataFrame.scalar()``,
referenced once): Spark runs the one-row aggregate and inlines the value, so
nothing is joined back and nothing pairwise is formed.  Every multi-column
report is a single pass with conditional aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import to_int_or_zero


def _desc_order(cols: list[str], tie: list[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in cols] + [F.col(t).asc_nulls_last() for t in tie]


def top_k(df: DataFrame, by: str, k: int = 10, tie: list[str] | None = None) -> DataFrame:
    """O2: the k largest rows by ``by`` (nulls last), ties by ``tie``; planned as TakeOrderedAndProject."""
    return df.orderBy(*_desc_order([by], tie or [])).limit(k)


def top_k_per(df: DataFrame, group: list[str], by: str, k: int = 10, tie: list[str] | None = None,
              position: str = "position") -> DataFrame:
    """O2 within each group: its k largest rows, numbered.  The limit is applied before the shuffle, so a group sends
    at most k rows from each task, however many it has."""
    w = Window.partitionBy(*group).orderBy(*_desc_order([by], tie or []))
    return df.withColumn(position, F.row_number().over(w)).where(F.col(position) <= k)


def share_of_max(df: DataFrame, value: str, k: int = 10, tie: list[str] | None = None,
                 out: str = "pct", factor: int = 100, by: list[str] | None = None) -> DataFrame:
    """A1: over the top k rows, ``int(count / max * factor)``; with ``by`` over the top k rows of each group (a
    profile), numbered in ``position``.

    A null count counts as 0; a null or zero maximum is replaced by 1.
    Division happens before multiplication and the result is truncated
    (29 of 50 -> 57), as in the reference.
    """
    top = top_k_per(df, by, value, k, tie) if by else top_k(df, value, k, tie)
    cnt = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    # at most k rows (of each group, on its partition) are left, so this window moves nothing
    m = F.max(F.col(value).cast("double")).over(Window.partitionBy(*(by or [])))
    m = F.when(m.isNull() | (m == 0), F.lit(1.0)).otherwise(m)
    return top.withColumn(out, ((cnt / m) * factor).cast("int"))


def sort_asc(df: DataFrame, value: str) -> DataFrame:
    """O3 (after F3): ascending order; ties on the value are broken on the other columns, so equal values can be split
    across the partitions of the sort."""
    kept = positive_only(df, value)
    return kept.orderBy(F.col(value).asc_nulls_last(), *[F.col(c).asc_nulls_last() for c in kept.columns if c != value])


def scale_to_width(df: DataFrame, value: str, width: int = 280, out: str = "bar_width",
                   by: list[str] | None = None) -> DataFrame:
    """A2 (after F3): ``int(v / max * width)`` with the max over all kept rows, in ascending order (O3); with ``by``
    the max of each group, no order.

    The maxima of groups are an aggregate with map-side combine that is joined back: unlike a window it never brings
    all rows of a group together, and a group that holds most rows can be split by the skew join.
    """
    v = F.col(value).cast("double")
    if by:
        kept = positive_only(df, value)
        top = kept.groupBy(*[F.col(c).alias(f"__g_{c}") for c in by]).agg(F.max(v).alias("__m"))
        same = [F.col(c).eqNullSafe(F.col(f"__g_{c}")) for c in by]
        scaled = kept.join(top, same).withColumn(out, F.coalesce((F.try_divide(v, F.col("__m")) * width).cast("int"), F.lit(0)))
        return scaled.select(*kept.columns, out)
    kept = sort_asc(df, value)
    m = positive_only(df, value).select(F.max(v).alias("m")).scalar()  # referenced once: one subquery run
    return kept.withColumn(out, F.coalesce((F.try_divide(v, m) * width).cast("int"), F.lit(0)))


def positive_only(df: DataFrame, value: str) -> DataFrame:
    """keep rows whose value parses to > 0 (bad or null count as 0)."""
    return df.withColumn(value, to_int_or_zero(value)).filter(F.col(value) > 0)


def count_rows(frames: dict[str, DataFrame]) -> DataFrame:
    """A3: row count per named frame, one partial-aggregated count each."""
    out = None
    for name, df in frames.items():
        c = df.groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("section"), "n_rows")
        out = c if out is None else out.unionByName(c)
    return out


# Values are summed in this type: exact to ten decimals whatever the order of the sums.
EXACT = "decimal(28,10)"

# Event kinds used by the engagement aggregate (parameters, with defaults).
DEFAULT_KINDS = {"view": "view", "interaction": "click", "positive": "purchase", "negative": "error"}


def section_engagement(events: DataFrame, group: list[str], kind: str = "event_type", value: str = "value",
                       kinds: dict[str, str] | None = None) -> DataFrame:
    """A4: views, view time, interactions and net feedback per group, in one pass.

    View time is summed as a wide decimal, so the total does not depend on the
    order partial sums are combined in and small values are not rounded away.
    """
    k = {**DEFAULT_KINDS, **(kinds or {})}
    kc = F.col(kind)
    vt = F.sum(F.when(kc == k["view"], F.col(value).cast(EXACT)))
    return events.groupBy(*group).agg(
        F.count_if(kc == k["view"]).alias("views"),
        F.coalesce(vt.cast("double"), F.lit(0.0)).alias("view_time"),
        F.count_if(kc == k["interaction"]).alias("interactions"),
        F.sum(F.when(kc == k["positive"], 1).when(kc == k["negative"], -1).otherwise(0)).cast("bigint").alias("feedback"),
    )


def weighted_score(engagement: DataFrame, w_time: float = 1.0, w_interactions: float = 1.0,
                   w_feedback: float = 1.0, out: str = "score") -> DataFrame:
    """A5: weighted sum of view time, interactions and feedback (weights are parameters)."""
    s = (F.col("view_time") * w_time + F.col("interactions") * w_interactions + F.col("feedback") * w_feedback)
    return engagement.withColumn(out, s)


SCROLL_MILESTONES = (25, 50, 75, 100)


def milestone(depth: Column | str) -> Column:
    """The deepest of SCROLL_MILESTONES that a depth reaches; 0 below the first or without a depth."""
    d = F.col(depth) if isinstance(depth, str) else depth
    out = F.lit(0)
    for m in SCROLL_MILESTONES:
        out = F.when(d >= m, F.lit(m)).otherwise(out)
    return out


def scroll_depth(df: DataFrame, group: list[str], depth: str) -> DataFrame:
    """Deepest milestone (25/50/75/100) reached per group; depth is rounded down to a milestone."""
    return df.groupBy(*group).agg(F.max(milestone(depth)).alias("max_depth"))


def session_stats(sessions: DataFrame, period: str = "week", start: str = "session_start",
                  duration: str = "duration_ms") -> DataFrame:
    """Sessions per period and their average duration (same unit as ``duration``)."""
    return (sessions.groupBy(F.date_trunc(period, F.col(start)).cast("timestamp_ntz").alias("period"))
            .agg(F.count(F.lit(1)).alias("n_sessions"), F.avg(duration).alias(f"avg_{duration}")))


def top_referrers(sessions: DataFrame, referrer: str = "referrer", k: int = 10) -> DataFrame:
    """The k referrers that opened the most sessions, from one row for each session with that of its first event
    (``session_groups`` with a ``min`` of (ts, id, referrer) gives it)."""
    counts = sessions.groupBy(F.col(referrer).alias("referrer")).agg(F.count(F.lit(1)).alias("n_sessions"))
    return top_k(counts, "n_sessions", k, ["referrer"])


def section_heatmap(df: DataFrame, period_col: Column, section: str, value: Column,
                    sections: list[str]) -> DataFrame:
    """Value per period x section with an explicit section list (no extra pass to find pivot values)."""
    return (df.groupBy(period_col.alias("period")).pivot(section, sections)
            .agg(F.sum(value.cast(EXACT)).cast("double")).na.fill(0.0, subset=sections))


def cold_start_gate(df: DataFrame, group: list[str], session: list[str] | None = None, threshold: int = 50,
                    approx: float | None = None) -> DataFrame:
    """Distinct sessions per group and whether the threshold is reached.

    Without ``session`` every row is a session of its group (as ``session_groups`` yields them) and rows are
    counted.  With ``session`` columns the count is exact by default; ``approx=rsd`` uses HyperLogLog++
    (``approx_count_distinct`` with that relative standard deviation), a fixed-size sketch per group
    instead of a shuffle of every distinct session.
    """
    if session is None:
        n = F.count(F.lit(1))
    elif approx:
        n = F.approx_count_distinct(F.struct(*[F.col(s) for s in session]), approx)
    else:
        # one struct per session: count_distinct over several columns would skip rows with a null in any of them
        n = F.count_distinct(F.struct(*[F.col(s) for s in session]))
    return (df.groupBy(*group).agg(n.alias("n_sessions"))
            .withColumn("ready", F.col("n_sessions") >= threshold))


def with_seeds(suggestions: DataFrame, gate: DataFrame, rules: DataFrame, group: list[str]) -> DataFrame:
    """A9, second half: the suggestions of groups that the gate calls ready, and the rows of the rule table for all
    other groups, those without any session included; ``origin`` tells them apart."""
    ready = gate.where("ready").select(*group)
    learnt = suggestions.join(ready, group, "left_semi").withColumn("origin", F.lit("data"))
    seeds = rules.join(ready, group, "left_anti").withColumn("origin", F.lit("rule"))
    return learnt.unionByName(seeds, allowMissingColumns=True)


def acceptance_rate(df: DataFrame, group: list[Column], status: str, alarm_below: float = 0.30) -> DataFrame:
    """A10: accepted / total per group, with an alarm flag under the threshold."""
    st = F.col(status)
    agg = df.groupBy(*group).agg(F.count_if(st == "accepted").alias("accepted"),
                                 F.count(F.lit(1)).alias("total"))
    rate = F.try_divide(F.col("accepted").cast("double"), F.col("total").cast("double"))
    return agg.withColumn("rate", rate).withColumn("alarm", F.col("rate") < alarm_below)


def missing_report(df: DataFrame, columns: list[str] | None = None, section: str | None = None) -> DataFrame:
    """Per column, how many rows are null or blank - one aggregate pass, then unpivot."""
    columns = columns or df.columns
    sums = [F.sum(F.when(F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == ""), 1).otherwise(0))
            .cast("bigint").alias(c) for c in columns]
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *sums)
    long = wide.unpivot(["__n"], columns, "field", "n_missing").withColumnRenamed("__n", "n_rows")
    if section is not None:
        long = long.withColumn("section", F.lit(section))
    return long
