"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Every source gets a target number of words: all words, shared by the sources' weights, but at most ``REPEATS``
times what the source holds; what is above is shared out again by weight.  Within its source a document stands
at a random but fixed place (a hash of its id), and each of up to ``REPEATS`` rounds over the source queues all
its documents once.  A queued copy's virtual finish time is the source's words up to and including it, divided
by the source's target; the mix is the queue of all sources in order of finish time, cut at the total budget.

No task sees a whole source: running sums are taken over ranges of the hash, sized by the source's row count,
and added to the sums of the ranges before.  The copies that finish by time 1 never exceed the budget
(each source's sum up to time 1 is at most its target), so the cut falls among the copies that are still
running at time 1, at most one per source: only those need one ordering.

Edge cases: null source is a source of its own, last in order; null text has size 0 and is never taken; rows
with equal id and size share one place and may be taken differently only if they are equal in both; an empty
table gives no rows; with no words at all every target is 0.  Other columns are ignored by ``plan`` and kept
by ``mix``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, words

WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Rows per running-sum range (a size of work, not a limit of rows).
RANGE_ROWS = 500


def source_targets(sized: DataFrame) -> DataFrame:
    """source, n_docs, source_size, target for each source of a (source, size) frame.

    Works on one row per source.  A source is capped where even the level reached after capping all sources with
    a smaller size per weight is above its own cap; the rest share what remains by weight.
    """
    per = sized.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("i", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("i") % len(WEIGHTS) + 1).cast("int")).cast("long"))
    per = per.withColumn("cap", F.col("source_size") * REPEATS)
    every = Window.partitionBy()
    before = Window.orderBy(F.col("cap") / F.col("weight"), "i").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    per = (per.withColumn("total", F.sum("source_size").over(every)).withColumn("weights", F.sum("weight").over(every))
           .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), zero))
           .withColumn("left_weight", F.col("weights") - F.coalesce(F.sum("weight").over(before), zero))
           .withColumn("capped", F.col("left") * F.col("weight") > F.col("cap") * F.col("left_weight")))
    per = (per.withColumn("capped_size", F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every))
           .withColumn("capped_weight", F.sum(F.when(F.col("capped"), F.col("weight")).otherwise(0)).over(every)))
    level = (F.col("total") - F.col("capped_size")) * F.col("weight") / (F.col("weights") - F.col("capped_weight"))
    return per.select("source", "n_docs", "source_size",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(level.cast("double")).alias("target"))


def _place(doc_id):
    """A fixed random place from 0 to 2^60 - 1, the first 15 hex digits of an MD5."""
    text = F.concat(F.lit("mix-"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, taken, finish (virtual finish time of the first copy) per row."""
    sized = materialize(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"),
                                    _place(F.col("doc_id")).alias("place")), "mix-sizes")
    targets = materialize(source_targets(sized), "mix-targets")
    same = F.col("a.source").eqNullSafe(F.col("b.source"))
    rows = sized.alias("a").join(targets.alias("b"), same).select("a.*", "n_docs", "source_size", "target")
    ranges = F.ceil(F.col("n_docs") / RANGE_ROWS)
    rows = rows.withColumn("range", F.floor(F.col("place") / F.lit(float(1 << 60)) * ranges))
    sums = rows.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sums = materialize(sums.withColumn("before", F.coalesce(F.sum("range_size").over(earlier), F.lit(0).cast("long"))), "mix-ranges")
    within = Window.partitionBy("source", "range").orderBy("place", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("size").over(within))
    queued = rows.alias("a").join(sums.alias("b"), same & (F.col("a.range") == F.col("b.range"))).select(
        "doc_id", "a.source", "size", "source_size", "target", (F.col("before") + F.col("upto")).alias("upto"))
    # rounds that have ended by time 1, and the round that is running then
    ends = [F.col("upto") + F.lit(r) * F.col("source_size") for r in range(REPEATS)]
    done = sum((F.when(e <= F.col("target"), 1).otherwise(0) for e in ends[1:]), F.when(ends[0] <= F.col("target"), 1).otherwise(0))
    running = F.coalesce(*[F.when((e > F.col("target")) & (e - F.col("size") < F.col("target")), e) for e in ends])
    queued = materialize(queued.withColumn("done", done).withColumn("running", running), "mix-queue")
    # at most one running copy per source: cut their queue where the budget ends
    used = queued.agg(F.sum("source_size").alias("x"), F.sum(F.col("size") * F.col("done")).alias("used"),
                      F.sum("size").alias("budget")).collect()[0]
    room = (used["budget"] or 0) - (used["used"] or 0)
    order = Window.orderBy(F.col("running") / F.col("target"), "source", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    last = (queued.where("running is not null").withColumn("sum", F.sum("size").over(order)).where(F.col("sum") <= room)
            .select("source", F.col("upto").alias("cut")))
    joined = queued.alias("a").join(last.alias("b"), same & (F.col("size") > 0) & (F.col("upto") == F.col("cut")), "left")
    copies = F.col("done") + F.when(F.col("cut").isNotNull(), 1).otherwise(0)
    return joined.select("doc_id", "a.source", "size", "source_size", "target", (F.col("size") * copies).alias("taken"),
                         F.try_divide("upto", "target").alias("finish"))  # null in a source without words


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents, range-sorted by virtual finish time, repeated copies as repeated rows."""
    key = ["doc_id", "source", "size"]
    nth = lambda: F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))  # noqa: E731 - tells repeated rows apart
    taken = plan(docs).where("taken > 0").withColumn("nth", nth())
    copies = taken.select(*[F.col(c).alias(f"t_{c}") for c in (*key, "nth")], (F.col("source_size") / F.col("target")).alias("lap"),
                          F.posexplode(F.array_repeat("finish", (F.col("taken") / F.col("size")).cast("int"))).alias("round", "first"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"))
    rows = rows.withColumn("nth", nth())
    same = [F.col(c).eqNullSafe(F.col(f"t_{c}")) for c in (*key, "nth")]
    mixed = rows.join(copies, same[0] & same[1] & same[2] & same[3])
    return mixed.withColumn("at", F.col("first") + F.col("round") * F.col("lap")).orderBy("at", "doc_id").select("row.*")
