"""Connected components of a link table, by rounds of Spark jobs over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, label) for every id of a (a, b) link table; label is the smallest id that can be reached.

    Each round takes the smallest of a row's label, its neighbours' labels and the label's own label (pointer
    jumping), in one aggregate: stars take one round and the one that finds nothing new, chains a logarithmic
    number.  Rounds are cut by written tables; the driver sees only whether a label changed.  Links may repeat.
    """
    both = links.select("a", "b").union(links.select("b", "a"))
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("n")).select(
        F.col("a").alias("id"), F.least("a", "n").alias("label")), "cc-labels")
    while True:
        none = F.lit(None).cast("long").alias("old")
        near = both.join(labels, both["b"] == labels["id"]).select(F.col("a").alias("id"), "label", none)
        own = labels.select(F.col("id").alias("j_id"), F.col("label").alias("j_label"))
        jump = labels.join(own, labels["label"] == own["j_id"]).select("id", F.col("j_label").alias("label"), none)
        rows = labels.select("id", "label", F.col("label").alias("old")).union(near).union(jump)
        nxt = materialize(rows.groupBy("id").agg(F.min("label").alias("label"), F.max("old").alias("old")), "cc-labels")
        labels = nxt.select("id", "label")
        if nxt.where("label <> old").isEmpty():
            return labels
