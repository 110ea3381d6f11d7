"""N-gram Jaccard join with set-relation skipping: documents whose word shingle sets are similar, as components.

1. A set's shingles stand in one global order, rare before frequent (``loads`` counts all shingles into a fixed number
   of buckets; the order is by bucket load, then hash).  Two sets of the asked similarity share a shingle among the
   first few of each, so only these prefixes are indexed.  Equal sets are one set, that of the smallest id.
2. Index lists are skipped in blocks: an entry meets only the blocks of sizes that allow the similarity, a shorter
   prefix stands for the smaller set, and positions too late in the order to reach the needed overlap are passed over.
   A pair also has to pass its parity bitmaps, whose distance never exceeds that of the sets.
3. Answers are derived from those of a similar set.  Each document is first compared with one leader, the document
   that leads most of its lists.  Documents that link with a leader form its star, their distance (size of the
   symmetric difference) to it is known, and they need no comparison with one another.  Next only stars of different
   components that share a list are compared, leader with leader: the distances of their members differ from that
   of the leaders by at most the members' own distances, so most members' answers follow.  Where they do not, the
   members are compared with the other leader, and where the stars are still divided, with each other, as far as the
   distances known by then leave a link possible.  Every comparison that counts is made on the full sets.

Links are exact (on 64-bit shingle hashes); none between two components is left out.  The leader of a very large star
is copied once per ``CELL`` shingles of its members, not once per member.

Edge cases: texts without words (or null) have an empty set and link with nothing; fewer words than a shingle make
one shingle of the whole sequence; repeated rows get the same result each (where one id has several texts, the one
with the smallest digest stands for it in comparisons); a row without id takes no part (its sizes and component are
null); other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .graph import components
from .neardup import shingle_hashes, word_memo

SHINGLE = 3
LIMIT = 90  # hundredths
BUCKET_BITS = 19
#: Shingles of the members that meet a leader in one task (a size of work, not a limit).
CELL = 1_000_000


def loads(docs: DataFrame, size: int) -> np.ndarray:
    """Shingles of all documents in each of 2^BUCKET_BITS buckets of their hashes (the array's size is fixed)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, total = word_memo(), np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for data in batch["text"]:
                found = shingle_hashes(data, memo, size)
                np.add.at(total, (found >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), 1)
        cells = np.flatnonzero(total)
        yield pd.DataFrame({"cell": cells.astype(np.int32), "n": total[cells]})

    rows = docs.where("doc_id is not null and text is not null").select(F.col("text").cast("binary").alias("text")).mapInPandas(run, "cell int, n long")
    found = rows.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def prefix_length(n: int, limit: int) -> int:
    """Shingles of a set of ``n`` that must be looked up to meet every set of at most its size."""
    return n + (-limit * n) // 100 + 1


def bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of at least 2 n cells, a power of two (so halves fold by xor)."""
    width = max(64, 1 << (2 * len(hashes) - 1).bit_length())
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def distance_bound(a: bytes, b: bytes) -> int:
    """A lower bound of the size of the symmetric difference of two sets, from their bitmaps."""
    x, y = (np.frombuffer(m, np.uint64) for m in ((a, b) if len(a) <= len(b) else (b, a)))
    y = np.bitwise_xor.reduce(y.reshape(-1, len(x)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def prefixes(docs: DataFrame, load: np.ndarray, size: int, limit: int) -> DataFrame:
    """doc_id, n, k1, k2 (identity of the set), prefix (rare shingles first), bits, for each row with an id."""
    rank = np.unique(load, return_inverse=True)[1].astype(np.int32)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch["doc_id"], batch["text"], strict=True):
                h = shingle_hashes(data, memo, size) if data else np.empty(0, np.uint64)
                if not len(h):
                    rows.append((doc_id, 0, 0, 0, None, None))
                    continue
                order = np.argsort(rank[(h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)], kind="stable")  # h ascends
                first = h[order[:prefix_length(len(h), limit)]].view(np.int64)
                k1, k2 = np.frombuffer(xxhash.xxh3_128_digest(h.tobytes()), np.int64).tolist()
                rows.append((doc_id, len(h), k1, k2, first, bitmap(h)))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "k1", "k2", "prefix", "bits"])

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
            .mapInPandas(run, "doc_id long, n long, k1 long, k2 long, prefix array<long>, bits binary"))


def shingle_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, set) of the full shingle sets of the documents of ``ids`` (id, k1, k2), written once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            for at in range(0, len(batch), 200):
                part, rows = batch.iloc[at:at + 200], []
                for doc_id, data, k1, k2 in part.itertuples(index=False, name=None):
                    h = shingle_hashes(data, memo, size)
                    if xxhash.xxh3_128_digest(h.tobytes()) == np.array([k1, k2], np.int64).tobytes():
                        rows.append((doc_id, h.view(np.int64)))
                yield pd.DataFrame(rows, columns=["id", "set"])

    texts = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text"))
    found = texts.join(ids, "id").select("id", "text", "k1", "k2").mapInPandas(run, "id long, set array<long>")
    return materialize(found.dropDuplicates(["id"]), "jaccard-sets")


def within(distance: Column, sizes: Column, slack: Column, limit: int) -> Column:
    """Whether sets of these sizes together may be as similar as asked, at a distance that may be too large by ``slack``."""
    return (100 + limit) * distance <= (100 - limit) * sizes + (100 + limit) * slack


def possible(pairs: DataFrame, sets: DataFrame, limit: int) -> DataFrame:
    """The rows of ``pairs`` (a, b, sizes, slack, more) whose bitmaps allow a link."""
    bits = lambda c: sets.select(F.col("doc_id").alias(c), F.col("bits").alias(f"bits_{c}"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                low = np.array(list(map(distance_bound, batch["bits_a"], batch["bits_b"])), np.int64)
                keep = (100 + limit) * low <= (100 - limit) * batch["sizes"].to_numpy() + (100 + limit) * batch["slack"].to_numpy()
                yield batch.loc[keep, ["a", "b", "sizes", "slack"]]

    joined = pairs.join(bits("a"), "a").join(bits("b"), "b").select("a", "b", "sizes", "slack", "bits_a", "bits_b")
    return materialize(joined.mapInPandas(run, "a long, b long, sizes long, slack long"), "jaccard-possible")


def measured(pairs: DataFrame, docs: DataFrame, reps: DataFrame, size: int) -> DataFrame:
    """a, b, n_a, n_b, distance: the symmetric difference of the full sets of each pair; ``b`` is the side met by many."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct().join(
        reps.select(F.col("doc_id").alias("id"), "n", "k1", "k2"), "id"), "jaccard-ids")
    sets = shingle_sets(docs, ids.select("id", "k1", "k2"), size)
    sized = pairs.select("a", "b").join(ids.select(F.col("id").alias("a"), F.col("n").alias("n_a")), "a")
    cells = sized.groupBy("b").agg(F.ceil(F.sum("n_a") / CELL).cast("int").alias("cells"))
    dealt = sized.join(cells, "b").withColumn("cell", F.pmod(F.xxhash64("a"), "cells").cast("int")).drop("cells")
    left = dealt.join(sets.select(F.col("id").alias("a"), "set"), "a").select("a", "b", "cell", "set")
    right = dealt.select("b", "cell").distinct().join(sets.select(F.col("id").alias("b"), "set"), "b").select(
        F.col("b").alias("leader"), F.col("cell").alias("part"), F.col("set").alias("own"))

    def meet(members: pd.DataFrame, leader: pd.DataFrame) -> pd.DataFrame:
        if not len(leader) or not len(members):
            return pd.DataFrame({"a": [], "b": [], "n_a": [], "n_b": [], "distance": []}, dtype="int64")
        own, sizes = leader["own"].iloc[0], members["set"].map(len).to_numpy()
        flat = np.concatenate(members["set"].tolist())
        shared = np.isin(flat, own)
        both = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[shared], minlength=len(sizes))
        return pd.DataFrame({"a": members["a"], "b": members["b"], "n_a": sizes, "n_b": len(own), "distance": sizes + len(own) - 2 * both})

    return materialize(left.groupBy("b", "cell").cogroup(right.groupBy("leader", "part")).applyInPandas(
        meet, "a long, b long, n_a long, n_b long, distance long"), "jaccard-measured")


def _size_class(n: Column, limit: int) -> Column:
    """Sizes of one class and the class below hold every size from n * limit to n."""
    return F.floor(F.log(n) / (1.0001 * math.log(100 / limit))).cast("int")


def _linked(limit: int) -> Column:
    return within(F.col("distance"), F.col("n_a") + F.col("n_b"), F.lit(0), limit)


def similar_components(docs: DataFrame, limit: int = LIMIT, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``; ``limit`` in hundredths."""
    sketched = materialize(prefixes(docs, loads(docs, size), size, limit), "jaccard-prefixes")
    full = sketched.where("n > 0")
    firsts = materialize(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "jaccard-firsts")
    reps = full.join(firsts.select(F.col("rep").alias("doc_id"), "k1", "k2"), ["doc_id", "k1", "k2"], "left_semi")
    reps = materialize(reps.groupBy("doc_id").agg(F.min(F.struct("k1", "k2", "n", "prefix", "bits")).alias("s")).select("doc_id", "s.*"), "jaccard-reps")

    # index lists of at least two sets, each with its leader: the smallest id whose short prefix holds the shingle
    short = F.col("n") - F.call_function("div", F.col("n") * 2 * limit + (99 + limit), F.lit(100 + limit)) + 1
    postings = reps.select("doc_id", "n", F.posexplode("prefix").alias("pos", "token")).withColumn("short", F.col("pos") < short)
    lists = postings.groupBy("token").agg(F.count("*").alias("m"), F.min(F.when(F.col("short"), F.struct("doc_id", "n"))).alias("lead")) \
        .where("m > 1 and lead is not null").select("token", "lead")
    members = materialize(postings.join(lists, "token"), "jaccard-members")

    # first each set meets the leader of most of its lists
    fits = limit * F.greatest("n", "lead.n") <= 100 * F.least("n", "lead.n")
    asked = members.where((F.col("lead.doc_id") != F.col("doc_id")) & fits).groupBy(
        F.col("doc_id").alias("a"), F.col("lead.doc_id").alias("b"), (F.col("n") + F.col("lead.n")).alias("sizes")).agg(F.count("*").alias("lists"))
    asked = asked.groupBy("a").agg(F.max(F.struct("lists", (-F.col("b")).alias("b"), "sizes")).alias("x")).select(
        "a", (-F.col("x.b")).alias("b"), "x.sizes", F.lit(0).cast("long").alias("slack"))
    met = measured(possible(asked, reps, limit), docs, reps, size)
    links = materialize(met.where(_linked(limit)).select("a", "b", "n_a", "distance"), "jaccard-links")
    labels = components(links.select("a", "b"))

    # a star is a leader that follows no other, and the sets linked to it
    follow = links.select(F.col("b").alias("id")).distinct().join(links.select(F.col("a").alias("id")), "id", "left_anti")
    stars = materialize(links.join(follow, links["b"] == follow["id"]).select(
        F.col("a").alias("doc_id"), F.col("b").alias("star"), F.col("n_a").alias("n"), F.col("distance").alias("off")), "jaccard-stars")
    wide = materialize(stars.groupBy("star").agg(F.max("n").alias("most"), F.max("off").alias("reach")), "jaccard-wide")

    def with_label(rows: DataFrame, labels: DataFrame, column: str, name: str) -> DataFrame:
        known = labels.select(F.col("id").alias(column), F.col("label").alias("_label"))
        return rows.join(known, column, "left").withColumn(name, F.coalesce("_label", column)).drop("_label")

    # then stars of different components that share a list, leader with leader
    starred = members.join(stars.select("doc_id", "star"), "doc_id", "left").withColumn("star", F.coalesce("star", "doc_id"))
    entries = starred.groupBy("token", "star").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("pos").alias("pos"), F.max("short").alias("short"))
    entries = materialize(with_label(entries, labels, "star", "label"), "jaccard-entries")
    divided = entries.groupBy("token").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h").select("token")
    entries = materialize(entries.join(divided, "token", "left_semi"), "jaccard-divided")
    block = lambda least: F.explode(F.sequence(_size_class(least, limit), _size_class(F.col("hi"), limit))).alias("block")
    index = entries.where("short").select("token", block(F.col("lo")), *[F.col(c).alias(f"{c}_i") for c in ("star", "lo", "hi", "pos", "label")])
    probe = entries.select("token", "star", "lo", "hi", "pos", "label", block(F.greatest(F.lit(1.0), F.col("lo") * limit / 100)))
    needed = limit * (F.col("lo") + F.col("lo_i"))
    reached = lambda hi, pos: (100 + limit) * (F.col(hi) - F.col(pos)) >= needed
    crossed = index.join(probe, ["token", "block"]).where(
        (F.col("label") != F.col("label_i")) & (F.col("lo_i") <= F.col("hi")) & (100 * F.col("hi_i") >= limit * F.col("lo"))
        & reached("hi", "pos") & reached("hi_i", "pos_i"))
    pairs = crossed.select(F.greatest("star", "star_i").alias("a"), F.least("star", "star_i").alias("b")).distinct()
    n_of = lambda c: reps.select(F.col("doc_id").alias(c), F.col("n").alias(f"n_{c}")).join(
        wide.select(F.col("star").alias(c), F.col("most").alias(f"most_{c}"), F.col("reach").alias(f"reach_{c}")), c, "left")
    sized = pairs.join(n_of("a"), "a").join(n_of("b"), "b")
    top = lambda c: F.greatest(f"n_{c}", F.coalesce(f"most_{c}", F.lit(0)))
    slack = lambda c: F.coalesce(f"reach_{c}", F.lit(0).cast("long"))
    sized = materialize(sized.select("a", "b", (top("a") + top("b")).alias("sizes"), (slack("a") + slack("b")).alias("slack")), "jaccard-pairs")
    maybe = possible(sized, reps, limit)
    if not maybe.isEmpty():
        met = measured(maybe, docs, reps, size)
        links = materialize(links.select("a", "b").union(met.where(_linked(limit)).select("a", "b")), "jaccard-links")
        labels = components(links)
        close = maybe.join(met.select("a", "b", "distance"), ["a", "b"]).where("slack > 0").where(
            within(F.col("distance"), F.col("sizes"), F.col("slack"), limit))

        def still_divided(rows: DataFrame, labels: DataFrame) -> DataFrame:
            return with_label(with_label(rows, labels, "a", "l_a"), labels, "b", "l_b").where("l_a <> l_b").drop("l_a", "l_b")

        close = materialize(still_divided(close, labels), "jaccard-close")
        if not close.isEmpty():
            links, labels = _members(close, stars, docs, reps, links, limit, size, still_divided)

    classes = firsts.join(labels, firsts["rep"] == labels["id"], "left").select("k1", "k2", F.coalesce("label", "rep").alias("component"))
    classes = materialize(classes, "jaccard-classes")
    out = sketched.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    none = F.lit(None).cast("long")
    return out.unionByName(docs.where("doc_id is null").select(none.alias("doc_id"), none.alias("n_shingles"), none.alias("component_id")))


def _members(close: DataFrame, stars: DataFrame, docs: DataFrame, reps: DataFrame, links: DataFrame, limit: int, size: int,
             still_divided) -> tuple[DataFrame, DataFrame]:
    """The links between members of the star pairs of ``close`` (a, b, distance) that the leaders' distance leaves open,
    added to ``links``, and the labels."""
    sizes = reps.select(F.col("doc_id").alias("id"), "n")
    centres = close.select(F.col("a").alias("star")).union(close.select("b")).distinct()
    everyone = stars.join(centres, "star", "left_semi").select("star", F.col("doc_id").alias("id"), "n", "off").unionByName(
        centres.select("star", F.col("star").alias("id")).join(sizes, "id").select("star", "id", "n", F.lit(0).cast("long").alias("off")))
    everyone = materialize(everyone, "jaccard-everyone")
    side = lambda c: everyone.select(F.col("star").alias(c), F.col("id").alias(f"id_{c}"), F.col("n").alias(f"n_{c}"), F.col("off").alias(f"off_{c}"))
    reach = everyone.groupBy("star").agg(F.max("off").alias("reach"), F.max("n").alias("most"))
    far = lambda c: reach.select(F.col("star").alias(c), F.col("reach").alias(f"reach_{c}"), F.col("most").alias(f"most_{c}"))

    # members of one star with the leader of the other
    def with_leader(own: str, other: str) -> DataFrame:
        rows = close.join(side(own), own).join(far(other), other).where(f"off_{own} > 0")
        least = F.greatest(F.lit(0), F.col("distance") - F.col(f"off_{own}"))
        both = F.col(f"n_{own}") + F.col(f"most_{other}")
        return rows.where(within(least, both, F.col(f"reach_{other}"), limit)).select(
            F.col(f"id_{own}").alias("a"), F.col(other).alias("b"), both.alias("sizes"), F.col(f"reach_{other}").alias("slack"))

    first = materialize(with_leader("a", "b").union(with_leader("b", "a")).distinct(), "jaccard-first")
    met = measured(possible(first, reps, limit), docs, reps, size)
    links = materialize(links.union(met.where(_linked(limit)).select("a", "b")), "jaccard-links")
    labels = components(links)

    # members of both stars: the distance of y to z is at least that of y to the other leader, less z's own
    left = still_divided(close, labels)
    known = met.select(F.col("a").alias("id"), F.col("b").alias("leader"), F.col("distance").alias("to"))
    to = lambda own, other: known.select(F.col("id").alias(f"id_{own}"), F.col("leader").alias(other), F.col("to").alias(f"to_{own}"))
    # a member that was not measured cannot link into the other star at all
    rows = left.join(side("a").where("off_a > 0").join(to("a", "b"), "id_a"), ["a", "b"]).join(
        side("b").where("off_b > 0").join(to("b", "a"), "id_b"), ["a", "b"])
    least = F.greatest(F.col("to_a") - F.col("off_b"), F.col("to_b") - F.col("off_a"), F.lit(0))
    both = F.col("n_a") + F.col("n_b")
    second = rows.where(within(least, both, F.lit(0), limit)).select(
        F.greatest("id_a", "id_b").alias("a"), F.least("id_a", "id_b").alias("b"), both.alias("sizes"), F.lit(0).cast("long").alias("slack")).distinct()
    second = possible(materialize(second, "jaccard-second"), reps, limit)
    if second.isEmpty():
        return links, labels
    met = measured(second, docs, reps, size)
    links = materialize(links.union(met.where(_linked(limit)).select("a", "b")), "jaccard-links")
    return links, components(links)
