"""Near-duplicates of shingle sets by SetSketch registers, banding, joint likelihood and exact confirmation.

1. Every text becomes a SetSketch: ``REGISTERS`` registers, each the exponentially spaced, truncated minimum of
   one exponential hash over the set's shingles.  Sketches of two sets merge to the sketch of their union by the
   registers' maximum (``merge_registers``), and equal registers are as frequent as the sets are similar.
2. Equal sets are one group, represented by its smallest id; all later steps work on representatives.
3. ``ROWS`` registers make a band.  Two sets of Jaccard similarity 0.85 agree in at least one of the
   ``REGISTERS / ROWS`` bands but for a probability below 1e-6, and more similar ones all the more.
4. A candidate pair goes on if its sizes allow the limit and the similarity estimated from both sketches by
   maximum likelihood is within six standard deviations of it (bound below 1e-8); it becomes a link if the full
   shingle sets confirm it.  Links give components.
5. Candidates come in three rounds.  First each document meets one other, the smallest id of its buckets.  Then
   the members of buckets that still hold several components meet two fixed members of other components.  Last,
   buckets that are still divided (near misses) are compared on their full sets in tiles of bounded size, which
   give back only links that join components.  A large group of copies is one component by then, no round emits
   all pairs of a group, and no link that would join two components is left out.

Edge cases: texts without words (or null) have an empty set and link with nothing; fewer words than a shingle
make one shingle of the whole sequence; repeated rows get the same result each (where one id has several texts,
one of them stands for it in comparisons); a row without id takes no part (its component is null, ``kept``
true); other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo, materialize
from .graph import components

SHINGLE = 5
LIMIT = 0.85
REGISTERS, ROWS = 180, 6
#: Shingles and documents of one chunk of a divided bucket; a tile compares two chunks (a size of work, not a limit).
TILE_SHINGLES, TILE_ROWS = 2_000_000, 2_000
BASE, RATE, TOP = 1.001, 20.0, 65534

_STEP = np.uint64(0x9E3779B97F4A7C15)
_ODD = np.uint64(0xBF58476D1CE4E5B9)
_rng = np.random.default_rng(20240601)
_MUL = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD
    return x ^ (x >> np.uint64(31))


def shingle_hashes(text: bytes, memo: Memo, size: int = SHINGLE) -> np.ndarray:
    """Distinct 64-bit hashes of the word shingles of a text (A-Z lower-cased), sorted."""
    found = text.lower().split()  # bytes: lowers A-Z only and splits at space and U+0009 to U+000D only
    if not found:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    k = min(size, len(w))
    h = np.full(len(w) - k + 1, k, np.uint64)
    for i in range(k):
        h = _mix(h * _STEP + w[i:len(w) - k + 1 + i])
    return np.unique(h)


def word_memo() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (0 to ``TOP`` + 1) of a non-empty set of hashes."""
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        part = hashes[i:i + 2048]
        low = np.minimum(low, ((part[None, :] + _ADD[:, None]) * _MUL[:, None]).min(axis=1))
    u = (low.astype(np.float64) + 0.5) / 2.0 ** 64
    exponential = np.maximum(-np.log1p(-np.minimum(u, 1 - 1e-16)), 1e-300)
    return np.clip(np.floor(1 - np.log(exponential / RATE) / math.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def joint_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity for rows of register pairs and the sets' sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = n_a / (n_a + n_b), n_b / (n_a + n_b)
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        p_more, p_less = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return more * np.log(p_more) + less * np.log(p_less) + same * np.log(np.maximum(1 - p_more - p_less, 1e-12))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(40):  # the likelihood has one maximum
        x, y = hi - golden * (hi - lo), lo + golden * (hi - lo)
        left = likelihood(x) >= likelihood(y)
        hi, lo = np.where(left, y, hi), np.where(left, lo, x)
    return (lo + hi) / 2


def sketch(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n (set size), k1, k2 (identity of the set), regs, bands for each row with an id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            rows = []
            for doc_id, data in zip(batch["doc_id"], batch["text"], strict=True):
                h = shingle_hashes(data, memo) if data else np.empty(0, np.uint64)
                if not len(h):
                    rows.append((doc_id, 0, 0, 0, None, None))
                    continue
                whole = xxhash.xxh3_128_digest(h.tobytes())
                regs = registers(h)
                bands = [xxhash.xxh64_intdigest(regs[i:i + ROWS].tobytes(), seed=i) - (1 << 63) for i in range(0, REGISTERS, ROWS)]
                rows.append((doc_id, len(h), *np.frombuffer(whole, np.int64).tolist(), regs.tobytes(), bands))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "k1", "k2", "regs", "bands"])

    return (docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
            .mapInPandas(run, "doc_id long, n long, k1 long, k2 long, regs binary, bands array<long>"))


def likely(pairs: DataFrame, reps: DataFrame, limit: float) -> DataFrame:
    """The (a, b) pairs whose sets may reach the similarity ``limit``, by their sizes and their sketches."""
    margin = 6 * math.sqrt(limit * (1 - limit) / REGISTERS)
    a = reps.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("r_a"))
    b = reps.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("r_b"))
    sized = pairs.join(a, "a").join(b, "b").where(F.least("n_a", "n_b") >= limit * F.greatest("n_a", "n_b"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                x, y = (np.frombuffer(b"".join(batch[c]), np.uint16).reshape(len(batch), -1) for c in ("r_a", "r_b"))
                j = joint_similarity(x, y, batch["n_a"].to_numpy(float), batch["n_b"].to_numpy(float))
                yield batch.loc[j >= limit - margin, ["a", "b"]]

    return sized.select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInPandas(run, "a long, b long")


def shingle_sets(docs: DataFrame, ids: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, set) for the documents of ``ids``, written once."""

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo = word_memo()
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at:at + 500]
                yield pd.DataFrame({"doc_id": part["doc_id"], "set": [shingle_hashes(t or b"", memo).view(np.int64) for t in part["text"]]})

    chosen = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    # the ids grow with the documents: one plan, a shuffled join, at every size
    return materialize(chosen.hint("merge").join(ids, "doc_id", "left_semi").mapInPandas(sets, "doc_id long, set array<long>")
                       .dropDuplicates(["doc_id"]), "neardup-sets")


def confirmed(pairs: DataFrame, sets: DataFrame, limit: float) -> DataFrame:
    """The (a, b) pairs whose full shingle sets reach ``limit`` (exact in integers for hundredths)."""
    a = sets.select(F.col("doc_id").alias("a"), F.col("set").alias("s_a"))
    b = sets.select(F.col("doc_id").alias("b"), F.col("set").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", both.alias("both"), (F.size("s_a") + F.size("s_b")).alias("sizes")).where(
        100 * F.col("both") >= round(100 * limit) * (F.col("sizes") - F.col("both"))).select("a", "b")


def tile_links(tile: pd.DataFrame, limit: float) -> pd.DataFrame:
    """Links between documents of different labels, as many as join the labels that have any (exact, on full sets)."""
    sets, labels, ids = tile["set"].tolist(), tile["label"].to_numpy(), tile["doc_id"].to_numpy()
    sizes = np.array([len(x) for x in sets])
    _, cell, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[cell] > 1
    column = (np.cumsum(times > 1) - 1)[cell[shared]]
    row = np.repeat(np.arange(len(sets)), sizes)[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int((times > 1).sum()), 2048):
        lo, hi = np.searchsorted(column, [at, at + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[row[lo:hi], column[lo:hi] - at] = 1
        both += part @ part.T
    linked = 100 * both >= round(100 * limit) * (sizes[:, None] + sizes[None, :] - both)
    linked &= labels[:, None] != labels[None, :]
    root: dict = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
        x, y = find(labels[i]), find(labels[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, limit: float = LIMIT, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``; ``limit`` in hundredths, 0.8 or more."""
    sketched = materialize(sketch(docs, text), "neardup-sketch")
    firsts = materialize(sketched.where("n > 0").groupBy("k1", "k2").agg(F.min("doc_id").alias("rep")), "neardup-firsts")
    reps = sketched.where("n > 0").join(firsts.select(F.col("rep").alias("doc_id"), "k1", "k2"), ["doc_id", "k1", "k2"], "left_semi")
    reps = materialize(reps.dropDuplicates(["doc_id"]), "neardup-reps")

    banded = reps.select("doc_id", "n", F.explode("bands").alias("band"))
    ends = banded.groupBy("band").agg(F.count("*").alias("m"), F.min("doc_id").alias("lo"),
                                      F.min_by("doc_id", F.xxhash64("doc_id", "band")).alias("any")).where("m > 1")
    ends = materialize(ends.select("band", "lo", "any"), "neardup-buckets")
    members = materialize(banded.join(ends, "band"), "neardup-members")
    sets = shingle_sets(docs, members.select("doc_id").distinct(), text)

    def links_of(pairs: DataFrame) -> DataFrame:
        return materialize(confirmed(materialize(likely(pairs, reps, limit), "neardup-likely"), sets, limit), "neardup-links")

    def pair(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def marked(labels: DataFrame, rows: DataFrame, doc_id: str, label: str) -> DataFrame:
        known = labels.select(F.col("id").alias("_id"), F.col("label").alias("_label"))
        return rows.join(known, rows[doc_id] == known["_id"], "left").withColumn(label, F.coalesce("_label", doc_id)).drop("_id", "_label")

    # one pair for each document
    first = materialize(members.groupBy("doc_id").agg(F.min("lo").alias("lo")).where("lo < doc_id").select(*pair("doc_id", "lo")), "neardup-first")
    links = links_of(first)
    labels = components(links)

    # two pairs for each member that is not yet in the component of its bucket's two
    ends_marked = materialize(marked(labels, marked(labels, ends, "lo", "lo_label"), "any", "any_label"), "neardup-ends")
    open_ = marked(labels, members.select("band", "doc_id", "n"), "doc_id", "label").join(ends_marked, "band")
    others = F.filter(F.array(F.struct(F.col("lo").alias("id"), F.col("lo_label").alias("l")), F.struct(F.col("any").alias("id"), F.col("any_label").alias("l"))),
                      lambda e: e["l"] != F.col("label"))
    second = open_.select("doc_id", F.explode(others).alias("e")).select("doc_id", F.col("e.id").alias("other")).select(*pair("doc_id", "other")).distinct()
    second = materialize(second.join(first, ["a", "b"], "left_anti"), "neardup-second")
    links = links.union(links_of(second))
    labels = components(links)

    # buckets that are still divided, tile by tile on the full sets
    rows = materialize(marked(labels, members.select("band", "doc_id", "n"), "doc_id", "label"), "neardup-marked")
    groups = rows.groupBy("band", "label").agg(F.sum("n").alias("n"), F.count("*").alias("m"))
    chunks = F.ceil(F.greatest(F.sum("n") / TILE_SHINGLES, F.sum("m") / TILE_ROWS)).cast("int")
    divided = materialize(groups.groupBy("band").agg(F.count("*").alias("k"), chunks.alias("chunks")).where("k > 1").drop("k"), "neardup-divided")
    own = F.pmod(F.xxhash64("doc_id"), F.col("chunks")).cast("int")
    tiles = rows.join(divided, "band").select("band", "doc_id", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("with"))
    tiles = tiles.select("band", "doc_id", "label", F.least("own", "with").alias("t1"), F.greatest("own", "with").alias("t2"))
    found = tiles.join(sets.hint("merge"), "doc_id").groupBy("band", "t1", "t2").applyInPandas(lambda t: tile_links(t, limit), "a long, b long")
    more = materialize(found.distinct(), "neardup-more")
    if not more.isEmpty():
        labels = components(links.union(more))

    classes = firsts.join(labels, firsts["rep"] == labels["id"], "left").select(
        "k1", "k2", F.coalesce("label", "rep").alias("component"))
    classes = materialize(classes, "neardup-classes")
    rows = sketched.select("doc_id", "n", "k1", "k2").join(classes, ["k1", "k2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
    out = rows.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    blank = docs.where("doc_id is null").select(F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("n_shingles"),
                                                F.lit(None).cast("long").alias("component_id"), F.lit(True).alias("kept"))
    return out.unionByName(blank)


def without_duplicates(docs: DataFrame, limit: float = LIMIT, text: str = "text") -> DataFrame:
    """One document of each component (the smallest id), and all rows without an id; all columns kept.  Of rows that
    repeat an id, each different text stays once: a text is never dropped for another of the same id."""
    keep = near_duplicates(docs, limit, text).where("kept and doc_id is not null").select("doc_id").distinct()
    keep = materialize(keep, "neardup-keep")
    return docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id", text]).unionByName(docs.where("doc_id is null"))
