"""Pairs of similar vectors, by banded signed random projections and exact cosines.

Rows of equal vectors are one class, named by its smallest id, and only classes are compared, so copies cost one
row each.  A class's signature holds the side of each of ``bands * bits`` random planes on which its vector lies;
two vectors at an angle of a agree on a plane with probability 1 - a / pi.  Classes that agree on all bits of a
band meet in a task; buckets are packed into cells of about ``TILE`` rows, and a larger bucket is split into
chunks of which each two meet in a task of their own, so no bucket is capped and no task holds one whole.  Pairs
that differ on more planes of a sketch than the threshold allows go; the cosine of the rest is computed from the
vectors.  Only sketches, the first planes of the signatures, travel once per band; vectors are joined to the few
pairs that are left.

The number of bands follows from ``recall``, the probability that a pair just at the threshold shares a band.  A
band has no more bits than it takes for buckets of about half a tile: more bits ask for more bands.  How crowded
buckets get is judged by the angles in a sample of ``SAMPLE`` classes; it decides the cost, not the result.

Edge cases: rows without an id are left out; an id that repeats keeps its smallest vector; null or empty vectors,
those with null or non-finite components and those of length zero are classes of their own without links;
shorter vectors count as padded with zeros; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

TILE = 1024
MIN_BITS, MAX_BITS = 8, 16
SAMPLE = 1000
#: Standard errors by which a pair's differing planes may exceed the number expected at the threshold.
SIGMAS = 6


def shape(classes: int, threshold: float, recall: float, agree: np.ndarray | None = None) -> tuple[int, int]:
    """(bands, bits): bits by the expected size of a class's bucket, bands so that a pair at the threshold meets with
    ``recall``.  ``agree`` holds the probabilities with which sampled pairs agree on a plane (a half if not given)."""
    agree = np.array([0.5]) if agree is None or not len(agree) else agree
    fits = (b for b in range(MIN_BITS, MAX_BITS) if classes * (agree ** b).mean() <= TILE / 2)
    bits = next(fits, MAX_BITS)
    together = (1 - math.acos(threshold) / math.pi) ** bits
    return max(1, math.ceil(math.log(1 - recall) / math.log1p(-together))), bits


def sampled_agreement(classes: DataFrame) -> np.ndarray:
    """For each two of ``SAMPLE`` classes, chosen by a hash of their ids, the probability to agree on a plane."""
    rows = classes.select("v", "peak", F.xxhash64("class_id").alias("h")).orderBy("h").limit(SAMPLE).collect()
    x = np.zeros((len(rows), max((len(r["v"]) for r in rows), default=0)))
    for i, r in enumerate(rows):
        x[i, :len(r["v"])] = np.array(r["v"]) / r["peak"]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return 1 - np.arccos(np.clip(x @ x.T, -1, 1)[np.triu_indices(len(x), 1)]) / math.pi


def sketch_planes(total: int, threshold: float) -> int:
    """Planes of a sketch, whole bytes: so many that ``SIGMAS`` on either side tell a pair at the threshold from one at
    right angles."""
    apart = math.acos(threshold) / math.pi
    needed = (SIGMAS * (math.sqrt(apart * (1 - apart)) + 0.5) / (0.5 - apart)) ** 2
    return min(total, 8 * math.ceil(needed / 8))


def planes(width: int, count: int, seed: int) -> np.ndarray:
    """``count`` random planes; a dimension's numbers do not depend on the width."""
    return np.array([np.random.default_rng([seed, d]).standard_normal(count) for d in range(width)]).reshape(width, count)


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return F.coalesce(finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    rows = vectors.where(F.col(vec_id).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"),
                                                           F.col(embedding).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.when(_usable(F.col("v")), F.col("v")))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def _signatures(classes: DataFrame, bands: int, bits: int, seed: int) -> DataFrame:
    """class_id, the packed signature and its band keys."""
    weights = 1 << np.arange(bits, dtype=np.int64)

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        normals = planes(0, bands * bits, seed)
        for batch in batches:
            width = max(map(len, batch["v"]), default=0)
            if width > len(normals):
                normals = planes(width, bands * bits, seed)
            x = np.zeros((len(batch), width))
            for i, v in enumerate(batch["v"]):
                x[i, :len(v)] = v
            x /= np.abs(x).max(1, keepdims=True)  # the side does not depend on the length; products stay finite
            side = (x @ normals[:width] > 0)
            keys = side.reshape(len(x), bands, bits) @ weights
            yield pd.DataFrame({"class_id": batch["class_id"], "signature": [s.tobytes() for s in np.packbits(side, axis=1)], "keys": list(keys)})

    return classes.select("class_id", "v").mapInPandas(sign, "class_id long, signature binary, keys array<long>")


def _candidates(signed: DataFrame, bands: int, bits: int, threshold: float) -> DataFrame:
    """a, b of the classes that share a band and whose sketches are near enough, each pair once."""
    total = sketch_planes(bands * bits, threshold)
    each = signed.select("class_id", F.expr(f"substring(signature, 1, {-(-total // 8)})").alias("sketch"),
                         F.posexplode("keys").alias("band", "key"))
    large = each.groupBy("band", "key").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
    large = materialize(large, "similar-buckets")  # few: its size is known, so ``each`` need not travel for the join
    cells = max(1, -(-signed.count() // TILE))
    chunks = F.coalesce(F.ceil(F.col("n") / TILE), F.lit(1).cast("long"))
    cell = F.when(F.col("n").isNotNull(), F.col("key")).otherwise(-1 - F.pmod(F.xxhash64("key"), F.lit(cells)))
    met = (each.join(large, ["band", "key"], "left")
           .withColumn("chunk", F.pmod(F.xxhash64("class_id"), chunks))
           .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
           .select("band", cell.alias("cell"), F.least("chunk", "other").alias("lo"), F.greatest("chunk", "other").alias("hi"),
                   "chunk", "key", "class_id", "sketch"))
    apart = math.acos(threshold) / math.pi
    limit = total * apart + SIGMAS * math.sqrt(total * apart * (1 - apart))
    whole = total // bits  # bands that a sketch holds

    def compare(key: tuple, d: pd.DataFrame) -> pd.DataFrame:
        band, _, lo, hi = key
        d = d.sort_values(["key", "class_id"])
        packed = np.frombuffer(b"".join(d["sketch"]), np.uint8).reshape(len(d), -1)
        sides = np.unpackbits(packed, axis=1, count=total)
        cuts = np.flatnonzero(np.diff(d["key"].to_numpy())) + 1
        found = [pd.DataFrame({"a": [], "b": []}, dtype="int64")]
        for start, end in zip([0, *cuts], [*cuts, len(d)], strict=True):
            side, ids, chunk = sides[start:end], d["class_id"].to_numpy()[start:end], d["chunk"].to_numpy()[start:end]
            signed = side.astype(np.float32) * 2 - 1
            near = np.triu((total - signed @ signed.T) / 2 <= limit, 1)
            i, j = np.nonzero(near & (chunk[:, None] != chunk[None, :]) if lo != hi else near)
            earlier = min(band, whole)
            for at in range(0, len(i), 1 << 16):  # a pair that shares an earlier band of the sketch counts there
                x, y = i[at:at + (1 << 16)], j[at:at + (1 << 16)]
                same = side[x, :earlier * bits] == side[y, :earlier * bits]
                first = ~same.reshape(len(x), earlier, bits).all(2).any(1)
                found.append(pd.DataFrame({"a": ids[x[first]], "b": ids[y[first]]}))
        return pd.concat(found)

    return met.groupBy("band", "cell", "lo", "hi").applyInPandas(compare, "a long, b long").distinct()


def cosine(x: Column, y: Column) -> Column:
    """Cosine of two arrays, the shorter padded with zeros."""
    total = lambda v: F.aggregate(v, F.lit(0.0), lambda a, p: a + p)
    dot = F.zip_with(x, y, lambda p, q: F.coalesce(p * q, F.lit(0.0)))
    norm = lambda v: F.sqrt(total(F.transform(v, lambda p: p * p)))
    return total(dot) / (norm(x) * norm(y))


def classes_of(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> tuple[DataFrame, DataFrame]:
    """(members, classes): vec_id with class_id for every id, and class_id, v, peak (the largest component by size) for
    every class that can have links."""
    rows = materialize(_rows(vectors, vec_id, embedding), "similar-rows")
    classes = rows.where("v is not null").groupBy("v").agg(F.min("vec_id").alias("class_id"))
    classes = materialize(classes.withColumn("peak", F.array_max(F.transform("v", F.abs))), "similar-classes")
    members = rows.join(classes.select("v", "class_id"), "v", "left").select("vec_id", F.coalesce("class_id", "vec_id").alias("class_id"))
    return members, classes


def similar_pairs(classes: DataFrame, threshold: float = 0.9, recall: float = 0.9999, seed: int = 7) -> DataFrame:
    """a, b, cosine: classes (a < b) of ``classes_of`` whose cosine is at least ``threshold`` (between 0 and 1)."""
    if not 0 < threshold < 1 or not 0 < recall < 1:
        raise ValueError("threshold and recall must lie between 0 and 1")
    bands, bits = shape(classes.count(), threshold, recall, sampled_agreement(classes))
    signed = materialize(_signatures(classes, bands, bits, seed), "similar-signatures")
    pairs = _candidates(signed, bands, bits, threshold)
    scaled = F.transform("v", lambda x: x / F.col("peak"))  # so that squares stay finite
    for side in "ab":
        pairs = pairs.join(classes.select(F.col("class_id").alias(side), scaled.alias(f"v{side}")), side)
    return pairs.select("a", "b", cosine(F.col("va"), F.col("vb")).alias("cosine")).where(F.col("cosine") >= threshold)


def similar_classes(vectors: DataFrame, threshold: float = 0.9, recall: float = 0.9999, vec_id: str = "vec_id",
                    embedding: str = "embedding") -> DataFrame:
    """vec_id, class_id, n_links: each id with its class and the number of other classes that are linked to it."""
    members, classes = classes_of(vectors, vec_id, embedding)
    pairs = materialize(similar_pairs(classes, threshold, recall).select("a", "b"), "similar-links")
    links = pairs.select(F.explode(F.array("a", "b")).alias("class_id")).groupBy("class_id").agg(F.count("*").alias("n_links"))
    return members.join(links, "class_id", "left").select("vec_id", "class_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
