"""J4 against brute force: recall, hot buckets, copies, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from dossier.operators import similar as S
from dossier.plans.base import table

SCHEMA = "vec_id long, embedding array<double>, class_id string, v int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else list(map(float, v)), "x", 1) for i, v in vectors], SCHEMA)


def brute(x, threshold):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return {(int(i), int(j)) for i, j in zip(*np.nonzero(np.triu(unit @ unit.T >= threshold, 1)))}


def pairs_of(spark, vectors, threshold, **more):
    _, classes = S.classes_of(vectors)
    return {(r["a"], r["b"]) for r in S.similar_pairs(classes, threshold, **more).collect()}


def test_recall_on_the_table_itself(spark):
    vectors = table(spark, "/root/testdata/sf0.001", "embeddings").orderBy("vec_id").limit(300)
    got = vectors.collect()
    x, ids = np.array([r["embedding"] for r in got], float), [r["vec_id"] for r in got]
    want = {(ids[i], ids[j]) for i, j in brute(x, 0.35)}
    found = pairs_of(spark, vectors, 0.35, recall=0.95)
    assert want and found <= want and len(found) >= 0.9 * len(want)


@pytest.mark.parametrize("tile", [1024, 16])
def test_groups_of_near_vectors(spark, monkeypatch, tile):
    """Many near vectors in one bucket: split into tiles, no pair is lost or given twice."""
    monkeypatch.setattr(S, "TILE", tile)
    rng = np.random.default_rng(1)
    x = np.vstack([rng.standard_normal(24) + 0.02 * rng.standard_normal((70, 24)), rng.standard_normal((80, 24))])
    vectors = frame(spark, enumerate(x))
    _, classes = S.classes_of(vectors)
    got = [(r["a"], r["b"]) for r in S.similar_pairs(classes, 0.95).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(x, 0.95)


def test_copies_and_odd_rows(spark):
    near, far = [1, 2, 3, 4], [-4, 1, 0, 2]
    rows = [(i, near) for i in range(10, 60)] + [(60, [1, 2, 3, 4.01]), (61, [1, 2, 3, 4.02]), (62, far), (62, far), (63, None), (64, []),
                                                 (65, [0, 0, 0, 0]), (66, [1, math.nan]), (67, [math.inf, 1]), (None, near), (68, [1, 2, 3, 4, 0.01]),
                                                 (69, [1e300, 2e300, 3e300, 4e300])]
    got = {r["vec_id"]: (r["class_id"], r["n_links"]) for r in S.similar_classes(frame(spark, rows)).collect()}
    assert set(got) == set(range(10, 70))
    assert all(got[i] == (10, 4) for i in range(10, 60)) and got[60] == (60, 4) and got[68] == (68, 4)
    assert all(got[i] == (i, 0) for i in range(62, 68))


def test_repeated_ids_keep_their_smallest_vector_and_empty_tables(spark):
    rows = [(1, [2, 0]), (1, [1, 0]), (2, [0, 1]), (3, [1, 0])]
    got = {r["vec_id"]: r["class_id"] for r in S.similar_classes(frame(spark, rows)).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    assert S.similar_classes(frame(spark, []).where("false")).count() == 0
    assert S.similar_classes(frame(spark, [(1, None)])).where(F.col("n_links") == 0).count() == 1


def test_bands_meet_the_recall():
    for threshold in (0.5, 0.9, 0.98):
        bands, bits = S.shape(10_000, threshold, 0.99)
        together = (1 - math.acos(threshold) / math.pi) ** bits
        assert 1 - (1 - together) ** bands >= 0.99 > 1 - (1 - together) ** (bands - 1)
    with pytest.raises(ValueError):
        S.similar_pairs(None, 1.5)


def test_bands_do_not_outnumber_what_buckets_need():
    """What travels is bands times a sketch: neither may be that of narrow buckets or whole signatures."""
    bands, bits = S.shape(1_000_000, 0.9, 0.9999)
    planes = S.sketch_planes(bands * bits, 0.9)
    assert bands * planes / 8 < 2000 and 1_000_000 / 2 ** bits <= S.TILE
    crowded = S.shape(1_000_000, 0.9, 0.9999, np.array([0.5, 0.8]))  # half of the pairs are alike: more bits
    assert crowded[1] == S.MAX_BITS


def test_sample_of_angles_with_odd_widths(spark):
    rows = [(1, [1, 0]), (2, [0, 1e300, 0]), (3, [-1]), (4, [2, 0, 0])]
    _, classes = S.classes_of(frame(spark, rows))
    assert sorted(np.round(S.sampled_agreement(classes), 6)) == [0, 0, 0.5, 0.5, 0.5, 1]
    assert pairs_of(spark, frame(spark, rows), 0.9) == {(1, 4)} and pairs_of(spark, frame(spark, rows[:1]), 0.9) == set()
