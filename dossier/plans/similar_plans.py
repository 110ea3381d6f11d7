"""Similar vectors over ``embeddings``.

No two vectors of the table come near one another, so each stands for three suggestions: itself, a copy (an exact
one for every third vector, else turned a little), and one turned further.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import similar as S
from .base import register, table

THRESHOLD = 0.9

VECTORS_DUCK = """
v AS (SELECT 3 * vec_id + c AS vec_id,
             [CAST(embedding[i] AS DOUBLE) + 0.01 * (CASE WHEN c = 1 AND vec_id % 3 = 0 THEN 0 ELSE c END) * ((vec_id * 31 + i * 17) % 7 - 3)
              FOR i IN range(1, len(embedding) + 1)] AS v
      FROM embeddings, (SELECT unnest([0, 1, 2]) AS c)),
k AS (SELECT v, min(vec_id) AS class_id FROM v GROUP BY v),
p AS (SELECT x.class_id AS a, y.class_id AS b, list_cosine_similarity(x.v, y.v) AS cosine FROM k x JOIN k y ON x.class_id < y.class_id),
pairs AS (SELECT * FROM p WHERE cosine >= 0.9)"""


def suggestions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("vec_id").alias("of"), "embedding", F.explode(F.array(*map(F.lit, range(3)))).alias("c"))
    turn = F.when((F.col("c") == 1) & (F.col("of") % 3 == 0), 0).otherwise(F.col("c"))
    moved = F.transform(F.col("embedding").cast("array<double>"),
                        lambda x, i: x + F.lit(0.01) * turn * ((F.col("of") * 31 + (i + 1) * 17) % 7 - 3))
    return e.select((3 * F.col("of") + F.col("c")).alias("vec_id"), moved.alias("embedding"))


@register("similar_pairs", f"WITH {VECTORS_DUCK} SELECT a, b, round(cosine, 6) AS cosine FROM pairs")
def similar_pairs(spark, d):
    _, classes = S.classes_of(suggestions(spark, d))
    return S.similar_pairs(classes, THRESHOLD).select("a", "b", F.round("cosine", 6).alias("cosine"))


@register("similar_classes", f"""WITH {VECTORS_DUCK},
n AS (SELECT class_id, count(*) AS n FROM (SELECT unnest([a, b]) AS class_id FROM pairs) GROUP BY class_id)
SELECT vec_id, class_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links FROM v JOIN k USING (v) LEFT JOIN n USING (class_id)""")
def similar_classes(spark, d):
    return S.similar_classes(suggestions(spark, d), THRESHOLD)
