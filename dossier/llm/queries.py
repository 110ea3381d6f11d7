"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import divergence, jaccard, language, licenses, mixing, neardup, packing, pii, quality, ranked, repeats, topk, toxicity
from .common import table

#: Words of a text, as DuckDB writes them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: The text with A-Z lower-cased.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: Terms of ranked search: letters and digits.
_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"


def _components_sql(size: int, limit: int, columns: str) -> str:
    """Components of documents whose sets of ``size`` words have a similarity of ``limit`` hundredths."""
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + {size - 1}], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM s x JOIN s y ON x.k = y.k AND x.doc_id <> y.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= {limit} * (na.n + nb.n - shared)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT {columns} FROM c LEFT JOIN n USING (doc_id)"""


ORACLES: dict[str, str] = {
    "op3_substring_dedup": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
firsts AS (SELECT k, min(doc_id) AS first_doc FROM win GROUP BY k),
hit AS (SELECT doc_id, i FROM win JOIN firsts USING (k) WHERE first_doc < doc_id),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM hit)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS rest, count(*) AS n
         FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op5_minhash_neardup": _components_sql(5, 85, "doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept"),
    "op9_exact_topk": """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY rank <= 20""",
    "op11_ranked_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_TERM}) AS w FROM documents WHERE doc_id IS NOT NULL),
tok AS (SELECT r, unnest(w) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM tok GROUP BY ALL),
n AS (SELECT r, sum(tf) AS n FROM tf GROUP BY r),
whole AS (SELECT count(*) AS n_docs, sum(n) AS n_terms FROM n),
m AS (SELECT r, 25 + (75 * n * n_docs) // n_terms AS m FROM n, whole),
w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), whole),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, {_TERM})) AS term
      FROM (SELECT item_id, min(text) AS text FROM benchmark WHERE item_id IS NOT NULL GROUP BY item_id)) GROUP BY ALL),
s AS (SELECT item_id, doc_id, r, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) JOIN d USING (r) GROUP BY ALL HAVING score > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score
FROM s QUALIFY rank <= 10""",
    "op12_ngram_jaccard": _components_sql(3, 90, "doc_id, coalesce(n, 0) AS n_shingles, component_id"),
    "op13_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  regexp_extract_all({_LOWER}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
tok AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM tok GROUP BY ALL HAVING count(DISTINCT r) >= 10),
here AS (SELECT lang, source, term, count(*) AS c FROM tok JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
gn AS (SELECT lang, source, coalesce((SELECT sum(c) FROM here h WHERE h.lang = g.lang AND h.source = g.source), 0) AS n, v FROM g JOIN v USING (lang)),
p AS (SELECT gn.lang, gn.source, kept.term, coalesce(c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c, 0) + 2)) // (n + 2 * v) AS p
      FROM gn JOIN kept ON kept.lang = gn.lang LEFT JOIN here ON here.lang = gn.lang AND here.source = gn.source AND here.term = kept.term),
whole AS (SELECT lang, term, sum(c) AS c FROM here GROUP BY ALL),
q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 2)) // (sum(c) OVER (PARTITION BY lang) + 2 * v) AS q FROM whole JOIN v USING (lang)),
summed AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
           FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
          FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE c > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10""",
}


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.size("spans").alias("n_spans"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedupe(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE))
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[of(k) for k in pii.BASE], F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"), pii.scores(F.col("spans")).alias("scores"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_language_id, op2_quality_rules, op3_substring_dedup, op4_best_fit_packing, op5_minhash_neardup, op6_license_scan,
    op7_toxicity, op8_pii, op9_exact_topk, op10_source_mixing, op11_ranked_search,
    op12_ngram_jaccard, op13_source_divergence)}
