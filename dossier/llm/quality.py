"""Quality rules as a short-circuit cascade, in DataFrame operations only.

Every rule is a boolean expression over a text's counts or the text itself.  On a bounded sample each rule's cost
(time of a job that evaluates it many times on each row, less that of the same job without a rule) and the set of
rows it rejects are measured; rules are then ordered greedily by rows newly rejected per cost.  The cascade is one CASE expression in that order: a row that a rule
rejects never evaluates the later ones.  The order changes the work, not the verdict.

Edge cases: null and empty texts have no words and fail the base rule; repeated rows are judged each; other
columns are kept by ``judge``, whatever their names; one with the name of a result column gives way to it.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash_share, materialize, words

#: Rows of the sample that orders the rules, about (a bound on the fit of the order only).
SAMPLE_ROWS = 2_000
#: Evaluations of a rule on each sampled row, and runs of each of which the fastest counts.
EVALUATIONS, RUNS = 20, 2
WINDOW = 8
MIN_WORDS, MAX_REPEAT_PERCENT = 20, 30

#: name -> rows to reject, over ``text`` and the counts.
RULES = {
    "symbols": lambda: F.col("n_symbols") * 5 > F.col("n_words"),
    "word_length": lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 14 * F.col("n_words")),
    "repeated_lines": lambda: F.col("n_dup_lines") * 2 > F.size(F.split(F.col("text"), "\n")),
    "exclamation": lambda: (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))) * 5 > F.col("n_words"),
    "few_lowercase": lambda: F.length(F.regexp_replace("text", r"[^\p{Ll}]+", "")) * 2 < F.length(F.regexp_replace("text", r"[^\p{L}]+", "")),
    "few_letters": lambda: F.length(F.regexp_replace("text", r"[^\p{L}]+", "")) * 10 < 6 * F.col("word_chars"),
    "few_distinct_words": lambda: F.size(F.array_distinct("words")) * 20 < F.col("n_words"),
}


COUNTS = ("words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _counted(rows: DataFrame) -> DataFrame:
    """``rows`` (row, text) with ``COUNTS``."""
    body = F.coalesce(F.col("text"), F.lit(""))
    df = rows.withColumn("words", words(body))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = (df.withColumn("n_words", F.size("words").cast("long"))
          .withColumn("word_chars", F.length(F.array_join("words", "")).cast("long"))
          .withColumn("n_symbols", (F.length(body) - F.length(F.regexp_replace(body, r"[#*$%&|<>]+", ""))).cast("long"))
          .withColumn("_lines", lines)
          .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
          .withColumn("_ids", F.transform("words", lambda w: F.xxhash64(w))))
    grams = F.transform(F.sequence(F.lit(1), F.size("_ids") - WINDOW + 1), lambda i: F.xxhash64(F.slice("_ids", i, WINDOW)))
    df = df.withColumn("_grams", F.when(F.size("_ids") >= WINDOW, grams).otherwise(F.array().cast("array<bigint>")))
    # windows that occur twice stand next to each other when sorted; each array a lambda reads is a column of its
    # own, so that it is computed once per row
    pairs = F.array_sort(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_sorted", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), pairs))
    at = lambda i: F.get(F.col("_sorted"), i)["h"]
    twice = F.filter(F.transform("_sorted", lambda s, i: F.when(
        (F.coalesce(at(i - 1) == s["h"], F.lit(False))) | (F.coalesce(at(i + 1) == s["h"], F.lit(False))), s["i"])), lambda i: i.isNotNull())
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    repeats = F.aggregate(F.array_sort(twice), start, lambda a, s: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), s - a["last"])).alias("n"), s.alias("last")), lambda a: a["n"])
    df = df.withColumn("n_repeat_words", F.coalesce(repeats, F.lit(0)).cast("long"))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return df.withColumn("base_failed", base).select("row", "text", *COUNTS)


def _apart(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` as (row, text): the row travels in one column, so no name of its own can meet one of the operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))


def _with(docs: DataFrame, judged: DataFrame, names: tuple[str, ...]) -> DataFrame:
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in names]
    return judged.select(*kept, *names)


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    return _with(docs, _counted(_apart(docs, text)), COUNTS)


def cost_of(sample: DataFrame, rule: Column) -> float:
    """Seconds of a job that evaluates ``rule`` ``EVALUATIONS`` times on each row, the fastest of ``RUNS``."""
    times = []
    for _ in range(RUNS):
        began = time.perf_counter()
        sample.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(EVALUATIONS)))).agg(F.count_if(rule)).collect()
        times.append(time.perf_counter() - began)
    return min(times)


def rule_order(docs: DataFrame, text: str = "text") -> list[str]:
    """The rules by rows newly rejected per cost, measured on a sample of about ``SAMPLE_ROWS`` rows."""
    total = docs.count()
    if not total:
        return list(RULES)
    chosen = docs.select(F.col(f"`{text}`").alias("text")).where(hash_share(F.xxhash64("text"), min(1.0, SAMPLE_ROWS / total)))
    # written first: a filter on computed columns would be pushed below them with all their expressions
    sample = materialize(with_counts(chosen), "quality-sample").where("not base_failed")
    mask = sum((F.when(rule(), 1 << k).otherwise(0) for k, rule in enumerate(RULES.values())), F.lit(0))
    groups = [(r["mask"], r["n"]) for r in sample.groupBy(mask.alias("mask")).agg(F.count("*").alias("n")).collect()]
    empty = cost_of(sample, F.length("text") < F.col("again"))  # reads the same columns
    cost = {name: max(cost_of(sample, rule()) - empty, 1e-3) for name, rule in RULES.items()}
    order, bits = [], {name: 1 << k for k, name in enumerate(RULES)}
    while len(order) < len(RULES):
        best = max((n for n in RULES if n not in order), key=lambda n: sum(c for m, c in groups if m & bits[n]) / cost[n])
        order.append(best)
        groups = [(m, c) for m, c in groups if not m & bits[best]]
    return order


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """``with_counts`` plus ``rejected_by`` (the first rule of the cascade that rejects, ``base``, or null) and ``kept``."""
    verdict = F.when(F.col("base_failed"), "base")
    for name in rule_order(docs, text):
        verdict = verdict.when(RULES[name](), name)
    judged = _counted(_apart(docs, text)).withColumn("rejected_by", verdict).withColumn("kept", F.col("rejected_by").isNull())
    return _with(docs, judged, (*COUNTS, "rejected_by", "kept"))
