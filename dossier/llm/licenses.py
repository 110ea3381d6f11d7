"""License scans by diagonal voting, in DataFrame operations only.

All rolling word k-grams of all texts are hashed and joined to the k-grams of license notices.  A match at word
``p`` of a text and word ``t`` of a notice votes for the diagonal ``p - t``; votes are counted per diagonal,
neighbouring diagonals (insertions or omissions) are merged, and the span they enclose is verified on its words.
The notices are a fixed table of this module, so their side of the join is broadcast.

Edge cases: a null text is empty; equal texts of one id are one case and get equal results; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize

K = 3
#: Diagonals are one alignment if no more words lie between them in the text than this share of the notice's k-grams.
GAP = 0.5
#: Share of a notice's k-grams that must vote, and of its words that must be in the span.
MIN_VOTES, MIN_WORDS = 0.5, 0.7
BASE_SCORE = 0.8

#: Phrases of the base scan, word by word, with their labels.
PHRASES = ((("mit", "license"), "mit"), (("apache", "license"), "apache"), (("general", "public", "license"), "gpl"))

#: Wording of common license notices.
NOTICES = (
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files to deal in the software without restriction"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
)

_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def license_words(text: Column) -> Column:
    """Lower-cased words of digits, letters and non-ASCII characters.

    Lower-casing all letters gives the same ASCII words as lower-casing A-Z, but for two characters (U+0130 and
    U+212A) whose lower case holds an ASCII letter; others stand in for them.
    """
    body = F.coalesce(text, F.lit(""))
    body = F.replace(F.replace(body, F.lit("\u0130"), F.lit("\u0131")), F.lit("\u212a"), F.lit("\u03ba"))
    return F.array_remove(F.split(F.lower(body), _BREAK), "")


def _grams(found: Column) -> Column:
    n = F.size(found)
    return F.when(n >= K, F.transform(F.sequence(F.lit(1), n - K + 1), lambda i: F.xxhash64(F.slice(found, i, K)))).otherwise(
        F.array().cast("array<bigint>"))


def _places(found: Column, phrase: tuple[str, ...], label: str) -> Column:
    """(start, label) of every place where the phrase's words stand consecutively."""

    def here(i):
        fits = F.get(found, i) == phrase[0]
        for j, word in enumerate(phrase[1:], 1):
            fits = fits & (F.get(found, i + j) == word)
        return fits

    spots = F.filter(F.sequence(F.lit(0), F.size(found) - len(phrase)), here)
    place = F.transform(spots, lambda i: F.struct(i.cast("long").alias("start"), F.lit(label).alias("label")))
    possible = (F.size(found) >= len(phrase)) & F.array_contains(found, phrase[-1])
    return F.when(possible, place).otherwise(F.array().cast("array<struct<start:bigint,label:string>>"))


def notices(spark: SparkSession) -> DataFrame:
    """notice, label, notice_words, n_grams, t, gram: every k-gram of every notice (a fixed table)."""
    rows = [(i, label, text.split()) for i, (label, text) in enumerate(NOTICES)]
    base = spark.createDataFrame(rows, "notice int, label string, notice_words array<string>")
    grams = _grams(F.col("notice_words"))
    return base.select("notice", "label", "notice_words", F.size(grams).alias("n_grams"), F.posexplode(grams).alias("t", "gram"))


def alignments(rows: DataFrame, table: DataFrame) -> DataFrame:
    """doc_id, key, notice, lo, hi (first and last voting word) of the diagonals with enough votes."""
    votes = rows.select("doc_id", "key", F.posexplode(_grams(F.col("words"))).alias("p", "gram"))
    votes = votes.join(F.broadcast(table.select("notice", "n_grams", "t", "gram")), "gram")
    diagonals = votes.groupBy("doc_id", "key", "notice", "n_grams", (F.col("p") - F.col("t")).alias("d")).agg(
        F.collect_set("t").alias("ts"), F.min("p").alias("lo"), F.max("p").alias("hi"))  # a notice has few k-grams
    order = Window.partitionBy("doc_id", "key", "notice").orderBy("lo", "d")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    gap = F.col("lo") - F.max("hi").over(before)
    grouped = diagonals.withColumn("new", F.when(gap <= K + GAP * F.col("n_grams"), 0).otherwise(1)).withColumn("run", F.sum("new").over(order))
    merged = grouped.groupBy("doc_id", "key", "notice", "n_grams", "run").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.collect_list("ts").alias("ts"))
    voted = F.size(F.array_distinct(F.flatten("ts")))
    return merged.where(voted >= MIN_VOTES * F.col("n_grams")).select("doc_id", "key", "notice", "lo", "hi")


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row of ``docs``."""
    table = notices(docs.sparkSession)
    keyed = docs.select("doc_id", F.xxhash64(text).alias("key"), F.col(text).alias("text"))
    rows = keyed.select("doc_id", "key", license_words(F.col("text")).alias("words"))
    spans = materialize(alignments(rows, table), "license-spans")

    # verify the spans on the words between their first and last vote
    match = F.expr("x.doc_id <=> y.doc_id and x.key = y.key")
    hit = keyed.alias("x").join(spans.alias("y"), match, "left_semi").select("doc_id", "key", license_words(F.col("text")).alias("words"))
    wording = F.broadcast(table.select("notice", "label", "notice_words").distinct())
    cut = hit.alias("x").join(spans.alias("y"), match).select(
        "x.doc_id", "x.key", "notice", F.slice("words", F.col("lo") + 1, F.col("hi") - F.col("lo") + K).alias("span"))
    there = F.size(F.array_intersect("span", "notice_words")) / F.size(F.array_distinct("notice_words"))
    verified = (cut.join(wording, "notice").withColumn("share", there).where(F.col("share") >= MIN_WORDS)
                .groupBy("doc_id", "key").agg(F.collect_set("label").alias("found"), F.max("share").alias("share")))

    places = F.concat(*[_places(F.col("words"), phrase, label) for phrase, label in PHRASES])
    base = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), places.alias("places")).select(
        "doc_id", "key", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        F.array_sort(F.array_distinct("places.label")).alias("marks"))
    out = base.alias("x").join(materialize(verified, "license-found").alias("y"), match, "left")
    labels = F.array_sort(F.array_union("marks", F.coalesce("found", F.array().cast("array<string>"))))
    score = F.greatest(F.coalesce("share", F.lit(0.0)), F.when(F.col("n_base") > 0, BASE_SCORE).otherwise(0.0))
    return out.select("x.doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("marks", ",").alias("base_labels"),
                      F.array_join(labels, ",").alias("labels"), F.least(score, F.lit(1.0)).alias("score"))
