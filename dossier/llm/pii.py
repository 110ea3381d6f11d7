"""Personal data: regular expressions propose spans, checksums confirm them, context words adjust their score.

DataFrame operations only.  A pattern's matches come from ``regexp_extract_all`` and the text between them
from ``split`` by the same pattern, so a match starts after all pieces before it; lengths are code points.
A span's context is the end of the text between it and the match of its kind before it: no span walks through the
text again, and ``redact`` takes its pieces from blocks of the text, for the same reason.
Patterns are possessive or guarded by a lookbehind where a plain form would read a long run again from each
of its characters, and use no repeated group that Java matches by recursion: time is linear in the text.

Kinds: email, ip (parts at most 255), card (Luhn), phone (9 to 15 digits), iban (mod-97).

Edge cases: null and empty texts have no spans; repeated rows are treated row by row; other columns are kept, whatever
their names, but for one of the name of the result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_BYTE = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    needs: str  # a pattern that every text with a match satisfies, cheaper to search
    score: float
    context: str  # words before the span that raise its score


#: In the order in which spans of equal start are listed.
KINDS = (
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9,
         "mail|contact|write|reach"),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", 0.6, r"\bip\b|address|host|server|login"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9][ -]?[0-9]", 0.7, "card|visa|master|credit|debit|pay"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.6, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         "[A-Z]{2}[0-9]{2}", 0.9, r"iban|account|bank"),
)
BASE = ("email", "ip", "card", "phone")
CONTEXT_CHARS, CONTEXT_GAIN = 40, 0.3


def _mod97(found: Column) -> Column:
    plain = F.regexp_replace(found, " ", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.substring(plain, 1, 4))
    digit = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)  # noqa: E731 - A is 10 ... Z is 35
    return F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).otherwise(
        (a * F.when(c >= "A", 100).otherwise(10) + digit(c)) % 97)) == 1


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return found.rlike(rf"^{_BYTE}(?:\.{_BYTE}){{3}}$")
    if kind == "card":
        digits = F.regexp_replace(found, "[ -]", "")
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(F.regexp_replace(found, "[^0-9]", "")).between(9, 15)
    if kind == "iban":
        return _mod97(found)
    return F.lit(True)


_CHUNK = 256
#: Code points of a block of text.
_BLOCK = 1024


def _with_starts(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the start of each match: sums over the pieces before it, in chunks so that many matches stay
    cheap.  Each array that a lambda reads is a column of its own, so that it is computed once per row."""
    found, between, lengths, chunks, before = (F.col(f"_{p}_{name}") for p in "fblcp")
    add = lambda a, x: a + x
    some = F.size(found) > 0
    df = df.withColumn(f"_l_{name}", F.when(some, F.zip_with(between, found, lambda b, f: F.length(b) + F.coalesce(F.length(f), F.lit(0)))))
    df = df.withColumn(f"_c_{name}", F.when(some, F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _CHUNK).cast("int")),
        lambda j: F.aggregate(F.slice(lengths, j * _CHUNK + 1, _CHUNK), F.lit(0), add))))
    df = df.withColumn(f"_p_{name}", F.when(some, F.transform(chunks, lambda _, j: F.when(
        F.size(chunks) > 1, F.aggregate(F.slice(chunks, F.lit(1), j), F.lit(0), add)).otherwise(0))))

    def start(f, i):
        j = F.floor(i / _CHUNK).cast("int")
        earlier = F.when(F.size(before) > 1, F.element_at(before, j + 1)).otherwise(0)
        return earlier + F.aggregate(F.slice(lengths, j * _CHUNK + 1, i - j * _CHUNK), F.lit(0), add) + F.length(F.element_at(between, i + 1))

    return df.withColumn(f"_s_{name}", F.when(some, F.transform(found, start)).otherwise(F.array().cast("array<int>")))


SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def _confirmed(k: Kind, starts: Column, found: Column, between: Column) -> Column:
    """The spans of one kind that pass its check, with scores."""

    def span(z):
        near = F.lower(F.right(z["b"], F.lit(CONTEXT_CHARS)))
        gain = F.when(near.rlike(k.context), CONTEXT_GAIN).otherwise(0.0)
        return F.struct(z["s"].alias("start"), F.lit(KINDS.index(k)).alias("rank"), (z["s"] + F.length(z["f"])).alias("end"),
                        F.lit(k.name).alias("kind"), F.least(F.lit(1.0), F.lit(k.score) + gain).alias("score"))

    pieces = F.slice(between, F.lit(1), F.size(found))
    matches = F.filter(F.arrays_zip(starts.alias("s"), found.alias("f"), pieces.alias("b")), lambda z: _valid(k.name, z["f"]))
    return F.transform(matches, span)


def _find(rows: DataFrame) -> DataFrame:
    """``rows`` (row, text) with ``spans``."""
    body = F.coalesce(F.col("text"), F.lit(""))
    df = rows
    none = F.array().cast("array<string>")
    for k in KINDS:
        df = df.withColumn(f"_f_{k.name}", F.when(body.rlike(k.needs), F.regexp_extract_all(body, F.lit(k.pattern), 0)).otherwise(none))
    for k in KINDS:
        found, starts, between = F.col(f"_f_{k.name}"), F.col(f"_s_{k.name}"), F.col(f"_b_{k.name}")
        df = df.withColumn(f"_b_{k.name}", F.when(F.size(found) > 0, F.split(body, k.pattern, -1)).otherwise(none))
        df = _with_starts(df, k.name)
        df = df.withColumn(f"_s_{k.name}", F.when(F.size(found) > 0, _confirmed(k, starts, found, between)).otherwise(F.array().cast(SPAN)))
    df = df.withColumn("spans", F.array_sort(F.concat(*[F.col(f"_s_{k.name}") for k in KINDS])))
    return df.select("row", "text", "spans")


def _apart(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` as (row, text): the row travels in one column, so no name of its own can meet one of the operator's."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))


def with_spans(docs: DataFrame, text: str = "text", out: str = "spans") -> DataFrame:
    """``docs`` with an array of (start, rank, end, kind, score), sorted by start and rank (the kind's place in ``KINDS``)."""
    return _find(_apart(docs, text)).select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c != out], F.col("spans").alias(out))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scores(spans: Column) -> Column:
    """The score of each span in hundredths, comma-joined in the order of ``listed``."""
    return F.array_join(F.transform(spans, lambda s: F.round(s["score"] * 100).cast("int").cast("string")), ",")


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span of personal data in ``text`` replaced by its kind in brackets, ``n_chars`` kept in
    step where the column exists.  Overlapping spans become one, named by the first."""
    df = _find(_apart(docs, text))
    some, last = F.size("spans") > 0, F.size("spans") - 1
    # each array that a lambda reads is a column of its own and is read more than once, so it is computed once per row
    df = df.withColumn("ends", F.when(some, F.transform("spans", lambda s: s["end"])))
    df = df.withColumn("tops", F.when(some & (F.size("ends") > 0), F.transform(
        F.sequence(F.lit(0), F.floor(last / _CHUNK).cast("int")), lambda j: F.array_max(F.slice("ends", j * _CHUNK + 1, _CHUNK)))))
    df = df.withColumn("before", F.when(F.size("tops") > 0, F.transform(
        "tops", lambda _, j: F.coalesce(F.array_max(F.slice("tops", F.lit(1), j)), F.lit(0)))))

    def open_at(s, i):  # the end of what all earlier spans cover
        j = F.floor(i / _CHUNK).cast("int")
        here = F.coalesce(F.array_max(F.slice("ends", j * _CHUNK + 1, i - j * _CHUNK)), F.lit(0))
        return F.struct(F.greatest(F.when(F.size("before") > 0, F.element_at("before", j + 1)).otherwise(0), here).alias("at"),
                        s["start"].alias("start"), s["kind"].alias("kind"))

    df = df.withColumn("gaps", F.when(some, F.transform("spans", open_at)))
    df = df.withColumn("blocks", F.when(some, F.regexp_extract_all("text", F.lit(f"(?s).{{1,{_BLOCK}}}"), F.lit(0))))

    def piece(start, end):
        first = F.floor(start / _BLOCK).cast("int")
        held = F.array_join(F.slice("blocks", first + 1, F.floor(end / _BLOCK).cast("int") - first + 1), "")
        return F.substr(held, start - first * _BLOCK + 1, end - start)

    parts = F.transform("gaps", lambda g: F.when(g["start"] >= g["at"], F.concat(
        piece(g["at"], g["start"]), F.lit("["), F.upper(g["kind"]), F.lit("]"))).otherwise(""))
    clean = F.concat(F.array_join(parts, ""), piece(F.array_max("ends"), F.length("text")))
    out = df.withColumn("clean", F.when(some & (F.size("blocks") > 0), clean).otherwise(F.coalesce("text", F.lit(""))))
    kept = {text: F.col("clean")}
    if "n_chars" in docs.columns:
        kept["n_chars"] = F.when(some, F.length("clean").cast("long")).otherwise(F.col("row.n_chars"))
    return out.select(*[kept.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
