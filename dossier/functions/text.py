"""Text rules as Column -> Column functions (all JVM-side, no UDFs)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
# Legal-suffix pattern removed from names after title-casing (case-sensitive
# by default, anchored at the end, one suffix only):
LEGAL_SUFFIX_PATTERN = (
    r",?\s*\b(?:Inc\.?|LLC\.?|Ltd\.?|L\.L\.C\.?|Corp\.?|Co\.?|PLC\.?|GmbH\.?|S\.A\.?|B\.V\.?)\.?$"
)
# The keywords of certificate issuers, checked in this order against issuer and name; the first hit wins.
VENDOR_KEYWORDS = (("amazon", "Amazon"), ("aws", "Amazon"), ("google", "Google"), ("microsoft", "Microsoft"), ("dbt", "dbt Labs"),
                   ("databricks", "Databricks"), ("snowflake", "Snowflake"))
VENDOR_DEFAULT = "other"
# ---------------------------------------------------------------------------

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` only strips spaces)."""
    return F.regexp_replace(_c(c), _EDGE_SPACE, "")


def clean_text(c: Column | str) -> Column:
    """Null -> '', text form, whitespace stripped."""
    return strip(F.coalesce(_c(c).cast("string"), F.lit("")))


def title_case(c: Column | str) -> Column:
    """Capital after every non-letter, the rest lower (Python ``str.title``).

    ``initcap`` only capitalises after spaces, so 'obscure-tool' would stay
    'Obscure-tool'.  We split into letter / non-letter runs and capitalise the
    first character of each run (a no-op for non-letter runs).
    """
    runs = F.regexp_extract_all(F.lower(_c(c)), F.lit(r"(\p{L}+|\P{L}+)"), 1)
    cap = F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1 << 30)))
    return F.when(_c(c).isNull(), F.lit(None).cast("string")).otherwise(F.array_join(cap, ""))


def strip_suffix(c: Column | str, ignore_case: bool = False) -> Column:
    """Drop one trailing legal suffix (after title-casing)."""
    flags = "(?U)(?i)" if ignore_case else "(?U)"
    return F.regexp_replace(_c(c), flags + LEGAL_SUFFIX_PATTERN, "")


def normalize_name(c: Column | str, suffix_ignore_case: bool = False) -> Column:
    """Strip, collapse whitespace, title-case, drop one legal suffix, strip."""
    x = strip(F.coalesce(_c(c).cast("string"), F.lit("")))
    x = F.regexp_replace(x, r"(?U)\s+", " ")
    x = title_case(x)
    x = strip_suffix(x, suffix_ignore_case)
    return strip(x)


def digits_to_int(c: Column | str) -> Column:
    """Keep the digits of a caption; none -> null ('3 from 2' -> 32); beyond bigint -> null."""
    d = F.nullif(F.regexp_replace(_c(c), r"[^0-9]", ""), F.lit(""))
    return d.try_cast("bigint")


def split_date_range(c: Column | str, variant: str = "experience") -> Column:
    """E7: 'Jan 2022 – Present · 2 yrs' -> struct(start, end, is_current).

    ``experience`` rules: text before the first non-empty '·' part; split on the
    en dash, else on ' - ', else on a bare hyphen when no ISO date is present;
    'present' (any case) in the end part sets is_current and nulls the end.
    ``education`` parity variant: no '·' handling, no 'present' rule, a blank
    end stays ''.
    """
    raw = F.coalesce(_c(c).cast("string"), F.lit(""))
    if variant == "experience":
        # the first non-blank '·'-separated part: skip leading blank parts, take up to the next '·'
        part = strip(F.regexp_extract(raw, r"(?U)^(?:\s*·)*\s*([^·]*)", 1))
    else:
        part = strip(raw)
    en = part.contains("–")
    spaced = part.contains(" - ")
    bare = part.contains("-") & ~part.rlike(r"\d{4}-\d{1,2}")
    sep = (F.when(en, F.lit("–")).when(spaced, F.lit(" - ")).when(bare, F.lit("-")))
    has_sep = sep.isNotNull()
    start = F.when(has_sep, strip(F.split_part(part, sep, F.lit(1)))).otherwise(F.lit(""))
    end_raw = F.when(has_sep, strip(F.split_part(part, sep, F.lit(2)))).otherwise(F.lit(""))
    if variant == "experience":
        current = F.lower(end_raw).contains("present")
        end = F.when(current | (end_raw == ""), F.lit(None).cast("string")).otherwise(end_raw)
    else:
        current = F.lit(False)
        end = end_raw
    return F.struct(start.alias("start"), end.alias("end"), current.alias("is_current"))


def coalesce_alias(df: DataFrame, names: list[str] | tuple[str, ...]) -> Column:
    """First non-empty value among the alternative columns present in df."""
    present = [n for n in names if n in df.columns]
    vals = [F.nullif(F.col(n).cast("string"), F.lit("")) for n in present]
    return F.coalesce(*vals, F.lit("")) if vals else F.lit("")


def classify_vendor(issuer: Column | str, name: Column | str) -> Column:
    """Ordered keyword match on issuer or name, first hit wins."""
    li = F.lower(F.coalesce(_c(issuer), F.lit("")))
    ln = F.lower(F.coalesce(_c(name), F.lit("")))
    expr = None
    for key, label in VENDOR_KEYWORDS:
        cond = li.contains(key) | ln.contains(key)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(VENDOR_DEFAULT))


def degree_line(degree: Column | str, field: Column | str) -> Column:
    """E15: 'degree, field' or whichever is present (each stripped first)."""
    return F.concat_ws(", ", F.nullif(strip(_c(degree)), F.lit("")), F.nullif(strip(_c(field)), F.lit("")))


_CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]"


def normalize_encoding(c: Column | str) -> Column:
    """Replace invalid UTF-8 and remove control characters (tab, LF, CR stay)."""
    return F.regexp_replace(F.make_valid_utf8(_c(c).cast("binary").cast("string")), _CONTROL, "")


def mask_person(c: Column | str, salt: str | None = None) -> Column:
    """Anonymise a person name: initials ('Ann Lee' -> 'A. L.'), or a salted hash."""
    if salt is not None:
        return F.sha2(F.concat(F.coalesce(_c(c), F.lit("")), F.lit(salt)), 256)
    words = F.filter(F.split(strip(F.coalesce(_c(c), F.lit(""))), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lit("."))), " ")


def session_hash(*parts: Column | str) -> Column:
    """SHA-256 of the '|'-joined parts (e.g. ip, user agent, date salt)."""
    return F.sha2(F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts]), 256)


def natural_key(*cols: Column | str) -> Column:
    """K1: id from a natural key.

    Each part is lower-cased text with null mapped to '\\x00' *before*
    joining, because ``concat_ws`` skips nulls and ('a', null, 'b') would
    collide with ('a', 'b').
    """
    parts = [F.coalesce(F.lower(_c(c).cast("string")), F.lit("\x00")) for c in cols]
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def fill_blank_id(id_col: Column | str, *key_cols: Column | str) -> Column:
    """Keep a non-blank id, else derive it from the natural key."""
    i = _c(id_col)
    return F.when(i.isNull() | (strip(i) == ""), natural_key(*key_cols)).otherwise(i)


def json_field(c: Column | str, path: str) -> Column:
    """One field of a JSON text column as text ('$.k')."""
    return F.get_json_object(_c(c), path)


def json_record(c: Column | str, schema: str, bad: str = "malformed") -> Column:
    """A JSON text column as a struct of typed fields (``schema`` as DDL), nested ones included; text that is not
    JSON of that schema is kept whole in the field ``bad``, which is null for all other rows."""
    return F.from_json(_c(c), f"{schema}, {bad} string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})


def and_all(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
