"""Date rules as Column -> Column functions.

Batch timestamps are TIMESTAMP_NTZ (as the files read).  Never
``try_cast(x as timestamp)``: it accepts fragments such as 'T10'.  Every
parse goes through ``try_to_timestamp`` with an explicit format, and each
format must match the whole value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import _c, strip

DEFAULT_DATE_FORMATS: tuple[str, ...] = (
    "yyyy-MM-dd",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM",
    "MMM yyyy",
    "MMMM yyyy",
    "yyyy",
)


# Times with an offset (``Z`` or ``+hh:mm``) name an instant; they become its UTC time.
_OFFSET_FORMATS = {
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$",
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]XXX": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})$",
}


def _try_offset(txt: Column, f: str, shape: str) -> Column:
    micros = F.unix_micros(F.try_to_timestamp(txt, F.lit(f)))
    return F.when(txt.rlike(shape), F.timestamp_add("MICROSECOND", micros, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")))


# Cheap shape checks for the built-in formats: a failed parse is an exception
# inside the formatter, so only values of the right shape are handed to it.
_SHAPES = {
    "yyyy-MM-dd": r"^\d{4}-\d{2}-\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ss": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd HH:mm:ss": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS": r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}$",
    "yyyy-MM-dd HH:mm:ss.SSSSSS": r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,6}$",
    "yyyy-MM": r"^\d{4}-\d{2}$",
    "MMM yyyy": r"^[A-Za-z]{3} \d{4}$",
    "MMMM yyyy": r"^[A-Za-z]{3,9} \d{4}$",
    "yyyy": r"^\d{4}$",
}


def _try_format(txt: Column, f: str) -> Column:
    parsed = F.try_to_timestamp(txt, F.lit(f))
    shape = _SHAPES.get(f)
    return F.when(txt.rlike(shape), parsed) if shape else parsed


def parse_date(c: Column | str, formats: tuple[str, ...] | list[str] | str | None = None,
               utc_from: str | None = None) -> Column:
    """Text -> TIMESTAMP_NTZ; every value is tried against every format, bad -> null.

    Times with an offset become their UTC time (unless ``formats`` says what to try).
    ``utc_from`` names a source zone to convert from (pandas ``utc=True``).
    """
    offsets = _OFFSET_FORMATS if formats is None else {}
    if formats is None:
        formats = DEFAULT_DATE_FORMATS
    elif isinstance(formats, str):
        formats = (formats,)
    txt = strip(_c(c).cast("string"))
    parsed = F.coalesce(*[_try_format(txt, f) for f in formats])
    if utc_from:
        parsed = F.to_utc_timestamp(parsed, utc_from)
    return F.coalesce(parsed.cast("timestamp_ntz"), *[_try_offset(txt, f, shape) for f, shape in offsets.items()])


def extract_year(c: Column | str, formats=None) -> Column:
    """Year as text, '' when the value does not parse."""
    return F.coalesce(F.year(parse_date(c, formats)).cast("string"), F.lit(""))


def month_label(c: Column | str) -> Column:
    """First 7 characters read as a date -> 'Mon YYYY'; null -> ''; else raw text."""
    head = F.substring(_c(c).cast("string"), 1, 7)
    ts = F.coalesce(_try_format(head, "yyyy-MM"), _try_format(head, "yyyy"))
    return F.when(_c(c).isNull(), F.lit("")).otherwise(F.coalesce(F.date_format(ts, "MMM yyyy"), head))


def date_range_label(start: Column | str, end: Column | str, is_current: Column | str | None = None) -> Column:
    """E11: 'start – end' with 'Present' for a current role; no start -> end only."""
    s = month_label(start)
    cur = F.coalesce(_c(is_current), F.lit(False)) if is_current is not None else F.lit(False)
    e = F.when(cur, F.lit("Present")).otherwise(month_label(end))
    return F.when(s != "", F.concat(s, F.lit(" – "), e)).otherwise(e)


def date_range_label_plain(start: Column | str, end: Column | str) -> Column:
    """E11 component variant: blank end -> 'Present', no formatting."""
    s = F.coalesce(_c(start).cast("string"), F.lit(""))
    e = F.coalesce(_c(end).cast("string"), F.lit(""))
    return F.concat(s, F.lit(" – "), F.when(strip(e) == "", F.lit("Present")).otherwise(e))


def year_range_label(start_year: Column | str, end_year: Column | str) -> Column:
    """E12: 's – e' with dangling spaces/dashes stripped; both blank -> ''."""
    s = F.coalesce(_c(start_year).cast("string"), F.lit(""))
    e = F.coalesce(_c(end_year).cast("string"), F.lit(""))
    joined = F.regexp_replace(F.concat(s, F.lit(" – "), e), r"^[ –]+|[ –]+$", "")
    return F.when((s == "") & (e == ""), F.lit("")).otherwise(joined)


def year_range_label_open(start_year: Column | str, end_year: Column | str) -> Column:
    """E12 component variant: start only -> 's – Present'."""
    s = F.coalesce(_c(start_year).cast("string"), F.lit(""))
    e = F.coalesce(_c(end_year).cast("string"), F.lit(""))
    return (F.when((s != "") & (e != ""), F.concat(s, F.lit(" – "), e))
            .when(s != "", F.concat(s, F.lit(" – Present")))
            .otherwise(e))


def swap_dates(df: DataFrame, start: str = "start_date", end: str = "end_date") -> DataFrame:
    """Swap start and end where both are set and start > end."""
    s, e = F.col(start), F.col(end)
    inverted = s.isNotNull() & e.isNotNull() & (s > e)
    return df.withColumns({start: F.when(inverted, e).otherwise(s),
                           end: F.when(inverted, s).otherwise(e)})


def tenure_months(start: Column | str, end: Column | str, as_of: str) -> Column:
    """Whole months from start to coalesce(end, as_of).

    (y2 - y1) * 12 + (m2 - m1), minus one when the end day-of-month is
    before the start day-of-month.  Null start -> null.
    """
    s = _c(start)
    e = F.coalesce(_c(end), F.lit(as_of).cast("timestamp_ntz"))
    m = (F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))
    return (m - F.when(F.dayofmonth(e) < F.dayofmonth(s), 1).otherwise(0)).cast("int")


def cert_status(expiry: Column | str, as_of: str) -> Column:
    """E18: 'active' when expiry is null (never expires) or on/after as_of, else 'expired'."""
    x = _c(expiry)
    return F.when(x.isNull() | (x >= F.lit(as_of).cast("timestamp_ntz")), F.lit("active")).otherwise(F.lit("expired"))
