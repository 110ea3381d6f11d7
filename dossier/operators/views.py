"""Serving views of the keyed sections: ordered reads plus the derived label columns.

Presentation (HTML, SVG) is out of scope; these are the columns it is built from.
Alternative column names written by older rows (``company`` / ``company_name`` ...)
are resolved with E13.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.dates import cert_status, date_range_label, tenure_months, year_range_label
from ..functions.numbers import to_int_or_zero
from ..functions.text import classify_vendor, coalesce_alias, degree_line
from ..schemas import SERVE_ORDER, validate_section
from ..sources.store import filter_eq, section_order, with_years
from .metrics import share_of_max


def section_view(df: DataFrame, section: str, as_of: str | None = None, top: int = 10, profile_id: str | None = None) -> DataFrame:
    """Labelled rows of one section as the profile page shows them: those of ``profile_id`` in order, or those of all
    profiles with their ``position`` within each."""
    validate_section(section)
    if profile_id is not None:
        df = filter_eq(df, {"profile_id": profile_id})
    by = ["profile_id"] if profile_id is None and "profile_id" in df.columns else None
    if section == "experience":
        out = df.withColumns({
            "company": coalesce_alias(df, ["company", "company_name"]),
            "date_range": date_range_label("start_date", "end_date",
                                           "is_current" if "is_current" in df.columns else None)})
        if as_of:
            out = out.withColumn("tenure_months", tenure_months("start_date", "end_date", as_of))
    elif section == "education":
        out = with_years(df)
        out = out.withColumns({
            "school": coalesce_alias(out, ["school", "school_name", "institution"]),
            "years": year_range_label("start_year", "end_year"),
            "degree_line": degree_line(coalesce_alias(out, ["degree"]), coalesce_alias(out, ["field_of_study", "field"]))})
    elif section == "certifications":
        name = coalesce_alias(df, ["name", "cert_name"])
        issuer = coalesce_alias(df, ["issuer", "authority"])
        out = df.withColumns({"name": name, "issuer": issuer, "vendor": classify_vendor(issuer, name),
                              "issued": coalesce_alias(df, ["issued_date", "issue_date"])})
        if as_of and "expiry_date" in df.columns:
            out = out.withColumn("status", cert_status("expiry_date", as_of))
    elif section == "skills":
        base = df.withColumns({"name": coalesce_alias(df, ["name", "skill_name"]),
                               "endorsements": to_int_or_zero(coalesce_alias(df, ["endorsements", "endorsement_count"]))})
        tie = ["name", *(c for c in ("id",) if c in base.columns)]  # a total order within a profile: no arbitrary cut
        return share_of_max(base, "endorsements", k=top, tie=tie, by=by)
    else:
        out = df
    if section in SERVE_ORDER and SERVE_ORDER[section] in out.columns:
        out = section_order(out, section, by=by)
    return out
