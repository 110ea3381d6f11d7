"""Section transforms: clean (T1-T5) and normalise.

Each clean step is one ``withColumns`` (a single Project after Catalyst);
each normalise step adds one shuffle for its dedup window.  Extra input
columns pass through untouched.  Keys include ``profile_id`` when the frame
has it (many profiles in one table).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import parse_date, swap_dates
from ..functions.numbers import to_bool, to_double, to_int_or_zero
from ..functions.text import clean_text, fill_blank_id, normalize_name
from ..schemas import NATURAL_KEYS
from .dedup import dedup_keep, latest_per_key
from .lookup import canonicalize


def _texts(df: DataFrame, cols: tuple[str, ...]) -> dict[str, Column]:
    return {c: clean_text(c) for c in cols if c in df.columns}


def clean_experience(df: DataFrame, date_formats=None) -> DataFrame:
    """T1."""
    m = _texts(df, ("id", "title", "location", "description"))
    m.update({"company_name": normalize_name("company_name"),
              "start_date": parse_date("start_date", date_formats),
              "end_date": parse_date("end_date", date_formats),
              "is_current": to_bool("is_current")})
    return df.withColumns(m)


def clean_education(df: DataFrame, date_formats=None) -> DataFrame:
    """T2."""
    m = _texts(df, ("id", "degree", "field_of_study"))
    m.update({"school_name": normalize_name("school_name"),
              "start_date": parse_date("start_date", date_formats),
              "end_date": parse_date("end_date", date_formats),
              "grade": to_double("grade")})
    return df.withColumns(m)


def clean_skills(df: DataFrame) -> DataFrame:
    """T3."""
    m = _texts(df, ("id", "skill_name"))
    m["endorsement_count"] = to_int_or_zero("endorsement_count")
    return df.withColumns(m)


def clean_certifications(df: DataFrame, date_formats=None) -> DataFrame:
    """T4."""
    m = _texts(df, ("id", "cert_name", "credential_id"))
    m.update({"authority": normalize_name("authority"),
              "issued_date": parse_date("issued_date", date_formats),
              "expiry_date": parse_date("expiry_date", date_formats)})
    return df.withColumns(m)


def clean_summary(df: DataFrame, date_formats=None) -> DataFrame:
    """T5."""
    m = _texts(df, ("id", "text"))
    m["last_updated"] = parse_date("last_updated", date_formats)
    return df.withColumns(m)


def clean_recommendations(df: DataFrame, date_formats=None) -> DataFrame:
    """Texts stripped, the day parsed; a person's name is not an employer's, so it keeps its case and suffix."""
    m = _texts(df, ("id", "recommender_name", "recommender_title", "relationship", "recommendation_text"))
    m["recommendation_date"] = parse_date("recommendation_date", date_formats)
    return df.withColumns(m)


def _keys(df: DataFrame, key: str) -> list[str]:
    return (["profile_id"] if "profile_id" in df.columns and key != "profile_id" else []) + [key]


def with_ids(df: DataFrame, section: str) -> DataFrame:
    """K1 before dedup: blank ids become the natural-key hash so id-less rows stay apart."""
    if "id" not in df.columns:
        df = df.withColumn("id", F.lit(None).cast("string"))
    cols = [c for c in NATURAL_KEYS[section] if c in df.columns]
    return df.withColumn("id", fill_blank_id("id", *cols))


def normalize_experience(df: DataFrame, order: list | None = None) -> DataFrame:
    """One row per id (first in ``order``, default scraped_at/start), then E16."""
    order = order or [c for c in ("scraped_at", "start_date") if c in df.columns]
    return swap_dates(dedup_keep(df, _keys(df, "id"), order), "start_date", "end_date")


def normalize_education(df: DataFrame, order: list | None = None) -> DataFrame:
    """T7."""
    order = order or [c for c in ("scraped_at", "start_date") if c in df.columns]
    return swap_dates(dedup_keep(df, _keys(df, "id"), order), "start_date", "end_date")


def normalize_skills(df: DataFrame, lookup: DataFrame | None = None) -> DataFrame:
    """Canonical names (J1), then one row per skill name.

    The first row wins, with skills ordered by endorsements (high first)
    then id - not the maximum of the duplicates, as in the reference.
    """
    out = canonicalize(df, "skill_name", lookup)
    return dedup_keep(out, _keys(out, "skill_name"), [F.col("endorsement_count").desc_nulls_last(), "id"])


def normalize_certifications(df: DataFrame, order: list | None = None) -> DataFrame:
    """T9."""
    order = order or [c for c in ("scraped_at", "issued_date") if c in df.columns]
    return swap_dates(dedup_keep(df, _keys(df, "id"), order), "issued_date", "expiry_date")


def normalize_summary(df: DataFrame) -> DataFrame:
    """Newest row per id (by last_updated when present)."""
    if "last_updated" in df.columns:
        return latest_per_key(df, _keys(df, "id"), "last_updated")
    return dedup_keep(df, _keys(df, "id"), [])


def normalize_recommendations(df: DataFrame, order: list | None = None) -> DataFrame:
    """One row per id (the last in ``order``, default scraped_at; ties by the other columns)."""
    order = order or [c for c in ("scraped_at",) if c in df.columns]
    return dedup_keep(df, _keys(df, "id"), order, keep="last")


CLEANERS = {
    "experience": clean_experience,
    "education": clean_education,
    "skills": clean_skills,
    "certifications": clean_certifications,
    "summary": clean_summary,
    "recommendations": clean_recommendations,
}
NORMALIZERS = {
    "experience": normalize_experience,
    "education": normalize_education,
    "skills": normalize_skills,
    "certifications": normalize_certifications,
    "summary": normalize_summary,
    "recommendations": normalize_recommendations,
}


def prepare_section(df: DataFrame, section: str) -> DataFrame:
    """clean -> natural ids -> normalise, as one lazy plan.

    Skills get their canonical name before the id: the id is a hash of it.
    """
    out = CLEANERS[section](df)
    if section == "skills":
        out = canonicalize(out, "skill_name")
    out = with_ids(out, section)
    return NORMALIZERS[section](out)
