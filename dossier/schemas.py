"""Section contracts: StructTypes, the section allowlist and natural keys.

Two contracts per section: ``RAW`` is what extraction yields (dates and
numbers still text) and ``STORED`` is the typed keyed table.  Every keyed
table carries ``profile_id`` so the same operators serve many profiles.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
TS = T.TimestampNTZType()


def _st(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW: dict[str, T.StructType] = {
    "profile": _st(("profile_id", S), ("full_name", S), ("headline", S), ("summary", S),
                   ("location", S), ("industry", S), ("profile_picture_url", S),
                   ("connection_count", T.LongType()), ("scraped_at", S)),
    "experience": _st(("id", S), ("profile_id", S), ("company_name", S), ("company_url", S),
                      ("company_logo_url", S), ("title", S), ("employment_type", S), ("location", S),
                      ("start_date", S), ("end_date", S), ("is_current", T.BooleanType()),
                      ("description", S), ("scraped_at", S)),
    "education": _st(("id", S), ("profile_id", S), ("school_name", S), ("school_url", S),
                     ("degree", S), ("field_of_study", S), ("start_date", S), ("end_date", S),
                     ("grade", S), ("activities", S), ("description", S), ("scraped_at", S)),
    "skills": _st(("id", S), ("profile_id", S), ("skill_name", S), ("endorsement_count", S),
                  ("scraped_at", S)),
    "certifications": _st(("id", S), ("profile_id", S), ("cert_name", S), ("authority", S),
                          ("issued_date", S), ("expiry_date", S), ("credential_id", S),
                          ("credential_url", S), ("scraped_at", S)),
    "summary": _st(("id", S), ("profile_id", S), ("text", S), ("last_updated", S)),
    "recommendations": _st(("id", S), ("profile_id", S), ("recommender_name", S),
                           ("recommender_title", S), ("relationship", S),
                           ("recommendation_text", S), ("recommendation_date", S), ("scraped_at", S)),
}

STORED: dict[str, T.StructType] = {
    "profile": _st(("profile_id", S), ("full_name", S), ("headline", S), ("summary", S),
                   ("location", S), ("industry", S), ("profile_picture_url", S),
                   ("connection_count", T.IntegerType()), ("scraped_at", TS)),
    "experience": _st(("id", S), ("profile_id", S), ("company_name", S), ("title", S), ("location", S),
                      ("start_date", TS), ("end_date", TS), ("description", S),
                      ("is_current", T.BooleanType())),
    "education": _st(("id", S), ("profile_id", S), ("school_name", S), ("degree", S),
                     ("field_of_study", S), ("start_date", TS), ("end_date", TS),
                     ("grade", T.DoubleType())),
    "skills": _st(("id", S), ("profile_id", S), ("skill_name", S),
                  ("endorsement_count", T.IntegerType())),
    "certifications": _st(("id", S), ("profile_id", S), ("cert_name", S), ("authority", S),
                          ("issued_date", TS), ("expiry_date", TS), ("credential_id", S)),
    "summary": _st(("id", S), ("profile_id", S), ("text", S), ("last_updated", TS)),
    "recommendations": _st(("id", S), ("profile_id", S), ("recommender_name", S),
                           ("recommender_title", S), ("relationship", S),
                           ("recommendation_text", S), ("recommendation_date", TS)),
}

SECTIONS: frozenset[str] = frozenset(STORED)

# Natural key per section (id = hash of these, see functions.text.natural_key).
NATURAL_KEYS: dict[str, tuple[str, ...]] = {
    "profile": ("profile_id",),
    "experience": ("profile_id", "company_name", "title", "start_date"),
    "education": ("profile_id", "school_name", "degree"),
    "skills": ("profile_id", "skill_name"),
    "certifications": ("profile_id", "cert_name", "authority", "issued_date"),
    "summary": ("profile_id",),
    "recommendations": ("profile_id", "recommender_name", "recommendation_date"),
}

# Column used to order a section when it is served (newest first).
SERVE_ORDER: dict[str, str] = {
    "experience": "start_date",
    "education": "end_date",
    "skills": "endorsement_count",
    "certifications": "issued_date",
}


def validate_section(section: str) -> str:
    """Raise ValueError for an unknown section, listing the valid ones."""
    if section not in SECTIONS:
        raise ValueError(f"unknown section {section!r}; known: {', '.join(sorted(SECTIONS))}")
    return section
