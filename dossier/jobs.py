"""Spark jobs: raw profile pages, or nested JSON responses -> keyed section tables -> run report.

    python -m dossier.jobs --pages <parquet of (page_id, html)> --store <root> --run-ts "2024-06-01 00:00:00"
    python -m dossier.jobs --responses <parquet of (profile_id, kind, body)> --store <root> --run-ts "2024-06-01 00:00:00"

Steps: S3 header and S4 section items from the pages, E7/E8 on the captions,
S5 stamp, S1 conform, T1-T5 clean, K1 ids, T6-T10 normalise, S6 upsert into the
store, S11 report.  Class names of the fields are parameters.  Responses are
flattened by S2 and then take the same steps from S5 on.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import digits_to_int, split_date_range
from .operators.transform import prepare_section
from .schemas import RAW
from .session import materialize
from .sources import extract as XT
from .sources import store as ST

# column -> css class of the element holding it, per page section
SECTION_FIELDS = {
    "experience": {"title": "title", "company_name": "subtitle", "location": "location",
                   "description": "description", "caption": "caption"},
    "education": {"school_name": "title", "degree": "subtitle", "field_of_study": "detail", "caption": "caption"},
    "skills": {"skill_name": "title", "caption": "caption"},
    "certifications": {"cert_name": "title", "authority": "subtitle", "issued_date": "caption"},
}


#: Checked responses in a file, so that parsing them spreads over tasks however the input was cut.
ROWS_PER_FILE = 50_000


def section_rows(pages: DataFrame, section: str, fields: dict[str, str] | None = None) -> DataFrame:
    """Raw rows of one section (RAW contract columns, still text)."""
    items = XT.section_items(pages, section, fields or SECTION_FIELDS[section])
    if section == "experience":
        r = split_date_range("caption")
        items = items.withColumns({"start_date": r.start, "end_date": r.end, "is_current": r.is_current})
    elif section == "education":
        r = split_date_range("caption")
        items = items.withColumns({"start_date": r.start, "end_date": r.end})
    elif section == "skills":
        items = ST.drop_unnamed(items, "skill_name").withColumn(
            "endorsement_count", digits_to_int("caption").cast("string"))
    elif section == "certifications":
        items = ST.drop_unnamed(items, "cert_name")
    return items.withColumn("profile_id", F.col("profile_id").cast("string"))


def build_sections(spark: SparkSession, pages: DataFrame, store_root: str, run_ts: str) -> DataFrame:
    store = ST.SectionStore(spark, store_root)
    store.create_sections()
    header = ST.stamp_batch(XT.extract_header(pages).withColumn("profile_id", F.col("profile_id").cast("string")),
                            run_ts)
    store.upsert("profile", header)
    for section in SECTION_FIELDS:
        raw = ST.stamp_batch(section_rows(pages, section), run_ts)
        raw = ST.conform(raw.withColumn("scraped_at", F.col("scraped_at").cast("string")), RAW[section])
        store.upsert(section, prepare_section(raw, section))
    sections = sorted(ST.STORED)
    return ST.run_report({s: store.keys(s) for s in sections}, sections)


def response_sections(responses: DataFrame, id_col: str = "profile_id", kind_col: str = "kind",
                      json_col: str = "body") -> tuple[dict[str, DataFrame], DataFrame]:
    """S2 for a table of responses: raw rows of each section, and the responses that give none.

    ``kind`` is profile, skills, certifications or recommendations.  A response of another kind, or whose body is null
    or no JSON, is returned apart with its ``problem`` and never reaches a section.  Entries without a name are
    dropped (F2); of recommendations those received are a profile's own.  Bodies are checked once, in a pass that
    writes the responses with their problem; each section reads only its kind's rows of these.
    """
    known = F.col(kind_col).isin("profile", "skills", "certifications", "recommendations")
    problem = (F.when(~F.coalesce(known, F.lit(False)), "unknown kind").when(F.col(json_col).isNull(), "no body")
               .when(F.try_parse_json(json_col).isNull(), "malformed"))
    checked = materialize(responses.withColumn("problem", problem), "responses-checked", ROWS_PER_FILE)
    apart = checked.where("problem is not null")

    def of(kind: str) -> DataFrame:
        return checked.where((F.col(kind_col) == kind) & F.col("problem").isNull()).withColumn(
            id_col, F.col(id_col).cast("string"))

    flat = XT.flatten_profile(of("profile"), id_col, json_col)
    recommended = XT.flatten_recommendations(of("recommendations"), id_col, json_col)
    rows = {
        "profile": flat["profile"], "experience": flat["experience"], "education": flat["education"],
        "skills": ST.drop_unnamed(XT.flatten_skills(of("skills"), id_col, json_col), "skill_name"),
        "certifications": ST.drop_unnamed(XT.flatten_certifications(of("certifications"), id_col, json_col), "cert_name"),
        "summary": ST.drop_unnamed(flat["profile"].select("profile_id", F.col("summary").alias("text")), "text"),
        "recommendations": ST.drop_unnamed(recommended.where("direction = 'received'"), "recommender_name"),
    }
    return rows, apart


def load_responses(spark: SparkSession, responses: DataFrame, store_root: str, run_ts: str) -> DataFrame:
    """Responses into the section store; the report has one more row, ``apart``, for those that gave no section."""
    store = ST.SectionStore(spark, store_root)
    store.create_sections()
    rows, apart = response_sections(responses)
    for section, flat in rows.items():
        raw = ST.stamp_batch(flat, run_ts)
        if section == "profile":
            store.upsert(section, raw)
            continue
        if section == "summary":
            raw = raw.withColumn("last_updated", F.col("scraped_at"))
        store.upsert(section, prepare_section(ST.conform(raw, RAW[section]), section))
    sections = sorted(ST.STORED)
    return ST.run_report({**{s: store.keys(s) for s in sections}, "apart": apart}, [*sections, "apart"])


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = ap.add_mutually_exclusive_group(required=True)
    source.add_argument("--pages")
    source.add_argument("--responses")
    ap.add_argument("--store", required=True)
    ap.add_argument("--run-ts", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("dossier-build-sections").getOrCreate()
    run = build_sections if a.pages else load_responses
    run(spark, spark.read.parquet(a.pages or a.responses), a.store, a.run_ts).show(truncate=False)


if __name__ == "__main__":
    main()
