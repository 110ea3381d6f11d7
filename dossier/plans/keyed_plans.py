"""Keyed-table queries: dedup (W1, W2), section transforms (T1-T10), store ops (S1, S5-S11, U1, J2),
filters (F1-F3), ordered reads (O1-O4), A1-A3, A11, Q3, Q4."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import DEFAULT_DATE_FORMATS
from ..functions.numbers import NUMBER_RE
from ..operators import transform as TR
from ..operators.dedup import dedup_keep, latest_per_key
from ..operators.lookup import canonicalize
from ..operators.metrics import count_rows, missing_report, positive_only, scale_to_width, share_of_max, sort_asc, top_k
from ..operators.quality import check_key, schema_drift
from ..session import scratch_path
from ..sources import store as ST
from .base import register, sql_on_tables, table
from .text_plans import CANON_SQL, RAW_SKILL_SQL, _values_sql, raw_skills, sql_normalize_name, sql_strip, sql_title

# ----------------------------------------------------------------- dialect helpers for raw frames
_FMT = {"ymd": ("yyyy-MM-dd", "%Y-%m-%d"), "mony": ("MMM yyyy", "%b %Y"), "ym": ("yyyy-MM", "%Y-%m"),
        "y": ("yyyy", "%Y")}


def fmt(expr: str, kind: str, dialect: str) -> str:
    spark_f, duck_f = _FMT[kind]
    return f"date_format({expr}, '{spark_f}')" if dialect == "spark" else f"strftime({expr}, '{duck_f}')"


def date_text(day_expr: str, key: str, dialect: str) -> str:
    """A date written in one of several formats (or junk) chosen by the key."""
    return (f"CASE CAST({key} % 5 AS INT) WHEN 0 THEN {fmt(day_expr, 'ymd', dialect)} "
            f"WHEN 1 THEN {fmt(day_expr, 'mony', dialect)} WHEN 2 THEN {fmt(day_expr, 'ym', dialect)} "
            f"WHEN 3 THEN concat(' ', {fmt(day_expr, 'ymd', dialect)}, ' ') ELSE 'not-a-date' END")


# DuckDB forms of the column rules used by the section oracles
def d_clean(x: str) -> str:
    return rf"regexp_replace(coalesce(CAST({x} AS VARCHAR), ''), '^\s+|\s+$', '', 'g')"


_DUCK_FORMATS = {"yyyy-MM-dd": "%Y-%m-%d", "yyyy-MM-dd'T'HH:mm:ss": "%Y-%m-%dT%H:%M:%S",
                 "yyyy-MM-dd HH:mm:ss": "%Y-%m-%d %H:%M:%S", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS": "%Y-%m-%dT%H:%M:%S.%f",
                 "yyyy-MM-dd HH:mm:ss.SSSSSS": "%Y-%m-%d %H:%M:%S.%f", "yyyy-MM": "%Y-%m", "MMM yyyy": "%b %Y",
                 "MMMM yyyy": "%B %Y", "yyyy": "%Y"}


def d_parse(x: str) -> str:
    fl = ", ".join(f"'{_DUCK_FORMATS[f]}'" for f in DEFAULT_DATE_FORMATS)
    return rf"try_strptime(regexp_replace(CAST({x} AS VARCHAR), '^\s+|\s+$', '', 'g'), [{fl}])"


def d_double(x: str) -> str:
    return f"CASE WHEN regexp_full_match({x}, '{NUMBER_RE}') THEN TRY_CAST(trim({x}) AS DOUBLE) END"


def d_int0(x: str) -> str:
    return f"coalesce(CAST(trunc({d_double(x)}) AS BIGINT), 0)"


def d_bool(x: str) -> str:
    return f"coalesce(TRY_CAST({x} AS BOOLEAN), false)"


def d_swap(s: str, e: str) -> str:
    inv = f"({s} IS NOT NULL AND {e} IS NOT NULL AND {s} > {e})"
    return f"CASE WHEN {inv} THEN {e} ELSE {s} END AS {s}, CASE WHEN {inv} THEN {s} ELSE {e} END AS {e}"


def d_rank_first(keys: list[str], order: list[str]) -> str:
    return f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"


def tie_order(cols: list[str], keys: list[str], named: list[str], desc: bool = False) -> list[str]:
    d = "DESC" if desc else "ASC"
    return [f"{c} {d} NULLS LAST" for c in cols if c not in keys and c not in named]


# ----------------------------------------------------------------- raw section frames
def raw_experience(dialect: str) -> str:
    k = "o_orderkey"
    start = "CAST(o_orderdate AS DATE)"
    end = (f"CASE WHEN {k} % 4 = 1 THEN CAST(o_orderdate AS DATE) - INTERVAL 200 DAY "
           f"ELSE CAST(o_orderdate AS DATE) + INTERVAL 300 DAY END")
    if dialect == "spark":
        end = end.replace("INTERVAL 200 DAY", "INTERVAL 200 DAYS").replace("INTERVAL 300 DAY", "INTERVAL 300 DAYS")
    return (f"SELECT CAST(CAST(floor({k} / 2) AS BIGINT) AS STRING) AS id, CAST(CAST(floor({k} / 100) AS BIGINT) AS STRING) AS profile_id, "
            f"concat(lower(o_orderpriority), CASE CAST({k} % 4 AS INT) WHEN 0 THEN ' inc.' WHEN 1 THEN '  llc' "
            f"ELSE '' END) AS company_name, concat('  ', o_orderstatus, ' ') AS title, "
            f"CASE WHEN {k} % 5 = 0 THEN NULL ELSE 'Remote' END AS location, "
            f"{date_text(start, k, dialect)} AS start_date, "
            f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE {fmt(end, 'ymd', dialect)} END AS end_date, "
            f"CASE WHEN {k} % 2 = 0 THEN NULL ELSE concat(' order ', CAST({k} AS STRING), ' ') END AS description, "
            f"CASE WHEN {k} % 3 = 0 THEN true WHEN {k} % 7 = 0 THEN NULL ELSE false END AS is_current "
            f"FROM orders")


def raw_education(dialect: str) -> str:
    k = "p_partkey"
    start = f"DATE '2000-01-01' + CAST({k} % 3000 AS INT)"
    end = f"DATE '2000-01-01' + CAST(({k} % 3000) + (p_size - 10) * 40 AS INT)"
    return (f"SELECT CAST(CAST(floor({k} / 2) AS BIGINT) AS STRING) AS id, CAST(CAST(floor({k} / 50) AS BIGINT) AS STRING) AS profile_id, "
            f"concat(' ', lower(p_brand), CASE CAST({k} % 3 AS INT) WHEN 0 THEN ' university' WHEN 1 THEN ' corp.' "
            f"ELSE '' END) AS school_name, concat(p_type, ' ') AS degree, "
            f"CASE WHEN {k} % 4 = 0 THEN NULL ELSE p_name END AS field_of_study, "
            f"{date_text(start, k, dialect)} AS start_date, "
            f"CASE WHEN {k} % 6 = 0 THEN NULL ELSE {fmt(end, 'ymd', dialect)} END AS end_date, "
            f"CASE CAST({k} % 5 AS INT) WHEN 0 THEN '3.8 GPA' WHEN 1 THEN NULL WHEN 2 THEN ' 3.9 ' "
            f"ELSE concat(CAST(p_size % 4 AS STRING), '.', CAST(p_size % 10 AS STRING)) END AS grade "
            f"FROM part")


RAW_ENDORSE = ("CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 'n/a' WHEN 1 THEN NULL WHEN 2 THEN ' 12 ' "
               "WHEN 3 THEN concat(CAST(p_size AS STRING), '.7') ELSE CAST(p_size AS STRING) END")


def raw_skills_section(dialect: str) -> str:
    return (f"SELECT CAST(r.p_partkey AS STRING) AS id, CAST(CAST(floor(r.p_partkey / 40) AS BIGINT) AS STRING) AS profile_id, "
            f"r.raw_skill AS skill_name, {RAW_ENDORSE} AS endorsement_count "
            f"FROM ({RAW_SKILL_SQL}) r JOIN (SELECT p_partkey AS pk, p_size FROM part) pp ON pp.pk = r.p_partkey")


def raw_certifications(dialect: str) -> str:
    k = "o_orderkey"
    issued = "CAST(o_orderdate AS DATE)"
    expiry = f"CAST(o_orderdate AS DATE) + CAST(({k} % 9 - 2) * 200 AS INT)"
    return (f"SELECT CAST(CAST(floor({k} / 3) AS BIGINT) AS STRING) AS id, CAST(CAST(floor({k} / 300) AS BIGINT) AS STRING) AS profile_id, "
            f"concat(o_orderpriority, ' cert') AS cert_name, "
            f"CASE CAST({k} % 4 AS INT) WHEN 0 THEN 'amazon web services' WHEN 1 THEN 'google llc' "
            f"WHEN 2 THEN ' databricks, inc. ' ELSE NULL END AS authority, "
            f"{date_text(issued, k, dialect)} AS issued_date, "
            f"CASE WHEN {k} % 6 = 0 THEN NULL ELSE {fmt(expiry, 'ymd', dialect)} END AS expiry_date, "
            f"concat(' CERT-', CAST({k} AS STRING), ' ') AS credential_id FROM orders")


def raw_summary(dialect: str) -> str:
    k = "c_custkey"
    day = f"DATE '2020-01-01' + CAST({k} % 700 AS INT)"
    return (f"SELECT CAST(CAST(floor({k} / 3) AS BIGINT) AS STRING) AS id, CAST(CAST(floor({k} / 30) AS BIGINT) AS STRING) AS profile_id, "
            f"concat('  ', c_name, ' ') AS text, "
            f"CASE WHEN {k} % 8 = 0 THEN NULL ELSE {date_text(day, k, dialect)} END AS last_updated FROM customer")


RAW = {"experience": raw_experience, "education": raw_education, "skills": raw_skills_section,
       "certifications": raw_certifications, "summary": raw_summary}


def raw_frame(spark, d, section: str):
    return sql_on_tables(spark, d, RAW[section]("spark"))


# DuckDB cleaned sections (column order = Spark's withColumns order on the raw frame)
CLEAN_DUCK = {
    "experience": ("SELECT {id} AS id, profile_id, {company} AS company_name, {title} AS title, {loc} AS location, "
                   "{sd} AS start_date, {ed} AS end_date, {desc} AS description, {cur} AS is_current FROM ({raw})").format(
        id=d_clean("id"), company=sql_normalize_name("company_name"), title=d_clean("title"), loc=d_clean("location"),
        sd=d_parse("start_date"), ed=d_parse("end_date"), desc=d_clean("description"), cur=d_bool("is_current"),
        raw=raw_experience("duck")),
    "education": ("SELECT {id} AS id, profile_id, {school} AS school_name, {deg} AS degree, {fos} AS field_of_study, "
                  "{sd} AS start_date, {ed} AS end_date, {gr} AS grade FROM ({raw})").format(
        id=d_clean("id"), school=sql_normalize_name("school_name"), deg=d_clean("degree"),
        fos=d_clean("field_of_study"), sd=d_parse("start_date"), ed=d_parse("end_date"), gr=d_double("grade"),
        raw=raw_education("duck")),
    "skills": ("SELECT {id} AS id, profile_id, {sk} AS skill_name, {ec} AS endorsement_count FROM ({raw})").format(
        id=d_clean("id"), sk=d_clean("skill_name"), ec=d_int0("endorsement_count"), raw=raw_skills_section("duck")),
    "certifications": ("SELECT {id} AS id, profile_id, {cn} AS cert_name, {au} AS authority, {iss} AS issued_date, "
                       "{exp} AS expiry_date, {cid} AS credential_id FROM ({raw})").format(
        id=d_clean("id"), cn=d_clean("cert_name"), au=sql_normalize_name("authority"), iss=d_parse("issued_date"),
        exp=d_parse("expiry_date"), cid=d_clean("credential_id"), raw=raw_certifications("duck")),
    "summary": ("SELECT {id} AS id, profile_id, {tx} AS text, {lu} AS last_updated FROM ({raw})").format(
        id=d_clean("id"), tx=d_clean("text"), lu=d_parse("last_updated"), raw=raw_summary("duck")),
}
COLS = {
    "experience": ["id", "profile_id", "company_name", "title", "location", "start_date", "end_date", "description",
                   "is_current"],
    "education": ["id", "profile_id", "school_name", "degree", "field_of_study", "start_date", "end_date", "grade"],
    "skills": ["id", "profile_id", "skill_name", "endorsement_count"],
    "certifications": ["id", "profile_id", "cert_name", "authority", "issued_date", "expiry_date", "credential_id"],
    "summary": ["id", "profile_id", "text", "last_updated"],
}


def _clean(section):
    def run(spark, d):
        return TR.CLEANERS[section](raw_frame(spark, d, section))
    return run


for _sec, _key in (("experience", "clean_experience"), ("education", "clean_education"), ("skills", "clean_skills"),
                   ("certifications", "clean_certifications"), ("summary", "clean_summary")):
    register(_key, CLEAN_DUCK[_sec])(_clean(_sec))


def _norm_dates_sql(section: str, s: str, e: str, order_col: str) -> str:
    cols = COLS[section]
    keys = ["profile_id", "id"]
    order = [f"{order_col} ASC NULLS LAST"] + tie_order(cols, keys, [order_col])
    rest = [c for c in cols if c not in (s, e)]
    return (f"SELECT {', '.join(rest)}, {d_swap(s, e)} FROM (SELECT * FROM ({CLEAN_DUCK[section]}) "
            f"QUALIFY {d_rank_first(keys, order)} = 1)")


@register("normalize_experience", _norm_dates_sql("experience", "start_date", "end_date", "start_date"))
def q_normalize_experience(spark, d):
    return TR.normalize_experience(TR.clean_experience(raw_frame(spark, d, "experience")))


@register("normalize_education", _norm_dates_sql("education", "start_date", "end_date", "start_date"))
def q_normalize_education(spark, d):
    return TR.normalize_education(TR.clean_education(raw_frame(spark, d, "education")))


@register("normalize_certifications", _norm_dates_sql("certifications", "issued_date", "expiry_date", "issued_date"))
def q_normalize_certifications(spark, d):
    return TR.normalize_certifications(TR.clean_certifications(raw_frame(spark, d, "certifications")))


_SKILLS_CANON = (f"SELECT c.id, c.profile_id, coalesce(lk.canonical, {sql_title('c.skill_name')}) AS skill_name, "
                 f"c.endorsement_count FROM ({CLEAN_DUCK['skills']}) c LEFT JOIN {_values_sql(False)} "
                 f"ON lk.key = trim(lower(c.skill_name))")


@register("normalize_skills", f"SELECT * FROM ({_SKILLS_CANON}) QUALIFY "
                              f"row_number() OVER (PARTITION BY profile_id, skill_name "
                              f"ORDER BY endorsement_count DESC NULLS LAST, id ASC NULLS LAST) = 1")
def q_normalize_skills(spark, d):
    return TR.normalize_skills(TR.clean_skills(raw_frame(spark, d, "skills")))


@register("normalize_summary", f"SELECT * FROM ({CLEAN_DUCK['summary']}) QUALIFY row_number() OVER "
                               f"(PARTITION BY profile_id, id ORDER BY last_updated DESC NULLS LAST, text ASC NULLS LAST) = 1")
def q_normalize_summary(spark, d):
    return TR.normalize_summary(TR.clean_summary(raw_frame(spark, d, "summary")))


# ----------------------------------------------------------------- W1, W2
LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount",
           "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
O_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("dedup_keep", "SELECT * FROM lineitem QUALIFY " + d_rank_first(
    ["l_orderkey", "l_linenumber"],
    ["l_shipdate DESC NULLS LAST"] + tie_order(LI_COLS, ["l_orderkey", "l_linenumber"], ["l_shipdate"], desc=True)) + " = 1")
def q_dedup_keep(spark, d):
    return dedup_keep(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"], keep="last")


@register("latest_per_key", "SELECT * FROM orders QUALIFY " + d_rank_first(
    ["o_custkey"], ["o_orderdate DESC NULLS LAST"] + tie_order(O_COLS, ["o_custkey"], ["o_orderdate"])) + " = 1")
def q_latest_per_key(spark, d):
    return latest_per_key(table(spark, d, "orders"), ["o_custkey"], "o_orderdate")


# ----------------------------------------------------------------- A1 (flagship), O1, O2, O3, A2, F3
SHARE_SQL = f"""
WITH c AS ({CANON_SQL}),
per_part AS (SELECT l_partkey, sum(l_quantity) AS q FROM lineitem GROUP BY l_partkey),
e AS (SELECT c.skill, CAST(trunc(sum(per_part.q)) AS BIGINT) AS endorsement_count
      FROM per_part JOIN c ON per_part.l_partkey = c.p_partkey GROUP BY c.skill),
t AS (SELECT * FROM e ORDER BY endorsement_count DESC NULLS LAST, skill ASC NULLS LAST LIMIT 10),
m AS (SELECT CASE WHEN max(endorsement_count) IS NULL OR max(endorsement_count) = 0 THEN 1.0
                  ELSE CAST(max(endorsement_count) AS DOUBLE) END AS m FROM t)
SELECT skill, endorsement_count,
       CAST(trunc(CAST(coalesce(endorsement_count, 0) AS DOUBLE) / m * 100) AS INTEGER) AS pct
FROM t, m"""


def skill_endorsements(spark, d):
    """Endorsements per canonical skill: lineitem quantity pre-aggregated per part before the join."""
    per_part = table(spark, d, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("q"))
    skills = canonicalize(raw_skills(spark, d).withColumnRenamed("raw_skill", "skill"), "skill")
    j = per_part.join(skills, per_part.l_partkey == skills.p_partkey)
    return j.groupBy("skill").agg(F.sum("q").cast("bigint").alias("endorsement_count"))


@register("share_of_max", SHARE_SQL)
def q_share_of_max(spark, d):
    return share_of_max(skill_endorsements(spark, d), "endorsement_count", k=10, tie=["skill"])


@register("top_k", "SELECT * FROM customer ORDER BY c_acctbal DESC NULLS LAST, c_custkey ASC NULLS LAST LIMIT 10")
def q_top_k(spark, d):
    return top_k(table(spark, d, "customer"), "c_acctbal", 10, ["c_custkey"])


SKILL_SECTION = ("SELECT CAST(p_partkey AS STRING) AS id, CAST(p_partkey % 97 AS STRING) AS profile_id, p_name AS skill_name, "
                 "p_size AS endorsement_count FROM part")


def d_position(order: str) -> str:
    return f"CAST(row_number() OVER (PARTITION BY profile_id ORDER BY {order} DESC NULLS LAST, id ASC NULLS LAST) AS INTEGER) AS position"


@register("section_order", f"SELECT *, {d_position('endorsement_count')} FROM ({SKILL_SECTION})")
def q_section_order(spark, d):
    return ST.section_order(sql_on_tables(spark, d, SKILL_SECTION), "skills", by=["profile_id"])


ENDORSE_PARTS = f"SELECT p_partkey, {RAW_ENDORSE} AS endorsement_count FROM part"
POSITIVE_SQL = f"SELECT p_partkey, {d_int0('endorsement_count')} AS endorsement_count FROM ({ENDORSE_PARTS})"


def _endorse_parts(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", f"{RAW_ENDORSE} AS endorsement_count")


@register("positive_only", f"SELECT * FROM ({POSITIVE_SQL}) WHERE endorsement_count > 0")
def q_positive_only(spark, d):
    return positive_only(_endorse_parts(spark, d), "endorsement_count")


@register("sort_asc", f"SELECT * FROM ({POSITIVE_SQL}) WHERE endorsement_count > 0 "
                      f"ORDER BY endorsement_count ASC, p_partkey ASC")
def q_sort_asc(spark, d):
    return sort_asc(_endorse_parts(spark, d), "endorsement_count")


@register("scale_to_width", f"""
WITH k AS (SELECT * FROM ({POSITIVE_SQL}) WHERE endorsement_count > 0)
SELECT p_partkey, endorsement_count,
  CAST(trunc(CAST(endorsement_count AS DOUBLE) / (SELECT max(endorsement_count) FROM k) * 280) AS INTEGER) AS bar_width
FROM k""")
def q_scale_to_width(spark, d):
    return scale_to_width(_endorse_parts(spark, d), "endorsement_count", 280)


# the same for many profiles at once: suppliers, each with the sizes of the parts it supplies
PROFILE_SKILLS = ("SELECT l_suppkey AS profile_id, l_partkey AS id, CAST(count(*) AS BIGINT) AS endorsement_count "
                  "FROM lineitem GROUP BY l_suppkey, l_partkey")


@register("share_of_max_per_profile", f"""
WITH t AS (SELECT *, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY endorsement_count DESC, id) AS INTEGER) AS position
           FROM ({PROFILE_SKILLS}) QUALIFY position <= 10)
SELECT *, CAST(trunc(CAST(endorsement_count AS DOUBLE) / max(endorsement_count) OVER (PARTITION BY profile_id) * 100) AS INTEGER) AS pct FROM t""")
def q_share_of_max_per_profile(spark, d):
    return share_of_max(sql_on_tables(spark, d, PROFILE_SKILLS), "endorsement_count", 10, ["id"], by=["profile_id"])


@register("scale_to_width_per_profile", f"""
SELECT *, CAST(trunc(CAST(endorsement_count AS DOUBLE) / max(endorsement_count) OVER (PARTITION BY profile_id) * 280) AS INTEGER) AS bar_width
FROM ({PROFILE_SKILLS})""")
def q_scale_to_width_per_profile(spark, d):
    return scale_to_width(sql_on_tables(spark, d, PROFILE_SKILLS), "endorsement_count", 280, by=["profile_id"])


# ----------------------------------------------------------------- F1, F2
@register("filter_eq", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey = 10")
def q_filter_eq(spark, d):
    return ST.filter_eq(table(spark, d, "customer"), {"c_mktsegment": "BUILDING", "c_nationkey": 10})


NAMED = "CASE WHEN p_partkey % 4 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN NULL ELSE p_name END"


@register("drop_unnamed", f"SELECT p_partkey, cert_name FROM (SELECT p_partkey, {NAMED} AS cert_name FROM part) "
                          "WHERE cert_name IS NOT NULL AND trim(cert_name) <> ''")
def q_drop_unnamed(spark, d):
    return ST.drop_unnamed(table(spark, d, "part").selectExpr("p_partkey", f"{NAMED} AS cert_name"), "cert_name")


# ----------------------------------------------------------------- S1, S5, S6, J2, U1
CUSTOMER_CONTRACT = T.StructType([
    T.StructField("c_custkey", T.LongType()), T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.LongType()), T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_phone", T.StringType()),
])


@register("typed_read", "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, "
                        "CAST(NULL AS VARCHAR) AS c_phone FROM customer")
def q_typed_read(spark, d):
    return ST.typed_read(spark, f"{d}/customer.parquet", CUSTOMER_CONTRACT)


RUN_TS = "2024-06-01 00:00:00"


@register("stamp_batch", f"SELECT o_orderkey, o_orderstatus, TIMESTAMP '{RUN_TS}' AS scraped_at FROM orders")
def q_stamp_batch(spark, d):
    return ST.stamp_batch(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), RUN_TS)


# the change set: pending orders get a new priority and a corrected total
CHANGES = ("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate, "
           "'1-URGENT' AS o_orderpriority FROM orders WHERE o_orderstatus = 'P'")


def _changes(spark, d):
    return sql_on_tables(spark, d, CHANGES)


@register("upsert", f"""
WITH src AS ({CHANGES})
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = o.o_orderkey)
UNION ALL SELECT * FROM src""")
def q_upsert(spark, d):
    return ST.upsert(table(spark, d, "orders"), _changes(spark, d), "o_orderkey")


@register("anti_ids", f"""
WITH src AS ({CHANGES})
SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.o_orderkey = o.o_orderkey)""")
def q_anti_ids(spark, d):
    return table(spark, d, "orders").join(_changes(spark, d).select("o_orderkey"), "o_orderkey", "left_anti")


@register("append_by_name", f"""
SELECT * FROM orders UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, CAST(NULL AS VARCHAR) AS o_orderpriority
FROM ({CHANGES})""")
def q_append_by_name(spark, d):
    src = _changes(spark, d).drop("o_orderpriority").select("o_totalprice", "o_orderkey", "o_custkey",
                                                           "o_orderstatus", "o_orderdate")
    return ST.append_by_name(table(spark, d, "orders"), src)


# ----------------------------------------------------------------- S8, S9, S10, S11, A3
EDU_SECTION = ("SELECT CAST(o_orderkey AS STRING) AS id, CAST(o_custkey AS STRING) AS profile_id, "
               "o_orderpriority AS school_name, o_orderdate AS start_date, "
               "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_orderdate + INTERVAL 4 YEAR END AS end_date FROM orders")


@register("load_section", "SELECT *, coalesce(CAST(year(start_date) AS VARCHAR), '') AS start_year, "
                          "coalesce(CAST(year(end_date) AS VARCHAR), '') AS end_year, " + d_position("end_date") + " FROM (" + EDU_SECTION + ")")
def q_load_section(spark, d):
    df = sql_on_tables(spark, d, EDU_SECTION.replace("INTERVAL 4 YEAR", "INTERVAL 4 YEARS"))
    return ST.load_section(df, "education", defaults=None)


PROFILES = ("SELECT CAST(c_custkey AS STRING) AS profile_id, c_name AS full_name, c_mktsegment AS headline, "
            "TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(c_nationkey AS INTEGER)) AS scraped_at FROM customer")


@register("load_profile", "SELECT *, '' AS summary FROM (" + PROFILES + ") "
                          "ORDER BY scraped_at DESC NULLS LAST, profile_id ASC NULLS LAST LIMIT 1")
def q_load_profile(spark, d):
    c = table(spark, d, "customer")
    df = c.select(F.col("c_custkey").cast("string").alias("profile_id"), F.col("c_name").alias("full_name"),
                  F.col("c_mktsegment").alias("headline"),
                  F.timestamp_add("DAY", F.col("c_nationkey"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
                  .alias("scraped_at"))
    return ST.load_profile(df)


@register("first_row", "SELECT * FROM orders ORDER BY o_orderdate DESC NULLS LAST, o_orderkey ASC NULLS LAST LIMIT 1")
def q_first_row(spark, d):
    return ST.first_row(table(spark, d, "orders"), [F.col("o_orderdate").desc_nulls_last(),
                                                     F.col("o_orderkey").asc_nulls_last()])


@register("raw_snapshot", "SELECT *, '2024-01-02' AS scrape_date, '2' AS run_id, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'P') "
                          "AS n_first_run FROM orders")
def q_raw_snapshot(spark, d):
    """The latest run of the latest date; the first run of that date still holds what it wrote."""
    root = scratch_path(spark, "snapshots")
    orders = table(spark, d, "orders")
    ST.write_snapshot(orders.filter(F.col("o_orderstatus") == "P"), root, "2024-01-01", "1")
    ST.write_snapshot(orders.filter(F.col("o_orderstatus") != "P"), root, "2024-01-02", "1")
    ST.write_snapshot(orders, root, "2024-01-02", "2")
    first = spark.read.parquet(root).where("scrape_date = '2024-01-02' and run_id = 1").select(F.count(F.lit(1))).scalar()
    return ST.read_latest_snapshot(spark, root).withColumn("n_first_run", first)


# stored orders, then a batch of newer rows (each twice), then a late one that must lose
NEWER = "SELECT * REPLACE (o_orderdate + INTERVAL 1 DAY AS o_orderdate, o_totalprice + 100 AS o_totalprice) FROM orders WHERE o_orderkey % 10 = 0"
LATE = "SELECT * REPLACE (o_orderdate - INTERVAL 1 DAY AS o_orderdate, 0 AS o_totalprice) FROM orders WHERE o_orderkey % 15 = 0"


@register("stored_upsert", f"""
SELECT * EXCLUDE (b) FROM (SELECT *, 0 AS b FROM orders UNION ALL SELECT *, 1 FROM ({NEWER}) UNION ALL SELECT *, 2 FROM ({LATE}))
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY o_orderdate DESC, b DESC) = 1""")
def q_stored_upsert(spark, d):
    """S6 in its stored form: three batches in a change log, the newest row of each key on reading."""
    orders = table(spark, d, "orders")
    moved = lambda days: F.timestamp_add("DAY", F.lit(days), "o_orderdate").cast(orders.schema["o_orderdate"].dataType)
    newer = orders.where("o_orderkey % 10 = 0").withColumns({"o_orderdate": moved(1), "o_totalprice": F.col("o_totalprice") + 100})
    late = orders.where("o_orderkey % 15 = 0").withColumns({"o_orderdate": moved(-1), "o_totalprice": F.lit(0.0)})
    log = ST.ChangeLog(spark, scratch_path(spark, "stored"), "o_orderkey", orders.schema, order="o_orderdate")
    for batch in (orders, newer.union(newer), late):
        log.upsert(batch)
    return log.compact(scratch_path(spark, "stored-compact")).read()


_REPORT_TABLES = ["customer", "orders", "lineitem", "part", "supplier"]


@register("count_rows", " UNION ALL ".join(f"SELECT '{t}' AS section, count(*) AS n_rows FROM {t}" for t in _REPORT_TABLES))
def q_count_rows(spark, d):
    return count_rows({t: table(spark, d, t) for t in _REPORT_TABLES})


@register("run_report", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS section, count(*) AS n_rows FROM {t}" for t in _REPORT_TABLES)
    + "), s AS (SELECT * FROM (VALUES " + ", ".join(f"('{t}')" for t in _REPORT_TABLES + ["recommendations"])
    + ") v(section)) SELECT s.section, coalesce(c.n_rows, 0) AS n_rows, CASE WHEN coalesce(c.n_rows, 0) > 0 "
      "THEN CAST(coalesce(c.n_rows, 0) AS VARCHAR) || ' rows' ELSE 'no data' END AS status FROM s LEFT JOIN c "
      "ON s.section = c.section")
def q_run_report(spark, d):
    return ST.run_report({t: table(spark, d, t) for t in _REPORT_TABLES}, _REPORT_TABLES + ["recommendations"])


# ----------------------------------------------------------------- Q3, Q4, A11
@register("check_key", "SELECT l_orderkey, l_linenumber, count(*) AS n, CASE WHEN l_orderkey IS NULL OR l_linenumber IS NULL "
                       "THEN 'null key' ELSE 'duplicate key' END AS problem FROM lineitem GROUP BY l_orderkey, l_linenumber "
                       "HAVING count(*) > 1 OR l_orderkey IS NULL OR l_linenumber IS NULL")
def q_check_key(spark, d):
    return check_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


LINEITEM_CONTRACT = T.StructType([
    T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.IntegerType()), T.StructField("l_returnflag", T.IntegerType()),
    T.StructField("l_shipdate", T.TimestampNTZType()), T.StructField("l_comment", T.StringType()),
])


@register("schema_drift", """
WITH info(field, expected, actual, problem) AS (VALUES
  ('l_orderkey', 'bigint', 'bigint', 'ok'), ('l_linenumber', 'int', 'int', 'ok'),
  ('l_quantity', 'int', 'double', 'type'), ('l_returnflag', 'int', 'string', 'type'),
  ('l_shipdate', 'timestamp_ntz', 'timestamp_ntz', 'ok'), ('l_comment', 'string', NULL, 'missing'),
  ('l_partkey', NULL, 'bigint', 'unexpected'), ('l_suppkey', NULL, 'bigint', 'unexpected'),
  ('l_extendedprice', NULL, 'double', 'unexpected'), ('l_discount', NULL, 'double', 'unexpected'),
  ('l_tax', NULL, 'double', 'unexpected'), ('l_linestatus', NULL, 'string', 'unexpected')),
bad AS (
  SELECT 'l_orderkey' AS field, CAST(0 AS BIGINT) AS n_bad FROM (SELECT 1)
  UNION ALL SELECT 'l_linenumber', CAST(0 AS BIGINT) FROM (SELECT 1)
  UNION ALL SELECT 'l_quantity', CAST(sum(CASE WHEN l_quantity IS NOT NULL AND TRY_CAST(trunc(l_quantity) AS INTEGER) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'l_returnflag', CAST(sum(CASE WHEN l_returnflag IS NOT NULL AND TRY_CAST(l_returnflag AS INTEGER) IS NULL THEN 1 ELSE 0 END) AS BIGINT) FROM lineitem
  UNION ALL SELECT 'l_shipdate', CAST(0 AS BIGINT) FROM (SELECT 1))
SELECT info.field, expected, actual, problem, coalesce(n_bad, 0) AS n_bad FROM info LEFT JOIN bad ON info.field = bad.field""")
def q_schema_drift(spark, d):
    return schema_drift(table(spark, d, "lineitem"), LINEITEM_CONTRACT)


MISSING_INPUT = ("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_name END AS c_name, "
                 "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer")
_MISSING_COLS = ["c_custkey", "c_name", "c_mktsegment", "c_acctbal"]


@register("missing_report", "WITH m AS (" + MISSING_INPUT + ") " + " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) AS n_rows, CAST(sum(CASE WHEN {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '' "
    f"THEN 1 ELSE 0 END) AS BIGINT) AS n_missing FROM m" for c in _MISSING_COLS))
def q_missing_report(spark, d):
    return missing_report(sql_on_tables(spark, d, MISSING_INPUT), _MISSING_COLS)


# ----------------------------------------------------------------- S7 (+ S6, S11): build the keyed section tables
_NORM_SQL = {
    "experience": _norm_dates_sql("experience", "start_date", "end_date", "start_date"),
    "education": _norm_dates_sql("education", "start_date", "end_date", "start_date"),
    "certifications": _norm_dates_sql("certifications", "issued_date", "expiry_date", "issued_date"),
    "skills": f"SELECT * FROM ({_SKILLS_CANON}) QUALIFY row_number() OVER (PARTITION BY profile_id, skill_name "
              f"ORDER BY endorsement_count DESC NULLS LAST, id ASC NULLS LAST) = 1",
    "summary": f"SELECT * FROM ({CLEAN_DUCK['summary']}) QUALIFY row_number() OVER "
               f"(PARTITION BY profile_id, id ORDER BY last_updated DESC NULLS LAST, text ASC NULLS LAST) = 1",
}
_ALL_SECTIONS = sorted(ST.STORED)


@register("create_sections", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT '{s}' AS section, count(*) AS n_rows FROM ({q})" for s, q in _NORM_SQL.items())
    + "), s AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}')" for s in _ALL_SECTIONS) + ") v(section)) "
    "SELECT s.section, coalesce(c.n_rows, 0) AS n_rows, CASE WHEN coalesce(c.n_rows, 0) > 0 "
    "THEN CAST(coalesce(c.n_rows, 0) AS VARCHAR) || ' rows' ELSE 'no data' END AS status "
    "FROM s LEFT JOIN c ON s.section = c.section")
def q_create_sections(spark, d):
    store = ST.SectionStore(spark, scratch_path(spark, "sections"))
    store.create_sections()
    for section in _NORM_SQL:
        store.upsert(section, TR.prepare_section(raw_frame(spark, d, section), section))
    return ST.run_report({s: store.read(s) for s in _ALL_SECTIONS}, _ALL_SECTIONS)


# ----------------------------------------------------------------- serving views (S8 + E9-E15, E17) end to end
SERVE_AS_OF = "2002-01-01"


def d_month(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '' ELSE strftime({x}, '%b %Y') END"


@register("serve_experience", f"""
WITH n AS ({_NORM_SQL['experience']}),
l AS (SELECT *, {d_month('start_date')} AS sl,
             CASE WHEN is_current THEN 'Present' ELSE {d_month('end_date')} END AS el,
             coalesce(end_date, TIMESTAMP '{SERVE_AS_OF}') AS e FROM n)
SELECT id, profile_id, company_name, title, location, start_date, end_date, description, is_current,
       coalesce(nullif(company_name, ''), '') AS company,
       CASE WHEN sl <> '' THEN sl || ' – ' || el ELSE el END AS date_range,
       CAST((year(e) - year(start_date)) * 12 + (month(e) - month(start_date))
            - CASE WHEN day(e) < day(start_date) THEN 1 ELSE 0 END AS INTEGER) AS tenure_months, {d_position('start_date')}
FROM l""")
def q_serve_experience(spark, d):
    from ..operators.views import section_view
    return section_view(TR.normalize_experience(TR.clean_experience(raw_frame(spark, d, "experience"))),
                        "experience", SERVE_AS_OF)


@register("serve_education", f"""
WITH n AS ({_NORM_SQL['education']}),
y AS (SELECT *, coalesce(CAST(year(start_date) AS VARCHAR), '') AS start_year,
             coalesce(CAST(year(end_date) AS VARCHAR), '') AS end_year FROM n)
SELECT *, coalesce(nullif(school_name, ''), '') AS school,
       CASE WHEN start_year = '' AND end_year = '' THEN ''
            ELSE regexp_replace(start_year || ' – ' || end_year, '^[ –]+|[ –]+$', '', 'g') END AS years,
       concat_ws(', ', nullif({sql_strip('degree')}, ''), nullif({sql_strip('field_of_study')}, '')) AS degree_line, {d_position('end_date')}
FROM y""")
def q_serve_education(spark, d):
    from ..operators.views import section_view
    return section_view(TR.normalize_education(TR.clean_education(raw_frame(spark, d, "education"))), "education")


def _vendor_case(issuer: str, name: str) -> str:
    from ..functions.text import VENDOR_DEFAULT, VENDOR_KEYWORDS
    parts = [f"WHEN lower({issuer}) LIKE '%{k}%' OR lower({name}) LIKE '%{k}%' THEN '{v}'" for k, v in VENDOR_KEYWORDS]
    return "CASE " + " ".join(parts) + f" ELSE '{VENDOR_DEFAULT}' END"


@register("serve_certifications", f"""
WITH n AS ({_NORM_SQL['certifications']}),
a AS (SELECT *, coalesce(nullif(cert_name, ''), '') AS name, coalesce(nullif(authority, ''), '') AS issuer,
             coalesce(nullif(CAST(issued_date AS VARCHAR), ''), '') AS issued FROM n)
SELECT *, {_vendor_case('issuer', 'name')} AS vendor,
       CASE WHEN expiry_date IS NULL OR expiry_date >= TIMESTAMP '{SERVE_AS_OF}' THEN 'active' ELSE 'expired' END AS status, {d_position('issued_date')}
FROM a""")
def q_serve_certifications(spark, d):
    from ..operators.views import section_view
    return section_view(TR.normalize_certifications(TR.clean_certifications(raw_frame(spark, d, "certifications"))),
                        "certifications", SERVE_AS_OF)


@register("serve_skills", f"""
WITH n AS ({_NORM_SQL['skills']}),
b AS (SELECT *, coalesce(nullif(skill_name, ''), '') AS name,
             coalesce(CAST(trunc(CASE WHEN regexp_full_match(CAST(endorsement_count AS VARCHAR), '{NUMBER_RE}')
                 THEN TRY_CAST(trim(CAST(endorsement_count AS VARCHAR)) AS DOUBLE) END) AS BIGINT), 0) AS endorsements FROM n),
t AS (SELECT *, CAST(row_number() OVER (PARTITION BY profile_id ORDER BY endorsements DESC, name, id) AS INTEGER) AS position FROM b
      QUALIFY position <= 10),
m AS (SELECT profile_id, CASE WHEN max(endorsements) = 0 THEN 1.0 ELSE CAST(max(endorsements) AS DOUBLE) END AS m FROM t GROUP BY profile_id)
SELECT t.*, CAST(trunc(CAST(endorsements AS DOUBLE) / m * 100) AS INTEGER) AS pct FROM t JOIN m USING (profile_id)""")
def q_serve_skills(spark, d):
    from ..operators.views import section_view
    return section_view(TR.normalize_skills(TR.clean_skills(raw_frame(spark, d, "skills"))), "skills")
