"""Scalar-rule queries (E1-E23, K1, J1) over supplier, part, customer, orders, lineitem, events, documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import numbers as N
from ..functions import text as X
from ..functions.numbers import NUMBER_RE
from ..operators.lookup import canonicalize, lookup_frame, skill_lookup_rows
from .base import register, table

# ----------------------------------------------------------------- shared SQL (Spark SQL and DuckDB alike)
DIRTY_SUPPLIER = (
    "CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE concat(repeat(' ', CAST(s_suppkey % 3 AS INT)), "
    "lower(replace(s_name, '#', ' o''neil-')), "
    "CASE CAST(s_suppkey % 6 AS INT) WHEN 0 THEN '' WHEN 1 THEN ' inc.' WHEN 2 THEN ' llc' "
    "WHEN 3 THEN ', ltd.' WHEN 4 THEN '  corp' ELSE ' co.' END, "
    "repeat(' ', CAST(s_suppkey % 2 AS INT))) END"
)


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def sql_title(x: str) -> str:
    return (rf"array_to_string(list_transform(regexp_extract_all(lower({x}), '\p{{L}}+|\P{{L}}+'), "
            rf"lambda p: upper(p[1]) || p[2:]), '')")


def sql_suffix(x: str) -> str:
    return f"regexp_replace({x}, '{X.LEGAL_SUFFIX_PATTERN}', '')"


def sql_normalize_name(x: str) -> str:
    s = sql_strip(f"coalesce({x}, '')")
    s = rf"regexp_replace({s}, '\s+', ' ', 'g')"
    return sql_strip(sql_suffix(sql_title(s)))


def _supplier(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.expr(DIRTY_SUPPLIER).alias("raw_name"))


_CLEANED = sql_strip("coalesce(raw_name, '')")


@register("clean_text", f"SELECT s_suppkey, raw_name, {_CLEANED} AS cleaned "
                        f"FROM (SELECT s_suppkey, {DIRTY_SUPPLIER} AS raw_name FROM supplier)")
def q_clean_text(spark, d):
    return _supplier(spark, d).withColumn("cleaned", X.clean_text("raw_name"))


@register("title_case", f"SELECT s_suppkey, raw_name, {sql_title('raw_name')} AS titled "
                        f"FROM (SELECT s_suppkey, {DIRTY_SUPPLIER} AS raw_name FROM supplier)")
def q_title_case(spark, d):
    return _supplier(spark, d).withColumn("titled", X.title_case("raw_name"))


@register("strip_suffix", f"SELECT s_suppkey, titled, {sql_suffix('titled')} AS stripped FROM "
                          f"(SELECT s_suppkey, {sql_title(DIRTY_SUPPLIER)} AS titled FROM supplier)")
def q_strip_suffix(spark, d):
    df = _supplier(spark, d).select("s_suppkey", X.title_case("raw_name").alias("titled"))
    return df.withColumn("stripped", X.strip_suffix("titled"))


@register("normalize_name", f"SELECT s_suppkey, raw_name, {sql_normalize_name('raw_name')} AS normalized "
                            f"FROM (SELECT s_suppkey, {DIRTY_SUPPLIER} AS raw_name FROM supplier)")
def q_normalize_name(spark, d):
    return _supplier(spark, d).withColumn("normalized", X.normalize_name("raw_name"))


def sql_normalize_name_ci(x: str) -> str:
    s = sql_strip(f"coalesce({x}, '')")
    s = rf"regexp_replace({s}, '\s+', ' ', 'g')"
    return sql_strip(f"regexp_replace({sql_title(s)}, '{X.LEGAL_SUFFIX_PATTERN}', '', 'i')")


@register("normalize_name_ignore_case", f"SELECT s_suppkey, raw_name, {sql_normalize_name_ci('raw_name')} AS normalized "
                                        f"FROM (SELECT s_suppkey, {DIRTY_SUPPLIER} AS raw_name FROM supplier)")
def q_normalize_name_ignore_case(spark, d):
    """E3 with suffix_ignore_case=True: 'Llc', 'Gmbh', 'Plc' are removed as well."""
    return _supplier(spark, d).withColumn("normalized", X.normalize_name("raw_name", suffix_ignore_case=True))


# ----------------------------------------------------------------- dates E2, E9
RAW_DATE_SPARK = ("CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
                  "WHEN 1 THEN date_format(o_orderdate, 'MMM yyyy') WHEN 2 THEN date_format(o_orderdate, 'yyyy') "
                  "WHEN 3 THEN date_format(o_orderdate, 'yyyy-MM') WHEN 4 THEN date_format(o_orderdate, 'MMMM yyyy') "
                  "WHEN 5 THEN date_format(o_orderdate, 'yyyy-MM-dd''T''HH:mm:ss') ELSE 'not-a-date' END")
RAW_DATE_DUCK = ("CASE CAST(o_orderkey % 7 AS INT) WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') "
                 "WHEN 1 THEN strftime(o_orderdate, '%b %Y') WHEN 2 THEN strftime(o_orderdate, '%Y') "
                 "WHEN 3 THEN strftime(o_orderdate, '%Y-%m') WHEN 4 THEN strftime(o_orderdate, '%B %Y') "
                 "WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ELSE 'not-a-date' END")
PARSE_DUCK = "try_strptime(raw_date, ['%Y-%m-%d', '%b %Y', '%Y', '%Y-%m', '%B %Y', '%Y-%m-%dT%H:%M:%S'])"


def _raw_dates(spark, d):
    return table(spark, d, "orders").select("o_orderkey", F.expr(RAW_DATE_SPARK).alias("raw_date"))


@register("parse_date", f"SELECT o_orderkey, raw_date, {PARSE_DUCK} AS parsed "
                        f"FROM (SELECT o_orderkey, {RAW_DATE_DUCK} AS raw_date FROM orders)")
def q_parse_date(spark, d):
    return _raw_dates(spark, d).withColumn("parsed", D.parse_date("raw_date"))


@register("extract_year", f"SELECT o_orderkey, raw_date, coalesce(CAST(year({PARSE_DUCK}) AS VARCHAR), '') AS year_text "
                          f"FROM (SELECT o_orderkey, {RAW_DATE_DUCK} AS raw_date FROM orders)")
def q_extract_year(spark, d):
    return _raw_dates(spark, d).withColumn("year_text", D.extract_year("raw_date"))


# ----------------------------------------------------------------- numbers E4, E5, E6, E8
RAW_NUMBER = ("CASE CAST(p_partkey % 6 AS INT) "
              "WHEN 0 THEN concat(CAST(p_size AS STRING), '.', CAST(p_partkey % 10 AS STRING), ' GPA') "
              "WHEN 1 THEN concat(' ', CAST(p_size AS STRING), '.5 ') "
              "WHEN 2 THEN concat(CAST(p_size AS STRING), 'e1') "
              "WHEN 3 THEN concat(CAST(p_size AS STRING), ',000') "
              "WHEN 4 THEN CASE WHEN p_partkey % 12 = 4 THEN '' ELSE concat(CAST(p_size AS STRING), 'd') END "
              "ELSE concat('-', CAST(p_size AS STRING), '.', CAST(p_partkey % 10 AS STRING)) END")
TO_DOUBLE_DUCK = f"CASE WHEN regexp_full_match(raw_number, '{NUMBER_RE}') THEN TRY_CAST(trim(raw_number) AS DOUBLE) END"


def _raw_numbers(spark, d):
    return table(spark, d, "part").select("p_partkey", F.expr(RAW_NUMBER).alias("raw_number"))


@register("to_double", f"SELECT p_partkey, raw_number, {TO_DOUBLE_DUCK} AS value "
                       f"FROM (SELECT p_partkey, {RAW_NUMBER} AS raw_number FROM part)")
def q_to_double(spark, d):
    return _raw_numbers(spark, d).withColumn("value", N.to_double("raw_number"))


@register("to_int_or_zero", f"SELECT p_partkey, raw_number, coalesce(CAST(trunc({TO_DOUBLE_DUCK}) AS BIGINT), 0) AS value "
                            f"FROM (SELECT p_partkey, {RAW_NUMBER} AS raw_number FROM part)")
def q_to_int_or_zero(spark, d):
    return _raw_numbers(spark, d).withColumn("value", N.to_int_or_zero("raw_number"))


RAW_BOOL = ("CASE CAST(c_custkey % 4 AS INT) WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN NULL "
            "ELSE 'maybe' END")


@register("to_bool", f"SELECT c_custkey, raw_flag, coalesce(TRY_CAST(raw_flag AS BOOLEAN), false) AS flag "
                     f"FROM (SELECT c_custkey, {RAW_BOOL} AS raw_flag FROM customer)")
def q_to_bool(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.expr(RAW_BOOL).alias("raw_flag"))
    return df.withColumn("flag", N.to_bool("raw_flag"))


RAW_CAPTION = ("CASE CAST(c_custkey % 3 AS INT) WHEN 0 THEN 'no endorsements' "
               "WHEN 1 THEN concat(CAST(c_nationkey AS STRING), ' endorsements') "
               "ELSE concat(CAST(c_nationkey AS STRING), ' endorsements from ', CAST(c_custkey % 9 AS STRING), ' people') END")


@register("digits_to_int", "SELECT c_custkey, caption, TRY_CAST(nullif(regexp_replace(caption, '[^0-9]', '', 'g'), '') AS BIGINT) "
                           f"AS endorsements FROM (SELECT c_custkey, {RAW_CAPTION} AS caption FROM customer)")
def q_digits_to_int(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.expr(RAW_CAPTION).alias("caption"))
    return df.withColumn("endorsements", X.digits_to_int("caption"))


# ----------------------------------------------------------------- ranges and labels E7, E10, E11, E12
def _range_text(fmt) -> str:
    """Range captions in five shapes by key: en dash with duration, spaced hyphen, bare year hyphen,
    ISO dates with an en dash, and a single ISO date (whose hyphens are not a separator)."""
    end = f"CASE WHEN o_orderkey % 3 = 0 THEN 'Present' ELSE {fmt('o_orderdate + INTERVAL 400 DAY', 'mony')} END"
    return (f"CASE CAST(o_orderkey % 5 AS INT) "
            f"WHEN 0 THEN concat({fmt('o_orderdate', 'mony')}, ' – ', {end}, ' · ', CAST(o_orderkey % 5 + 1 AS STRING), ' yrs') "
            f"WHEN 1 THEN concat({fmt('o_orderdate', 'mony')}, ' - ', {end}) "
            f"WHEN 2 THEN concat({fmt('o_orderdate', 'y')}, '-', CASE WHEN o_orderkey % 3 = 0 THEN 'present' "
            f"ELSE {fmt('o_orderdate + INTERVAL 800 DAY', 'y')} END) "
            f"WHEN 3 THEN concat({fmt('o_orderdate', 'ymd')}, ' – ', CASE WHEN o_orderkey % 3 = 0 THEN 'Present' "
            f"ELSE {fmt('o_orderdate + INTERVAL 400 DAY', 'ymd')} END) "
            f"ELSE {fmt('o_orderdate', 'ymd')} END")


def _fmt_spark(e, k):
    return {"mony": f"date_format({e}, 'MMM yyyy')", "y": f"date_format({e}, 'yyyy')",
            "ymd": f"date_format({e}, 'yyyy-MM-dd')"}[k].replace("INTERVAL 400 DAY", "INTERVAL 400 DAYS").replace(
        "INTERVAL 800 DAY", "INTERVAL 800 DAYS")


def _fmt_duck(e, k):
    return {"mony": f"strftime({e}, '%b %Y')", "y": f"strftime({e}, '%Y')", "ymd": f"strftime({e}, '%Y-%m-%d')"}[k]


RANGE_SPARK = _range_text(_fmt_spark)
RANGE_DUCK = _range_text(_fmt_duck)


@register("split_date_range", f"""
WITH r AS (SELECT o_orderkey, {RANGE_DUCK} AS range_text FROM orders),
p AS (SELECT o_orderkey, range_text, trim(split_part(range_text, '·', 1)) AS dp FROM r),
s AS (SELECT o_orderkey, range_text, dp,
        CASE WHEN contains(dp, '–') THEN '–' WHEN contains(dp, ' - ') THEN ' - '
             WHEN contains(dp, '-') AND NOT regexp_matches(dp, '[0-9]{{4}}-[0-9]{{1,2}}') THEN '-' END AS sep FROM p),
h AS (SELECT o_orderkey, range_text,
        CASE WHEN sep IS NULL THEN '' ELSE trim(split_part(dp, sep, 1)) END AS start_text,
        CASE WHEN sep IS NULL THEN '' ELSE trim(split_part(dp, sep, 2)) END AS end_raw FROM s)
SELECT o_orderkey, range_text, start_text,
       CASE WHEN contains(lower(end_raw), 'present') OR end_raw = '' THEN NULL ELSE end_raw END AS end_text,
       contains(lower(end_raw), 'present') AS is_current
FROM h""")
def q_split_date_range(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.expr(RANGE_SPARK).alias("range_text"))
    r = X.split_date_range("range_text")
    return df.select("o_orderkey", "range_text", r.start.alias("start_text"), r.end.alias("end_text"),
                     r.is_current.alias("is_current"))


START_OR_NULL = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderdate END"


@register("month_label", f"SELECT o_orderkey, CASE WHEN s IS NULL THEN '' ELSE strftime(s, '%b %Y') END AS label "
                         f"FROM (SELECT o_orderkey, {START_OR_NULL} AS s FROM orders)")
def q_month_label(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.expr(START_OR_NULL).alias("s"))
    return df.select("o_orderkey", D.month_label("s").alias("label"))


@register("date_range_label", f"""
SELECT o_orderkey,
  CASE WHEN s IS NULL THEN el ELSE strftime(s, '%b %Y') || ' – ' || el END AS label
FROM (SELECT o_orderkey, {START_OR_NULL} AS s,
        CASE WHEN o_orderkey % 3 = 0 THEN 'Present' ELSE strftime(o_orderdate + INTERVAL 400 DAY, '%b %Y') END AS el
      FROM orders)""")
def q_date_range_label(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", F.expr(START_OR_NULL).alias("s"), F.expr("o_orderdate + INTERVAL 400 DAYS").alias("e"),
        F.expr("o_orderkey % 3 = 0").alias("cur"))
    return df.select("o_orderkey", D.date_range_label("s", "e", "cur").alias("label"))


YEARS = ["CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE CAST(year(o_orderdate) AS STRING) END AS sy",
         "CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE CAST(year(o_orderdate) + 4 AS STRING) END AS ey"]


@register("year_range_label", "SELECT o_orderkey, CASE WHEN sy = '' AND ey = '' THEN '' ELSE "
                              "regexp_replace(sy || ' – ' || ey, '^[ –]+|[ –]+$', '', 'g') END AS label "
                              f"FROM (SELECT o_orderkey, {', '.join(YEARS)} FROM orders)")
def q_year_range_label(spark, d):
    df = table(spark, d, "orders").selectExpr("o_orderkey", *YEARS)
    return df.select("o_orderkey", D.year_range_label("sy", "ey").alias("label"))


PLAIN_RANGE = ["CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(year(o_orderdate) AS STRING) END AS s",
               "CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 7 = 0 THEN NULL "
               "ELSE CAST(year(o_orderdate) + 2 AS STRING) END AS e"]


@register("date_range_label_plain", "SELECT o_orderkey, coalesce(s, '') || ' – ' || CASE WHEN trim(coalesce(e, '')) = '' "
                                    "THEN 'Present' ELSE e END AS label "
                                    f"FROM (SELECT o_orderkey, {', '.join(PLAIN_RANGE)} FROM orders)")
def q_date_range_label_plain(spark, d):
    """E11 component variant: blank end -> 'Present', values used as given."""
    df = table(spark, d, "orders").selectExpr("o_orderkey", *PLAIN_RANGE)
    return df.select("o_orderkey", D.date_range_label_plain("s", "e").alias("label"))


@register("year_range_label_open", "SELECT o_orderkey, CASE WHEN sy <> '' AND ey <> '' THEN sy || ' – ' || ey "
                                   "WHEN sy <> '' THEN sy || ' – Present' ELSE ey END AS label "
                                   f"FROM (SELECT o_orderkey, {', '.join(YEARS)} FROM orders)")
def q_year_range_label_open(spark, d):
    """E12 component variant: a start without an end reads 's – Present'."""
    df = table(spark, d, "orders").selectExpr("o_orderkey", *YEARS)
    return df.select("o_orderkey", D.year_range_label_open("sy", "ey").alias("label"))


# ----------------------------------------------------------------- E13, E14, E15, E18
ALIASES = ["CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_brand END AS company",
           "CASE WHEN p_partkey % 2 = 0 THEN NULL ELSE p_type END AS company_name"]


@register("coalesce_alias", "SELECT p_partkey, coalesce(nullif(company, ''), nullif(company_name, ''), '') AS company "
                            f"FROM (SELECT p_partkey, {', '.join(ALIASES)} FROM part)")
def q_coalesce_alias(spark, d):
    df = table(spark, d, "part").selectExpr("p_partkey", *ALIASES)
    return df.select("p_partkey", X.coalesce_alias(df, ["company", "company_name"]).alias("company"))


ISSUER = ("CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN NULL WHEN 1 THEN 'Amazon Web Services' "
          "WHEN 2 THEN 'AWS Training' WHEN 3 THEN 'Google Cloud' WHEN 4 THEN 'Microsoft' WHEN 5 THEN 'dbt Labs' "
          "WHEN 6 THEN 'Databricks Academy' WHEN 7 THEN 'Snowflake' ELSE 'Coursera' END")
CERT_NAME = "CASE WHEN p_partkey % 5 = 0 THEN concat(p_name, ' on snowflake') ELSE p_name END"


def _vendor_sql() -> str:
    parts = []
    for key, label in X.VENDOR_KEYWORDS:
        parts.append(f"WHEN lower(coalesce(issuer, '')) LIKE '%{key}%' OR lower(coalesce(cert_name, '')) LIKE '%{key}%' "
                     f"THEN '{label}'")
    return "CASE " + " ".join(parts) + f" ELSE '{X.VENDOR_DEFAULT}' END"


@register("classify_vendor", f"SELECT p_partkey, issuer, cert_name, {_vendor_sql()} AS vendor "
                             f"FROM (SELECT p_partkey, {ISSUER} AS issuer, {CERT_NAME} AS cert_name FROM part)")
def q_classify_vendor(spark, d):
    df = table(spark, d, "part").select("p_partkey", F.expr(ISSUER).alias("issuer"), F.expr(CERT_NAME).alias("cert_name"))
    return df.withColumn("vendor", X.classify_vendor("issuer", "cert_name"))


DEGREE = ["CASE WHEN p_partkey % 3 = 0 THEN '' ELSE p_type END AS degree",
          "CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_brand END AS field"]


@register("degree_line", f"SELECT p_partkey, concat_ws(', ', nullif({sql_strip('degree')}, ''), "
                         f"nullif({sql_strip('field')}, '')) AS degree_line "
                         f"FROM (SELECT p_partkey, {', '.join(DEGREE)} FROM part)")
def q_degree_line(spark, d):
    df = table(spark, d, "part").selectExpr("p_partkey", *DEGREE)
    return df.select("p_partkey", X.degree_line("degree", "field").alias("degree_line"))


CERT_AS_OF = "2001-01-01"


@register("cert_status", f"SELECT o_orderkey, expiry, CASE WHEN expiry IS NULL OR expiry >= TIMESTAMP '{CERT_AS_OF}' "
                         "THEN 'active' ELSE 'expired' END AS status FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 "
                         "THEN NULL ELSE o_orderdate + INTERVAL 3 YEAR END AS expiry FROM orders)")
def q_cert_status(spark, d):
    df = table(spark, d, "orders").select(
        "o_orderkey", F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderdate + INTERVAL 3 YEARS END").alias("expiry"))
    return df.withColumn("status", D.cert_status("expiry", CERT_AS_OF))


# ----------------------------------------------------------------- E16, E17 over orders x lineitem
SWAP_INPUT = ["CASE WHEN l_linenumber % 2 = 0 THEN l_shipdate ELSE o_orderdate END AS start_date",
              "CASE WHEN l_linenumber % 5 = 0 THEN NULL WHEN l_linenumber % 2 = 0 THEN o_orderdate "
              "ELSE l_shipdate END AS end_date"]
SWAP_DUCK = f"""
WITH j AS (SELECT l_orderkey, l_linenumber, {', '.join(SWAP_INPUT)}
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
s AS (SELECT l_orderkey, l_linenumber,
        CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL AND start_date > end_date THEN end_date ELSE start_date END AS start_date,
        CASE WHEN start_date IS NOT NULL AND end_date IS NOT NULL AND start_date > end_date THEN start_date ELSE end_date END AS end_date
      FROM j)"""


def _swapped(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey).selectExpr("l_orderkey", "l_linenumber", *SWAP_INPUT)
    return D.swap_dates(j, "start_date", "end_date")


@register("swap_dates", SWAP_DUCK + " SELECT * FROM s")
def q_swap_dates(spark, d):
    return _swapped(spark, d)


TENURE_AS_OF = "2002-01-01"


@register("tenure", SWAP_DUCK + f"""
, e AS (SELECT l_orderkey, l_linenumber, start_date, coalesce(end_date, TIMESTAMP '{TENURE_AS_OF}') AS e FROM s)
SELECT l_orderkey, l_linenumber,
  CAST((year(e) - year(start_date)) * 12 + (month(e) - month(start_date))
       - CASE WHEN day(e) < day(start_date) THEN 1 ELSE 0 END AS INTEGER) AS tenure_months
FROM e""")
def q_tenure(spark, d):
    s = _swapped(spark, d)
    return s.select("l_orderkey", "l_linenumber", D.tenure_months("start_date", "end_date", TENURE_AS_OF).alias("tenure_months"))


# ----------------------------------------------------------------- E19, E20, E21, K1, E22
@register("normalize_text_encoding", r"""
SELECT doc_id, length(c) AS n_clean_chars, sha256(c) AS clean_sha256
FROM (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g') AS c FROM documents)""")
def q_normalize_encoding(spark, d):
    c = X.normalize_encoding("text")
    return table(spark, d, "documents").select("doc_id", F.length(c).cast("bigint").alias("n_clean_chars"),
                                               F.sha2(c, 256).alias("clean_sha256"))


@register("mask_person", r"""
SELECT c_custkey, array_to_string(list_transform(list_filter(string_split_regex(trim(person), '\s+'),
         lambda w: w <> ''), lambda w: upper(w[1]) || '.'), ' ') AS initials
FROM (SELECT c_custkey, concat(c_mktsegment, ' ', c_name) AS person FROM customer)""")
def q_mask_person(spark, d):
    df = table(spark, d, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit(" "), "c_name").alias("person"))
    return df.select("c_custkey", X.mask_person("person").alias("initials"))


MASK_SALT = "2024-06-01"


@register("mask_person_hash", f"SELECT c_custkey, sha256(coalesce(concat(c_mktsegment, ' ', c_name), '') || '{MASK_SALT}') "
                              "AS masked FROM customer")
def q_mask_person_hash(spark, d):
    """E20 hashed variant: SHA-256 of name and salt."""
    df = table(spark, d, "customer").select("c_custkey", F.concat("c_mktsegment", F.lit(" "), "c_name").alias("person"))
    return df.select("c_custkey", X.mask_person("person", salt=MASK_SALT).alias("masked"))


@register("session_hash", "SELECT event_id, sha256(concat_ws('|', CAST(user_id AS VARCHAR), event_type, "
                          "CAST(CAST(ts AS DATE) AS VARCHAR))) AS session_hash FROM events")
def q_session_hash(spark, d):
    ev = table(spark, d, "events")
    return ev.select("event_id", X.session_hash("user_id", "event_type", F.to_date("ts")).alias("session_hash"))


NK_TYPE = "CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_type END"


@register("natural_key", "SELECT event_id, sha256(concat_ws(chr(31), coalesce(lower(CAST(user_id AS VARCHAR)), chr(0)), "
                         "coalesce(lower(et), chr(0)), coalesce(lower(props), chr(0)))) AS id "
                         f"FROM (SELECT event_id, user_id, {NK_TYPE} AS et, props FROM events)")
def q_natural_key(spark, d):
    ev = table(spark, d, "events").select("event_id", "user_id", F.expr(NK_TYPE).alias("et"), "props")
    return ev.select("event_id", X.natural_key("user_id", "et", "props").alias("id"))


@register("json_fields", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def q_json_fields(spark, d):
    return table(spark, d, "events").select("event_id", X.json_field("props", "$.k").alias("k"))


# event metadata with several fields, one of them nested; some rows cut short, some without any
METADATA = ("CASE CAST(event_id % 9 AS INT) WHEN 0 THEN concat('{\"k\": ', CAST(event_id AS STRING)) WHEN 1 THEN NULL WHEN 2 THEN '{}' "
            "ELSE concat('{\"k\": ', CAST(event_id AS STRING), ', \"kind\": \"', event_type, '\", \"by\": {\"user\": ', "
            "coalesce(CAST(user_id AS STRING), 'null'), '}, \"tags\": [\"a\", \"', event_type, '\"]}') END")


@register("json_record", f"""
SELECT event_id, CAST(json_extract_string(j, '$.k') AS BIGINT) AS k, json_extract_string(j, '$.kind') AS kind,
       CAST(json_extract_string(j, '$.by.user') AS BIGINT) AS by_user, json_extract_string(j, '$.tags[1]') AS tag,
       CASE WHEN m IS NOT NULL AND j IS NULL THEN m END AS malformed
FROM (SELECT event_id, m, CASE WHEN json_valid(m) THEN m END AS j FROM (SELECT event_id, {METADATA} AS m FROM events))""")
def q_json_record(spark, d):
    m = X.json_record("m", "k bigint, kind string, by struct<user: bigint>, tags array<string>")
    rows = table(spark, d, "events").select("event_id", F.expr(METADATA).alias("m")).withColumn("j", m)
    whole = F.col("j.malformed").isNull()  # fields read before a text broke off are not taken
    return rows.select("event_id", *[F.when(whole, c).alias(n) for n, c in (
        ("k", F.col("j.k")), ("kind", F.col("j.kind")), ("by_user", F.col("j.by.user")), ("tag", F.get("j.tags", F.lit(1))))], "j.malformed")


# ----------------------------------------------------------------- J1, E23
RAW_SKILL = ("CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN upper(v) WHEN 1 THEN concat(' ', v, ' ') ELSE v END")
SKILL_VARIANT = ("CASE CAST(p_partkey % 16 AS INT) WHEN 0 THEN 'sklearn' WHEN 1 THEN 'NLP' WHEN 2 THEN 'python' "
                 "WHEN 3 THEN 'Apache Spark' WHEN 4 THEN 'obscure-tool' WHEN 5 THEN 'c++' WHEN 6 THEN 'postgres' "
                 "WHEN 7 THEN 'powerbi' WHEN 8 THEN 'k8s engineering' WHEN 9 THEN 'ci/cd' WHEN 10 THEN 'scikit learn' "
                 "WHEN 11 THEN 'tf' WHEN 12 THEN 'google cloud' WHEN 13 THEN 'c' ELSE p_name END")
RAW_SKILL_SQL = f"SELECT p_partkey, {RAW_SKILL} AS raw_skill FROM (SELECT p_partkey, {SKILL_VARIANT} AS v FROM part)"

# A category table is a parameter of E23 (the reference gives none); this one serves the registered query.
SKILL_CATEGORIES = {
    "Python": "language", "C++": "language", "C": "language", "Scikit-Learn": "ml", "TensorFlow": "ml",
    "Natural Language Processing": "ml", "PostgreSQL": "database", "Power BI": "bi", "GCP": "cloud",
    "CI/CD": "devops",
}


def raw_skills(spark, d):
    return table(spark, d, "part").selectExpr("p_partkey", f"{SKILL_VARIANT} AS v").selectExpr(
        "p_partkey", f"{RAW_SKILL} AS raw_skill")


def _values_sql(with_category: bool) -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"
    rows = []
    for k, v in skill_lookup_rows():
        cat = SKILL_CATEGORIES.get(v, "other")
        rows.append(f"({q(k)}, {q(v)}, {q(cat)})" if with_category else f"({q(k)}, {q(v)})")
    cols = "(key, canonical, category)" if with_category else "(key, canonical)"
    return f"(VALUES {', '.join(rows)}) AS lk{cols}"


CANON_SQL = (f"SELECT r.p_partkey, r.raw_skill, coalesce(lk.canonical, {sql_title('r.raw_skill')}) AS skill "
             f"FROM ({RAW_SKILL_SQL}) r LEFT JOIN {_values_sql(False)} ON lk.key = trim(lower(r.raw_skill))")


@register("canonicalize", CANON_SQL)
def q_canonicalize(spark, d):
    return canonicalize(raw_skills(spark, d).withColumn("skill", F.col("raw_skill")), "skill")


@register("categorize", f"SELECT r.p_partkey, coalesce(lk.canonical, {sql_title('r.raw_skill')}) AS skill, "
                        f"coalesce(lk.category, 'other') AS category "
                        f"FROM ({RAW_SKILL_SQL}) r LEFT JOIN {_values_sql(True)} ON lk.key = trim(lower(r.raw_skill))")
def q_categorize(spark, d):
    out = canonicalize(raw_skills(spark, d).withColumnRenamed("raw_skill", "skill"), "skill", category_col="category", categories=SKILL_CATEGORIES)
    return out.select("p_partkey", "skill", "category")
