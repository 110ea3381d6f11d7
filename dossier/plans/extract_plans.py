"""Extraction queries: S3 header and S4 items over ``pages``; S2 nested JSON built from ``lineitem``."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import jobs
from ..session import scratch_path
from ..sources import extract as XT
from ..sources import store as ST
from .base import register, table

# References as the oracle reads them, written out here so that it does not lean on the code it checks.
D_NAMED = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "''"), ("&nbsp;", " "), ("&middot;", "·"), ("&ndash;", "–"),
           ("&mdash;", "—"), ("&hellip;", "…"), ("&copy;", "©"), ("&eacute;", "é"), ("&szlig;", "ß"), ("&euro;", "€"), ("&frac12;", "½"))


def d_numeric_refs(x: str) -> str:
    ref = ("CASE WHEN regexp_full_match(t, '&#[0-9]+;') THEN TRY_CAST(regexp_extract(t, '&#([0-9]+);', 1) AS INTEGER) "
           "WHEN regexp_full_match(t, '&#[xX][0-9a-fA-F]+;') THEN TRY_CAST('0x' || regexp_extract(t, '&#[xX]([0-9a-fA-F]+);', 1) "
           "AS INTEGER) END")
    dec = (f"CASE WHEN ({ref}) > 0 AND ({ref}) <= 1114111 AND NOT (({ref}) BETWEEN 55296 AND 57343) "
           f"THEN chr({ref}) ELSE t END")
    return (f"CASE WHEN contains({x}, '&#') THEN array_to_string(list_transform("
            f"regexp_extract_all({x}, '(&#(?:[0-9]{{1,7}}|[xX][0-9a-fA-F]{{1,6}});|[^&]+|&)', 1), lambda t: {dec}), '') ELSE {x} END")


def d_inner_text(x: str) -> str:
    s = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in D_NAMED:
        s = f"replace({s}, '{ent}', '{ch}')"
    s = f"replace({d_numeric_refs(s)}, '&amp;', '&')"  # last, so '&amp;lt;' stays '&lt;'
    return rf"coalesce(regexp_replace({s}, '^\s+|\s+$', '', 'g'), '')"


def d_first(tag: str) -> str:
    return d_inner_text(rf"regexp_extract(html, '(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>', 1)")


_LOC = r"""regexp_extract(html, '(?is)<[a-z0-9]+[^>]*class="[^"]*\blocation\b[^"]*"[^>]*>(.*?)</', 1)"""


@register("extract_header", f"SELECT page_id AS profile_id, {d_first('h1')} AS full_name, {d_first('title')} AS headline, "
                            f"{d_inner_text(_LOC)} AS location FROM pages")
def q_extract_header(spark, d):
    return XT.extract_header(table(spark, d, "pages"))


ITEMS_DUCK = rf"""
WITH x AS (SELECT page_id, regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li>', 1) AS items FROM pages),
u AS (SELECT page_id, unnest(range(len(items))) AS pos, unnest(items) AS item FROM x)
SELECT page_id, pos, regexp_extract(item, 'href="([^"]*)"', 1) AS href, {d_inner_text('item')} AS text FROM u"""


@register("extract_items", ITEMS_DUCK)
def q_extract_items(spark, d):
    return XT.extract_items(table(spark, d, "pages"))


@register("extract_items_nested", ITEMS_DUCK)
def q_extract_items_nested(spark, d):
    """S4 through the nested-markup parser (mapInPandas); on flat lists it equals the regex path."""
    return XT.extract_items_nested(table(spark, d, "pages"))


# pages with a section of nested and unclosed items put into them, on both sides the page's own title in it
def _nested_section(title: str, concat) -> str:
    return concat(
        "'<section id=\"experience\"><ul><li class=\"x\"><b class=\"title big\">Lead &amp;amp; '", title, "' &eacute;&#233;</b><span class=\"subtitle\">Nord&szlig;</span>"
        "<ul><li><span class=\"title\">Deputy <i>of '", title, "'</i></span><li>plain bullet<li><span class=\"caption\">2 &frac12; yrs</span></ul>"
        "<li><span class=\"title\">Clerk<br>at sea</span><span class=\"title\">second</span>"
        "<li><p class=\"caption\">Jan 2020 &ndash; Present</ul></section><section id=\"skills\"><li><span class=\"title\">other</section>'")


_NESTED_HTML = "concat(coalesce(html, ''), " + _nested_section("CAST(page_id AS STRING)", lambda *p: ", ".join(p)) + ")"


@register("section_items_nested", """
SELECT page_id AS profile_id, unnest(['Lead &amp; ' || page_id || ' éé', 'Deputy of ' || page_id, '', 'Clerkat sea', '']) AS title,
       unnest(['Nordß', '', '', '', '']) AS company_name, unnest(['', '', '2 ½ yrs', '', 'Jan 2020 – Present']) AS caption,
       unnest([0, 1, 1, 0, 0])::INTEGER AS level, unnest([NULL, 0, 0, NULL, NULL])::BIGINT AS parent_at FROM pages""")
def q_section_items_nested(spark, d):
    """Fields of nested, unclosed and entity-bearing items, in a section added to every page; ``parent_at`` counts
    from the first item of the section."""
    pages = table(spark, d, "pages").select("page_id", F.expr(_NESTED_HTML).alias("html"))
    rows = XT.section_items(pages, "experience", {"title": "title", "company_name": "subtitle", "caption": "caption"})
    first = F.min("pos").over(Window.partitionBy("profile_id"))
    return rows.select("profile_id", "title", "company_name", "caption", "level", (F.col("parent") - first).alias("parent_at"))


# ----------------------------------------------------------------- S2: one nested profile document per lineitem row
def _profile_docs(spark, d):
    li = table(spark, d, "lineitem")
    ym = lambda y, m: F.struct(y.cast("int").alias("year"), m.cast("int").alias("month"))
    y, m = F.year("l_shipdate"), F.month("l_shipdate")
    e0 = F.struct(F.col("l_returnflag").alias("companyName"), F.col("l_linestatus").alias("title"),
                  F.struct(ym(y, m).alias("startDate"),
                           F.when(F.col("l_linenumber") % 3 == 0, F.lit(None))
                           .otherwise(ym(y + 1, F.lit(None))).alias("endDate")).alias("timePeriod"))
    e1 = F.struct(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("companyName"),
                  F.lit(None).cast("string").alias("title"),
                  F.struct(ym(y, m).alias("startDate"), ym(y + 2, m).alias("endDate")).alias("timePeriod"))
    full = F.array(e0, e1)
    exp = F.when(F.col("l_quantity") > 48, F.slice(full, 1, 0)).otherwise(full)
    doc = F.to_json(F.struct(F.concat(F.lit("Order "), F.col("l_orderkey").cast("string")).alias("firstName"),
                             F.lit("Line").alias("lastName"), exp.alias("experience")))
    pid = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    return li.select(pid.alias("doc_id"), doc.alias("doc"))


FLATTEN_DUCK = """
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS profile_id, 0 AS pos,
       l_returnflag AS company_name, l_linestatus AS title,
       make_timestamp(year(l_shipdate), month(l_shipdate), 1, 0, 0, 0) AS start_date,
       CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE make_timestamp(year(l_shipdate) + 1, 1, 1, 0, 0, 0) END AS end_date,
       l_linenumber % 3 = 0 AS is_current
FROM lineitem WHERE NOT l_quantity > 48
UNION ALL
SELECT concat(CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)), 1,
       'S' || CAST(l_suppkey AS VARCHAR), CAST(NULL AS VARCHAR),
       make_timestamp(year(l_shipdate), month(l_shipdate), 1, 0, 0, 0),
       make_timestamp(year(l_shipdate) + 2, month(l_shipdate), 1, 0, 0, 0), false
FROM lineitem WHERE NOT l_quantity > 48"""


@register("flatten_json", FLATTEN_DUCK)
def q_flatten_json(spark, d):
    exp = XT.flatten_profile(_profile_docs(spark, d), "doc_id", "doc")["experience"]
    return exp.select("profile_id", "pos", "company_name", "title", "start_date", "end_date", "is_current")


# the other outputs of S2: responses put together from rows of customer, orders, part and supplier
def _ym(y: str, m: str) -> str:
    return f"named_struct('year', CAST({y} AS INT), 'month', CAST({m} AS INT))"


_PROFILE_DOC = """to_json(named_struct('firstName', split(c_name, '#')[0], 'lastName', if(c_custkey % 7 = 0, NULL, split(c_name, '#')[1]),
  'headline', concat(c_mktsegment, ' "lead" \\\\ é'), 'summary', if(c_custkey % 3 = 0, NULL, concat('In ', c_mktsegment, '\\n since')),
  'geoLocationName', CAST(c_nationkey AS STRING), 'industryName', c_mktsegment, 'displayPictureUrl', concat('/d/', c_custkey),
  'img_800_800', if(c_custkey % 2 = 0, concat('/i/', c_custkey), NULL),
  'connections', if(c_custkey % 5 = 0, NULL, named_struct('total', c_custkey * 3000000000))))"""


@register("flatten_json_profile", r"""
SELECT CAST(c_custkey AS VARCHAR) AS profile_id, 'Customer' || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE ' ' || split_part(c_name, '#', 2) END AS full_name,
       c_mktsegment || ' "lead" \ é' AS headline, CASE WHEN c_custkey % 3 <> 0 THEN 'In ' || c_mktsegment || chr(10) || ' since' END AS summary,
       CAST(c_nationkey AS VARCHAR) AS location, c_mktsegment AS industry,
       CASE WHEN c_custkey % 2 = 0 THEN '/i/' ELSE '/d/' END || c_custkey AS profile_picture_url,
       CASE WHEN c_custkey % 5 <> 0 THEN c_custkey * 3000000000 END AS connection_count FROM customer""")
def q_flatten_json_profile(spark, d):
    docs = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"), F.expr(_PROFILE_DOC).alias("doc"))
    return XT.flatten_profile(docs, "id", "doc")["profile"]


_EDUCATION_DOC = f"""to_json(named_struct('education', CASE WHEN o_orderkey % 10 = 0 THEN array() WHEN o_orderkey % 10 = 1 THEN NULL ELSE array(
  named_struct('schoolName', concat('School ', o_custkey), 'degreeName', o_orderpriority, 'fieldOfStudy', o_orderstatus, 'grade', CAST(o_custkey % 5 AS STRING),
    'activities', CAST(NULL AS STRING), 'description', 'a,b', 'timePeriod', named_struct('startDate', {_ym('year(o_orderdate)', 'NULL')},
    'endDate', {_ym('year(o_orderdate) + 4', 'if(o_orderkey % 4 = 0, 13, 6)')})),
  named_struct('schoolName', NULL, 'degreeName', NULL, 'fieldOfStudy', NULL, 'grade', NULL, 'activities', 'chess', 'description', NULL, 'timePeriod', NULL)) END))"""


@register("flatten_json_education", """
SELECT CAST(o_orderkey AS VARCHAR) AS profile_id, 0 AS pos, 'School ' || o_custkey AS school_name, o_orderpriority AS degree,
       o_orderstatus AS field_of_study, CAST(o_custkey % 5 AS VARCHAR) AS grade, CAST(NULL AS VARCHAR) AS activities, 'a,b' AS description,
       make_timestamp(year(o_orderdate), 1, 1, 0, 0, 0) AS start_date,
       CASE WHEN o_orderkey % 4 <> 0 THEN make_timestamp(year(o_orderdate) + 4, 6, 1, 0, 0, 0) END AS end_date
FROM orders WHERE o_orderkey % 10 > 1
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 1, NULL, NULL, NULL, NULL, 'chess', NULL, NULL, NULL FROM orders WHERE o_orderkey % 10 > 1""")
def q_flatten_json_education(spark, d):
    docs = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.expr(_EDUCATION_DOC).alias("doc"))
    return XT.flatten_profile(docs, "id", "doc")["education"]


_SKILLS_DOC = """to_json(array(named_struct('name', p_type, 'endorsementCount', p_size),
  named_struct('name', concat(p_name, ' ', p_partkey), 'endorsementCount', CAST(NULL AS INT))))"""


@register("flatten_json_skills", """
SELECT CAST(p_partkey AS VARCHAR) AS profile_id, 0 AS pos, p_type AS skill_name, p_size AS endorsement_count FROM part
UNION ALL SELECT CAST(p_partkey AS VARCHAR), 1, p_name || ' ' || p_partkey, NULL FROM part""")
def q_flatten_json_skills(spark, d):
    docs = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("id"), F.expr(_SKILLS_DOC).alias("doc"))
    return XT.flatten_skills(docs, "id", "doc")


_CERTIFICATIONS_DOC = f"""to_json(array(named_struct('name', o_orderpriority, 'authority', concat('Body ', o_custkey),
  'licenseNumber', if(o_orderkey % 3 = 0, NULL, CAST(o_orderkey AS STRING)), 'url', concat('https://x/', o_orderkey, '?a=1&b="'),
  'timePeriod', if(o_orderkey % 6 = 0, NULL, named_struct('startDate', {_ym('year(o_orderdate)', 'month(o_orderdate)')},
    'endDate', if(o_orderkey % 2 = 0, NULL, {_ym('year(o_orderdate) + 3', 'month(o_orderdate)')}))))))"""


@register("flatten_json_certifications", """
SELECT CAST(o_orderkey AS VARCHAR) AS profile_id, 0 AS pos, o_orderpriority AS cert_name, 'Body ' || o_custkey AS authority,
       CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS credential_id, 'https://x/' || o_orderkey || '?a=1&b="' AS credential_url,
       CASE WHEN o_orderkey % 6 <> 0 THEN make_timestamp(year(o_orderdate), month(o_orderdate), 1, 0, 0, 0) END AS issued_date,
       CASE WHEN o_orderkey % 2 <> 0 THEN make_timestamp(year(o_orderdate) + 3, month(o_orderdate), 1, 0, 0, 0) END AS expiry_date FROM orders""")
def q_flatten_json_certifications(spark, d):
    docs = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.expr(_CERTIFICATIONS_DOC).alias("doc"))
    return XT.flatten_certifications(docs, "id", "doc")


def _recommendation(first: str, year: str) -> str:
    return (f"named_struct('recommender', named_struct('firstName', {first}, 'lastName', concat('L', o_custkey), 'occupation', o_orderpriority), "
            f"'relationshipType', o_orderstatus, 'recommendationText', concat('  by ', o_custkey, ' '), 'creationDate', {_ym(year, 'month(o_orderdate)')})")


_RECOMMENDATIONS_DOC = f"""to_json(named_struct('receivedRecommendations', if(o_orderkey % 5 = 0, array(), array({_recommendation("'Ann'", 'year(o_orderdate)')})),
  'givenRecommendations', if(o_orderkey % 2 = 0, NULL, array({_recommendation('NULL', 'year(o_orderdate) + 1')}))))"""


@register("flatten_json_recommendations", """
SELECT CAST(o_orderkey AS VARCHAR) AS profile_id, 'received' AS direction, 'Ann L' || o_custkey AS recommender_name, o_orderpriority AS recommender_title,
       o_orderstatus AS relationship, '  by ' || o_custkey || ' ' AS recommendation_text,
       make_timestamp(year(o_orderdate), month(o_orderdate), 1, 0, 0, 0) AS recommendation_date FROM orders WHERE o_orderkey % 5 <> 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'given', 'L' || o_custkey, o_orderpriority, o_orderstatus, '  by ' || o_custkey || ' ',
       make_timestamp(year(o_orderdate) + 1, month(o_orderdate), 1, 0, 0, 0) FROM orders WHERE o_orderkey % 2 <> 0""")
def q_flatten_json_recommendations(spark, d):
    docs = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("id"), F.expr(_RECOMMENDATIONS_DOC).alias("doc"))
    return XT.flatten_recommendations(docs, "id", "doc")


# responses of every kind into the store: profiles of customers, recommendations on orders (several of one profile,
# some alike in person and month), a cut body and an unknown kind
def _responses(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("profile_id"), F.lit("profile").alias("kind"), F.expr(_PROFILE_DOC).alias("body"))
    orders = table(spark, d, "orders").where("o_custkey is not null")
    r = orders.select(F.col("o_custkey").alias("profile_id"), F.lit("recommendations").alias("kind"), F.expr(_RECOMMENDATIONS_DOC).alias("body"))
    cut = r.where("profile_id % 4 = 0").withColumn("body", F.expr("substring(body, 1, length(body) - 2)"))
    return c.unionByName(r).unionByName(cut).unionByName(c.withColumn("kind", F.lit("likes")))


@register("load_responses", """
WITH r AS (SELECT o_custkey AS k, 'Ann L' || o_custkey AS n, date_trunc('month', o_orderdate) AS m FROM orders WHERE o_orderkey % 5 <> 0)
SELECT s AS section, n AS n_rows, CASE WHEN n > 0 THEN n || ' rows' ELSE 'no data' END AS status FROM (
  SELECT 'profile' AS s, count(*) AS n FROM customer UNION ALL SELECT 'summary', count(*) FROM customer WHERE c_custkey % 3 <> 0
  UNION ALL SELECT 'recommendations', count(DISTINCT (k, n, m)) FROM r
  UNION ALL SELECT 'apart', (SELECT count(*) FROM orders WHERE o_custkey % 4 = 0) + (SELECT count(*) FROM customer)
  UNION ALL SELECT unnest(['experience', 'education', 'skills', 'certifications']), 0)""")
def q_load_responses(spark, d):
    """S2 into S6: the report of a load."""
    return jobs.load_responses(spark, _responses(spark, d), scratch_path(spark, "responses"), "2024-06-01 00:00:00")


@register("stored_recommendations", """
SELECT CAST(o_custkey AS VARCHAR) AS profile_id, 'Ann L' || o_custkey AS recommender_name, 'by ' || o_custkey AS recommendation_text,
       CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS recommendation_date, max(o_orderpriority) AS recommender_title,
       arg_max(o_orderstatus, (o_orderpriority, o_orderstatus)) AS relationship FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1, 2, 3, 4""")
def q_stored_recommendations(spark, d):
    """The rows of one section after two loads of the same responses."""
    root = scratch_path(spark, "responses")
    for run_ts in ("2024-06-01 00:00:00", "2024-06-02 00:00:00"):
        jobs.load_responses(spark, _responses(spark, d), root, run_ts)
    return ST.SectionStore(spark, root).read("recommendations").drop("id")
