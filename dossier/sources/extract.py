"""Section extraction from raw pages (S3, S4) and nested JSON responses.

Flat markup is handled with JVM regex functions inside whole-stage codegen.
Nested markup goes through ``mapInPandas`` with the standard-library HTML
parser, one Arrow batch at a time on the executors.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from html.entities import html5
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import _c, strip

# --------------------------------------------------------------------------- markup helpers
# All named character references of HTML, the commonest first (a lookup in a map literal reads it from the front).
_COMMON = ("amp", "nbsp", "lt", "gt", "quot", "apos", "ndash", "mdash", "middot", "hellip", "rsquo", "lsquo", "rdquo", "ldquo")
NAMED_REFERENCES = {f"&{n};": html5[f"{n};"] for n in _COMMON} | {f"&{n}": c for n, c in html5.items() if n.endswith(";")}

_TOKENS = r"(&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});|[^&]+|&)"


def _code_point(cp: Column) -> Column:
    """The character of a code point, from its four bytes in UTF-32."""
    return F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32")


def _decode_ref(t: Column) -> Column:
    """The character that a reference stands for; unknown names and invalid numbers (0, surrogates, > U+10FFFF) stay."""
    number = F.regexp_extract(t, r"^&#([0-9]+);$", 1).try_cast("int")
    cp = F.coalesce(number, F.conv(F.nullif(F.regexp_extract(t, r"^&#[xX]([0-9a-fA-F]+);$", 1), F.lit("")), 16, 10).try_cast("int"))
    valid = cp.isNotNull() & (cp > 0) & (cp <= 0x10FFFF) & ~cp.between(0xD800, 0xDFFF)
    names = F.from_json(F.lit(json.dumps(NAMED_REFERENCES)), "map<string,string>")  # folded to one literal
    return F.when(t.startswith("&#"), F.when(valid, _code_point(cp)).otherwise(t)).when(
        t.startswith("&"), F.coalesce(F.try_element_at(names, t), t)).otherwise(t)


def decode_entities(c: Column | str) -> Column:
    """Decode named and numeric references, each once: '&amp;#65;' and '&amp;lt;' come out as the text '&#65;' and
    '&lt;'.  No-break spaces become blanks."""
    x = _c(c)
    tokens = F.regexp_extract_all(x, F.lit(_TOKENS), 1)
    return F.translate(F.when(x.contains("&"), F.array_join(F.transform(tokens, _decode_ref), "")).otherwise(x), "\u00a0", " ")


def inner_text(c: Column | str) -> Column:
    """Text of a markup fragment: tags removed, entities decoded, ends stripped; null -> ''."""
    return F.coalesce(strip(decode_entities(F.regexp_replace(_c(c), r"<[^>]*>", ""))), F.lit(""))


def first_element_text(html: Column | str, tag: str) -> Column:
    """Inner text of the first ``<tag ...>...</tag>``; missing -> ''."""
    frag = F.regexp_extract(_c(html), rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)
    return inner_text(frag)


# --------------------------------------------------------------------------- S3
def extract_header(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                   name_tag: str = "h1", headline_tag: str = "title",
                   location_class: str = "location") -> DataFrame:
    """S3: one header row per page (full_name, headline, location); a missing element gives ''."""
    html = F.col(html_col)
    loc = F.regexp_extract(html, rf'(?is)<[a-z0-9]+[^>]*class="[^"]*\b{location_class}\b[^"]*"[^>]*>(.*?)</', 1)
    return pages.select(
        F.col(id_col).alias("profile_id"),
        first_element_text(html, name_tag).alias("full_name"),
        first_element_text(html, headline_tag).alias("headline"),
        inner_text(loc).alias("location"),
    )


# --------------------------------------------------------------------------- S4
ITEM_PATTERN = r"(?is)<li\b[^>]*>(.*?)</li>"


def extract_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html",
                  item_pattern: str = ITEM_PATTERN) -> DataFrame:
    """One row per list item (pos, href, text), flat markup, all JVM-side."""
    items = pages.select(F.col(id_col), F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(item_pattern), 1)))
    return items.select(
        F.col(id_col),
        F.col("pos").cast("bigint").alias("pos"),
        F.regexp_extract("col", r'href="([^"]*)"', 1).alias("href"),
        inner_text("col").alias("text"),
    )


#: Elements without an end tag, and elements whose text is not shown (fixed values).
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset(("script", "style"))
#: Stands for '&' while a page is parsed, so that references are decoded in one place, ``decode_entities``.
_AMP = "\ue000"
#: Bytes of markup whose rows are handed on together.
PARSED_BYTES = 8 << 20


class _Item:
    """One list item: where it stands, its own text and link, and the text of the first element of each class."""

    def __init__(self, section: str, parent: int | None, level: int):
        self.section, self.parent, self.level = section, parent, level
        self.text: list[str] = []
        self.href = ""
        self.fields: dict[str, list[str]] = {}


class PageItems(HTMLParser):
    """The list items of a page, nested and unclosed ones included, from one stack of its open elements.

    A new item closes the open one of its list; an end tag closes what is open inside its element; an end tag without
    a start tag is passed over, and the end of the page closes all.  An element belongs to its innermost item, text to
    all items and fields around it.
    """

    def __init__(self):
        super().__init__(convert_charrefs=False)
        self.items: list[_Item] = []
        self.open: list[tuple[str, int | None, list[str] | None, str]] = []  # tag, item, field being read, section

    def _item(self) -> int | None:
        return next((i for _, i, _, _ in reversed(self.open) if i is not None), None)

    def handle_starttag(self, tag, attrs):
        named = dict(attrs)
        if tag == "li":
            for at in range(len(self.open) - 1, -1, -1):
                if self.open[at][0] in ("ul", "ol", "section"):
                    break
                if self.open[at][0] == "li":
                    del self.open[at:]
                    break
        section = (named.get("id") or "") if tag == "section" else (self.open[-1][3] if self.open else "")
        around, item, field = self._item(), None, None
        if tag == "li":
            item = len(self.items)
            self.items.append(_Item(section, around, 0 if around is None else self.items[around].level + 1))
        elif around is not None:
            own = self.items[around]
            if tag == "a" and not own.href:
                own.href = named.get("href") or ""
            for name in (named.get("class") or "").split():
                if name not in own.fields:
                    field = own.fields[name] = field if field is not None else []
        if tag not in VOID:
            self.open.append((tag, item, field, section))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                del self.open[at:]
                return

    def handle_data(self, data):
        if any(tag in HIDDEN for tag, *_ in self.open):
            return
        for _, item, field, _ in self.open:
            if item is not None:
                self.items[item].text.append(data)
            if field is not None:
                field.append(data)


def page_items(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """Id, section ('' outside any), pos (document order), parent, level, href, text, fields (class -> text) of all
    list items, parsed page by page in ``mapInPandas``.  Rows of many pages are handed on by bytes, not by pages."""
    kind = dict(pages.dtypes)[id_col]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [id_col, "section", "pos", "parent", "level", "href", "text", "fields"]
        back = lambda parts: "".join(parts).replace(_AMP, "&")
        for batch in batches:
            rows, size = [], 0
            for page, markup in zip(batch[id_col], batch[html_col], strict=True):
                parser = PageItems()
                parser.feed((markup or "").replace("&", _AMP))
                parser.close()
                rows += [(page, back(x.section), pos, x.parent, x.level, back(x.href), back(x.text), {k: back(v) for k, v in x.fields.items()})
                         for pos, x in enumerate(parser.items)]
                size += len(markup or "")
                if size > PARSED_BYTES:
                    yield pd.DataFrame(rows, columns=columns).astype({"parent": "Int64"})
                    rows, size = [], 0
            yield pd.DataFrame(rows, columns=columns).astype({"parent": "Int64"})

    schema = f"`{id_col}` {kind}, section string, pos long, parent long, level int, href string, text string, fields map<string,string>"
    return pages.select(id_col, F.col(html_col).cast("string").alias(html_col)).mapInPandas(run, schema)


def _shown(c: Column) -> Column:
    return F.coalesce(strip(decode_entities(c)), F.lit(""))


def section_items(pages: DataFrame, section_id: str, fields: dict[str, str], id_col: str = "page_id",
                  html_col: str = "html") -> DataFrame:
    """The items of ``<section id=...>``, one row for each, one column for each field (``{column: css class}``): the
    text of the first element of that class that belongs to the item; missing -> ''.

    Items may be nested (``level``, and ``parent``: the position of the item around it) or unclosed.  An item inside
    another counts as one of its own if it has any of the fields; plain bullet points stay text of the item around.
    """
    items = page_items(pages, id_col, html_col).where(F.col("section") == section_id)
    has_any = F.lit(False)
    for css in fields.values():
        has_any = has_any | F.map_contains_key("fields", css)
    return items.where((F.col("level") == 0) | has_any).select(
        F.col(id_col).alias("profile_id"), "pos", "parent", "level",
        *[_shown(F.try_element_at("fields", F.lit(css))).alias(name) for name, css in fields.items()])


def extract_items_nested(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """S4 for nested markup: the outermost items of a page, numbered, each with the text of all it holds."""
    outer = page_items(pages, id_col, html_col).where("level = 0")
    order = Window.partitionBy(id_col).orderBy("pos")
    return outer.select(id_col, (F.row_number().over(order) - 1).cast("bigint").alias("pos"), "href", _shown(F.col("text")).alias("text"))


# --------------------------------------------------------------------------- S2
_YM = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
PERIOD = T.StructType([T.StructField("startDate", _YM), T.StructField("endDate", _YM)])


def _f(name: str, dt: T.DataType = T.StringType()) -> T.StructField:
    return T.StructField(name, dt, True)


PROFILE_JSON = T.StructType([
    _f("firstName"), _f("lastName"), _f("headline"), _f("summary"), _f("geoLocationName"),
    _f("industryName"), _f("displayPictureUrl"), _f("img_800_800"),
    _f("connections", T.StructType([_f("total", T.LongType())])),
    _f("experience", T.ArrayType(T.StructType([
        _f("companyName"), _f("title"), _f("employmentType"), _f("locationName"), _f("timePeriod", PERIOD),
        _f("description"),
        _f("company", T.StructType([_f("miniCompany", T.StructType([
            _f("universalName"), _f("logo", T.StructType([_f("rootUrl")]))]))])),
    ]))),
    _f("education", T.ArrayType(T.StructType([
        _f("schoolName"), _f("degreeName"), _f("fieldOfStudy"), _f("grade"), _f("activities"),
        _f("description"), _f("timePeriod", PERIOD), _f("school", T.StructType([_f("universalName")])),
    ]))),
])
SKILLS_JSON = T.ArrayType(T.StructType([_f("name"), _f("endorsementCount", T.IntegerType())]))
CERTIFICATIONS_JSON = T.ArrayType(T.StructType([
    _f("name"), _f("authority"), _f("licenseNumber"), _f("url"), _f("timePeriod", PERIOD)]))
_REC = T.StructType([
    _f("recommender", T.StructType([_f("firstName"), _f("lastName"), _f("occupation")])),
    _f("relationshipType"), _f("recommendationText"), _f("creationDate", _YM)])
RECOMMENDATIONS_JSON = T.StructType([_f("receivedRecommendations", T.ArrayType(_REC)),
                                     _f("givenRecommendations", T.ArrayType(_REC))])


def year_month_ts(ym: Column) -> Column:
    """struct(year, month) -> first day of that month (missing month = January); bad -> null."""
    y, m = ym.getField("year"), F.coalesce(ym.getField("month"), F.lit(1))
    return F.try_make_timestamp_ntz(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0))


def _entries(df: DataFrame, entries: str, name: str) -> DataFrame:
    """posexplode of an array, as ``pos`` and ``name``.  An outer one, whose rows without a position go: Spark adds a filter
    below an inner one that parses the JSON behind the array twice more."""
    kept = [c for c in df.columns if c != entries.partition(".")[0]]
    return df.select(*kept, F.posexplode_outer(entries).alias("pos", name)).where("pos is not null")


def flatten_profile(raw: DataFrame, id_col: str, json_col: str) -> dict[str, DataFrame]:
    """One profile response (text) per row -> profile, experience and education rows."""
    p = raw.select(F.col(id_col).alias("profile_id"), F.from_json(json_col, PROFILE_JSON).alias("j"))
    profile = p.select(
        "profile_id",
        F.concat_ws(" ", "j.firstName", "j.lastName").alias("full_name"),
        F.col("j.headline").alias("headline"), F.col("j.summary").alias("summary"),
        F.col("j.geoLocationName").alias("location"), F.col("j.industryName").alias("industry"),
        F.coalesce("j.img_800_800", "j.displayPictureUrl").alias("profile_picture_url"),
        F.col("j.connections.total").alias("connection_count"))
    exp = p.select("profile_id", F.posexplode_outer("j.experience").alias("pos", "e")).filter(F.col("e").isNotNull())
    experience = exp.select(
        "profile_id", "pos",
        F.col("e.companyName").alias("company_name"), F.col("e.title").alias("title"),
        F.col("e.employmentType").alias("employment_type"), F.col("e.locationName").alias("location"),
        year_month_ts(F.col("e.timePeriod.startDate")).alias("start_date"),
        year_month_ts(F.col("e.timePeriod.endDate")).alias("end_date"),
        F.col("e.timePeriod.endDate").isNull().alias("is_current"),
        F.col("e.description").alias("description"),
        F.col("e.company.miniCompany.universalName").alias("company_universal_name"),
        F.col("e.company.miniCompany.logo.rootUrl").alias("company_logo_url"))
    edu = p.select("profile_id", F.posexplode_outer("j.education").alias("pos", "e")).filter(F.col("e").isNotNull())
    education = edu.select(
        "profile_id", "pos",
        F.col("e.schoolName").alias("school_name"), F.col("e.degreeName").alias("degree"),
        F.col("e.fieldOfStudy").alias("field_of_study"), F.col("e.grade").alias("grade"),
        F.col("e.activities").alias("activities"), F.col("e.description").alias("description"),
        year_month_ts(F.col("e.timePeriod.startDate")).alias("start_date"),
        year_month_ts(F.col("e.timePeriod.endDate")).alias("end_date"))
    return {"profile": profile, "experience": experience, "education": education}


def flatten_skills(raw: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Skills response -> (profile_id, pos, skill_name, endorsement_count)."""
    j = raw.select(F.col(id_col).alias("profile_id"), F.from_json(json_col, SKILLS_JSON).alias("j"))
    s = _entries(j, "j", "s")
    return s.select("profile_id", "pos", F.col("s.name").alias("skill_name"),
                    F.col("s.endorsementCount").alias("endorsement_count"))


def flatten_certifications(raw: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Certifications response -> section rows."""
    j = raw.select(F.col(id_col).alias("profile_id"), F.from_json(json_col, CERTIFICATIONS_JSON).alias("j"))
    s = _entries(j, "j", "c")
    return s.select("profile_id", "pos", F.col("c.name").alias("cert_name"), F.col("c.authority").alias("authority"),
                    F.col("c.licenseNumber").alias("credential_id"), F.col("c.url").alias("credential_url"),
                    year_month_ts(F.col("c.timePeriod.startDate")).alias("issued_date"),
                    year_month_ts(F.col("c.timePeriod.endDate")).alias("expiry_date"))


def flatten_recommendations(raw: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """Recommendations response (received and given) -> section rows."""
    j = raw.select(F.col(id_col).alias("profile_id"), F.from_json(json_col, RECOMMENDATIONS_JSON).alias("j"))
    received = _entries(j, "j.receivedRecommendations", "r").withColumn("direction", F.lit("received"))
    rec = received.unionByName(_entries(j, "j.givenRecommendations", "r").withColumn("direction", F.lit("given")))
    return rec.select(
        "profile_id", "direction",
        F.concat_ws(" ", "r.recommender.firstName", "r.recommender.lastName").alias("recommender_name"),
        F.col("r.recommender.occupation").alias("recommender_title"),
        F.col("r.relationshipType").alias("relationship"),
        F.col("r.recommendationText").alias("recommendation_text"),
        year_month_ts(F.col("r.creationDate")).alias("recommendation_date"))
