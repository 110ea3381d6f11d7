"""Extraction: page header, list items (regex and nested-markup parser), nested JSON responses."""

import datetime as dt
import json

from dossier.sources import extract as XT


def test_header_and_items(spark):
    html = ('<html><head><title>Ann Lee | Profile</title></head><body><h1 class="n"> Ann &amp; Lee </h1>'
            '<span class="text location">Berlin</span><ul><li><a href="/a">A</a></li><li>B &lt;x&gt;</li></ul></body></html>')
    pages = spark.createDataFrame([(1, html), (2, "<p>nothing</p>")], "page_id bigint, html string")
    h = {r["profile_id"]: r for r in XT.extract_header(pages).collect()}
    assert (h[1]["full_name"], h[1]["headline"], h[1]["location"]) == ("Ann & Lee", "Ann Lee | Profile", "Berlin")
    assert (h[2]["full_name"], h[2]["headline"], h[2]["location"]) == ("", "", "")
    items = sorted(tuple(r) for r in XT.extract_items(pages).collect())
    assert items == [(1, 0, "/a", "A"), (1, 1, "", "B <x>")]


def test_nested_items_parser(spark):
    html = "<ul><li><a href='/x'>Outer</a><ul><li>inner</li></ul></li><li>Two</li></ul><script>'<li>no</li>'</script>"
    pages = spark.createDataFrame([(5, html)], "page_id bigint, html string")
    got = [tuple(r) for r in XT.extract_items_nested(pages).orderBy("pos").collect()]
    assert got == [(5, 0, "/x", "Outerinner"), (5, 1, "", "Two")]


def test_flatten_profile_json(spark):
    doc = {"firstName": "Ann", "lastName": "Lee", "headline": "Data", "connections": {"total": 500},
           "experience": [
               {"companyName": "Acme", "title": "Eng", "timePeriod": {"startDate": {"year": 2020, "month": 3}}},
               {"companyName": "Globex", "title": "Analyst",
                "timePeriod": {"startDate": {"year": 2018}, "endDate": {"year": 2020, "month": 2}}}],
           "education": [{"schoolName": "Uni", "degreeName": "BSc", "grade": "3.8 GPA",
                          "timePeriod": {"startDate": {"year": 2014}, "endDate": {"year": 2018}}}]}
    raw = spark.createDataFrame([("p1", json.dumps(doc)), ("p2", json.dumps({"firstName": "Bo"}))], "pid string, doc string")
    out = XT.flatten_profile(raw, "pid", "doc")
    prof = {r["profile_id"]: r for r in out["profile"].collect()}
    assert prof["p1"]["full_name"] == "Ann Lee" and prof["p1"]["connection_count"] == 500
    exp = sorted((r["company_name"], r["start_date"], r["end_date"], r["is_current"]) for r in out["experience"].collect())
    assert exp == [("Acme", dt.datetime(2020, 3, 1), None, True),
                   ("Globex", dt.datetime(2018, 1, 1), dt.datetime(2020, 2, 1), False)]
    edu = out["education"].collect()
    assert len(edu) == 1 and edu[0]["grade"] == "3.8 GPA"


def test_flatten_lists(spark):
    skills = json.dumps([{"name": "Python", "endorsementCount": 12}, {"name": "SQL"}])
    certs = json.dumps([{"name": "AWS SA", "authority": "Amazon", "url": None,
                         "timePeriod": {"startDate": {"year": 2022, "month": 3}}}])
    recs = json.dumps({"receivedRecommendations": [{"recommender": {"firstName": "Al", "lastName": "Bo"},
                                                    "recommendationText": "great", "creationDate": {"year": 2021, "month": 5}}],
                       "givenRecommendations": []})
    raw = spark.createDataFrame([("p1", skills, certs, recs)], "pid string, s string, c string, r string")
    s = sorted((r["skill_name"], r["endorsement_count"]) for r in XT.flatten_skills(raw, "pid", "s").collect())
    assert s == [("Python", 12), ("SQL", None)]
    c = XT.flatten_certifications(raw, "pid", "c").collect()[0]
    assert c["issued_date"] == dt.datetime(2022, 3, 1) and c["credential_url"] is None
    r = XT.flatten_recommendations(raw, "pid", "r").collect()
    assert len(r) == 1 and r[0]["recommender_name"] == "Al Bo" and r[0]["recommendation_date"] == dt.datetime(2021, 5, 1)


PROFILE_PAGE = """<html><body><h1>Ann Lee</h1>
<section id="experience"><ul>
 <li class="item"><span class="title">Data Engineer</span><span class="subtitle">Acme Inc.</span>
   <span class="caption">Jan 2022 – Present · 2 yrs</span></li>
 <li class="item"><span class="title">Analyst</span><span class="subtitle">Globex</span>
   <span class="caption">Jun 2018 - Dec 2021</span></li>
</ul></section>
<section id="skills"><ul>
 <li class="item"><span class="title">python</span><span class="caption">42 endorsements</span></li>
 <li class="item"><span class="title"></span></li>
 <li class="item"><span class="title">SQL</span></li>
</ul></section></body></html>"""


def test_section_items_with_captions(spark):
    from dossier.functions.text import digits_to_int, split_date_range
    from dossier.sources.store import drop_unnamed
    pages = spark.createDataFrame([(7, PROFILE_PAGE)], "page_id bigint, html string")
    exp = XT.section_items(pages, "experience", {"title": "title", "company_name": "subtitle", "caption": "caption"})
    r = split_date_range("caption")
    got = sorted((x["title"], x["company_name"], x["s"], x["e"], x["c"]) for x in
                 exp.select("title", "company_name", r.start.alias("s"), r.end.alias("e"), r.is_current.alias("c")).collect())
    assert got == [("Analyst", "Globex", "Jun 2018", "Dec 2021", False),
                   ("Data Engineer", "Acme Inc.", "Jan 2022", None, True)]
    sk = XT.section_items(pages, "skills", {"skill_name": "title", "caption": "caption"})
    sk = drop_unnamed(sk, "skill_name").withColumn("endorsement_count", digits_to_int("caption"))
    assert sorted((x["skill_name"], x["endorsement_count"]) for x in sk.collect()) == [("SQL", None), ("python", 42)]


def test_entity_captions_split(spark):
    from dossier.functions.text import split_date_range
    html = ('<section id="experience"><ul><li><span class="title">Eng &amp; Ops</span>'
            '<span class="caption">Jan 2022 &ndash; Present &middot; 2 yrs</span></li></ul></section>')
    pages = spark.createDataFrame([(1, html)], "page_id bigint, html string")
    rows = XT.section_items(pages, "experience", {"title": "title", "caption": "caption"})
    r = split_date_range("caption")
    got = [tuple(x) for x in rows.select("title", r.start, r.end, r.is_current).collect()]
    assert got == [("Eng & Ops", "Jan 2022", None, True)]


def test_extractors_on_bad_input(spark):
    raw = spark.createDataFrame([("p1", "{not json"), ("p2", None), ("p3", '{"experience": []}')], "pid string, doc string")
    out = XT.flatten_profile(raw, "pid", "doc")
    assert out["profile"].count() == 3 and out["experience"].count() == 0 and out["education"].count() == 0
    pages = spark.createDataFrame([(1, None), (2, "<html><body>no sections</body></html>")], "page_id bigint, html string")
    h = [tuple(r) for r in XT.extract_header(pages).orderBy("profile_id").collect()]
    assert h == [(1, "", "", ""), (2, "", "", "")]
    assert XT.extract_items(pages).count() == 0
    assert XT.section_items(pages, "experience", {"title": "title"}).count() == 0
    assert XT.extract_items_nested(pages).count() == 0


def test_numeric_character_references(spark):
    vals = ["caf&#233; &#x2014; it&#8217;s", "&#128512;", "bad &#0; &#xD800; &#1114112; kept", "&amp;#65; stays",
            "x &#65;&#66; y &lt;b&gt;"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(XT.inner_text("v")).collect()]
    assert got == ["café — it’s", "😀", "bad &#0; &#xD800; &#1114112; kept", "&#65; stays", "x AB y <b>"]


def test_items_with_attributes(spark):
    html = '<link rel="x"><ul><li class="a"><a href="/1">One</a></li><LI>Two</LI></ul>'
    pages = spark.createDataFrame([(3, html)], "page_id bigint, html string")
    assert sorted(tuple(r) for r in XT.extract_items(pages).collect()) == [(3, 0, "/1", "One"), (3, 1, "", "Two")]


NESTED = """<section id="experience"><ul>
<li><span class="title">Lead</span><span class="subtitle">Nord &amp; S&ouml;hne</span>
  <ul><li><span class="title">Deputy</span><span class="caption">2019 &ndash; 2020</span></li>
      <li>plain bullet &hearts;</li><li><span class="title">Trainee</span>
  </ul>
<li><span class="title">Clerk<br>at sea</span></div><script>var x = "<li>";</script>
<li><p class="caption">&notareference; &#0; &amp;lt;"""


def test_section_items_nested_unclosed_and_entities(spark):
    pages = spark.createDataFrame([(1, NESTED), (2, None), (3, "<ul><li>x")], "page_id bigint, html string")
    rows = XT.section_items(pages, "experience", {"title": "title", "company_name": "subtitle", "caption": "caption"}).orderBy("pos").collect()
    got = [(r["level"], r["parent"], r["title"], r["company_name"], r["caption"]) for r in rows]
    assert got == [(0, None, "Lead", "Nord & Söhne", ""), (1, 0, "Deputy", "", "2019 – 2020"), (1, 0, "Trainee", "", ""),
                   (0, None, "Clerkat sea", "", ""), (0, None, "", "", "&notareference; &#0; &lt;")]
    outer = XT.extract_items_nested(pages).where("page_id = 1").orderBy("pos").collect()
    assert len(outer) == 3 and "plain bullet ♥" in outer[0]["text"] and "var x" not in outer[1]["text"]


def test_both_paths_decode_every_named_reference(spark):
    from html.entities import html5
    names = sorted(n for n in html5 if n.endswith(";"))
    markup = "".join(f"<li>a&{n}b</li>" for n in names)
    pages = spark.createDataFrame([(1, markup)], "page_id bigint, html string")
    want = [f"a{html5[n]}b".replace("\u00a0", " ") for n in names]
    for rows in (XT.extract_items(pages), XT.extract_items_nested(pages)):
        assert [r["text"] for r in rows.orderBy("pos").collect()] == want


def test_rows_are_handed_on_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(XT, "PARSED_BYTES", 10)
    pages = spark.createDataFrame([(i, f"<li>{i}</li>") for i in range(30)], "page_id bigint, html string")
    assert sorted(r["text"] for r in XT.extract_items_nested(pages).collect()) == sorted(map(str, range(30)))
