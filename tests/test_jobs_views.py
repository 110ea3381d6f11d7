"""The collect-and-store job over invented profile pages, and the serving views."""

import datetime as dt

from dossier import jobs
from dossier.operators.views import section_view
from dossier.session import scratch_path

PAGE = """<html><head><title>Ann Lee - Data</title></head><body><h1>Ann Lee</h1>
<span class="location">Berlin</span>
<section id="experience"><ul>
 <li><span class="title">  Data Engineer </span><span class="subtitle">acme inc.</span>
     <span class="caption">Jan 2022 – Present · 2 yrs</span></li>
 <li><span class="title">Analyst</span><span class="subtitle">globex llc</span>
     <span class="caption">Jun 2018 - Dec 2021</span></li>
</ul></section>
<section id="education"><ul>
 <li><span class="title">mit</span><span class="subtitle">BSc</span><span class="detail">CS</span>
     <span class="caption">2014 – 2018</span></li>
</ul></section>
<section id="skills"><ul>
 <li><span class="title">sklearn</span><span class="caption">12 endorsements</span></li>
 <li><span class="title">scikit learn</span><span class="caption">7 endorsements</span></li>
 <li><span class="title">python</span><span class="caption">40 endorsements</span></li>
 <li><span class="title"></span></li>
</ul></section>
<section id="certifications"><ul>
 <li><span class="title">AWS Solutions Architect</span><span class="subtitle">amazon web services</span>
     <span class="caption">Mar 2022</span></li>
</ul></section></body></html>"""


def test_build_sections_job(spark):
    pages = spark.createDataFrame([(1, PAGE), (2, PAGE.replace("Ann Lee", "Bo Chan"))], "page_id bigint, html string")
    root = scratch_path(spark, "job-test")
    report = {r["section"]: r["n_rows"] for r in jobs.build_sections(spark, pages, root, "2024-06-01 00:00:00").collect()}
    assert report == {"certifications": 2, "education": 2, "experience": 4, "profile": 2, "recommendations": 0,
                      "skills": 4, "summary": 0}
    # re-running the same pages is idempotent (ids come from natural keys)
    again = {r["section"]: r["n_rows"] for r in jobs.build_sections(spark, pages, root, "2024-06-02 00:00:00").collect()}
    assert again == report
    from dossier.sources.store import SectionStore
    store = SectionStore(spark, root)
    exp = {r["company_name"]: r for r in store.read("experience").filter("profile_id = '1'").collect()}
    assert set(exp) == {"Acme", "Globex Llc"}
    assert exp["Acme"]["is_current"] is True and exp["Acme"]["end_date"] is None
    assert exp["Acme"]["start_date"] == dt.datetime(2022, 1, 1) and exp["Acme"]["title"] == "Data Engineer"
    skills = {r["skill_name"]: r["endorsement_count"] for r in store.read("skills").filter("profile_id = '1'").collect()}
    assert skills == {"Scikit-Learn": 12, "Python": 40}
    prof = store.read("profile").filter("profile_id = '2'").collect()[0]
    assert prof["full_name"] == "Bo Chan" and prof["location"] == "Berlin"


def test_section_views(spark):
    exp = spark.createDataFrame([("e1", "Acme", dt.datetime(2021, 12, 1), None, True),
                                 ("e2", "Globex", dt.datetime(2018, 6, 1), dt.datetime(2021, 11, 30), False)],
                                "id string, company_name string, start_date timestamp_ntz, end_date timestamp_ntz, is_current boolean")
    v = [(r["id"], r["company"], r["date_range"], r["tenure_months"]) for r in section_view(exp, "experience", "2022-06-01").collect()]
    assert v == [("e1", "Acme", "Dec 2021 – Present", 6), ("e2", "Globex", "Jun 2018 – Nov 2021", 41)]
    edu = spark.createDataFrame([("UofC", "BSc", "CS", "2010-01-01", "2014-05-01")],
                                "school_name string, degree string, field_of_study string, start_date string, end_date string")
    r = section_view(edu, "education").collect()[0]
    assert (r["school"], r["years"], r["degree_line"]) == ("UofC", "2010 – 2014", "BSc, CS")
    sk = spark.createDataFrame([("a", 50), ("b", 40), ("c", 0)], "skill_name string, endorsement_count int")
    assert [(r["name"], r["pct"]) for r in section_view(sk, "skills").collect()] == [("a", 100), ("b", 80), ("c", 0)]
    certs = spark.createDataFrame([("AWS SA", "Amazon", dt.datetime(2022, 3, 1), dt.datetime(2025, 3, 1))],
                                  "cert_name string, authority string, issued_date timestamp_ntz, expiry_date timestamp_ntz")
    r = section_view(certs, "certifications", "2026-01-01").collect()[0]
    assert (r["vendor"], r["status"]) == ("Amazon", "expired")


def test_cli_lists_and_runs(spark, capsys):
    from dossier.plans.__main__ import main
    main([])
    listing = capsys.readouterr().out
    assert "share_of_max" in listing and "oracle" in listing
    main(["top_k", "/root/testdata/sf0.001", "--rows", "2"])
    out = capsys.readouterr().out
    assert "c_custkey" in out and "only showing top 2 rows" in out


def test_load_responses_job(spark):
    import json
    profile = {"firstName": "Ann", "lastName": "Lee", "summary": " About me ", "connections": {"total": 12},
               "experience": [{"companyName": "acme inc.", "title": " Eng ", "timePeriod": {"startDate": {"year": 2020, "month": 3}}}],
               "education": [{"schoolName": "mit", "degreeName": "BSc", "timePeriod": {"startDate": {"year": 2018}, "endDate": {"year": 2014}}}]}
    skills = [{"name": "sklearn", "endorsementCount": 3}, {"name": "scikit learn", "endorsementCount": 9}, {"name": " "}]
    certs = [{"name": "AWS SA", "authority": "amazon", "timePeriod": {"startDate": {"year": 2022, "month": 3}}}]
    person = {"firstName": "Bo", "lastName": "Hu", "occupation": " CTO "}
    recs = {"receivedRecommendations": [
        {"recommender": person, "recommendationText": "good", "creationDate": {"year": 2023, "month": 4}},
        {"recommender": person, "recommendationText": "great", "creationDate": {"year": 2023, "month": 4}},
        {"recommender": None, "recommendationText": "nobody", "creationDate": None}],
        "givenRecommendations": [{"recommender": person, "recommendationText": "given"}]}
    bodies = [(1, "profile", json.dumps(profile)), (1, "skills", json.dumps(skills)), (1, "certifications", json.dumps(certs)),
              (1, "recommendations", json.dumps(recs)), (2, "profile", json.dumps(profile)[:-1]), (2, "skills", None),
              (2, "likes", "[]"), (2, None, "[]"), (3, "recommendations", "{}"), (3, "skills", "[]")]
    responses = spark.createDataFrame(bodies, "profile_id bigint, kind string, body string")
    root = scratch_path(spark, "responses-test")
    expected = {"certifications": 1, "education": 1, "experience": 1, "profile": 1, "recommendations": 1, "skills": 1, "summary": 1, "apart": 4}
    for run_ts in ("2024-06-01 00:00:00", "2024-06-02 00:00:00"):  # the second load changes nothing
        report = {r["section"]: r["n_rows"] for r in jobs.load_responses(spark, responses, root, run_ts).collect()}
        assert report == expected
    problems = sorted(r["problem"] for r in jobs.response_sections(responses)[1].collect())
    assert problems == ["malformed", "no body", "unknown kind", "unknown kind"]
    from dossier.sources.store import SectionStore
    store = SectionStore(spark, root)
    row = {s: store.read(s).collect()[0] for s in expected if s != "apart"}
    assert row["experience"]["company_name"] == "Acme" and row["experience"]["start_date"] == dt.datetime(2020, 3, 1)
    assert row["experience"]["is_current"] is True and row["experience"]["end_date"] is None
    assert row["education"]["start_date"] == dt.datetime(2014, 1, 1)  # swapped
    assert (row["skills"]["skill_name"], row["skills"]["endorsement_count"]) == ("Scikit-Learn", 9)
    assert row["certifications"]["issued_date"] == dt.datetime(2022, 3, 1)
    rec = row["recommendations"]
    assert (rec["recommender_name"], rec["recommender_title"], rec["recommendation_text"]) == ("Bo Hu", "CTO", "great")
    assert rec["recommendation_date"] == dt.datetime(2023, 4, 1) and row["summary"]["text"] == "About me"
    assert row["profile"]["connection_count"] == 12
    empty, apart = jobs.response_sections(responses.where("false"))
    assert apart.count() == 0 and all(df.count() == 0 for df in empty.values())


def test_bodies_are_checked_once_and_parsed_once_for_a_section(spark):
    kinds = [(1, "skills", '[{"name": "a"}, null, {"name": "b"}]'), (2, "skills", "[]"), (3, "skills", "null"), (4, "skills", "{"),
             (1, "recommendations", '{"receivedRecommendations": [{"recommender": {"firstName": "Bo"}}, null]}'), (1, "profile", '{"firstName": "Al"}'),
             (1, "certifications", '[{"name": "c"}]')]
    responses = spark.createDataFrame(kinds, "profile_id bigint, kind string, body string")
    rows, apart = jobs.response_sections(responses)
    for name, df in [*rows.items(), ("apart", apart)]:
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "parse_json" not in plan and "VariantExpressionEvalUtils" not in plan
        assert name not in ("skills", "certifications", "recommendations") or plan.count("from_json(") == 1
    assert [(r["profile_id"], r["problem"]) for r in apart.collect()] == [(4, "malformed")]
    assert sorted((r["profile_id"], r["pos"], r["skill_name"]) for r in rows["skills"].collect()) == [("1", 0, "a"), ("1", 2, "b")]
    assert [(r["profile_id"], r["recommender_name"]) for r in rows["recommendations"].collect()] == [("1", "Bo")]
    from dossier.sources import extract as XT
    flat = XT.flatten_skills(responses.where("kind = 'skills'"), "profile_id", "body")
    assert sorted((r["profile_id"], r["pos"], r["skill_name"] or "") for r in flat.collect()) == [(1, 0, "a"), (1, 1, ""), (1, 2, "b")]
    flat = XT.flatten_recommendations(responses.where("kind = 'recommendations'"), "profile_id", "body")
    assert sorted(r["recommender_name"] for r in flat.collect()) == ["", "Bo"]


def test_report_counts_keys_not_change_rows(spark):
    from dossier.sources.store import SectionStore
    store = SectionStore(spark, scratch_path(spark, "keys-test"))
    store.create_sections(["skills"])
    assert store.keys("skills").count() == 0
    for names in (["a", "b"], ["b", "c"]):
        store.upsert("skills", spark.createDataFrame([(n, "p", n) for n in names], "id string, profile_id string, skill_name string"))
    assert sorted(tuple(r) for r in store.keys("skills").collect()) == [("p", n) for n in "abc"] and store.read("skills").count() == 3
