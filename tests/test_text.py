"""Worked cases of the column rules (one-row frames, as the reference tests them)."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from dossier.functions import dates as D
from dossier.functions import numbers as N
from dossier.functions import text as X
from dossier.operators.lookup import canonicalize, skill_lookup_rows


def col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_clean_text(spark):
    assert col(spark, ["  hello  ", " world", None, "\t tab\n"], X.clean_text) == ["hello", "world", "", "tab"]


def test_parse_date(spark):
    out = col(spark, ["not-a-date", None, "2020-01-01", "Jan 2022", "January 2022", "2022-04", "T10", " 2021 "],
              D.parse_date)
    assert out == [None, None, dt.datetime(2020, 1, 1), dt.datetime(2022, 1, 1), dt.datetime(2022, 1, 1),
                   dt.datetime(2022, 4, 1), None, dt.datetime(2021, 1, 1)]


def test_normalize_name(spark):
    vals = ["  acme  ", "globex corporation", "Acme Inc.", "FooCorp Inc", None, "globex llc", "mit",
            "Foo   Bar  Ltd", "Big Co.", "Acme, Inc."]
    assert col(spark, vals, X.normalize_name) == ["Acme", "Globex Corporation", "Acme", "Foocorp", "", "Globex Llc",
                                                  "Mit", "Foo Bar", "Big", "Acme"]
    assert col(spark, ["globex llc"], lambda c: X.normalize_name(c, suffix_ignore_case=True)) == ["Globex"]


def test_title_case(spark):
    assert col(spark, ["obscure-tool", "k8s", "o'neil 3m", "l.l.c.", None], X.title_case) == \
        ["Obscure-Tool", "K8S", "O'Neil 3M", "L.L.C.", None]


def test_numbers(spark):
    assert col(spark, ["not-a-number", "3.8 GPA", " 3.9 ", "1e3", "1,234", "1d", "inf", ".5"], N.to_double) == \
        [None, None, 3.9, 1000.0, None, None, None, 0.5]
    assert col(spark, [None, "3.7", "-3.7", "x"], N.to_int_or_zero) == [0, 3, -3, 0]
    assert col(spark, [None, True, False], N.to_bool, "boolean") == [False, True, False]


def test_split_date_range(spark):
    df = spark.createDataFrame([("Jan 2022 – Present · 2 yrs",), ("Jan 2020 - Mar 2021",), ("2020-01-01",),
                                ("May 2019 – Jun 2020",)], "v string")
    r = X.split_date_range("v")
    got = [tuple(x) for x in df.select(r.start, r.end, r.is_current).collect()]
    assert got == [("Jan 2022", None, True), ("Jan 2020", "Mar 2021", False), ("", None, False),
                   ("May 2019", "Jun 2020", False)]
    e = X.split_date_range("v", variant="education")
    got = [tuple(x) for x in spark.createDataFrame([("Jan 2010 – Present",), ("2012",)], "v string")
           .select(e.start, e.end, e.is_current).collect()]
    assert got == [("Jan 2010", "Present", False), ("", "", False)]


def test_digits(spark):
    assert col(spark, ["42 endorsements", "3 endorsements from 2 people", "99+", "none"], X.digits_to_int) == \
        [42, 32, 99, None]


def test_labels(spark):
    assert col(spark, ["2021-01-01", None, "not-a-date"], D.extract_year) == ["2021", "", ""]
    assert col(spark, ["2021-12-01", None, "soon"], D.month_label) == ["Dec 2021", "", "soon"]
    df = spark.createDataFrame([("2021-12-01", None, True), ("2020-01-15", "2021-03-01", False),
                                (None, "2021-03-01", False)], "s string, e string, c boolean")
    assert [r[0] for r in df.select(D.date_range_label("s", "e", "c")).collect()] == \
        ["Dec 2021 – Present", "Jan 2020 – Mar 2021", "Mar 2021"]
    df = spark.createDataFrame([("2010", "2014"), ("2010", ""), ("", "2014"), ("", "")], "s string, e string")
    assert [r[0] for r in df.select(D.year_range_label("s", "e")).collect()] == ["2010 – 2014", "2010", "2014", ""]
    assert [r[0] for r in df.select(D.year_range_label_open("s", "e")).collect()] == \
        ["2010 – 2014", "2010 – Present", "2014", ""]


def test_degree_vendor(spark):
    df = spark.createDataFrame([("BSc", "CS"), ("BSc", ""), ("", "CS"), (None, None)], "d string, f string")
    assert [r[0] for r in df.select(X.degree_line("d", "f")).collect()] == ["BSc, CS", "BSc", "CS", ""]
    df = spark.createDataFrame([("Amazon Web Services", "x"), (None, "Google Data"), ("Coursera", "dbt Fundamentals"),
                                ("Other", "Other")], "i string, n string")
    assert [r[0] for r in df.select(X.classify_vendor("i", "n")).collect()] == ["Amazon", "Google", "dbt Labs", "other"]


def test_swap_dates(spark):
    df = spark.createDataFrame([(1, dt.datetime(2023, 6, 1), dt.datetime(2020, 1, 1)),
                                (2, dt.datetime(2018, 1, 1), dt.datetime(2022, 12, 31)),
                                (3, dt.datetime(2018, 1, 1), None)], "i int, s timestamp_ntz, e timestamp_ntz")
    got = [tuple(r) for r in D.swap_dates(df, "s", "e").orderBy("i").collect()]
    assert got == [(1, dt.datetime(2020, 1, 1), dt.datetime(2023, 6, 1)),
                   (2, dt.datetime(2018, 1, 1), dt.datetime(2022, 12, 31)), (3, dt.datetime(2018, 1, 1), None)]


def test_tenure_and_status(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 15), dt.datetime(2021, 1, 14)),
                                (dt.datetime(2020, 1, 15), None)], "s timestamp_ntz, e timestamp_ntz")
    assert [r[0] for r in df.select(D.tenure_months("s", "e", "2020-03-15")).collect()] == [11, 2]
    df = spark.createDataFrame([(None,), (dt.datetime(2030, 1, 1),), (dt.datetime(2001, 1, 1),)], "x timestamp_ntz")
    assert [r[0] for r in df.select(D.cert_status("x", "2024-01-01")).collect()] == ["active", "active", "expired"]


def test_natural_key_no_collision(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    k = [r[0] for r in df.select(X.natural_key("x", "y", "z")).collect()]
    assert k[0] != k[1]


def test_mask_and_encoding(spark):
    assert col(spark, ["Ann  Lee", " bob "], X.mask_person) == ["A. L.", "B."]
    assert col(spark, ["a\x00b\x07c\td"], X.normalize_encoding) == ["abc\td"]


def test_canonicalize(spark):
    keys = dict(skill_lookup_rows())
    assert len(keys) == 73
    assert keys["c"] == "C" and keys["c++"] == "C++" and keys["cicd"] == "CI/CD" and keys["scikitlearn"] == "Scikit-Learn"
    assert "apache spark" not in keys
    vals = ["python", "sklearn", "NLP", "obscure-tool", " Apache Spark", None, "  TF  "]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, skill string")
    got = [r[0] for r in canonicalize(df, "skill").orderBy("i").select("skill").collect()]
    assert got == ["Python", "Scikit-Learn", "Natural Language Processing", "Obscure-Tool", " Apache Spark", None,
                   "TensorFlow"]


def test_parse_date_formats_and_utc(spark):
    assert col(spark, ["03/15/2022", "2022-03-15"], lambda c: D.parse_date(c, "MM/dd/yyyy")) == \
        [dt.datetime(2022, 3, 15), None]
    got = col(spark, ["2022-03-15 12:00:00"], lambda c: D.parse_date(c, utc_from="America/New_York"))
    assert got == [dt.datetime(2022, 3, 15, 16, 0)]


def test_plain_range_and_summaries(spark):
    df = spark.createDataFrame([("2020-01", ""), ("2020-01", "2021-03"), ("2020-01", None)], "s string, e string")
    assert [r[0] for r in df.select(D.date_range_label_plain("s", "e")).collect()] == \
        ["2020-01 – Present", "2020-01 – 2021-03", "2020-01 – Present"]
    from dossier.operators import events as EV
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    a = EV.sessions_from_events(EV.assign_sessions(ev)).select("user_id", "session_start", "n_events", "duration_ms")
    b = EV.sessionize(ev).select("user_id", "session_start", "n_events", "duration_ms")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_parse_date_of_typed_and_fractional_values(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 10, 0, 0, 500000),), (dt.datetime(2021, 5, 6),)], "t timestamp_ntz")
    assert [r[0] for r in df.select(D.parse_date("t")).collect()] == [dt.datetime(2020, 1, 1, 10, 0, 0, 500000),
                                                                      dt.datetime(2021, 5, 6)]
    assert col(spark, ["2020-01-01T10:00:00.25", "2020-01-01 10:00:00.123456"], D.parse_date) == \
        [dt.datetime(2020, 1, 1, 10, 0, 0, 250000), dt.datetime(2020, 1, 1, 10, 0, 0, 123456)]


def test_split_date_range_leading_blank_parts(spark):
    df = spark.createDataFrame([(" · · Jan 2020 – Mar 2021 · 1 yr",), ("·",), ("",)], "v string")
    r = X.split_date_range("v")
    assert [tuple(x) for x in df.select(r.start, r.end, r.is_current).collect()] == \
        [("Jan 2020", "Mar 2021", False), ("", None, False), ("", None, False)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_parse_date_independent_of_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = col(spark, ["2022-03-15 12:00:00", "Mar 2022"], D.parse_date)
        utc = col(spark, ["2022-03-15 12:00:00"], lambda c: D.parse_date(c, utc_from="America/New_York"))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2022, 3, 15, 12, 0), dt.datetime(2022, 3, 1)]
    assert utc == [dt.datetime(2022, 3, 15, 16, 0)]


def test_parse_date_with_offset_is_utc(spark):
    got = col(spark, ["2024-06-01T10:00:00.123456+00:00", "2024-06-01T10:00:00Z", "2024-06-01 10:00:00+05:30", "2024-06-01T10:00:00+99:00"],
              D.parse_date)
    assert got == [dt.datetime(2024, 6, 1, 10, 0, 0, 123456), dt.datetime(2024, 6, 1, 10), dt.datetime(2024, 6, 1, 4, 30), None]
