"""Property tests: rules agree with the Python semantics they are defined by; keyed operators are
order-insensitive and idempotent; sessionisation equals brute force on random streams."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dossier.functions import text as X
from dossier.operators import events as EV
from dossier.operators.dedup import dedup_keep
from dossier.sources.store import upsert

from test_events import brute_sessions

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
# letters with one-to-one case mappings, digits, punctuation and spaces
WORDY = st.text(alphabet=st.sampled_from(list("abcXYZ019 -'.,&/éüøÉ")), max_size=24)
SPACY = st.text(alphabet=st.sampled_from(list("ab c\t\n\r ")), max_size=16)


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


@SETTINGS
@given(st.lists(WORDY, min_size=1, max_size=30))
def test_title_case_is_python_title(spark, values):
    assert _eval(spark, values, X.title_case) == [v.title() for v in values]


@SETTINGS
@given(st.lists(SPACY, min_size=1, max_size=30))
def test_clean_text_is_python_strip(spark, values):
    assert _eval(spark, values, X.clean_text) == [v.strip() for v in values]


ROWS = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 5), st.sampled_from(["x", "y", None])),
                min_size=1, max_size=25)


@SETTINGS
@given(ROWS, st.integers(1, 4), st.randoms())
def test_dedup_is_order_insensitive(spark, rows, parts, rnd):
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    a = spark.createDataFrame(rows, "k string, v int, w string")
    b = spark.createDataFrame(shuffled, "k string, v int, w string").repartition(parts)
    for keep in ("first", "last"):
        ra = sorted(map(tuple, dedup_keep(a, ["k"], ["v"], keep).collect()), key=str)
        rb = sorted(map(tuple, dedup_keep(b, ["k"], ["v"], keep).collect()), key=str)
        assert ra == rb and len(ra) == len({r[0] for r in rows})


@SETTINGS
@given(st.dictionaries(st.integers(0, 30), st.sampled_from("abc"), max_size=15),
       st.dictionaries(st.integers(0, 30), st.sampled_from("xyz"), max_size=15))
def test_upsert_is_idempotent(spark, target, source):
    t = spark.createDataFrame(list(target.items()) or [(0, "a")], "id int, v string")
    s = spark.createDataFrame(list(source.items()), "id int, v string")
    once = upsert(t, s, "id")
    twice = upsert(once, s, "id")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect()))
    got = dict(map(tuple, once.collect()))
    want = {**(dict(target) or {0: "a"}), **source}
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3 * 24 * 3600)), min_size=1, max_size=60),
       st.sampled_from([0, 60, 1800, 6 * 3600]))
def test_sessions_match_brute_force(spark, evs, gap):
    base = dt.datetime(2024, 1, 1)
    rows = [(i, base + dt.timedelta(seconds=s), u) for i, (u, s) in enumerate(evs)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint")
    import pandas as pd
    got = {(r["user_id"], pd.Timestamp(r["session_start"]), pd.Timestamp(r["session_end"]), r["n_events"])
           for r in EV.sessionize(df, gap_seconds=gap).collect()}
    assert got == brute_sessions(df.toPandas(), gap)


from dossier.functions import numbers as N  # noqa: E402

NUMS = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SETTINGS
@given(st.lists(st.tuples(NUMS, st.sampled_from(["{:.3f}", "{:.0f}", "{:e}", " {:.2f} ", "{:.1f}x"])),
                min_size=1, max_size=20))
def test_to_double_on_formatted_numbers(spark, items):
    texts = [fmt.format(x) for x, fmt in items]
    want = [None if t.strip().endswith("x") else float(t) for t in texts]
    assert _eval(spark, texts, N.to_double) == want


CAPTIONS = st.text(alphabet=st.sampled_from(list("ab 12·-–+")), max_size=18)  # <= 18 digits fit a bigint


@SETTINGS
@given(st.lists(CAPTIONS, min_size=1, max_size=25))
def test_digits_to_int_is_joined_digits(spark, texts):
    want = [int(d) if (d := "".join(ch for ch in t if ch.isdigit())) else None for t in texts]
    assert _eval(spark, texts, X.digits_to_int) == want


MONTHS = st.sampled_from(["Jan", "Feb", "Mar", "Oct", "Dec"])
YEARS = st.integers(1990, 2030)


@SETTINGS
@given(st.lists(st.tuples(MONTHS, YEARS, st.one_of(st.none(), st.tuples(MONTHS, YEARS)), st.integers(0, 9)),
                min_size=1, max_size=20))
def test_split_date_range_on_generated_captions(spark, items):
    texts, want = [], []
    for m1, y1, end, yrs in items:
        end_txt = "Present" if end is None else f"{end[0]} {end[1]}"
        texts.append(f"{m1} {y1} – {end_txt} · {yrs} yrs")
        want.append((f"{m1} {y1}", None if end is None else end_txt, end is None))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    r = X.split_date_range("v")
    got = [tuple(x) for x in df.orderBy("i").select(r.start, r.end, r.is_current).collect()]
    assert got == want
