"""Every registered query against its DuckDB oracle on the smallest driver tables (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from dossier.plans import load_all

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
SQL = {name: q.oracle for name, q in load_all().items() if q.oracle}


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean",
                 "TIMESTAMP": "timestamp_ntz", "DATE": "date"}


def norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 6))
    return str(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(norm(r[i]) for i in order) for r in rows)


WATCHED = ["spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled",
           "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold", "spark.checkpoint.dir"]
_CONF_BEFORE = {}


@pytest.fixture(scope="module")
def duck(spark):
    _CONF_BEFORE.update({k: spark.conf.get(k, None) for k in WATCHED})
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_operator_key_is_registered():
    assert len(load_all()) >= 105 and set(load_all()) <= set(E.queries())
    assert set(SQL) <= set(E.queries())


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10 and set(df.columns) == {"skill", "endorsement_count", "pct"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    res = E.queries()[name](spark, SF)
    cur = duck.execute(SQL[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(res.columns) == sorted(dcols)
    dtypes = {r[0]: DUCK_TO_SPARK.get(r[1], r[1]) for r in duck.execute(f"DESCRIBE {SQL[name]}").fetchall()}
    assert {c: t for c, t in res.dtypes} == dtypes
    assert canon(res.columns, [tuple(r) for r in res.collect()]) == canon(dcols, drows)


def test_queries_leave_session_conf_unchanged(spark, duck):
    assert _CONF_BEFORE and {k: spark.conf.get(k, None) for k in WATCHED} == _CONF_BEFORE
