"""Every registered query against its DuckDB oracle (row count, columns,
order-insensitive values) on the smallest driver tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from reelhouse.plans.oracle import ORACLE
from reelhouse.plans.queries import QUERIES
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(rel.columns)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    want = _rows(rel.columns, rel.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_smoke(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 5
    assert entry.entry(spark).columns == ["genre_name", "nb_items", "mean_vote"]


@pytest.mark.parametrize("name", ["metric_increase", "metric_sample", "clean_items", "dim_date"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = QUERIES[name](spark, SF_SMALL)
        got = _rows(df.columns, [tuple(r) for r in df.collect()])
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    rel = duck.sql(ORACLE[name])
    assert got == _rows(rel.columns, rel.fetchall())
