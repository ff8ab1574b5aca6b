import datetime as dt

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import analytics, marts, quality
from reelhouse.operators.quality import Check


def test_calendar_default_range(spark):
    cal = marts.dim_date(spark)
    assert cal.count() == 47846
    first, last = cal.agg(F.min("date_day"), F.max("date_day")).collect()[0]
    assert (first, last) == (dt.date(1900, 1, 1), dt.date(2030, 12, 30))
    assert marts.dim_date(spark, inclusive=True).count() == 47847


def test_calendar_columns(spark):
    row = marts.dim_date(spark, "2023-01-01", "2023-01-02").collect()[0]
    assert row.date_id == 20230101 and row.year == 2023 and row.quarter == 1 and row.month == 1
    assert (row.month_name, row.day_name, row.day_of_week, row.week_of_year) == ("Jan", "Sun", 0, 52)
    assert row.is_weekend is True and row.decade == 2020


def test_calendar_is_generated_in_parallel(spark):
    assert marts.dim_date(spark).rdd.getNumPartitions() > 1


def test_unique_not_null_accepted(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "z"), (None, None), (2, "a")], "k long, v string")
    assert [(r.k, r.n_records) for r in quality.unique(df, "k").collect()] == [(1, 2)]
    assert quality.not_null(df, "k").count() == 2
    acc = {r.value_field: r.n_records for r in quality.accepted_values(df, "v", ["a", "b"]).collect()}
    assert acc == {"z": 1}  # NULL passes
    combo = {r.k: r.n_records for r in quality.unique_combination(df.select("k"), ["k"]).collect()}
    assert combo == {1: 2, None: 2}  # NULLs form one group
    nulls = {r.column_name: r.n_null for r in quality.null_counts(df).collect()}
    assert nulls == {"k": 2, "v": 1}


def test_unique_combination_groups_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1)], "a long, b long")
    assert [(r.a, r.b, r.n_records) for r in quality.unique_combination(df, ["a", "b"]).collect()] == [(None, 1, 2)]


def test_relationships_ignores_null_fk(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id long, fk long")
    parent = spark.createDataFrame([(10,), (None,)], "key long")
    assert [r.id for r in quality.relationships(child, "fk", parent, "key").collect()] == [3]


def test_suite_and_assert(spark):
    dim = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "genre_id long, genre_name string")
    fact = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "movie_id long, genre_id long")
    checks = [
        Check("unique", "dim", ("genre_id",)),
        Check("not_null", "dim", ("genre_name",)),
        Check("accepted_values", "dim", ("genre_name",), values=("a",)),
        Check("relationships", "fact", ("genre_id",), parent="dim", parent_key="genre_id"),
        Check("unique_combination", "fact", ("movie_id", "genre_id")),
    ]
    res = {r.test_name: (r.failures, r.status) for r in quality.run_suite({"dim": dim, "fact": fact}, checks).collect()}
    assert res == {
        "unique_dim_genre_id": (1, "fail"),
        "not_null_dim_genre_name": (1, "fail"),
        "accepted_values_dim_genre_name": (1, "fail"),
        "relationships_fact_genre_id__dim": (1, "fail"),
        "unique_combination_fact_movie_id_genre_id": (0, "pass"),
    }
    with pytest.raises(quality.DataQualityError, match="4 data test"):
        quality.assert_suite(quality.run_suite({"dim": dim, "fact": fact}, checks))


def test_declared_suite_has_51_tests():
    kinds = [c.kind for c in quality.CATALOGUE_SUITE]
    assert len(kinds) == 51
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships"),
            kinds.count("accepted_values"), kinds.count("unique_combination")) == (28, 15, 4, 2, 2)
    assert len({c.name for c in quality.CATALOGUE_SUITE}) == 51


def test_expect_counts(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "table_name string, n_rows long")
    e = spark.createDataFrame([("x", 1), ("y", 3), ("z", 0)], "table_name string, n_rows long")
    assert sorted(r.table_name for r in quality.expect_counts(a, e).collect()) == ["y", "z"]


def test_discover_and_top_k(spark):
    rows = [(i, float(i % 7), i % 11 == 0, False) for i in range(1, 101)]
    items = spark.createDataFrame(rows, "id long, popularity double, adult boolean, video boolean")
    listing = sorted([r for r in rows if not r[2]], key=lambda r: (-r[1], r[0]))
    page2 = [r.id for r in analytics.discover_page(items, 2, page_size=10).collect()]
    assert page2 == [r[0] for r in listing[10:20]]
    top = [r.id for r in analytics.top_k_popular(items, 2, page_size=10).collect()]
    assert top == [r[0] for r in listing[:20]]
