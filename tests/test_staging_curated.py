import math

from pyspark.sql import functions as F

from reelhouse.functions import expressions as X
from reelhouse.operators import clean, enrich
from tests.helpers import D1, D2, by_key, day, genres, languages, raw_items


def test_clean_items_rules(spark):
    items = by_key(clean.clean_items(raw_items(spark)), "movie_id")
    assert set(items) == {1, 2, 3, 4, 5, 6}  # NULL id dropped, id 1 once
    # latest listing date wins
    assert items[1].title == "A2" and items[1].ingestion_date == D2
    # trim + fill
    assert items[4].title == "" and items[4].vote_count == 0
    assert items[3].original_language == "xx"
    assert items[5].popularity == 0.0 and items[5].vote_average == 0.0
    # NaN filled too
    assert items[6].popularity == 0.0
    # dates: empty / invalid -> NULL, leap day ok
    assert items[3].release_date is None and items[3].release_year is None
    assert items[5].release_date is None
    assert items[4].release_date == day("2024-02-29") and items[4].release_year == 2024
    assert items[2].overview == "ov"


def test_dedup_any_keeps_one_row_per_key(spark):
    items = clean.clean_items(raw_items(spark), dedup="any")
    assert items.count() == 6


def test_one_per_key_is_deterministic_and_prefers_order_columns(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "b"), (1, "2024-01-02", "a"), (1, "2024-01-02", "c"), (2, "2024-01-01", None)],
        "k long, d string, v string",
    )
    out = by_key(clean.one_per_key(df, ["k"], order_by=["d"]), "k")
    assert (out[1].d, out[1].v) == ("2024-01-02", "c")
    first = by_key(clean.one_per_key(df, ["k"], order_by=["d"], latest=False), "k")
    assert (first[1].d, first[1].v) == ("2024-01-01", "b")


def test_clean_lookup_drops_null_keys_and_duplicates(spark):
    out = clean.clean_lookup(genres(spark), "id")
    assert sorted(r.id for r in out.collect()) == [1, 2, 5]


def test_reject_counts(spark):
    raw = raw_items(spark)
    r = clean.reject_counts(raw, clean.clean_items(raw)).collect()[0]
    assert (r.n_raw, r.n_clean, r.rejected) == (8, 6, 2)
    # the one-read form agrees with counting the cleaned output
    assert clean.item_reject_counts(raw).collect()[0] == r


def test_items_enriched_tiers_and_names(spark):
    items = clean.clean_items(raw_items(spark))
    lang = enrich.dim_language(clean.clean_lookup(languages(spark), "iso_639_1"))
    e = by_key(enrich.items_enriched(items, lang), "movie_id")
    assert e[1].popularity_tier == "low" and e[1].vote_tier == "average"  # latest row: 1.0 / 5.0
    assert e[2].popularity_tier == "medium" and e[2].vote_tier == "good"
    assert e[3].popularity_tier == "medium" and e[3].vote_tier == "good"
    assert e[4].popularity_tier == "low" and e[4].vote_tier == "poor"
    assert e[6].popularity_tier == "low" and e[6].vote_tier == "average"
    assert e[5].language_name is None and e[3].language_name is None  # zz, xx unknown
    assert e[2].language_name == "French"
    assert e[1].release_decade == 1990 and e[3].release_decade is None
    assert e[3].has_release_date is False and e[4].has_release_date is True


def test_tiers_thresholds(spark):
    df = spark.createDataFrame([(100.0, 7.5), (99.99, 7.49), (20.0, 6.0), (19.99, 3.99), (None, None)], "p double, v double")
    got = [(r.pt, r.vt) for r in df.select(X.popularity_tier("p").alias("pt"), X.vote_tier("v").alias("vt")).collect()]
    assert got == [("high", "excellent"), ("medium", "good"), ("medium", "good"), ("low", "poor"), ("low", "poor")]


def test_bridge_explodes_distinct_non_null(spark):
    items = clean.clean_items(raw_items(spark, [
        (1, "A", "en", [1, 2, 2], 1.0, "", 1.0, 1, D1),
        (2, "B", "en", [], 1.0, "", 1.0, 1, D1),
        (3, "C", "en", None, 1.0, "", 1.0, 1, D1),
        (4, "D", "en", [None, 5], 1.0, "", 1.0, 1, D1),
        (5, "E", "en", [99], 1.0, "", 1.0, 1, D1),
    ]))
    g = enrich.dim_genre(clean.clean_lookup(genres(spark), "id"))
    rows = sorted((r.movie_id, r.genre_id, r.genre_name) for r in enrich.item_genres(items, g).collect())
    assert rows == [(1, 1, "Action"), (1, 2, "Drama"), (4, 5, "Comedy"), (5, 99, None)]


def test_composite_score_and_recent(spark):
    df = spark.createDataFrame([(10.0, 9, 8.0, 2000), (10.0, 0, 8.0, None)], "p double, n long, v double, y int")
    r = df.select(
        X.composite_score("p", "n", "v").alias("s"), X.is_recent("y", "2004-06-01").alias("rec")
    ).collect()
    assert r[0].s == round(10.0 * math.log(10) * 0.8, 2) and r[0].rec is True
    assert r[1].s == 0.0 and r[1].rec is False


def test_parse_date_never_raises_under_ansi(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    df = spark.createDataFrame([("",), ("2024-13-01",), ("2024-02-29",)], "s string")
    got = [r.d for r in df.select(X.parse_date("s").alias("d")).collect()]
    assert got == [None, None, day("2024-02-29")]


def test_date_key(spark):
    df = spark.createDataFrame([(day("1999-12-31"),), (None,)], "d date")
    assert [r.k for r in df.select(X.date_key("d").alias("k")).collect()] == [19991231, None]
    assert df.select(X.date_key("d").alias("k")).schema["k"].dataType.simpleString() == "int"


def test_no_python_udf_in_item_plan(spark, capsys):
    clean.clean_items(raw_items(spark)).explain()
    plan = capsys.readouterr().out
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert F is not None
