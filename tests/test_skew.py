"""Exact results when one key holds a third of all rows."""

from pyspark.sql import functions as F

from reelhouse.operators import analytics, clean, enrich
from reelhouse.sources.load import align_to_schema
from reelhouse.sources.schemas import RAW_ITEMS


def _raw(spark, n=30_000):
    # every third row is the hot item 0, listed on many dates; others unique
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("id"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title"),
        F.array(F.lit(1), (F.col("id") % 7).cast("long")).alias("genre_ids"),
        (F.col("id") % 500).cast("double").alias("popularity"),
        F.lit("2000-01-01").alias("release_date"),
        (F.col("id") % 10).cast("double").alias("vote_average"),
        F.lit(3).cast("long").alias("vote_count"),
        F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 97).cast("int")), "yyyy-MM-dd")
        .alias("ingestion_date"),
    )
    return align_to_schema(df, RAW_ITEMS)


def test_hot_key_dedup_is_exact(spark):
    raw = _raw(spark)
    items = clean.clean_items(raw)
    assert items.count() == 1 + 30_000 - 10_000  # one row for the hot key
    hot = items.filter("movie_id = 0").collect()[0]
    # latest date wins, then the greatest remaining columns
    want = (
        raw.filter("id = 0")
        .orderBy(F.desc("ingestion_date"), F.desc("genre_ids"), F.desc("original_language"), F.desc("original_title"),
                 F.desc("overview"), F.desc("popularity"), F.desc("release_date"), F.desc("title"))
        .first()
    )
    assert (hot.ingestion_date, hot.title) == (want.ingestion_date, want.title.strip())


def test_hot_genre_aggregation_is_exact(spark):
    items = clean.clean_items(_raw(spark))
    genres = spark.createDataFrame([(g, f"g{g}") for g in range(7)], "genre_id long, genre_name string")
    bridge = enrich.item_genres(items, genres).select("movie_id", "genre_id")
    top = {r.genre_name: r.nb_items for r in analytics.top_genres(items, bridge, genres, n=7).collect()}
    # genre 1 is in every item's array: the hot group holds every item
    assert top["g1"] == items.count()
    pairs = items.select("movie_id", F.explode(F.array_distinct("genre_ids")).alias("g"))
    want = {f"g{r.g}": r["count"] for r in pairs.groupBy("g").count().collect()}
    assert top == want


def test_quantile_with_a_hot_group_is_exact(spark):
    """One user holds a third of all samples, with values of its own."""
    import numpy as np

    from reelhouse.operators import metrics

    n = 30_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("user"),
        F.when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.pow(F.col("id") % 9_973, F.lit(1.5))).alias("value"),
    ).unionByName(spark.createDataFrame([(None, 3.0), (None, 7.0), (77, None), (78, 1.0)], "user long, value double"))
    plan = metrics.quantile(df, ["user"])._jdf.queryExecution().optimizedPlan().toString()
    assert "percentile(" not in plan
    for q in (0.0, 0.5, 0.99, 1.0):
        got = {r[0]: r[1] for r in metrics.quantile(df, ["user"], q).collect()}
        want = {r[0]: r[1] for r in df.groupBy("user").agg(F.percentile("value", q)).collect()}
        assert got.keys() == want.keys()
        for k, v in want.items():
            assert got[k] == v or np.isclose(got[k], v, rtol=1e-12), (k, q)


def test_counter_deltas_split_a_busy_minute(spark):
    """A third of all samples in one minute of one series."""
    from reelhouse.operators import metrics

    n = 12_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (F.col("id") % 40).cast("string"))).alias("s"),
        F.when(F.col("id") % 3 == 0, F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id") * 5))
        .otherwise(F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("id") * 700)).alias("ts"),
        F.col("id"),
        (F.col("id") % 97).cast("double").alias("value"),
    )
    got = metrics.increase(metrics.counter_deltas(df, ["s"], tiebreak=["id"]), ["s"], "30 days")
    from pyspark.sql.window import Window

    prev = F.lag("value").over(Window.partitionBy("s").orderBy("ts", "id"))
    plain = df.withColumn("d", F.when(F.col("value") < prev, F.col("value")).otherwise(F.col("value") - prev))
    want = {r.s: r.d for r in plain.groupBy("s").agg(F.sum("d").alias("d")).collect()}
    assert {r.s: r.increase for r in got.groupBy("s").agg(F.sum("increase").alias("increase")).collect()} == want
