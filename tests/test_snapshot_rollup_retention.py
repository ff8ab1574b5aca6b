import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from reelhouse.operators import analytics, clean, rollup
from reelhouse.sources import load, samples, snapshot

D = ["2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04"]
ITEMS = "id long, ingestion_date string, title string, popularity double"


def _day(spark, day, rows):
    return spark.createDataFrame([(i, D[day], t, p) for i, t, p in rows], ITEMS)


DAYS = {
    0: [(1, "a", 1.0), (2, "b", 2.0), (2, "b2", None), (None, "x", 1.0), (5, None, None)],
    2: [(2, "c", 0.5), (3, "d", 4.0), (3, "d", 4.0)],
    1: [(2, "late", 9.0), (1, "a2", 1.0), (4, "e", 1.0)],
    3: [],
}


def test_merging_dates_equals_one_dedup_over_all(spark):
    table = "snap_items"
    everything = None
    for day, rows in DAYS.items():
        part = _day(spark, day, rows)
        everything = part if everything is None else everything.unionByName(part)
        n = snapshot.merge_latest(spark, table, part, ["id"], ["ingestion_date"], buckets=4)
        want = clean.one_per_key(everything.filter("id is not null"), ["id"], ["ingestion_date"])
        got = spark.table(table)
        assert got.columns == want.columns
        assert sorted(got.collect()) == sorted(want.collect()) if day != 0 else n == 3
        assert n == got.count()
    before = sorted(map(str, spark.table(table).collect()))
    snapshot.merge_latest(spark, table, _day(spark, 2, DAYS[2]), ["id"], ["ingestion_date"], buckets=4)
    assert sorted(map(str, spark.table(table).collect())) == before  # the same date again
    with pytest.raises(Exception, match="half-way"):
        broken = _day(spark, 3, [(9, "z", 1.0)]).withColumn("title", F.raise_error(F.lit("half-way")).cast("string"))
        snapshot.merge_latest(spark, table, broken, ["id"], ["ingestion_date"], buckets=4)
    assert sorted(map(str, spark.table(table).collect())) == before
    load.drop_table(spark, table)


def test_the_snapshot_is_not_shuffled(spark):
    table = "snap_plan"
    snapshot.merge_latest(spark, table, _day(spark, 0, DAYS[0]), ["id"], ["ingestion_date"], buckets=4)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("3", "4", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            new = snapshot.merged(spark, table, _day(spark, 1, DAYS[1]), ["id"], ["ingestion_date"], 4)
            plan = new._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        scan = plan[: plan.index("FileScan")]
        assert "SortMergeJoin" in scan and "Exchange" not in scan and "Bucketed: true" in plan
    load.drop_table(spark, table)


def test_rollup_equals_the_distinct_counts(spark):
    n = 40_000  # two id ranges of a bitmap
    items = spark.range(n).select(
        (F.col("id") * 2 - 7).alias("movie_id"),
        F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.col("id") % 10).cast("double").alias("vote_average"),
        F.concat(F.lit("2024-01-0"), (F.col("id") % 3 + 1).cast("string")).alias("ingestion_date"),
    )
    pairs = items.select("movie_id", F.explode(F.array(F.lit(1), F.pmod("movie_id", F.lit(5)) + 2)).alias("genre_id"))
    genres = spark.createDataFrame([(g, f"g{g}") for g in range(1, 9)], "genre_id long, genre_name string")
    stored = rollup.genre_rollup(items, pairs)
    want = analytics.top_genres(items, pairs, genres, 6).collect()
    assert rollup.top_genres(stored, genres, 6).collect() == want and want[0].nb_items == n
    days = F.col("day") <= "2024-01-02"
    part = items.filter("ingestion_date <= '2024-01-02'")
    assert rollup.top_genres(stored, genres, 6, days).collect() == analytics.top_genres(part, pairs, genres, 6).collect()
    # an item that two rows of the rollup hold counts once
    twice = rollup.genre_counts(stored.unionByName(stored)).collect()
    assert {r.genre_id: r.nb_items for r in twice} == {r.genre_id: r.nb_items for r in rollup.genre_counts(stored).collect()}


T0 = dt.datetime(2024, 3, 1)


def _samples(spark, hours):
    rows = [(T0 + dt.timedelta(hours=h), float(h)) for h in hours]
    return spark.createDataFrame(rows, "ts timestamp_ntz, value double")


def test_range_reads_prune_days_and_expiry_drops_them(spark, tmp_path, capsys):
    path = str(tmp_path / "samples")
    df = _samples(spark, range(0, 240, 5))
    samples.write_samples(df, path)
    samples.write_samples(_samples(spark, [241]), path)  # added, not replaced
    since, until = T0 + dt.timedelta(hours=60), T0 + dt.timedelta(hours=100)
    part = samples.read_samples(spark, path, df.schema, since, until)
    assert sorted(r.value for r in part.collect()) == [float(h) for h in range(60, 101, 5)]
    part.explain("formatted")
    plan = capsys.readouterr().out
    assert re.search(r"PartitionFilters: \[.*day.* >= 2024-03-03.*day.* <= 2024-03-05", plan)
    assert "GreaterThanOrEqual(ts,2024-03-03T12:00)" in plan
    as_of = T0 + dt.timedelta(hours=241)
    gone = samples.expire_samples(spark, path, as_of, dt.timedelta(days=3))
    assert [d.day for d in gone] == list(range(1, 8))
    kept = samples.read_samples(spark, path, df.schema, T0, as_of)
    # whole days stay: the first one is that of the oldest instant kept
    assert min(r.ts for r in kept.collect()) == T0 + dt.timedelta(hours=170)
    assert samples.expire_samples(spark, path, as_of, dt.timedelta(days=3)) == []
