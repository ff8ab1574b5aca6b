import datetime as dt

from pyspark.sql import functions as F

from reelhouse.operators import metrics

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def _samples(spark, values, step_s=20, series="s"):
    rows = [(series, T0 + dt.timedelta(seconds=i * step_s), float(v), i) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "series string, ts timestamp, value double, seq long")


def test_increase_handles_reset(spark):
    d = metrics.counter_deltas(_samples(spark, [1, 2, 3, 1, 2]), ["series"], tiebreak=["seq"])
    inc = metrics.increase(d, ["series"], "1 day").collect()[0]
    assert inc.increase == 4.0


def test_deltas_cross_bucket_boundaries(spark):
    # 10-minute steps over 3 hours: predecessors come from the previous bucket
    vals = [1, 2, 4, 8, 3, 5, 6, 10, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    d = metrics.counter_deltas(_samples(spark, vals, step_s=600), ["series"], tiebreak=["seq"], bucket="1 hour")
    got = [r.delta for r in d.orderBy("seq").collect()]
    expect = [None] + [(v if v < p else v - p) for p, v in zip(vals, vals[1:])]
    assert got == expect


def test_rate_per_minute(spark):
    d = metrics.counter_deltas(_samples(spark, [0, 3, 6, 9], step_s=20), ["series"], tiebreak=["seq"])
    r = {row.window_start: row.rate_per_min for row in metrics.rate_per_minute(d, ["series"]).collect()}
    assert sorted(r.values()) == [3.0, 6.0]


def test_mapping_rules(spark):
    names = [
        ("airflow.ti.finish.d.t.success",),
        ("airflow.scheduler_heartbeat",),
        ("airflow.foo",),
        ("airflow.dag_processing.import_errors",),
        ("airflow.dag.d1.t1.duration",),
        ("airflow.dagrun.dependency-check.d2",),
    ]
    out = {r.name: r for r in metrics.map_metric_names(spark.createDataFrame(names, "name string")).collect()}
    r = out["airflow.ti.finish.d.t.success"]
    assert (r.metric, r.dag_id, r.task_id, r.state) == ("airflow_ti_finish_total", "d", "t", "success")
    assert out["airflow.scheduler_heartbeat"].metric == "airflow_scheduler_heartbeat"
    assert out["airflow.scheduler_heartbeat"].raw_metric is None  # explicit rule before the fallback
    assert (out["airflow.foo"].metric, out["airflow.foo"].raw_metric) == ("airflow_unmapped", "foo")
    un = out["airflow.dag_processing.import_errors"]
    assert (un.metric, un.raw_metric) == ("airflow_dag_processing_import_errors", None)
    assert (out["airflow.dag.d1.t1.duration"].dag_id, out["airflow.dag.d1.t1.duration"].task_id) == ("d1", "t1")
    assert out["airflow.dagrun.dependency-check.d2"].metric == "airflow_dagrun_dependency_check_seconds"


def test_mapping_matches_regex_semantics(spark):
    import re

    names = ["airflow.a", "airflow.", "airflow..x", "airflow.ti.start.x.", "airflow.ti.start.x.y.z", "other.a", "airflow"]
    names += ["other.my-dag:load time", "statsd.é/x", "airflow.pool.open-slots.default pool"]
    out = {r.name: r.metric for r in metrics.map_metric_names(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    for n in names:
        want = next((r.name for r in metrics.MAPPING_RULES if re.fullmatch(r.regex[1:-1], n)), re.sub("[^A-Za-z0-9_]", "_", n))
        assert out[n] == want, n


def test_last_max_quantile_sample(spark):
    s = _samples(spark, [5, 1, 7, 3], step_s=10)
    lm = metrics.last_and_max(s, ["series"], tiebreak=["seq"]).collect()[0]
    assert (lm.last_value, lm.max_value) == (3.0, 7.0)
    q = metrics.quantile(s, ["series"], 0.5).collect()[0]
    assert q.p50 == 4.0
    sm = sorted((r.step_start, r.value) for r in metrics.sample_last(s, ["series"], "15 seconds").collect())
    assert [v for _, v in sm] == [1.0, 7.0, 3.0]
    rng = metrics.in_range(s, "ts", F.lit(T0 + dt.timedelta(seconds=30)).cast("timestamp"), "15 seconds")
    assert sorted(r.value for r in rng.collect()) == [3.0, 7.0]


def test_status_thresholds(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (5.0,)], "r double")
    got = [(x.a, x.b) for x in df.select(metrics.rate_status(F.col("r")).alias("a"), metrics.failure_status(F.col("r")).alias("b")).collect()]
    assert got == [("red", "green"), ("yellow", "red"), ("green", "red")]


def test_null_labelled_series_is_its_own_series(spark):
    rows = [(None, T0 + dt.timedelta(seconds=i * 90), float(v), i) for i, v in enumerate([1, 3, 2, 5])]
    rows += [("a", T0 + dt.timedelta(seconds=i * 90), float(v), 10 + i) for i, v in enumerate([10, 11])]
    df = spark.createDataFrame(rows, "series string, ts timestamp, value double, seq long")
    d = metrics.counter_deltas(df, ["series"], tiebreak=["seq"])
    got = {(r.series, r.seq): r.delta for r in d.collect()}
    assert got == {(None, 0): None, (None, 1): 2.0, (None, 2): 2.0, (None, 3): 3.0, ("a", 10): None, ("a", 11): 1.0}
    assert d.columns == ["series", "ts", "value", "seq", "delta"]


def _increase_cases():
    # (series, hours before the instant, value)
    return [
        ("a", 30, 5.0), ("a", 25, 9.0), ("a", 23, 10.0), ("a", 2, 14.0), ("a", 1, 3.0),  # predecessor 9; a reset
        ("b", 50, 7.0),  # silent in the window
        ("c", 24, 2.0), ("c", 5, 6.0),  # a sample at the open end is the predecessor
        ("d", 3, 8.0), ("d", 0, 9.0),  # its first sample has no increase; the instant counts
        (None, 26, 1.0), (None, 4, 4.0), ("e", 1, None),
    ]


def test_trailing_increase_looks_back_no_further_than_it_must(spark, tmp_path, capsys):
    at = dt.datetime(2024, 1, 10, 12)
    rows = [(s, at - dt.timedelta(hours=h), v, i) for i, (s, h, v) in enumerate(_increase_cases())]
    rows.append(("a", at + dt.timedelta(hours=1), 500.0, 99))  # later than the instant
    path = str(tmp_path / "s")
    spark.createDataFrame(rows, "series string, ts timestamp_ntz, value double, seq long").write.parquet(path)
    df = metrics.trailing_increase(spark.read.parquet(path), ["series"], at, tiebreak=["seq"])
    assert df.collect()[0].increase == (1 + 4 + 3) + 4 + 1 + 3
    df.explain("formatted")
    plan = capsys.readouterr().out
    pushed = [x for x in plan.splitlines() if "PushedFilters" in x]
    recent = [x for x in pushed if "GreaterThan(ts,2024-01-09T12:00)" in x and "LessThanOrEqual(ts,2024-01-10T12:00)" in x]
    before = [x for x in pushed if "LessThanOrEqual(ts,2024-01-09T12:00)" in x]
    assert recent and before and len(recent) + len(before) == len(pushed)
    # the window and what is before it are read once each
    assert plan.split("== Initial Plan ==")[0].count("Scan parquet") == 2


def test_last_before_is_the_as_of_row(spark):
    s = _samples(spark, [5, 1, 7, 3], step_s=10)
    last = metrics.last_before(s, ["series"], F.lit(T0 + dt.timedelta(seconds=20)).cast("timestamp"), tiebreak=["seq"])
    assert [tuple(r) for r in last.collect()] == [("s", T0 + dt.timedelta(seconds=20), 7.0, 2)]


def test_quantile_orders_a_bounded_share_beside_an_outlier(spark):
    """One value of 1e12 in a hot group: equal-width ranges would put all others into one."""
    import numpy as np

    n = 60_000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 40).alias("user"),
        (F.col("id") * 7919 % 1_000_003).cast("double").alias("value"),
    ).unionByName(spark.createDataFrame([(0, 1e12), (0, -1e12)], "user long, value double"))
    out = metrics.quantile(df, ["user"], 0.99)
    got = {r.user: r.p99 for r in out.collect()}
    want = {r.user: r.p for r in df.groupBy("user").agg(F.percentile("value", 0.99).alias("p")).collect()}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k], rtol=1e-12) for k in want)
    # rows of the hot group that are ordered in the end
    rows = df.select(F.col("user").alias("_g0"), F.col("value").alias("_v"))
    ranges = metrics.quantile_ranges(rows, ["user"], 0.99).filter("_g0r = 0").collect()
    hot = df.filter("user = 0").count()
    assert 1 <= len(ranges) <= 2 and sum(r._m for r in ranges) < 0.05 * hot
