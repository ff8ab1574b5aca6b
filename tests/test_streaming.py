import os

from pyspark.sql import functions as F

from reelhouse.operators import metrics as batch
from reelhouse.plans import fixtures
from reelhouse.streaming import metrics as stream
from tests.conftest import SF_SMALL


def _file_stream(spark, tmp_path, df, name, parts=4):
    src = str(tmp_path / name)
    df.repartitionByRange(parts, "ts").write.parquet(src)
    _order_files(src)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)


def _order_files(src):
    """The file source takes files by modification time: give range-partitioned
    part files (ordered by event time) increasing times in part order."""
    parts = sorted(f for f in os.listdir(src) if f.endswith(".parquet"))
    for i, f in enumerate(parts):
        os.utime(os.path.join(src, f), (1_700_000_000 + i, 1_700_000_000 + i))


def _run(df, tmp_path, name, mode="append"):
    q = (
        df.writeStream.outputMode(mode)
        .format("memory")
        .queryName(name)
        .option("checkpointLocation", str(tmp_path / f"ckpt_{name}"))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return df.sparkSession.table(name)


def test_windowed_count_matches_batch_on_closed_windows(spark, tmp_path):
    ev = fixtures.event_samples(spark, SF_SMALL)
    out = _run(stream.windowed_count(_file_stream(spark, tmp_path, ev, "ev"), ["event_type"], "1 day", "1 hour"), tmp_path, "wc")
    got = {(r.event_type, r.window_start): r.rate_per_min for r in out.collect()}
    exp = {
        (r.event_type, r.ws): r.n * 60.0 / 86400.0
        for r in ev.groupBy("event_type", F.window("ts", "1 day").start.alias("ws")).count().withColumnRenamed("count", "n").collect()
    }
    bad = [(k, v, exp.get(k)) for k, v in got.items() if exp.get(k) != v]
    assert got and not bad, bad[:5]
    assert len(got) >= len(exp) - 5 * 2  # only the last open windows may be missing


def test_windowed_last_max_and_quantile(spark, tmp_path):
    ev = fixtures.event_samples(spark, SF_SMALL)
    s = _file_stream(spark, tmp_path, ev, "ev2")
    out = _run(stream.windowed_last_max(s, ["event_type"], "1 day", "1 hour", tiebreak=["event_id"]), tmp_path, "lm")
    got = {(r.event_type, r.window_start): (r.last_value, r.max_value) for r in out.collect()}
    b = ev.groupBy("event_type", F.window("ts", "1 day").start.alias("ws")).agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("l"), F.max("value").alias("m"))
    exp = {(r.event_type, r.ws): (r.l, r.m) for r in b.collect()}
    assert got and all(exp[k] == v for k, v in got.items())
    s2 = _file_stream(spark, tmp_path, ev, "ev3")
    qo = _run(stream.windowed_quantile(s2, ["event_type"], 0.99, "1 day", "1 hour"), tmp_path, "qt")
    assert qo.count() > 0


def test_labelled_counts_and_dedup(spark, tmp_path):
    names = fixtures.metric_names(spark, SF_SMALL)
    out = _run(stream.labelled_counts(_file_stream(spark, tmp_path, names, "nm"), window="30 days", lateness="1 hour"), tmp_path, "lc")
    got = {(r.dag_id, r.task_id, r.state, r.window_start): r.n_samples for r in out.collect()}
    mapped = batch.map_metric_names(names).filter(F.col("metric") == "airflow_ti_finish_total")
    by_window = mapped.groupBy("dag_id", "task_id", "state", F.window("ts", "30 days").start.alias("ws")).count()
    exp = {(r.dag_id, r.task_id, r.state, r.ws): r["count"] for r in by_window.collect()}
    # the last window is still open; every emitted window equals the batch counts
    assert got and all(exp[k] == v for k, v in got.items())
    ev = fixtures.event_samples(spark, SF_SMALL)
    doubled = ev.unionByName(ev)
    dd = _run(stream.dedup_events(_file_stream(spark, tmp_path, doubled, "dup"), ["event_id"], "1 hour"), tmp_path, "dd")
    assert dd.count() == ev.count()


def test_increase_stream_equals_batch(spark, tmp_path):
    cs = fixtures.counter_samples(spark, SF_SMALL)
    out = _run(stream.status_stream(_file_stream(spark, tmp_path, cs, "cs")), tmp_path, "inc")
    got = {(r.series, r.window_start): (r.increase, r.rate_status, r.failure_status) for r in out.collect()}
    daily = batch.increase(batch.counter_deltas(cs, ["event_type"], tiebreak=["event_id"]), ["event_type"], "1 day")
    per_min = F.col("increase") / 1440.0
    daily = daily.select("*", batch.rate_status(per_min).alias("rs"), batch.failure_status(F.col("increase")).alias("fs"))
    exp = {(r.event_type, r.window_start): (r.increase or 0.0, r.rs, r.fs) for r in daily.collect()}
    assert got and all(exp[k] == v for k, v in got.items())
    assert len(got) >= len(exp) - 5 * 2  # the open windows of five series


def test_out_of_order_samples_are_no_resets(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    row = lambda i, sec, v: (i, t0 + dt.timedelta(seconds=sec), "a", v)
    batches = [
        [row(1, 0, 1.0), row(2, 20, 5.0)],
        [row(3, 10, 3.0), row(4, 30, 6.0)],  # 10 s comes after 20 s, within the lateness
        [row(5, 40, 2.0), row(6, 3 * 86400, 4.0)],  # a reset; then far ahead
        [row(9, 3 * 86400 + 1, 4.0)],  # the watermark for late rows follows one batch behind
        [row(7, 5, 100.0), row(8, 4 * 86400, 5.0)],  # later than the lateness allows: dropped
    ]
    src = tmp_path / "ooo"
    schema = "event_id long, ts timestamp, event_type string, value double"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        for f in src.glob("*.parquet"):
            if f.stat().st_mtime > 1_700_000_100:
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = _run(stream.increase_stream(s), tmp_path, "ooo")
    # 1, 3, 5, 6 then a reset to 2: 5 + 2 on the first day
    assert [(r.window_start.day, r.increase) for r in out.orderBy("window_start").collect()][0] == (1, 7.0)


def test_rate_stream_job_is_exactly_once(spark, tmp_path):
    ev = fixtures.event_samples(spark, SF_SMALL)
    src = str(tmp_path / "src")
    ev.repartitionByRange(4, "ts").write.parquet(src)
    _order_files(src)
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt_job")
    for _ in range(2):  # the second run resumes and adds nothing
        q = stream.run_rate_stream(spark, src, sink, ev.schema, checkpoint=ckpt)
        q.awaitTermination()
    out = spark.read.parquet(sink)
    got = {(r.event_type, r.window_start): r.rate_per_min for r in out.collect()}
    assert out.count() == len(got)  # no duplicate windows after the restart
    exp = {
        (r.event_type, r.ws): float(r.n)
        for r in ev.groupBy("event_type", F.window("ts", "1 minute").start.alias("ws")).agg(F.count("*").alias("n")).collect()
    }
    assert got and all(exp[k] == v for k, v in got.items())
    assert len(got) >= len(exp) - 20  # only windows within the final watermark delay stay open


def test_a_silent_series_gets_its_last_window_by_the_watermark(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    row = lambda i, sec, s, v: (i, t0 + dt.timedelta(seconds=sec), s, v)
    batches = [
        [row(1, 0, "quiet", 1.0), row(2, 20, "quiet", 5.0), row(3, 10, "loud", 1.0)],
        [row(4, 86400 + 5, "loud", 4.0)],  # quiet never speaks again
        [row(5, 2 * 86400 + 5, "loud", 6.0)],
        [row(6, 3 * 86400, "loud", 7.0)],
    ]
    schema = "event_id long, ts timestamp, event_type string, value double"
    src = tmp_path / "quiet"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        for f in src.glob("*.parquet"):
            if f.stat().st_mtime > 1_700_000_100:
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = _run(stream.increase_stream(s), tmp_path, "quiet")
    got = sorted((r.series, r.window_start.day, r.increase) for r in out.collect())
    batch_rows = spark.createDataFrame([r for b in batches for r in b], schema)
    daily = batch.increase(batch.counter_deltas(batch_rows, ["event_type"], tiebreak=["event_id"]), ["event_type"], "1 day")
    want = sorted((r.event_type, r.window_start.day, r.increase or 0.0) for r in daily.collect())
    assert got == [w for w in want if w[1] <= 2 or w in got]  # days the watermark has passed
    assert ("quiet", 1, 4.0) in got and [g for g in got if g[0] == "loud"][:2] == [("loud", 1, 0.0), ("loud", 2, 3.0)]


def test_a_forgotten_series_starts_anew(spark, tmp_path):
    import datetime as dt

    t0 = dt.datetime(2024, 1, 1)
    rows = [(0, 1.0, "a"), (10, 3.0, "a"), (3 * 86400, 1.0, "b"), (6 * 86400, 9.0, "b"), (9 * 86400, 50.0, "a"), (9 * 86400 + 9, 53.0, "a"), (12 * 86400, 1.0, "b"), (15 * 86400, 2.0, "b")]
    schema = "event_id long, ts timestamp, event_type string, value double"
    src = tmp_path / "anew"
    for i, (sec, v, s) in enumerate(rows):
        spark.createDataFrame([(i, t0 + dt.timedelta(seconds=sec), s, v)], schema).coalesce(1).write.mode("append").parquet(str(src))
        for f in src.glob("*.parquet"):
            if f.stat().st_mtime > 1_700_000_100:
                os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(src))
    out = _run(stream.increase_stream(s, forget="2 days"), tmp_path, "anew")
    got = {(r.series, r.window_start.day): r.increase for r in out.collect()}
    assert got["a", 1] == 2.0 and got["a", 10] == 3.0  # not 50: the silent series was forgotten
