"""Metric-series operators on Structured Streaming (M3-M11, streaming forms).

Event time must be ``timestamp`` (not ``timestamp_ntz``) for watermarks. The
watermark bounds the state each aggregate keeps: a window is emitted (append
mode) and its state dropped once the watermark passes the window end, so
state grows with the lateness allowed, not with the stream.

Counter increases need the previous sample of the series. Samples are first
summarised per (series, bucket) behind the watermark, natively: samples that
come in any order within the lateness are sorted inside their bucket, later
ones are dropped, and a hot series is split over its buckets. Only the
summaries, one row per series and bucket, reach the per-series state of the
same query (``transformWithState``: last value, open window and its sum), whose
event-time timers close the windows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from reelhouse.operators import metrics as batch


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Cast the event time to ``timestamp`` so it can carry a watermark."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def samples_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int | None = 1_000) -> DataFrame:
    """A file source of samples (Parquet); new files are new micro-batches of a bounded number of files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def windowed_count(
    stream: DataFrame,
    series: Sequence[str],
    window: str = "1 minute",
    lateness: str = "10 minutes",
    ts: str = "ts",
) -> DataFrame:
    """M3 on a stream of counter increments: events per series and window,
    scaled to per-minute."""
    seconds = _seconds(window)
    return (
        event_time(stream, ts)
        .withWatermark(ts, lateness)
        .groupBy(*series, F.window(ts, window).alias("w"))
        .agg((F.count(F.lit(1)) * F.lit(60.0) / F.lit(float(seconds))).alias("rate_per_min"))
        .select(*series, F.col("w.start").alias("window_start"), "rate_per_min")
    )


def windowed_last_max(
    stream: DataFrame,
    series: Sequence[str],
    window: str = "15 seconds",
    lateness: str = "1 minute",
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """M5/M7/M9: last and max value per series and window."""
    order = F.struct(*[F.col(c) for c in [ts, *tiebreak]])
    return (
        event_time(stream, ts)
        .filter(F.col(value).isNotNull())
        .withWatermark(ts, lateness)
        .groupBy(*series, F.window(ts, window).alias("w"))
        .agg(F.max_by(value, order).alias("last_value"), F.max(value).alias("max_value"))
        .select(*series, F.col("w.start").alias("window_start"), "last_value", "max_value")
    )


def windowed_quantile(
    stream: DataFrame,
    group: Sequence[str],
    q: float = 0.99,
    window: str = "1 day",
    lateness: str = "1 hour",
    ts: str = "ts",
    value: str = "value",
    accuracy: int = 10_000,
) -> DataFrame:
    """M6: approximate quantile per group and window (fixed-size sketch
    state per group, whatever the stream volume)."""
    return (
        event_time(stream, ts)
        .withWatermark(ts, lateness)
        .groupBy(*group, F.window(ts, window).alias("w"))
        .agg(F.percentile_approx(value, q, accuracy).alias(f"p{int(round(q * 100))}"))
        .select(*group, F.col("w.start").alias("window_start"), f"p{int(round(q * 100))}")
    )


def labelled_counts(
    stream: DataFrame,
    name_col: str = "name",
    metric: str = "airflow_ti_finish_total",
    labels: Sequence[str] = ("dag_id", "task_id", "state"),
    window: str = "1 day",
    lateness: str = "1 hour",
    ts: str = "ts",
) -> DataFrame:
    """M1 + M11: map dotted names, count one metric by labels per window."""
    mapped = batch.map_metric_names(event_time(stream, ts), name_col)
    return (
        mapped.filter(F.col("metric") == metric)
        .withWatermark(ts, lateness)
        .groupBy(*labels, F.window(ts, window).alias("w"))
        .agg(F.count(F.lit(1)).alias("n_samples"))
        .select(*labels, F.col("w.start").alias("window_start"), "n_samples")
    )


def dedup_events(stream: DataFrame, keys: Sequence[str], lateness: str = "10 minutes", ts: str = "ts") -> DataFrame:
    """Drop repeated deliveries of the same event within the watermark."""
    return event_time(stream, ts).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(list(keys))


# --- counters: bucket summaries, then a small state per series ---------------


def bucket_summaries(
    stream: DataFrame,
    series: str = "event_type",
    ts: str = "ts",
    value: str = "value",
    tiebreak: str = "event_id",
    bucket: str = "1 second",
    lateness: str = "1 minute",
) -> DataFrame:
    """(series, bucket, first, last, inner) per series and closed bucket:
    first and last value, and the increase between them (resets handled)."""
    s = event_time(stream, ts).filter(F.col(value).isNotNull()).withWatermark(ts, lateness)
    ordered = F.sort_array(F.collect_list(F.struct(ts, tiebreak, F.col(value).cast("double").alias("v"))))["v"]
    grouped = s.groupBy(F.col(series).cast("string").alias("series"), F.window(ts, bucket).alias("w")).agg(
        ordered.alias("v")
    )
    step = lambda p, x: F.when(x < p, x).otherwise(x - p)
    pairs = F.zip_with(F.slice("v", 1, F.size("v") - 1), F.slice("v", 2, F.size("v") - 1), step)
    return grouped.select(
        "series",
        F.col("w.start").alias("bucket"),
        F.element_at("v", 1).alias("first"),
        F.element_at("v", -1).alias("last"),
        F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x).alias("inner"),
    )


INCREASE_SCHEMA = "series string, window_start timestamp, increase double"


class WindowIncreases(StatefulProcessor):
    """Counter increases per series and window, closed by the watermark.

    State is one row per series: its last bucket and value, the open window and
    what it has counted. A window is given out by the event-time timer set at
    its end, so a series that falls silent gets its last window when the
    watermark passes, or at once when its next bucket lies in a later window.
    A second timer forgets a series that has been silent for ``forget``; should
    it speak again it starts anew, as a series does.
    """

    def __init__(self, seconds: int, forget: int):
        self._ms, self._forget = seconds * 1_000, forget * 1_000

    def init(self, handle) -> None:
        self._handle = handle
        # Times in milliseconds; window -1: none open.
        self._state = handle.getValueState("series", "bucket long, value double, window long, total double")

    def _out(self, key: tuple, window: int, total: float) -> tuple:
        return key[0], pd.Timestamp(window, unit="ms"), total

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        out = []
        known = self._state.get()
        seen, last, window, total = known if known is not None else (None, None, -1, 0.0)
        new = pd.concat(list(rows), ignore_index=True).sort_values("bucket")  # summaries, a few per micro-batch
        ms = new["bucket"].astype("datetime64[ms]").astype("int64")
        for at, first, end, inner in zip(ms, new["first"], new["last"], new["inner"]):
            start = at - at % self._ms
            if start != window:
                if window >= 0:
                    out.append(self._out(key, window, total))
                window, total = start, 0.0
                self._handle.registerTimer(window + self._ms)
            # As in the batch form the first sample of a series has no increase.
            carried = 0.0 if last is None else first if first < last else first - last
            total, last, seen = total + carried + inner, float(end), int(at)
        self._state.update((seen, last, int(window), float(total)))
        self._handle.registerTimer(seen + self._forget)
        yield pd.DataFrame(out, columns=["series", "window_start", "increase"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        out = []
        known = self._state.get()
        if known is not None:
            seen, last, window, total = known
            at = expiredTimerInfo.getExpiryTimeInMs()
            if window >= 0 and window + self._ms <= at:
                out.append(self._out(key, window, total))
                window, total = -1, 0.0
                self._state.update((seen, last, window, total))
            if seen + self._forget <= at:
                self._state.clear()
        yield pd.DataFrame(out, columns=["series", "window_start", "increase"])

    def close(self) -> None:
        pass


def increase_stream(samples: DataFrame, window: str = "1 day", forget: str = "30 days", **options) -> DataFrame:
    """M4 on a stream of samples, one query: (series, window_start, increase) of closed windows.

    ``options`` are those of ``bucket_summaries``. A window is given out once,
    when the watermark has passed its end or a later window of the series has
    begun. Needs the RocksDB state store (``stateful_session``).
    """
    stateful_session(samples.sparkSession)
    summaries = bucket_summaries(samples, **options)
    processor = WindowIncreases(_seconds(window), _seconds(forget))
    return summaries.groupBy("series").transformWithStateInPandas(
        processor, INCREASE_SCHEMA, outputMode="append", timeMode="eventTime"
    )


def stateful_session(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: it may outgrow the memory of an executor, and timers need it."""
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def status_stream(samples: DataFrame, window: str = "1 day", **options) -> DataFrame:
    """M8 on a stream: rate and failure lights of every closed window."""
    per_min = F.col("increase") / F.lit(_seconds(window) / 60.0)
    return increase_stream(samples, window, **options).select(
        "series",
        "window_start",
        "increase",
        per_min.alias("rate_per_min"),
        batch.rate_status(per_min).alias("rate_status"),
        batch.failure_status(F.col("increase")).alias("failure_status"),
    )


def _seconds(interval: str) -> int:
    n, unit = interval.split()
    unit = unit.rstrip("s")
    return int(n) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit]


# --- jobs ----------------------------------------------------------------------


def stream_checkpoint(spark: SparkSession, name: str) -> str:
    """Checkpoint folder of a named stream, under the shared checkpoint dir."""
    from reelhouse.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def run_rate_stream(
    spark: SparkSession,
    source_path: str,
    sink_path: str,
    schema,
    name: str = "metric_rate",
    series: Sequence[str] = ("event_type",),
    window: str = "1 minute",
    lateness: str = "10 minutes",
    checkpoint: str | None = None,
    available_now: bool = True,
):
    """M3 as a job: new sample files -> per-minute rates -> Parquet sink.

    Append mode emits a window once the watermark passes its end; the file
    sink and the checkpoint together make the output exactly-once across
    restarts (a re-run resumes from the checkpoint, files already processed
    are not read again).
    """
    stream = samples_stream(spark, source_path, schema)
    rates = windowed_count(stream, list(series), window, lateness)
    writer = (
        rates.writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint or stream_checkpoint(spark, name))
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="15 seconds")
    return writer.start()
