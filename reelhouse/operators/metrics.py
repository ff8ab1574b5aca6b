"""Metric-series operators, batch forms.

Samples are rows (ts, series labels..., value). Counter increases need each
sample's predecessor in its series. A window over the whole series would sort
a hot series in one task, so the predecessor is found in two levels: inside a
time bucket with ``lag`` (partitioned by series and bucket), and for the
first sample of a bucket from the last value of the previous non-empty bucket
(a bucket-level frame: one row per series and bucket, joined back).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelhouse.functions.expressions import wall_clock

# --- metric-name mapping (M1, M2) -------------------------------------------


@dataclass(frozen=True)
class MappingRule:
    match: str  # glob: '*' matches one dot-free segment
    name: str
    labels: dict[str, str] = field(default_factory=dict)  # label -> "$n"

    @property
    def regex(self) -> str:
        return "^" + self.match.replace(".", r"\.").replace("*", "([^.]*)") + "$"


# The scheduler's metric mapping rules, in match order (the
# last one is the fallback that keeps the raw name as a label).
MAPPING_RULES: tuple[MappingRule, ...] = (
    MappingRule("airflow.dagrun.duration.success.*", "airflow_dagrun_duration_success_seconds", {"dag_id": "$1"}),
    MappingRule("airflow.dagrun.duration.failed.*", "airflow_dagrun_duration_failed_seconds", {"dag_id": "$1"}),
    MappingRule("airflow.dag.*.*.duration", "airflow_task_duration_seconds", {"dag_id": "$1", "task_id": "$2"}),
    MappingRule("airflow.ti.finish.*.*.*", "airflow_ti_finish_total", {"dag_id": "$1", "task_id": "$2", "state": "$3"}),
    MappingRule("airflow.ti.start.*.*", "airflow_ti_start_total", {"dag_id": "$1", "task_id": "$2"}),
    MappingRule("airflow.dagrun.dependency-check.*", "airflow_dagrun_dependency_check_seconds", {"dag_id": "$1"}),
    MappingRule("airflow.dagrun_succeeded", "airflow_dagrun_succeeded_total"),
    MappingRule("airflow.dagrun_failed", "airflow_dagrun_failed_total"),
    MappingRule("airflow.ti_successes", "airflow_ti_successes_total"),
    MappingRule("airflow.ti_failures", "airflow_ti_failures_total"),
    MappingRule("airflow.scheduler_heartbeat", "airflow_scheduler_heartbeat"),
    MappingRule("airflow.scheduler.tasks.running", "airflow_scheduler_tasks_running"),
    MappingRule("airflow.scheduler.tasks.executable", "airflow_scheduler_tasks_executable"),
    MappingRule("airflow.executor.open_slots", "airflow_executor_open_slots"),
    MappingRule("airflow.executor.running_tasks", "airflow_executor_running_tasks"),
    MappingRule("airflow.executor.queued_tasks", "airflow_executor_queued_tasks"),
    MappingRule("airflow.*", "airflow_unmapped", {"raw_metric": "$1"}),
)
MAPPED_LABELS = ("dag_id", "task_id", "state", "raw_metric")


def _label_positions(rules: Sequence[MappingRule], label: str) -> list[int | None]:
    """Per rule, the 1-based segment holding ``label`` ($n = n-th ``*``)."""
    out: list[int | None] = []
    for r in rules:
        ref = r.labels.get(label)
        stars = [i + 1 for i, part in enumerate(r.match.split(".")) if part == "*"]
        out.append(stars[int(ref[1:]) - 1] if ref else None)
    return out


def map_metric_names(
    df: DataFrame,
    name_col: str = "name",
    rules: Sequence[MappingRule] = MAPPING_RULES,
    labels: Sequence[str] = MAPPED_LABELS,
) -> DataFrame:
    """M1/M2: add ``metric`` and one column per label.

    The first matching rule wins; a name no rule matches passes through with
    every other sign than letters, digits and underscores replaced by an
    underscore, and no labels. The index of the first
    matching rule is found once per row (``coalesce`` stops at the first
    match); the metric name and every label are then read by that index: a
    glob ``*`` is exactly one dot-free segment, so ``$n`` is a segment at a
    fixed position of the rule.
    """
    name = F.col(name_col)
    first = F.coalesce(*[F.when(name.rlike(r.regex), F.lit(i + 1)) for i, r in enumerate(rules)])
    df = df.withColumn("_rule", first).withColumn("_segs", F.split(name, r"\.", -1))
    rule = F.col("_rule")
    # An explicit CASE, not coalesce: element_at over a literal array of
    # non-null names is typed non-nullable, so a coalesce fallback would be
    # optimized away although a NULL index yields NULL.
    metric = F.when(rule.isNotNull(), F.element_at(F.array(*[F.lit(r.name) for r in rules]), rule)).otherwise(
        F.regexp_replace(name, "[^A-Za-z0-9_]", "_")
    )
    out = [metric.alias("metric")]
    for label in labels:
        pos = F.array(*[F.lit(p).cast("int") for p in _label_positions(rules, label)])
        idx = F.element_at(pos, rule)
        out.append(F.when(idx.isNotNull(), F.element_at(F.col("_segs"), idx)).alias(label))
    return df.select("*", *out).drop("_rule", "_segs")


# --- counters (W2, M3, M4) ------------------------------------------------------


def counter_deltas(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
    bucket: str = "1 second",
) -> DataFrame:
    """Per sample, the increase since the previous sample of its series.

    delta = value when the counter went down (reset), else value - previous;
    NULL for the first sample of a series (nothing to compare with).

    One window task sorts one (series, bucket) group, so ``bucket`` bounds
    the work of a task even for a very hot series or a busy minute of it (a
    series carrying a third of 100 TB over a month has about 13 MB per second).
    The bucket-level frame has at most one row per series and bucket.
    """
    series = list(series)
    order = [ts, *tiebreak]
    # Series are matched on non-null surrogate keys (text value + is-null
    # flag), as a null-safe join is planned: NULL-labelled samples form their
    # own series, and no NULL filter is inferred on one branch only, so the
    # two branches below stay identical and share one read and one shuffle.
    types = {c: samples.schema[c].dataType for c in series}
    s = samples.filter(F.col(value).isNotNull())
    keys: list[str] = []
    for i, c in enumerate(series):
        s = s.withColumn(f"_k{i}", F.coalesce(F.col(c).cast("string"), F.lit(""))).withColumn(
            f"_n{i}", F.col(c).isNull()
        )
        keys += [f"_k{i}", f"_n{i}"]
    s = s.drop(*series).withColumn("_bucket", F.window(ts, bucket).start)
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    whole = within.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # Both the predecessor and the bucket's last value come from the same
    # window, so the per-bucket frame shares the window's shuffle and needs
    # no exchange of its own.
    s = s.withColumn("_prev", F.lag(value).over(within)).withColumn("_last", F.last(value).over(whole))
    last = s.select(*keys, "_bucket", "_last").dropDuplicates([*keys, "_bucket"])
    across = Window.partitionBy(*keys).orderBy("_bucket")
    carry = last.select(*keys, "_bucket", F.lag("_last").over(across).alias("_carry"))
    prev = F.coalesce(F.col("_prev"), F.col("_carry"))
    v = F.col(value)
    delta = F.when(prev.isNull(), F.lit(None).cast("double")).when(v < prev, v).otherwise(v - prev)
    out = s.join(carry, [*keys, "_bucket"], "left").withColumn("delta", delta.cast("double"))
    for i, c in enumerate(series):
        out = out.withColumn(c, F.when(F.col(f"_n{i}"), F.lit(None)).otherwise(F.col(f"_k{i}")).cast(types[c]))
    rest = [c for c in samples.columns if c not in series]
    return out.select(*series, *rest, "delta")


def increase(
    deltas: DataFrame,
    series: Sequence[str],
    window: str = "1 day",
    ts: str = "ts",
) -> DataFrame:
    """M4: counter increase per series and tumbling window (resets handled)."""
    return deltas.groupBy(*series, F.window(ts, window).start.alias("window_start")).agg(
        F.sum("delta").alias("increase")
    )


def rate_per_minute(
    deltas: DataFrame,
    series: Sequence[str],
    window: str = "1 minute",
    window_seconds: int = 60,
    ts: str = "ts",
) -> DataFrame:
    """M3: rate(counter[window]) * 60 per series and tumbling window."""
    return deltas.groupBy(*series, F.window(ts, window).start.alias("window_start")).agg(
        (F.sum("delta") * F.lit(60.0) / F.lit(float(window_seconds))).alias("rate_per_min")
    )


def last_before(samples: DataFrame, series: Sequence[str], before: Column, ts: str = "ts", tiebreak: Sequence[str] = ()) -> DataFrame:
    """The last sample of each series up to an instant (as-of predecessor), whole rows.

    A plain aggregate, combined map-side: one row per series and task moves.
    """
    order = F.struct(*[F.col(c) for c in [ts, *tiebreak]])
    rest = [c for c in samples.columns if c not in series]
    kept = samples.filter(F.col(ts) <= before).groupBy(*series).agg(F.max_by(F.struct(*rest), order).alias("_s"))
    return kept.select(*series, "_s.*").select(*samples.columns)


def trailing_increase(
    samples: DataFrame,
    series: Sequence[str],
    at: dt.datetime,
    lookback: dt.timedelta = dt.timedelta(hours=24),
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """M4: ``sum(increase(counter[lookback]))`` over all series at an instant (one row).

    Only the samples of the look-back window are compared with each other; the
    window is a literal range of the time, so it is a pushed filter of their
    scan. Each series' sample before the window joins them as the predecessor
    of its first one, so an increase across the window's start counts.
    """
    until, since = (wall_clock(t, samples.schema[ts].dataType) for t in (at, at - lookback))
    known = samples.select(*series, ts, *tiebreak, value).filter(F.col(value).isNotNull())
    recent = known.filter((F.col(ts) <= until) & (F.col(ts) > since))
    both = recent.unionByName(last_before(known, series, since, ts, tiebreak))
    deltas = counter_deltas(both, series, ts, value, tiebreak).filter(F.col(ts) > since)
    return deltas.agg(F.coalesce(F.sum("delta"), F.lit(0.0)).alias("increase"))


# --- gauges (M5-M7, M9, M10) -------------------------------------------------


def last_and_max(
    samples: DataFrame,
    series: Sequence[str],
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """M5/M7: last non-NULL value (latest ts) and maximum per series.

    Both are plain aggregates, combined map-side before the shuffle.
    """
    order = F.struct(*[F.col(c) for c in [ts, *tiebreak]])
    return (
        samples.filter(F.col(value).isNotNull())
        .groupBy(*series)
        .agg(F.max_by(value, order).alias("last_value"), F.max(value).alias("max_value"))
    )


# Size parameter of the quantile sketches: a rank is right to about a quarter of a percent.
SKETCH_K = 2_048
# Ranks around the quantile at which a group's values are cut, as distances from it.
PIVOT_DISTANCES = (1 / 256, 1 / 64, 1 / 16, 1 / 4)


def _keyed(group: Sequence[str], suffix: str = "") -> list[str]:
    return [f"_g{i}{suffix}" for i in range(len(group))]


def _same_group(group: Sequence[str], suffix: str) -> Column:
    """Equality of the group's keys with those of the same names and a suffix (NULL equals NULL)."""
    pairs = zip(_keyed(group), _keyed(group, suffix))
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in pairs], F.lit(True))


def quantile_ranges(rows: DataFrame, group: Sequence[str], q: float, sketch_k: int = SKETCH_K) -> DataFrame:
    """The ranges of values that hold a group's quantile, at most two per group.

    ``rows``: the group's keys as ``_keyed`` names them, and ``_v``. Returns
    the keys with suffix r, the range's number, its smallest and largest value
    ``_lo`` and ``_hi``, the values in it and ``_before`` it, and the position
    of the quantile in the group.
    """
    keys = _keyed(group)
    known = rows.where("_v is not null")
    # One row per group: its count, the ranks around the quantile, the pivots.
    groups = rows.groupBy(*keys).agg(F.count("_v").alias("_n"), F.kll_sketch_agg_double("_v", F.lit(sketch_k)).alias("_s"))
    ranks = sorted({min(max(q + d * sign, 0.0), 1.0) for d in PIVOT_DISTANCES for sign in (-1, 1)})
    pivots = F.array(*[F.kll_sketch_get_quantile_double("_s", F.lit(r)) for r in ranks])
    pos = (F.col("_n") - 1) * F.lit(float(q))
    cut = groups.where("_n > 0").select(
        *[F.col(k).alias(f"{k}c") for k in keys], pos.alias("_pos"), F.floor(pos).alias("_below"), pivots.alias("_p")
    )
    # A value's range is the number of pivots up to it.
    number = reduce(lambda x, y: x + y, [(F.col("_v") >= F.get("_p", F.lit(i))).cast("int") for i in range(len(ranks))])
    placed = known.join(cut, _same_group(group, "c")).select(*keys, "_v", "_pos", "_below", number.alias("_r"))
    counted = placed.groupBy(*keys, "_r", "_pos", "_below").agg(
        F.count(F.lit(1)).alias("_m"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    running = Window.partitionBy(*keys).orderBy("_r")
    counted = counted.withColumn("_before", F.sum("_m").over(running) - F.col("_m"))
    needed = counted.where("_before <= _below + 1 and _before + _m > _below")
    return needed.select(*[F.col(k).alias(f"{k}r") for k in keys], F.col("_r").alias("_range"), "_pos", "_below", "_before", "_m", "_lo", "_hi")


def quantile(
    samples: DataFrame,
    group: Sequence[str],
    q: float = 0.99,
    value: str = "value",
    exact: bool = True,
    accuracy: int = 10_000,
    sketch_k: int = SKETCH_K,
) -> DataFrame:
    """M6: q-quantile per group (linear interpolation), NULL for groups without values.

    Exact without ordering or gathering a group, in three passes that shuffle
    a bounded number of rows per task and group, the last one also the rows
    around the quantile:

    1. a mergeable sketch per group (KLL, combined map-side) and the count of
       its values give pivots at ranks around the quantile;
    2. the values between neighbouring pivots are counted exactly, and the
       running counts tell which ranges hold the two ranks needed;
    3. only values of those ranges are counted by value and ordered.

    Pivots follow ranks, not values, so an outlier widens no range that
    matters, and a range holds about one in a hundred of a group's rows. The
    sketch only decides where the cuts are: the counts make the result exact
    wherever they fall. ``exact=False`` uses ``percentile_approx``.
    """
    name = f"p{int(round(q * 100))}"
    group = list(group)
    if not exact:
        return samples.groupBy(*group).agg(F.percentile_approx(value, q, accuracy).alias(name))
    keys = _keyed(group)
    rows = samples.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(value).cast("double").alias("_v"))
    needed = quantile_ranges(rows, group, q, sketch_k)
    inside = Window.partitionBy(*keys, "_range").orderBy("_v")
    ranked = (
        rows.where("_v is not null")
        .join(needed, _same_group(group, "r") & (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
        .groupBy(*keys, "_range", "_pos", "_below", "_before", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.col("_before") + F.sum("_n").over(inside))
        .where("_end > _below and _end - _n <= _below + 1")
    )
    low = F.min(F.when(F.col("_end") > F.col("_below"), F.col("_v")))
    high = F.min(F.when(F.col("_end") > F.col("_below") + 1, F.col("_v")))
    part = F.first("_pos") - F.first("_below")
    found = ranked.groupBy(*keys).agg((low + (F.coalesce(high, low) - low) * part).alias(name))
    # Groups that have NULL values only still get their row.
    rest = rows.groupBy(*keys).agg(F.max("_v").alias(name)).where(F.col(name).isNull())
    return found.unionByName(rest).select(*[F.col(k).alias(g) for k, g in zip(keys, group)], name)


def in_range(samples: DataFrame, ts: str, as_of: Column, lookback: str) -> DataFrame:
    """Samples with as_of - lookback <= ts <= as_of."""
    return samples.filter((F.col(ts) <= as_of) & (F.col(ts) >= as_of - F.expr(f"INTERVAL {lookback}")))


def sample_last(
    samples: DataFrame,
    series: Sequence[str],
    step: str = "15 seconds",
    ts: str = "ts",
    value: str = "value",
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """M9: one value per series and step: the last sample in the step."""
    order = F.struct(*[F.col(c) for c in [ts, *tiebreak]])
    return (
        samples.filter(F.col(value).isNotNull())
        .groupBy(*series, F.window(ts, step).start.alias("step_start"))
        .agg(F.max_by(value, order).alias("value"))
    )


# --- status and counts (M8, M11) ------------------------------------------------

# Stat thresholds. Rate: green >= 5, yellow >= 1, else red.
# Failures: red from 1 up.
RATE_GREEN = 5.0
RATE_YELLOW = 1.0
FAILURE_RED = 1.0


def rate_status(c: Column, green: float = RATE_GREEN, yellow: float = RATE_YELLOW) -> Column:
    """M8: traffic light of a rate stat."""
    return F.when(c >= green, "green").when(c >= yellow, "yellow").otherwise("red")


def failure_status(c: Column, red: float = FAILURE_RED) -> Column:
    """M8: red as soon as one failure is counted."""
    return F.when(c >= red, "red").otherwise("green")


def counts_by_labels(mapped: DataFrame, metric: str, labels: Sequence[str]) -> DataFrame:
    """Samples of one mapped metric counted by its labels."""
    return (
        mapped.filter(F.col("metric") == metric)
        .groupBy(*labels)
        .agg(F.count(F.lit(1)).alias("n_samples"))
    )
