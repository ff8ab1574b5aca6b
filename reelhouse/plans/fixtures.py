"""Catalogue-shaped inputs derived from the driver's tables.

Every frame here is a lazy derivation over whole tables, so its work grows
with them:

* raw listing items  <- orders + line items (one item per order; genre codes
  from the parts of its lines; a second listing date for open orders, as an
  item re-listed the next day with a higher popularity)
* raw languages      <- the language code of every document
* raw genres         <- every part's genre code
* raw countries      <- nations with their region
* metric samples     <- events
"""

from __future__ import annotations

import os
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.sources.load import align_to_schema
from reelhouse.sources.schemas import RAW_ITEMS

# --- Fixed values of the fixtures -----------------------------------------
FIRST_DATE = "2024-01-01"
RELIST_DATE = "2024-01-02"
GENRE_CODES = 19
# Language code by o_custkey % 5: 0 en, 1 fr, 2 de, 3 xx, 4 NULL.
LANGUAGE_BY_CUSTOMER = ("en", "fr", "de", "xx")
# Language lookup: code, English name, native name.
LANGUAGE_NAMES = (
    ("en", "English", "English"),
    ("fr", "French", "Français"),
    ("de", "German", "Deutsch"),
    ("es", "Spanish", "Español"),
)
# Priority whose release date is left empty.
UNDATED_PRIORITY = "4-NOT SPECIFIED"
# Counter samples wrap around at this value.
COUNTER_WRAP = 1000
# Further metric names, by event_id modulo their number: one per mapping rule,
# and names that no rule matches.
SYSTEM_NAMES = (
    "airflow.dagrun.duration.success.my-dag",
    "airflow.dagrun.duration.failed.my-dag",
    "airflow.dag.my-dag.load.duration",
    "airflow.ti.finish.my-dag.load.skipped",
    "airflow.ti.start.my-dag.load",
    "airflow.dagrun.dependency-check.my-dag",
    "airflow.dagrun_succeeded",
    "airflow.dagrun_failed",
    "airflow.ti_successes",
    "airflow.ti_failures",
    "airflow.scheduler_heartbeat",
    "airflow.scheduler.tasks.running",
    "airflow.scheduler.tasks.executable",
    "airflow.executor.open_slots",
    "airflow.executor.running_tasks",
    "airflow.executor.queued_tasks",
    "airflow.zombies",
    "airflow.pool.open-slots.default pool",
    "statsd.my-dag:x",
)
# Task labels: task_<user_id % 10> in the pipeline "catalogue".
METRIC_DAG = "catalogue"
TASK_LABELS = 10


# Per live session (weakly held, so a stopped session's frames go with it).
_TABLES: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; the (immutable) DataFrame is defined once per session
    so its schema is inferred once, not in every query."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    frames = _TABLES.setdefault(spark, {})
    if path not in frames:
        frames[path] = spark.read.parquet(path)
    return frames[path]


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw listing rows with the fixed 15-column raw schema."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", (F.col("l_partkey") % GENRE_CODES).alias("g"), "l_quantity"
    )
    # collect_set keeps each array within GENRE_CODES elements whatever the
    # order size, and combines map-side before the shuffle.
    per_order = lines.groupBy("l_orderkey").agg(
        F.collect_set("g").alias("genre_ids"),
        F.count(F.lit(1)).alias("n"),
        F.sum("l_quantity").alias("q"),
    )
    orders = table(spark, sf_dir, "orders")
    lang = F.col("o_custkey") % 5
    lang_expr = F.when(lang == 0, LANGUAGE_BY_CUSTOMER[0])
    for i, code in enumerate(LANGUAGE_BY_CUSTOMER[1:], start=1):
        lang_expr = lang_expr.when(lang == i, code)
    # One row per listing date: every order on the first date, open orders
    # again on the re-listing date (one pass, no self-union).
    dates = F.when(F.col("o_orderstatus") == "O", F.array(F.lit(FIRST_DATE), F.lit(RELIST_DATE))).otherwise(
        F.array(F.lit(FIRST_DATE))
    )
    # The listing date is generated on the orders side, before the join, so
    # a filter on the date (one partition) is applied before joining.
    listed = orders.select("*", F.explode(dates).alias("ingestion_date"))
    joined = listed.join(per_order, listed["o_orderkey"] == per_order["l_orderkey"], "left")
    bump = F.when(F.col("ingestion_date") == RELIST_DATE, F.lit(1.0)).otherwise(F.lit(0.0))
    items = joined.select(
        (F.col("o_orderstatus") == "P").alias("adult"),
        "genre_ids",
        F.col("o_orderkey").alias("id"),
        lang_expr.alias("original_language"),
        F.col("o_orderpriority").alias("original_title"),
        F.concat(F.lit(" "), F.col("o_orderstatus"), F.lit(" ")).alias("overview"),
        (F.col("o_totalprice") / 2500.0 + bump).alias("popularity"),
        F.when(F.col("o_orderpriority") == UNDATED_PRIORITY, F.lit(""))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("release_date"),
        F.concat(F.lit("  "), F.col("o_orderpriority"), F.lit(" ")).alias("title"),
        (F.col("o_orderpriority") == "5-LOW").alias("video"),
        (F.col("q") / F.col("n") / 5.0).alias("vote_average"),
        F.col("n").alias("vote_count"),
        "ingestion_date",
    )
    # Display paths are not in the source: the fixed schema fills them NULL.
    return align_to_schema(items, RAW_ITEMS)


def raw_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language lookup rows, one per document (duplicated keys on purpose)."""
    code = F.col("lang")
    english = native = F.lit(None).cast("string")
    for c, en, nat in reversed(LANGUAGE_NAMES):
        english = F.when(code == c, F.lit(en)).otherwise(english)
        native = F.when(code == c, F.lit(nat)).otherwise(native)
    return table(spark, sf_dir, "documents").select(
        code.alias("iso_639_1"),
        english.alias("english_name"),
        native.alias("name"),
        F.lit(FIRST_DATE).alias("ingestion_date"),
    )


def raw_genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Genre lookup rows, one per part (duplicated keys on purpose)."""
    gid = F.col("p_partkey") % GENRE_CODES
    return table(spark, sf_dir, "part").select(
        gid.alias("id"),
        F.concat(F.lit("cat"), gid.cast("string")).alias("name"),
        F.lit(FIRST_DATE).alias("ingestion_date"),
    )


def raw_countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country lookup rows: nations with their region as native name."""
    nation = table(spark, sf_dir, "nation")
    region = F.broadcast(table(spark, sf_dir, "region"))  # regions: a fixed handful
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("iso_3166_1"),
        F.col("n_name").alias("english_name"),
        F.col("r_name").alias("native_name"),
        F.lit(FIRST_DATE).alias("ingestion_date"),
    )


def event_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric samples: ts, series label, user, value.

    ``ts`` stays ``timestamp_ntz`` (wall-clock time, as stored), so windows
    and day boundaries do not depend on the session time zone; the streaming
    forms convert it to ``timestamp`` for watermarks.
    """
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        "event_type",
        "user_id",
        "value",
    )


def counter_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A per-event-type counter that wraps around (resets) at a fixed width.

    The counter value seen with each event is the running event number
    modulo COUNTER_WRAP, plus one: it rises within a series and falls back
    when it wraps, like a fixed-width counter. A pure projection of events:
    no join, so the counter operators read and shuffle the samples once.
    """
    return event_samples(spark, sf_dir).select(
        "event_id",
        "ts",
        "event_type",
        "user_id",
        ((F.col("event_id") % COUNTER_WRAP) + 1).cast("double").alias("value"),
    )


def metric_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted metric names emitted by events, four per event: the specific
    name, a one-segment name, a two-segment name and one of SYSTEM_NAMES."""
    ev = event_samples(spark, sf_dir)
    task = F.concat(F.lit("task_"), (F.col("user_id") % TASK_LABELS).cast("string"))
    t = F.col("event_type")
    specific = (
        F.when(t == "view", F.concat(F.lit(f"airflow.dag.{METRIC_DAG}."), task, F.lit(".duration")))
        .when(t == "click", F.concat(F.lit(f"airflow.ti.start.{METRIC_DAG}."), task))
        .when(t == "purchase", F.concat(F.lit(f"airflow.ti.finish.{METRIC_DAG}."), task, F.lit(".success")))
        .when(t == "error", F.concat(F.lit(f"airflow.ti.finish.{METRIC_DAG}."), task, F.lit(".failed")))
        .when(t == "signup", F.lit("airflow.scheduler_heartbeat"))
        .otherwise(F.concat(F.lit("airflow."), t))
    )
    system = F.element_at(
        F.array(*[F.lit(n) for n in SYSTEM_NAMES]), (F.col("event_id") % len(SYSTEM_NAMES) + 1).cast("int")
    )
    names = F.array(specific, F.concat(F.lit("airflow."), t), F.concat(F.lit("airflow."), t, F.lit(".total")), system)
    return ev.select("event_id", "ts", "value", F.explode(names).alias("name"))
