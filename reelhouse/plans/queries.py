"""Registered queries: one callable (spark, sf_dir) -> DataFrame per key.

Each query reads the driver's tables (or frames Spark derives from them)
whole. Arrays are reported as sorted comma lists and timestamps as
``timestamp_ntz`` so results compare engine-independently.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.expressions import date_key, explode_distinct
from reelhouse.operators import analytics, clean, marts, metrics, quality, rollup
from reelhouse.plans import fixtures, pipeline
from reelhouse.plans.catalogue import Catalogue
from reelhouse.session import scratch_path, sized
from reelhouse.sources import drift, io, load, samples, schemas, snapshot
from reelhouse.sources.load import align_to_schema, load_all
from reelhouse.sources.schemas import schema_of

from pyspark.sql.types import DateType, DoubleType, LongType, StringType

# Fixed values of the registered queries.
# Reference date of the recent flag, so results do not drift with the clock.
AS_OF = "2001-01-01"
DISCOVER_PAGE = 3
PAGE_IDS = 250
MAX_PAGES = 3
TOP_GENRES = 5
ACCEPTED_LANGUAGES = ("en", "fr", "de")
P99_SERIES = "view"
SAMPLE_STEP = "15 seconds"
RETENTION = "7 days"
RETENTION_DAYS = 7
RANGE_HOURS = 36
THIRD_DATE = "2024-01-03"
SNAPSHOT_BUCKETS = 16

ANALYST_SQL = f"""
    SELECT g.genre_name, COUNT(DISTINCT b.movie_id) AS nb_items, ROUND(AVG(f.vote_average), 2) AS mean_vote
    FROM fact_items f
    JOIN bridge_item_genre b USING (movie_id)
    JOIN dim_genre g USING (genre_id)
    GROUP BY g.genre_name
    ORDER BY nb_items DESC, genre_name
    LIMIT {TOP_GENRES}"""

ORDERS_TARGET = schema_of(
    ("o_orderkey", LongType()),
    ("o_custkey", LongType()),
    ("o_orderstatus", StringType()),
    ("o_totalprice", DoubleType()),
    ("o_orderdate", DateType()),
    ("o_orderpriority", StringType()),
)


def genre_list(c: str = "genre_ids") -> Column:
    """Sorted comma list of an array (order-independent representation)."""
    return F.array_join(F.array_sort(F.col(c)).cast("array<string>"), ",")


def _ntz(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("timestamp_ntz")


# --- staging / curated ------------------------------------------------------------


def q_scan_partition(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_items(spark, d)
    part = raw.filter(F.col(io.PARTITION_COL) == F.lit(fixtures.RELIST_DATE))
    return part.select(
        "id", "title", "original_language", genre_list().alias("genre_list"), "popularity",
        "release_date", "vote_average", "vote_count", "adult", "video", "ingestion_date",
    )


def q_stamp_date(spark: SparkSession, d: str) -> DataFrame:
    return io.stamp_date(fixtures.table(spark, d, "nation"), fixtures.FIRST_DATE)


def q_clean_items(spark: SparkSession, d: str) -> DataFrame:
    items = clean.clean_items(fixtures.raw_items(spark, d))
    return items.withColumn("genre_ids", genre_list()).withColumnRenamed("genre_ids", "genre_list")


def q_clean_lookup(spark: SparkSession, d: str) -> DataFrame:
    customers = fixtures.table(spark, d, "customer")
    return clean.clean_lookup(customers, "c_nationkey", order_by=["c_custkey"], latest=False)


def q_dedup_latest(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_items(spark, d).select("id", "ingestion_date", "popularity", "title")
    return clean.one_per_key(raw.filter(F.col("id").isNotNull()), ["id"], order_by=["ingestion_date"])


def q_reject_counts(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_items(spark, d)
    return clean.reject_counts(raw, clean.clean_items(raw, columns=("movie_id",)))


def q_items_enriched(spark: SparkSession, d: str) -> DataFrame:
    return Catalogue.from_tables(spark, d, AS_OF).movies_enriched


def q_bridge_item_genre(spark: SparkSession, d: str) -> DataFrame:
    return Catalogue.from_tables(spark, d, AS_OF).movie_genres


def q_distinct_pairs(spark: SparkSession, d: str) -> DataFrame:
    return analytics.distinct_pairs(fixtures.table(spark, d, "lineitem"), "l_orderkey", "l_partkey")


def _mart(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return Catalogue.from_tables(spark, d, AS_OF).model(name)

    run.__name__ = f"q_{name}"
    return run


def q_dim_date(spark: SparkSession, d: str) -> DataFrame:
    """Calendar covering the whole years of the order dates."""
    bounds = fixtures.table(spark, d, "orders").agg(
        F.make_date(F.year(F.min("o_orderdate")), F.lit(1), F.lit(1)).alias("start"),
        F.make_date(F.year(F.max("o_orderdate")), F.lit(12), F.lit(31)).alias("end"),
    )
    return marts.dim_date_between(bounds)


def q_fact_by_calendar(spark: SparkSession, d: str) -> DataFrame:
    """From the fact columns it counts: no language lookup on the way."""
    cat = Catalogue.from_tables(spark, d, AS_OF, item_columns=("movie_id", "release_date", "vote_count", "popularity"))
    fact = cat.stg_items_clean.select(date_key("release_date").alias("release_date_id"), "vote_count", "popularity")
    return marts.fact_by_calendar(fact, cat.dim_date, marts.calendar_days())


def q_load_by_name(spark: SparkSession, d: str) -> DataFrame:
    src = fixtures.table(spark, d, "orders").selectExpr(
        "o_totalprice AS O_TOTALPRICE",
        "o_orderdate AS o_OrderDate",
        "o_orderkey AS O_ORDERKEY",
        "o_custkey",
        "o_orderstatus AS O_OrderStatus",
        "length(o_orderpriority) AS o_extra",
    )
    return align_to_schema(src, ORDERS_TARGET)


def q_row_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts from the columns that decide them: keys and genre arrays. The
    dimension joins of the enriched items, fact and pairs look up unique keys,
    so these have the rows of the items and of the exploded arrays."""
    cat = Catalogue.from_tables(spark, d, AS_OF, item_columns=("movie_id", "genre_ids"))
    items = cat.stg_items_clean.select("movie_id")
    pairs = cat.stg_items_clean.select("movie_id", explode_distinct("genre_ids").alias("genre_id"))
    return analytics.row_counts(
        {
            "raw_items": cat.raw.items,
            "stg_items": items,
            "movies_enriched": items,
            "movie_genres": pairs,
            "fact_items": items,
            "bridge_item_genre": pairs,
            "dim_genre": cat.dim_genre.select("genre_id"),
            "dim_country": cat.dim_country.select("country_code"),
            "dim_language": cat.dim_language.select("language_code"),
            "dim_date": cat.dim_date,
        }
    )


# --- the lake and the tables, really written and read ------------------------------


def _lake(spark: SparkSession, d: str, dates=(fixtures.FIRST_DATE, fixtures.RELIST_DATE)) -> str:
    """A lake with the raw listing in one partition per date."""
    root = scratch_path(spark, "lake")
    raw = fixtures.raw_items(spark, d)
    for day in dates:
        io.write_partition(raw.filter(F.col(io.PARTITION_COL) == F.lit(day)), root, "raw", "movies", day)
    return root


def _listed(df: DataFrame) -> DataFrame:
    return df.select(
        "id", "title", "original_language", genre_list().alias("genre_list"), "popularity",
        "release_date", "vote_average", "vote_count", "adult", "video", "ingestion_date",
    )


def q_lake_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    root = _lake(spark, d)
    return _listed(io.read_partition(spark, root, "raw", "movies", fixtures.RELIST_DATE, schemas.RAW_ITEMS))


def q_lake_rerun_empty(spark: SparkSession, d: str) -> DataFrame:
    """Rows per date after the second date was written again without rows."""
    root = _lake(spark, d)
    empty = io.empty_frame(spark, schemas.RAW_ITEMS)
    io.write_partition(empty, root, "raw", "movies", fixtures.RELIST_DATE)
    days = {
        day: io.read_partition(spark, root, "raw", "movies", day, schemas.RAW_ITEMS)
        for day in (fixtures.FIRST_DATE, fixtures.RELIST_DATE)
    }
    return analytics.row_counts(days, "ingestion_date")


def _page_documents(spark: SparkSession, d: str, ids: int) -> DataFrame:
    """The first listing as page documents of ``ids`` ids each; page numbers without an item are pages too."""
    raw = fixtures.raw_items(spark, d).filter(F.col(io.PARTITION_COL) == F.lit(fixtures.FIRST_DATE))
    item = schemas.PAGE_DOCUMENT["results"].dataType.elementType.fieldNames()
    page = (F.floor(F.col("id") / ids) + 1).cast("long")
    last = raw.select(F.max(page).alias("total_pages"))
    docs = raw.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*item)).alias("results"))  # <= ids rows a page
    every = last.select("total_pages", F.explode(F.sequence(F.lit(1).cast("long"), "total_pages")).alias("page"))
    return every.join(docs, "page", "left")


def _save_pages(docs: DataFrame, path: str) -> None:
    docs.write.mode("overwrite").option("maxRecordsPerFile", 1).json(path)  # a document is a file


def q_pages_landed(spark: SparkSession, d: str) -> DataFrame:
    """The first listing saved as JSON documents of up to 1,000 ids, read back as rows."""
    path = scratch_path(spark, "pages")
    _save_pages(_page_documents(spark, d, 1_000), path)
    rows = io.read_pages(spark, path, schemas.PAGE_DOCUMENT)
    return rows.select("id", "title", genre_list().alias("genre_list"), "popularity", "release_date", "vote_count")


def q_pages_complete(spark: SparkSession, d: str) -> DataFrame:
    """What is amiss with a listing whose pages were partly lost and partly saved twice."""
    path = scratch_path(spark, "pages")
    docs = _page_documents(spark, d, PAGE_IDS).filter(F.col("page") % 5 != 3)
    again = F.when(F.col("page") % 4 == 0, 2).otherwise(1)
    _save_pages(docs.select("*", F.explode(F.sequence(F.lit(1), again))).drop("col"), path)
    return io.page_report(spark, path, schemas.PAGE_DOCUMENT)


def q_lake_rerun_failed(spark: SparkSession, d: str) -> DataFrame:
    """Rows and votes per date after a second write of the second date has failed half-way."""
    root = _lake(spark, d)
    raw = fixtures.raw_items(spark, d).filter(F.col(io.PARTITION_COL) == F.lit(fixtures.RELIST_DATE))
    last = raw.select(F.max("id")).scalar()
    broken = raw.withColumn("id", F.when(F.col("id") == last, F.raise_error(F.lit("lost half-way")).cast("long")).otherwise(F.col("id")))
    try:
        io.write_partition(broken, root, "raw", "movies", fixtures.RELIST_DATE)
    except PySparkException as e:
        if "lost half-way" not in str(e):
            raise
    else:
        raise AssertionError("the broken write did not fail")
    days = [
        io.read_partition(spark, root, "raw", "movies", day, schemas.RAW_ITEMS)
        for day in (fixtures.FIRST_DATE, fixtures.RELIST_DATE)
    ]
    return days[0].unionByName(days[1]).groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("vote_count").alias("n_votes")
    )


def q_load_versions(spark: SparkSession, d: str) -> DataFrame:
    """What a reader of a table sees, and the versions there are, after a load, a load that
    died before publishing, a load that failed, and a good one."""
    raw = fixtures.raw_items(spark, d)
    first, second = (raw.filter(F.col(io.PARTITION_COL) == F.lit(day)) for day in (fixtures.FIRST_DATE, fixtures.RELIST_DATE))
    rows = []

    def seen(step: str) -> None:
        now = spark.table(table).agg(F.count(F.lit(1)), F.sum("vote_count")).first()
        rows.append((step, now[0], now[1], len(load.table_versions(spark, table))))

    with _namespace(spark, "load") as namespace:
        table = f"{namespace}.movies"
        load.load_table(spark, first, table, schemas.RAW_ITEMS)
        seen("1 loaded")
        load.write_version(spark, second, table, schemas.RAW_ITEMS)
        seen("2 died before publishing")
        try:
            load.load_table(spark, second.withColumn("vote_count", F.col("original_title")), table, schemas.RAW_ITEMS)
        except PySparkException:
            seen("3 failed")
        load.load_table(spark, second, table, schemas.RAW_ITEMS)
        seen("4 loaded again")
    return spark.createDataFrame(rows, "step string, n_rows long, n_votes long, n_versions int")


def q_load_counts(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the five loaded tables, loaded twice, counted in the tables."""
    cat = Catalogue.from_tables(spark, d, AS_OF)
    cat.materialize("stg_items_clean")
    namespace = f"load_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {namespace}")
    try:
        for _ in range(2):
            loaded = load_all(spark, cat.curated(), schemas.WAREHOUSE_TABLES, namespace).collect()
        counts = {t: spark.table(f"{namespace}.{t}").count() for t in schemas.WAREHOUSE_TABLES}
    finally:
        spark.sql(f"DROP DATABASE {namespace} CASCADE")
    rows = [(r.dataset, r.n_rows, counts[r.dataset], r.status) for r in loaded]
    return spark.createDataFrame(rows, "dataset string, n_rows long, n_table long, status string")


@contextmanager
def _namespace(spark: SparkSession, kind: str) -> Iterator[str]:
    """A database of its own for the time of a query that loads tables."""
    name = f"{kind}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def q_latest_merge(spark: SparkSession, d: str) -> DataFrame:
    """The latest row per item after three dates, merged into the snapshot one by one."""
    raw = fixtures.raw_items(spark, d).select("id", "ingestion_date", "popularity", "title")
    first, second = (raw.filter(F.col(io.PARTITION_COL) == F.lit(day)) for day in (fixtures.FIRST_DATE, fixtures.RELIST_DATE))
    third = first.filter(F.col("id") % 3 == 0).withColumn("ingestion_date", F.lit(THIRD_DATE))
    third = third.withColumn("popularity", F.col("popularity") * 2)
    path = scratch_path(spark, "latest")
    with _namespace(spark, "latest") as namespace:
        table = f"{namespace}.items"
        for rows in (first, third, second):  # a late date changes nothing that is newer
            snapshot.merge_latest(spark, table, rows, ["id"], ["ingestion_date"], SNAPSHOT_BUCKETS)
        spark.table(table).write.parquet(path)
    return spark.read.schema(raw.schema).parquet(path)


def q_dated_run(spark: SparkSession, d: str) -> DataFrame:
    """The whole run of a date, from saved pages and lookups to the tested marts: its log."""
    src, root = scratch_path(spark, "extract"), scratch_path(spark, "lake")
    raw = Catalogue.from_tables(spark, d, AS_OF)
    _save_pages(_page_documents(spark, d, 1_000), f"{src}/pages")
    lookups = {
        "genres.json": (raw.stg_genres_clean, F.to_json(F.struct(F.col("rows").alias("genres")))),
        "countries.json": (raw.stg_countries_clean, F.to_json("rows")),
        "languages.json": (raw.stg_languages_clean, F.to_json("rows")),
    }
    for name, (rows, document) in lookups.items():  # one document each, of the distinct codes
        one = F.struct(*[c for c in rows.columns if c != io.PARTITION_COL])
        rows.agg(F.collect_list(one).alias("rows")).select(document).write.text(f"{src}/{name}")
    landed = pipeline.ingest_json(spark, src, root, fixtures.FIRST_DATE)
    log = [("ingest", k, n, "success") for k, n in landed.items()]
    with _namespace(spark, "run_raw") as namespace, _namespace(spark, "run_marts") as marts_ns:
        table = f"{marts_ns}.run_log"
        pipeline.run_pipeline(
            spark, root, fixtures.FIRST_DATE, AS_OF, namespace, marts_ns, fail_on_test=False, log_table=table
        )
        log += [tuple(r) for r in spark.table(table).select("layer", "dataset", "n_rows", "status").collect()]
    return spark.createDataFrame(log, pipeline.LOG_SCHEMA)


def q_drift_gate(spark: SparkSession, d: str) -> DataFrame:
    """Rows per listing status that staging reads after the gate has set drifted files aside,
    and how many files it set aside: one status lacks a column, one has another type."""
    root = scratch_path(spark, "lake")
    raw = fixtures.raw_items(spark, d).drop(io.PARTITION_COL)
    leaf = f"{io.dataset_path(root, 'raw', 'movies')}/{io.PARTITION_COL}={fixtures.FIRST_DATE}"
    status = F.trim("overview")
    parts = {
        "F": raw.filter(status == "F"),
        "O": raw.filter(status == "O").withColumn("vote_count", F.col("vote_count").cast("string")),
        "P": raw.filter(status == "P").drop("title").withColumn("tagline", F.lit("x")),
    }
    with sized(spark, fixtures.table(spark, d, "lineitem").count()):
        parts.pop("F").write.mode("append").parquet(leaf)
        for part in parts.values():  # one part file of each kind: tasks do the work, the last one copies stored rows
            stored = scratch_path(spark, "drifted")
            part.write.parquet(stored)
            spark.read.schema(part.schema).parquet(stored).coalesce(1).write.mode("append").parquet(leaf)
    n = drift.drift_gate(spark, root, "raw", "movies", fixtures.FIRST_DATE, schemas.RAW_ITEMS, set_aside=True)
    rows = io.read_partition(spark, root, "raw", "movies", fixtures.FIRST_DATE, schemas.RAW_ITEMS)
    return rows.groupBy(F.trim("overview").alias("status")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("vote_count").alias("n_votes")
    ).withColumn("n_drifted", F.lit(n).cast("long"))


# --- analytics -------------------------------------------------------------------------


def _listing(spark: SparkSession, d: str) -> DataFrame:
    raw = fixtures.raw_items(spark, d)
    return raw.filter(F.col("ingestion_date") == F.lit(fixtures.FIRST_DATE))


def q_discover_page(spark: SparkSession, d: str) -> DataFrame:
    page = analytics.discover_page(_listing(spark, d), DISCOVER_PAGE)
    return page.select("id", "title", "popularity", "release_date")


def q_top_k_popular(spark: SparkSession, d: str) -> DataFrame:
    top = analytics.top_k_popular(_listing(spark, d), MAX_PAGES)
    return top.select("id", "title", "popularity", "release_date")


def q_top_genres(spark: SparkSession, d: str) -> DataFrame:
    """Fact and bridge from the three columns the ranking needs: no language
    lookup, no stored layer; both sides of the item join come from the dedup's
    partitioning."""
    cat = Catalogue.from_tables(spark, d, AS_OF, item_columns=("movie_id", "genre_ids", "vote_average"))
    pairs = cat.stg_items_clean.select("movie_id", explode_distinct("genre_ids").alias("genre_id"))
    return analytics.top_genres(cat.stg_items_clean, pairs, cat.dim_genre, TOP_GENRES)


def q_top_genres_rollup(spark: SparkSession, d: str) -> DataFrame:
    """The ranking from a stored daily rollup with bitmaps."""
    cat = Catalogue.from_tables(spark, d, AS_OF, item_columns=("movie_id", "genre_ids", "vote_average"))
    pairs = cat.stg_items_clean.select("movie_id", explode_distinct("genre_ids").alias("genre_id"))
    path = scratch_path(spark, "rollup")
    rollup.genre_rollup(cat.stg_items_clean, pairs).write.partitionBy("day").parquet(path)
    return rollup.top_genres(spark.read.parquet(path), cat.dim_genre, TOP_GENRES)


def q_views_top_genres(spark: SparkSession, d: str) -> DataFrame:
    """The analyst's SQL over the models as views, the models over loaded tables of a named source."""
    cat = Catalogue.from_tables(spark, d, AS_OF)
    with sized(spark, fixtures.table(spark, d, "lineitem").count()), _namespace(spark, "src") as namespace:
        cat.materialize("stg_items_clean")
        load_all(spark, cat.curated(), schemas.WAREHOUSE_TABLES, namespace)
        models = pipeline.warehouse_catalogue(spark, namespace, AS_OF)
        views = models.register_views(("fact_items", "bridge_item_genre", "dim_genre"))
        try:
            rows = spark.sql(ANALYST_SQL).collect()  # TOP_GENRES rows
        finally:
            for view in views:
                spark.catalog.dropTempView(view)
    return spark.createDataFrame(rows, "genre_name string, nb_items long, mean_vote double")


def q_listing_after(spark: SparkSession, d: str) -> DataFrame:
    """The listing page after the row that ends page DISCOVER_PAGE - 1, by key."""
    before = analytics.discover_page(_listing(spark, d), DISCOVER_PAGE - 1).orderBy("popularity", F.desc("id"))
    end = before.select("popularity", "id").first()  # one row: the client's bookmark
    page = analytics.listing_after(_listing(spark, d), tuple(end) if end else None)
    return page.select("id", "title", "popularity", "release_date")


# --- data quality ------------------------------------------------------------------------


def q_dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique(fixtures.table(spark, d, "lineitem"), "l_orderkey")


def q_dq_unique_combination(spark: SparkSession, d: str) -> DataFrame:
    return quality.unique_combination(fixtures.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    return quality.null_counts(fixtures.raw_items(spark, d))


def q_dq_accepted_values(spark: SparkSession, d: str) -> DataFrame:
    return quality.accepted_values(fixtures.raw_items(spark, d), "original_language", ACCEPTED_LANGUAGES)


def q_dq_relationships(spark: SparkSession, d: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, d, AS_OF, item_columns=("movie_id", "original_language"))
    fact = cat.stg_items_clean.select("movie_id", F.col("original_language").alias("language_code"))
    orphans = quality.relationships(fact, "language_code", cat.dim_language, "language_code")
    return orphans.select("movie_id", "language_code")


def q_dq_suite(spark: SparkSession, d: str) -> DataFrame:
    cat = Catalogue.from_tables(spark, d, AS_OF)
    # The checks read 17 models built from the cleaned items: those are
    # stored once (shared checkpoint folder), so the raw chain runs once.
    cat.materialize("stg_items_clean")
    names = {c.model for c in quality.CATALOGUE_SUITE} | {c.parent for c in quality.CATALOGUE_SUITE if c.parent}
    names |= set(quality.CHAIN_SAME_ROWS.values())
    return quality.run_suite(cat.models(sorted(names)), quality.CATALOGUE_SUITE, quality.CHAIN_SAME_ROWS)


DIRTY_SUITE = [
    quality.Check("unique", "raw_items", ("id",)),
    quality.Check("unique", "raw_languages", ("iso_639_1",)),
    quality.Check("not_null", "raw_items", ("original_language",)),
    quality.Check("not_null", "raw_items", ("id",)),
    quality.Check("accepted_values", "raw_items", ("original_language",), values=ACCEPTED_LANGUAGES),
    quality.Check("accepted_values", "raw_items", ("overview",), values=(" O ",)),
    quality.Check("unique_combination", "raw_items", ("id", "vote_count")),
    quality.Check("relationships", "raw_items", ("original_language",), parent="raw_languages", parent_key="iso_639_1"),
    quality.Check("relationships", "raw_items", ("vote_count",), parent="raw_countries", parent_key="code"),
]


def q_dq_suite_dirty(spark: SparkSession, d: str) -> DataFrame:
    """The suite over uncleaned rows: every kind of check has failures."""
    models = {
        "raw_items": fixtures.raw_items(spark, d),
        "raw_languages": fixtures.raw_languages(spark, d),
        "raw_countries": fixtures.raw_countries(spark, d).select(F.col("iso_3166_1").cast("long").alias("code")),
    }
    return quality.run_suite(models, DIRTY_SUITE)


# --- metric series ---------------------------------------------------------------------


def q_metric_mapping(spark: SparkSession, d: str) -> DataFrame:
    mapped = metrics.map_metric_names(fixtures.metric_names(spark, d))
    return mapped.groupBy("metric", *metrics.MAPPED_LABELS).agg(F.count(F.lit(1)).alias("n_samples"))


def _deltas(spark: SparkSession, d: str) -> DataFrame:
    return metrics.counter_deltas(
        fixtures.counter_samples(spark, d), ["event_type"], tiebreak=["event_id"]
    )


def q_metric_rate(spark: SparkSession, d: str) -> DataFrame:
    r = metrics.rate_per_minute(_deltas(spark, d), ["event_type"])
    return r.select("event_type", _ntz("window_start").alias("window_start"), "rate_per_min")


def q_metric_increase(spark: SparkSession, d: str) -> DataFrame:
    inc = metrics.increase(_deltas(spark, d), ["event_type"], "1 day")
    return inc.select("event_type", _ntz("window_start").alias("window_start"), "increase")


def q_metric_increase_total(spark: SparkSession, d: str) -> DataFrame:
    """Increase of all series in the 24 hours before the last sample."""
    samples = fixtures.counter_samples(spark, d)
    at = samples.agg(F.max("ts")).first()[0]  # the instant that a client asks about
    return metrics.trailing_increase(samples, ["event_type"], at, tiebreak=["event_id"])


def q_metric_last(spark: SparkSession, d: str) -> DataFrame:
    return metrics.last_and_max(fixtures.event_samples(spark, d), ["event_type", "user_id"], tiebreak=["event_id"])


def q_metric_p99(spark: SparkSession, d: str) -> DataFrame:
    ev = fixtures.event_samples(spark, d).filter(F.col("event_type") == P99_SERIES)
    return metrics.quantile(ev, ["user_id"], 0.99).select("user_id", F.round("p99", 6).alias("p99"))


def q_metric_status(spark: SparkSession, d: str) -> DataFrame:
    inc = metrics.increase(_deltas(spark, d), ["event_type"], "1 day")
    per_min = F.col("increase") / F.lit(1440.0)
    return inc.select(
        "event_type",
        _ntz("window_start").alias("window_start"),
        "increase",
        per_min.alias("rate_per_min"),
        metrics.rate_status(per_min).alias("rate_status"),
        metrics.failure_status(F.col("increase")).alias("failure_status"),
    )


def q_metric_sample(spark: SparkSession, d: str) -> DataFrame:
    ev = fixtures.event_samples(spark, d)
    as_of = ev.select(F.max("ts")).scalar()
    recent = metrics.in_range(ev, "ts", as_of, RETENTION)
    s = metrics.sample_last(recent, ["event_type"], SAMPLE_STEP, tiebreak=["event_id"])
    return s.select("event_type", _ntz("step_start").alias("step_start"), "value")


def q_metric_retention(spark: SparkSession, d: str) -> DataFrame:
    """Samples per day that are kept, and those of the last RANGE_HOURS, after expiry."""
    ev = fixtures.event_samples(spark, d).select("event_id", "ts", "event_type", "value")
    path = scratch_path(spark, "samples")
    samples.write_samples(ev, path)
    as_of = ev.agg(F.max("ts")).first()[0]
    samples.expire_samples(spark, path, as_of, dt.timedelta(days=RETENTION_DAYS))
    stored = spark.read.schema(ev.schema).parquet(path).select("ts", F.lit(0).alias("recent"))
    recent = samples.read_samples(spark, path, ev.schema, as_of - dt.timedelta(hours=RANGE_HOURS), as_of)
    both = stored.unionByName(recent.select("ts", F.lit(1).alias("recent")))
    return both.groupBy(F.to_date("ts").alias("day")).agg(
        F.sum(1 - F.col("recent")).alias("n_kept"), F.sum("recent").alias("n_recent")
    )


def q_metric_by_state(spark: SparkSession, d: str) -> DataFrame:
    mapped = metrics.map_metric_names(fixtures.metric_names(spark, d))
    return metrics.counts_by_labels(mapped, "airflow_ti_finish_total", ["dag_id", "task_id", "state"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_partition": q_scan_partition,
    "lake_roundtrip": q_lake_roundtrip,
    "lake_rerun_empty": q_lake_rerun_empty,
    "pages_landed": q_pages_landed,
    "stamp_date": q_stamp_date,
    "clean_items": q_clean_items,
    "clean_lookup": q_clean_lookup,
    "dedup_latest": q_dedup_latest,
    "reject_counts": q_reject_counts,
    "items_enriched": q_items_enriched,
    "bridge_item_genre": q_bridge_item_genre,
    "distinct_pairs": q_distinct_pairs,
    "dim_genre": _mart("dim_genre"),
    "dim_country": _mart("dim_country"),
    "dim_language": _mart("dim_language"),
    "stg_items": _mart("stg_items"),
    "item_metrics": _mart("item_metrics"),
    "fact_items": _mart("fact_items"),
    "dim_date": q_dim_date,
    "fact_by_calendar": q_fact_by_calendar,
    "load_by_name": q_load_by_name,
    "pages_complete": q_pages_complete,
    "lake_rerun_failed": q_lake_rerun_failed,
    "load_counts": q_load_counts,
    "load_versions": q_load_versions,
    "latest_merge": q_latest_merge,
    "drift_gate": q_drift_gate,
    "dated_run": q_dated_run,
    "row_counts": q_row_counts,
    "discover_page": q_discover_page,
    "listing_after": q_listing_after,
    "top_k_popular": q_top_k_popular,
    "top_genres": q_top_genres,
    "top_genres_rollup": q_top_genres_rollup,
    "views_top_genres": q_views_top_genres,
    "dq_unique": q_dq_unique,
    "dq_unique_combination": q_dq_unique_combination,
    "dq_not_null": q_dq_not_null,
    "dq_accepted_values": q_dq_accepted_values,
    "dq_relationships": q_dq_relationships,
    "dq_suite": q_dq_suite,
    "dq_suite_dirty": q_dq_suite_dirty,
    "metric_mapping": q_metric_mapping,
    "metric_rate": q_metric_rate,
    "metric_increase": q_metric_increase,
    "metric_increase_total": q_metric_increase_total,
    "metric_last": q_metric_last,
    "metric_p99": q_metric_p99,
    "metric_status": q_metric_status,
    "metric_sample": q_metric_sample,
    "metric_by_state": q_metric_by_state,
    "metric_retention": q_metric_retention,
}
