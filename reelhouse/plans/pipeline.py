"""End-to-end batch run for one date.

raw (lake) -> staging (lake) -> curated (lake) -> warehouse tables ->
marts tables -> data tests. Each layer is written before the next one reads
it: the written Parquet is the durable boundary that cuts lineage, so a lost
executor costs at most the current layer. A partition write replaces its
date, a table write the table, and the run log the rows of its date, so
re-running a date gives the same result (K16).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelhouse.operators import analytics, clean, marts, quality
from reelhouse.plans.catalogue import Catalogue, Raw
from reelhouse.sources import drift, io, schemas
from reelhouse.sources.load import load_table

MART_SCHEMAS = {
    "fact_items": schemas.FACT_ITEMS,
    "bridge_item_genre": schemas.BRIDGE_ITEM_GENRE,
    "dim_genre": schemas.DIM_GENRE,
    "dim_country": schemas.DIM_COUNTRY,
    "dim_language": schemas.DIM_LANGUAGE,
    "dim_date": schemas.DIM_DATE,
}


def land_raw(
    spark: SparkSession, root: str, raw: Raw, ingestion_date: str, records_per_file: int | None = None
) -> dict[str, int]:
    """K1-K3: write raw frames as the date partition of the raw layer.

    ``records_per_file`` bounds the part files of the listing (the demo's
    files hold 2,000 rows); unset, files are as large as their tasks."""
    frames = {"movies": raw.items, "genres": raw.genres, "countries": raw.countries, "languages": raw.languages}
    out = {}
    for name, df in frames.items():
        stamped = io.stamp_date(df.drop(io.PARTITION_COL) if io.PARTITION_COL in df.columns else df, ingestion_date)
        per_file = records_per_file if name == "movies" else None
        out[name] = io.write_partition(stamped, root, "raw", name, ingestion_date, per_file)
    return out


def ingest_json(
    spark: SparkSession,
    src: str,
    root: str,
    ingestion_date: str,
    max_pages: int | None = None,
    records_per_file: int | None = None,
) -> dict[str, int]:
    """Extract stage re-aimed (S3-S6, K1-K3): saved listing pages and lookup
    documents -> raw date partitions.

    ``src/pages/`` holds one JSON document per listing page (pages past
    page 1's ``total_pages``, or ``max_pages`` when given, are ignored); ``genres.json`` is
    wrapped (``{"genres": [...]}``); ``countries.json`` and ``languages.json``
    are top-level arrays.
    """
    def lookup_schema(raw_schema):
        return StructType([f for f in raw_schema.fields if f.name != io.PARTITION_COL])

    items = io.read_pages(spark, f"{src}/pages", schemas.PAGE_DOCUMENT, max_pages)
    raw = Raw(
        items=items,
        genres=io.read_wrapped_lookup(spark, f"{src}/genres.json", "genres", lookup_schema(schemas.RAW_GENRES)),
        countries=io.read_array_lookup(spark, f"{src}/countries.json", lookup_schema(schemas.RAW_COUNTRIES)),
        languages=io.read_array_lookup(spark, f"{src}/languages.json", lookup_schema(schemas.RAW_LANGUAGES)),
    )
    return land_raw(spark, root, raw, ingestion_date, records_per_file)


LOG_SCHEMA = "layer string, dataset string, n_rows long, status string"


def _summary(spark: SparkSession, layer: str, counts: dict[str, int]) -> DataFrame:
    return spark.createDataFrame([(layer, k, int(v), "success") for k, v in counts.items()], LOG_SCHEMA)


RAW_SCHEMAS = {
    "movies": schemas.RAW_ITEMS,
    "genres": schemas.RAW_GENRES,
    "countries": schemas.RAW_COUNTRIES,
    "languages": schemas.RAW_LANGUAGES,
}


def run_staging(spark: SparkSession, root: str, ingestion_date: str, set_drift_aside: bool = False) -> dict[str, int]:
    """Raw partition -> cleaned staging partition, per dataset.

    Every raw part file passes the drift gate first (S7): a drifted one stops
    the stage by name, or is set aside and counted when that is asked for.
    """
    drifted = {
        f"{name}_drifted": drift.drift_gate(spark, root, "raw", name, ingestion_date, schema, set_drift_aside)
        for name, schema in RAW_SCHEMAS.items()
    }
    raw = Raw(
        items=io.read_partition(spark, root, "raw", "movies", ingestion_date, schemas.RAW_ITEMS),
        genres=io.read_partition(spark, root, "raw", "genres", ingestion_date, schemas.RAW_GENRES),
        countries=io.read_partition(spark, root, "raw", "countries", ingestion_date, schemas.RAW_COUNTRIES),
        languages=io.read_partition(spark, root, "raw", "languages", ingestion_date, schemas.RAW_LANGUAGES),
    )
    cat = Catalogue(spark, raw)
    items, seen_raw, seen_clean = clean.observed_cleaning(raw.items)
    n_items = io.write_partition(items, root, "staging", "movies", ingestion_date)
    return {
        "movies": n_items,
        "movies_raw": int(seen_raw.get["n"]),
        "movies_rejected": int(seen_raw.get["n"]) - int(seen_clean.get["n"]),
        "genres": io.write_partition(cat.stg_genres_clean, root, "staging", "genres", ingestion_date),
        "countries": io.write_partition(cat.stg_countries_clean, root, "staging", "countries", ingestion_date),
        "languages": io.write_partition(cat.stg_languages_clean, root, "staging", "languages", ingestion_date),
        **{name: n for name, n in drifted.items() if n},
    }


def _staging_catalogue(spark: SparkSession, root: str, ingestion_date: str, as_of: str | None) -> Catalogue:
    """A catalogue whose staging layers are the written staging partitions."""
    cat = Catalogue(spark, Raw(None, None, None, None), as_of)  # type: ignore[arg-type]
    reads = {
        "stg_items_clean": ("movies", schemas.STAGING_ITEMS),
        "stg_genres_clean": ("genres", schemas.RAW_GENRES),
        "stg_countries_clean": ("countries", schemas.RAW_COUNTRIES),
        "stg_languages_clean": ("languages", schemas.RAW_LANGUAGES),
    }
    for attr, (dataset, schema) in reads.items():
        df = io.read_partition(spark, root, "staging", dataset, ingestion_date, schema)
        cat.use(attr, df.select(*[f.name for f in schema.fields]), loaded=False)
    return cat


def run_curated(spark: SparkSession, root: str, ingestion_date: str, as_of: str | None = None) -> dict[str, int]:
    """Staging partitions -> five curated partitions."""
    cat = _staging_catalogue(spark, root, ingestion_date, as_of)
    out = {}
    for name, df in cat.curated().items():
        stamped = io.stamp_date(df.drop(io.PARTITION_COL) if io.PARTITION_COL in df.columns else df, ingestion_date)
        out[name] = io.write_partition(stamped, root, "curated", name, ingestion_date)
    return out


def run_load(spark: SparkSession, root: str, ingestion_date: str, namespace: str = "raw") -> dict[str, int]:
    """Curated partitions -> fixed-schema warehouse tables (replaced)."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace}")
    out = {}
    for name, target in schemas.WAREHOUSE_TABLES.items():
        df = io.read_partition(spark, root, "curated", name, ingestion_date)
        out[name] = load_table(spark, df, io.qualified_name(namespace, name), target)
    return out


def warehouse_catalogue(spark: SparkSession, namespace: str = "raw", as_of: str | None = None) -> Catalogue:
    """A catalogue whose curated layers are the loaded warehouse tables."""
    cat = Catalogue(spark, Raw(None, None, None, None), as_of)  # type: ignore[arg-type]
    for attr, table in {
        "cur_dim_genre": "dim_genre",
        "cur_dim_country": "dim_country",
        "cur_dim_language": "dim_language",
        "movies_enriched": "movies_enriched",
        "movie_genres": "movie_genres",
    }.items():
        cat.use(attr, spark.table(io.qualified_name(namespace, table)))
    return cat


def run_models(
    spark: SparkSession, namespace: str = "raw", marts_ns: str = "marts", as_of: str | None = None
) -> dict[str, int]:
    """Staging views + intermediate model stay lazy; marts are tables."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {marts_ns}")
    cat = warehouse_catalogue(spark, namespace, as_of)
    return {
        name: load_table(spark, cat.model(name), io.qualified_name(marts_ns, name), target)
        for name, target in MART_SCHEMAS.items()
    }


SOURCE_CHECKS = [c for c in quality.CATALOGUE_SUITE if c.model.startswith("src_")]


def run_tests(
    spark: SparkSession,
    namespace: str = "raw",
    marts_ns: str | None = "marts",
    as_of: str | None = None,
    checks=None,
) -> DataFrame:
    """Q6 over the loaded sources, the lazy staging views and the marts.

    ``marts_ns=None`` tests the models without reading mart tables (used for
    the source tests, before the marts are built)."""
    checks = list(checks or quality.CATALOGUE_SUITE)
    cat = warehouse_catalogue(spark, namespace, as_of)
    if marts_ns is not None:
        for name in MART_SCHEMAS:
            cat.use(name, spark.table(io.qualified_name(marts_ns, name)))
    names = sorted({c.model for c in checks} | {c.parent for c in checks if c.parent})
    return quality.run_suite(cat.models(names), checks)


def run_counts(spark: SparkSession, curated: dict[str, int], marts_ns: str = "marts") -> dict[str, int]:
    """Q8: the marts hold the rows that the curated layer promised; raises where one does not."""
    expected = {
        "fact_items": curated["movies_enriched"],
        "bridge_item_genre": curated["movie_genres"],
        **{name: curated[name] for name in ("dim_genre", "dim_country", "dim_language")},
        "dim_date": marts.calendar_days(),
    }
    actual = analytics.row_counts({name: spark.table(io.qualified_name(marts_ns, name)) for name in expected})
    wanted = spark.createDataFrame(list(expected.items()), "table_name string, n_rows long")
    differing = quality.expect_counts(actual, wanted).collect()  # at most one row per mart
    if differing:
        told = ", ".join(f"{r.table_name} has {r.actual} rows for {r.expected}" for r in differing)
        raise quality.DataQualityError(f"row counts differ: {told}")
    return {"tables": len(expected)}


def write_run_log(spark: SparkSession, summary: DataFrame, ingestion_date: str, table: str = "run_log") -> None:
    """The run log's rows of this date, one per layer and dataset; a re-run replaces them."""
    rows = summary.withColumn("run_date", F.lit(ingestion_date))
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").partitionBy("run_date").saveAsTable(table)
        return
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        rows.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)


def run_pipeline(
    spark: SparkSession,
    root: str,
    ingestion_date: str,
    as_of: str | None = None,
    namespace: str = "raw",
    marts_ns: str = "marts",
    fail_on_test: bool = True,
    set_drift_aside: bool = False,
    log_table: str = "run_log",
) -> DataFrame:
    """The whole run for one date; returns a (layer, dataset, n_rows,
    status) summary. The source tests gate the marts, the others follow them
    (Q7): with ``fail_on_test`` a failing one raises ``DataQualityError``. The
    row counts of the marts are compared with the curated layer last (Q8).
    The run log gets every step's status, also of a run that fails: the step
    that raised is ``failed`` and those after it are ``skipped``."""
    own = [c for c in quality.CATALOGUE_SUITE if c not in SOURCE_CHECKS]

    def tested(marts: str | None, checks) -> dict[str, int]:
        results = run_tests(spark, namespace, marts, as_of, checks).collect()  # one row per declared test
        if fail_on_test:
            quality.raise_on_failures(results)
        return {"tests": len(results)}

    done: dict[str, dict[str, int]] = {}
    steps = {
        "staging": lambda: run_staging(spark, root, ingestion_date, set_drift_aside),
        "curated": lambda: run_curated(spark, root, ingestion_date, as_of),
        "warehouse": lambda: run_load(spark, root, ingestion_date, namespace),
        "source_tests": lambda: tested(None, SOURCE_CHECKS),
        "marts": lambda: run_models(spark, namespace, marts_ns, as_of),
        "model_tests": lambda: tested(marts_ns, own),
        "counts": lambda: run_counts(spark, done["curated"], marts_ns),
    }
    parts: list[DataFrame] = []
    failure: Exception | None = None
    for layer, step in steps.items():
        if failure is not None:
            parts.append(spark.createDataFrame([(layer, "-", 0, "skipped")], LOG_SCHEMA))
            continue
        try:
            done[layer] = step()
            parts.append(_summary(spark, layer, done[layer]))
        except Exception as e:  # logged below, then raised
            failure = e
            parts.append(spark.createDataFrame([(layer, "-", 0, "failed")], LOG_SCHEMA))
    summary = reduce(DataFrame.unionByName, parts)
    write_run_log(spark, summary, ingestion_date, log_table)
    if failure is not None:
        raise failure
    return summary
