"""Fixed schemas of every layer.

All fields are nullable: keys are enforced by the data-quality operators,
not by constraints. Ids and counts are LongType, years/decades/date keys
IntegerType, measures DoubleType.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def schema_of(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


# --- RAW -----------------------------------------------------------------

RAW_ITEMS = schema_of(
    ("adult", BooleanType()),
    ("backdrop_path", StringType()),
    ("genre_ids", ArrayType(LongType())),
    ("id", LongType()),
    ("original_language", StringType()),
    ("original_title", StringType()),
    ("overview", StringType()),
    ("popularity", DoubleType()),
    ("poster_path", StringType()),
    ("release_date", StringType()),
    ("title", StringType()),
    ("video", BooleanType()),
    ("vote_average", DoubleType()),
    ("vote_count", LongType()),
    ("ingestion_date", StringType()),
)

RAW_GENRES = schema_of(("id", LongType()), ("name", StringType()), ("ingestion_date", StringType()))
RAW_COUNTRIES = schema_of(
    ("iso_3166_1", StringType()),
    ("english_name", StringType()),
    ("native_name", StringType()),
    ("ingestion_date", StringType()),
)
RAW_LANGUAGES = schema_of(
    ("iso_639_1", StringType()),
    ("english_name", StringType()),
    ("name", StringType()),
    ("ingestion_date", StringType()),
)

# One saved listing page: {"page": .., "total_pages": .., "results": [...]}
PAGE_DOCUMENT = schema_of(
    ("page", IntegerType()),
    ("total_pages", IntegerType()),
    ("results", ArrayType(StructType([f for f in RAW_ITEMS.fields if f.name != "ingestion_date"]))),
)

# --- STAGING -------------------------------------------------------------

STAGING_ITEMS = schema_of(
    ("movie_id", LongType()),
    ("genre_ids", ArrayType(LongType())),
    ("original_language", StringType()),
    ("original_title", StringType()),
    ("overview", StringType()),
    ("popularity", DoubleType()),
    ("release_date", DateType()),
    ("title", StringType()),
    ("vote_average", DoubleType()),
    ("vote_count", LongType()),
    ("ingestion_date", StringType()),
    ("release_year", IntegerType()),
)

# --- CURATED = warehouse RAW (K6) ------------------------------------------

DIM_GENRE = schema_of(("genre_id", LongType()), ("genre_name", StringType()))
DIM_COUNTRY = schema_of(
    ("country_code", StringType()),
    ("country_name", StringType()),
    ("country_native_name", StringType()),
)
DIM_LANGUAGE = schema_of(
    ("language_code", StringType()),
    ("language_name", StringType()),
    ("language_native_name", StringType()),
)
ITEMS_ENRICHED = schema_of(
    ("movie_id", LongType()),
    ("title", StringType()),
    ("original_title", StringType()),
    ("overview", StringType()),
    ("language_code", StringType()),
    ("language_name", StringType()),
    ("release_date", DateType()),
    ("release_year", IntegerType()),
    ("release_decade", IntegerType()),
    ("has_release_date", BooleanType()),
    ("popularity", DoubleType()),
    ("popularity_tier", StringType()),
    ("vote_average", DoubleType()),
    ("vote_count", LongType()),
    ("vote_tier", StringType()),
    ("ingestion_date", StringType()),
)
ITEM_GENRES = schema_of(("movie_id", LongType()), ("genre_id", LongType()), ("genre_name", StringType()))

WAREHOUSE_TABLES: dict[str, StructType] = {
    "dim_genre": DIM_GENRE,
    "dim_country": DIM_COUNTRY,
    "dim_language": DIM_LANGUAGE,
    "movies_enriched": ITEMS_ENRICHED,
    "movie_genres": ITEM_GENRES,
}

# --- MARTS ---------------------------------------------------------------

FACT_ITEMS = schema_of(
    ("movie_id", LongType()),
    ("release_date_id", IntegerType()),
    ("language_code", StringType()),
    ("title", StringType()),
    ("original_title", StringType()),
    ("release_date", DateType()),
    ("release_year", IntegerType()),
    ("release_decade", IntegerType()),
    ("has_release_date", BooleanType()),
    ("is_recent", BooleanType()),
    ("popularity_tier", StringType()),
    ("vote_tier", StringType()),
    ("popularity", DoubleType()),
    ("vote_average", DoubleType()),
    ("vote_count", LongType()),
    ("composite_score", DoubleType()),
    ("ingestion_date", DateType()),
)
BRIDGE_ITEM_GENRE = schema_of(("movie_id", LongType()), ("genre_id", LongType()))
DIM_DATE = schema_of(
    ("date_id", IntegerType()),
    ("date_day", DateType()),
    ("year", IntegerType()),
    ("quarter", IntegerType()),
    ("month", IntegerType()),
    ("month_name", StringType()),
    ("day_of_month", IntegerType()),
    ("day_of_week", IntegerType()),
    ("day_name", StringType()),
    ("week_of_year", IntegerType()),
    ("is_weekend", BooleanType()),
    ("decade", IntegerType()),
)


def schema_drift(actual: StructType, expected: StructType) -> dict[str, list[str]]:
    """Names missing from / unexpected in ``actual`` (case-insensitive)."""
    have = {f.name.lower() for f in actual.fields}
    want = {f.name.lower() for f in expected.fields}
    return {"missing": sorted(want - have), "unexpected": sorted(have - want)}
