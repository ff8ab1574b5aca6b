"""Curated layer: lookup dimensions, enriched items and the item-genre pairs
(P3-P6, J1, J2, C4, C5, F6-F9, F21).

Every output is projected onto its target schema: a column comes from the
table of origins below or from the column of the same name, so a layer's
columns and their order are stated once, in ``sources.schemas``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelhouse.functions.expressions import decade, explode_distinct, popularity_tier, vote_tier
from reelhouse.sources import schemas

# Where renamed columns of the curated layer come from.
ORIGINS = {
    "genre": {"genre_id": "id", "genre_name": "name"},
    "country": {"country_code": "iso_3166_1", "country_name": "english_name", "country_native_name": "native_name"},
    "language": {"language_code": "iso_639_1", "language_name": "english_name", "language_native_name": "name"},
    "item": {"language_code": "original_language"},
}


def onto(df: DataFrame, target: StructType, origins: dict[str, str], derived: dict[str, Column] | None = None) -> DataFrame:
    """``df`` in the columns of ``target``: derived, renamed, or as named."""
    derived = derived or {}
    return df.select(
        *[derived.get(f.name, F.col(origins.get(f.name, f.name))).alias(f.name) for f in target.fields]
    )


def dim_genre(genres: DataFrame) -> DataFrame:
    """P3."""
    return onto(genres, schemas.DIM_GENRE, ORIGINS["genre"])


def dim_country(countries: DataFrame) -> DataFrame:
    """P4."""
    return onto(countries, schemas.DIM_COUNTRY, ORIGINS["country"])


def dim_language(languages: DataFrame) -> DataFrame:
    """P5."""
    return onto(languages, schemas.DIM_LANGUAGE, ORIGINS["language"])


def _named(codes: DataFrame, code: str, dim: DataFrame, key: str, name: str) -> DataFrame:
    """``codes`` with ``name`` looked up in a dimension (NULL when absent)."""
    lookup = dim.select(F.col(key).alias("_key"), F.col(name).alias(name))
    return codes.join(lookup, codes[code] == F.col("_key"), "left").drop("_key")


def items_enriched(items: DataFrame, languages: DataFrame) -> DataFrame:
    """C4: items with the language name, decade, date flag and tiers."""
    derived = {
        "release_decade": decade("release_year"),
        "has_release_date": F.col("release_date").isNotNull(),
        "popularity_tier": popularity_tier("popularity"),
        "vote_tier": vote_tier("vote_average"),
    }
    found = _named(items, "original_language", languages, "language_code", "language_name")
    return onto(found, schemas.ITEMS_ENRICHED, ORIGINS["item"], derived)


def item_genres(items: DataFrame, genres: DataFrame, items_unique: bool = True) -> DataFrame:
    """One row per (movie_id, genre_id) with the genre name (NULL when
    the id is not in the dimension).

    Elements are de-duplicated and NULLs dropped inside the array before the
    explode; when items are unique per ``movie_id`` (the staging contract)
    the pairs are then unique without any shuffle. ``items_unique=False``
    adds the general ``dropDuplicates`` on the pair.
    """
    pairs = items.select("movie_id", explode_distinct("genre_ids").alias("genre_id"))
    if not items_unique:
        pairs = pairs.dropDuplicates(["movie_id", "genre_id"])
    return onto(_named(pairs, "genre_id", genres, "genre_id", "genre_name"), schemas.ITEM_GENRES, {})
