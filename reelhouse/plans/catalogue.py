"""The catalogue's layers as one lazy chain of DataFrames.

``Catalogue`` wires staging -> curated -> marts from any raw inputs. Each
layer is built on first access only, building runs no job, and Catalyst
optimizes the chain a query does read as one plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from reelhouse.functions.expressions import date_key
from reelhouse.operators import clean, enrich, marts
from reelhouse.plans import fixtures
from reelhouse.session import scratch_path

DIM_COLUMNS = {
    "dim_genre": ["genre_id", "genre_name"],
    "dim_country": ["country_code", "country_name", "country_native_name"],
    "dim_language": ["language_code", "language_name", "language_native_name"],
}


@dataclass
class Raw:
    items: DataFrame
    genres: DataFrame
    countries: DataFrame
    languages: DataFrame


class Catalogue:
    """Layers of one run; ``raw`` frames in, every model as an attribute.

    ``as_of`` is the reference date of the recent flag (None: today).
    ``item_columns`` limits the cleaned items to the columns a caller needs.
    """

    def __init__(
        self, spark: SparkSession, raw: Raw, as_of: str | None = None, item_columns: tuple[str, ...] | None = None
    ):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.item_columns = item_columns
        self.loaded: set[str] = set()  # layers that come from tables

    def use(self, name: str, frame: DataFrame, loaded: bool = True) -> None:
        """Set a layer to a stored frame instead of deriving it."""
        self.__dict__[name] = frame
        if loaded:
            self.loaded.add(name)

    @classmethod
    def from_tables(
        cls, spark: SparkSession, sf_dir: str, as_of: str | None = None, item_columns: tuple[str, ...] | None = None
    ) -> Catalogue:
        """Raw inputs derived from the driver's tables (see ``fixtures``)."""
        return cls(
            spark,
            Raw(
                items=fixtures.raw_items(spark, sf_dir),
                genres=fixtures.raw_genres(spark, sf_dir),
                countries=fixtures.raw_countries(spark, sf_dir),
                languages=fixtures.raw_languages(spark, sf_dir),
            ),
            as_of,
            item_columns,
        )

    # --- staging (C3) -------------------------------------------------------------
    @cached_property
    def stg_items_clean(self) -> DataFrame:
        return clean.clean_items(self.raw.items, columns=self.item_columns)

    @cached_property
    def stg_genres_clean(self) -> DataFrame:
        return clean.clean_lookup(self.raw.genres, "id")

    @cached_property
    def stg_countries_clean(self) -> DataFrame:
        return clean.clean_lookup(self.raw.countries, "iso_3166_1")

    @cached_property
    def stg_languages_clean(self) -> DataFrame:
        return clean.clean_lookup(self.raw.languages, "iso_639_1")

    # --- curated (C6) -------------------------------------------------------------
    @cached_property
    def cur_dim_genre(self) -> DataFrame:
        return enrich.dim_genre(self.stg_genres_clean)

    @cached_property
    def cur_dim_country(self) -> DataFrame:
        return enrich.dim_country(self.stg_countries_clean)

    @cached_property
    def cur_dim_language(self) -> DataFrame:
        return enrich.dim_language(self.stg_languages_clean)

    @cached_property
    def movies_enriched(self) -> DataFrame:
        return enrich.items_enriched(self.stg_items_clean, self.cur_dim_language)

    @cached_property
    def movie_genres(self) -> DataFrame:
        return enrich.item_genres(self.stg_items_clean, self.cur_dim_genre)

    def curated(self) -> dict[str, DataFrame]:
        return {
            "dim_genre": self.cur_dim_genre,
            "dim_country": self.cur_dim_country,
            "dim_language": self.cur_dim_language,
            "movies_enriched": self.movies_enriched,
            "movie_genres": self.movie_genres,
        }

    # --- warehouse models (C7) ----------------------------------------------------
    @cached_property
    def stg_items(self) -> DataFrame:
        return marts.stg_items(self.movies_enriched)

    @cached_property
    def item_metrics(self) -> DataFrame:
        return marts.item_metrics(self.stg_items, self.as_of)

    @cached_property
    def fact_items(self) -> DataFrame:
        return marts.fact_items(self.item_metrics)

    @cached_property
    def items_all(self) -> DataFrame:
        """Every column of the item layers, row for row (for the data tests)."""
        return self.item_metrics.withColumn("release_date_id", date_key("release_date"))

    @cached_property
    def stg_item_genres(self) -> DataFrame:
        # The pairs of a chain built here are unique by construction; loaded
        # tables (see ``pipeline.warehouse_catalogue``) promise nothing.
        return marts.stg_item_genres(self.movie_genres, distinct="movie_genres" in self.loaded)

    @cached_property
    def bridge_item_genre(self) -> DataFrame:
        return marts.bridge_item_genre(self.stg_item_genres)

    @cached_property
    def dim_genre(self) -> DataFrame:
        return marts.passthrough(self.cur_dim_genre, DIM_COLUMNS["dim_genre"])

    @cached_property
    def dim_country(self) -> DataFrame:
        return marts.passthrough(self.cur_dim_country, DIM_COLUMNS["dim_country"])

    @cached_property
    def dim_language(self) -> DataFrame:
        return marts.passthrough(self.cur_dim_language, DIM_COLUMNS["dim_language"])

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.spark)

    def model(self, name: str) -> DataFrame:
        """A model by the name the declared tests use."""
        aliases = {
            "src_items_enriched": "movies_enriched",
            "src_dim_genre": "cur_dim_genre",
            "src_dim_country": "cur_dim_country",
            "src_dim_language": "cur_dim_language",
            "src_item_genres": "movie_genres",
            "stg_genres": "dim_genre",
            "stg_countries": "dim_country",
            "stg_languages": "dim_language",
        }
        return getattr(self, aliases.get(name, name))

    def models(self, names) -> dict[str, DataFrame]:
        return {n: self.model(n) for n in names}

    def register_views(self, names=("stg_items", "item_metrics", "stg_item_genres", "fact_items",
                                    "bridge_item_genre", "dim_genre", "dim_country", "dim_language",
                                    "dim_date")) -> list[str]:
        """Expose models as session views, so they can be queried with
        ``spark.sql``; views stay lazy and are inlined into each query."""
        for n in names:
            self.model(n).createOrReplaceTempView(n)
        return list(names)

    def materialize(self, *names: str) -> None:
        """Compute the named layers once and cut their lineage.

        Each layer is written as Parquet under the shared
        ``spark.checkpoint.dir`` and read back, so later models read the
        stored rows (columnar, with pruning and pushdown) and a lost
        executor does not recompute the chain. Layers are materialized in
        the given order, so later ones build on earlier stored ones.
        ``session.release_scratch`` deletes the files.
        """
        for name in names:
            path = scratch_path(self.spark, f"layer-{name}")
            getattr(self, name).write.mode("overwrite").parquet(path)
            self.__dict__[name] = self.spark.read.parquet(path)
