"""Warehouse models: staging views, metrics, fact, bridge and calendar
(P7-P12, F10-F22, J6, C7).

The models are plain DataFrame functions; called in dependency order they
stay one lazy plan, so Catalyst collapses the staging -> intermediate -> fact
projections into a single scan.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.functions.expressions import (
    CALENDAR_END,
    CALENDAR_START,
    calendar_columns,
    composite_score,
    date_key,
    is_recent,
)
from reelhouse.operators.joins import broadcast_bounded

ENRICHED_COLUMNS = [
    "movie_id",
    "title",
    "original_title",
    "overview",
    "language_code",
    "language_name",
    "release_date",
    "release_year",
    "release_decade",
    "has_release_date",
    "popularity",
    "popularity_tier",
    "vote_average",
    "vote_count",
    "vote_tier",
]


def stg_items(enriched: DataFrame) -> DataFrame:
    """Typed staging view; the audit date becomes a date."""
    return enriched.select(*ENRICHED_COLUMNS, F.col("ingestion_date").cast("date").alias("ingestion_date"))


def item_metrics(stg: DataFrame, as_of: str | None = None) -> DataFrame:
    """Composite score and recent flag (``as_of`` default today)."""
    return stg.select(
        *ENRICHED_COLUMNS,
        composite_score().alias("composite_score"),
        is_recent("release_year", as_of).alias("is_recent"),
        "ingestion_date",
    )


def fact_items(metrics: DataFrame) -> DataFrame:
    """One row per item; FK to the calendar as a YYYYMMDD key."""
    return metrics.select(
        "movie_id",
        date_key("release_date").alias("release_date_id"),
        "language_code",
        "title",
        "original_title",
        "release_date",
        "release_year",
        "release_decade",
        "has_release_date",
        "is_recent",
        "popularity_tier",
        "vote_tier",
        "popularity",
        "vote_average",
        "vote_count",
        "composite_score",
        "ingestion_date",
    )


def stg_item_genres(item_genres: DataFrame, distinct: bool = True) -> DataFrame:
    """Distinct pairs with both keys present.

    Pairs straight from ``item_genres`` are unique by construction;
    ``distinct=False`` then saves the shuffle.
    """
    pairs = item_genres.select("movie_id", "genre_id").dropna(subset=["movie_id", "genre_id"])
    return pairs.distinct() if distinct else pairs


def bridge_item_genre(stg_pairs: DataFrame) -> DataFrame:
    """P12."""
    return stg_pairs.select("movie_id", "genre_id")


def passthrough(df: DataFrame, columns: list[str]) -> DataFrame:
    """Staging and mart views of the dimensions (the same frame when
    it already has exactly these columns, so tests on it are shared)."""
    return df if df.columns == list(columns) else df.select(*columns)


def calendar_days(start: str = CALENDAR_START, end: str = CALENDAR_END, inclusive: bool = False) -> int:
    n = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days
    return n + 1 if inclusive else n


def dim_date(
    spark: SparkSession,
    start: str = CALENDAR_START,
    end: str = CALENDAR_END,
    inclusive: bool = False,
) -> DataFrame:
    """one row per day from ``start``; ``end`` excluded unless
    ``inclusive`` (the default range gives 47,846 days).

    Days come from ``spark.range`` so the spine is generated in parallel
    across partitions rather than exploded from one row in one task.
    """
    n = calendar_days(start, end, inclusive)
    days = spark.range(0, n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))
    return days.select(*calendar_columns("date_day"))


def dim_date_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """F22 with a data-derived range: ``bounds`` holds one row with an
    inclusive start and end date. The spine length is the number of days in
    the range (a calendar, bounded by the range, not by the data volume)."""
    days = bounds.select(
        F.explode(F.sequence(F.col(start_col).cast("date"), F.col(end_col).cast("date"))).alias("date_day")
    )
    return days.select(*calendar_columns("date_day"))


def fact_by_calendar(fact: DataFrame, calendar: DataFrame, calendar_rows: int | None = None) -> DataFrame:
    """Items per (year, quarter) through the calendar dimension.

    Fact rows whose key is outside the calendar (or NULL) land in a NULL
    (year, quarter) group, as a left join keeps them.
    """
    cal = calendar.select("date_id", "year", "quarter")
    if calendar_rows is not None:
        cal = broadcast_bounded(cal, calendar_rows)
    joined = fact.join(cal, fact["release_date_id"] == cal["date_id"], "left")
    return joined.groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum("vote_count").cast("long").alias("total_votes"),
        F.max("popularity").alias("max_popularity"),
    )
