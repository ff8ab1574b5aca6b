"""Genre counts from a daily rollup with bitmaps.

The rollup holds, per genre, date and range of 32,768 item ids, a bitmap of
the items and the sum and number of their votes. Bitmaps are mergeable where
distinct counts are not: any set of dates is answered by OR-ing them, exactly,
from rows whose number does not depend on how many items a genre has. Every
item belongs to the date of its latest listing, so the vote sums add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def genre_rollup(items: DataFrame, pairs: DataFrame, day: str = "ingestion_date") -> DataFrame:
    """(genre_id, day, id_range, items, vote_sum, votes) from items and their unique genre pairs."""
    joined = pairs.select("movie_id", "genre_id").join(items.select("movie_id", "vote_average", F.col(day).alias("day")), "movie_id")
    return joined.groupBy("genre_id", "day", F.bitmap_bucket_number("movie_id").alias("id_range")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("movie_id")).alias("items"),
        F.sum("vote_average").alias("vote_sum"),
        F.count("vote_average").alias("votes"),
    )


def genre_counts(rollup: DataFrame, days: Column | None = None) -> DataFrame:
    """(genre_id, nb_items, vote_sum, votes) over the dates that ``days`` (a condition on day) selects."""
    part = rollup if days is None else rollup.filter(days)
    merged = part.groupBy("genre_id", "id_range").agg(
        F.bitmap_count(F.bitmap_or_agg("items")).alias("n"), F.sum("vote_sum").alias("s"), F.sum("votes").alias("v")
    )
    return merged.groupBy("genre_id").agg(F.sum("n").alias("nb_items"), F.sum("s").alias("vote_sum"), F.sum("v").alias("votes"))


def top_genres(rollup: DataFrame, genres: DataFrame, n: int = 5, days: Column | None = None) -> DataFrame:
    """C8 from the rollup: top ``n`` genres by distinct items, with the mean vote (2 digits)."""
    counts = genre_counts(rollup, days).join(genres.select("genre_id", "genre_name"), "genre_id")
    return (
        counts.groupBy("genre_name")
        .agg(
            F.sum("nb_items").alias("nb_items"),
            F.round(F.sum("vote_sum") / F.sum("votes"), 2).alias("mean_vote"),
        )
        .orderBy(F.desc("nb_items"), F.asc("genre_name"))
        .limit(n)
    )
