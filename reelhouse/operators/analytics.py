"""Ranking, paging, top-k and count queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 20


def top_genres(
    fact: DataFrame,
    bridge: DataFrame,
    genres: DataFrame,
    n: int = 5,
) -> DataFrame:
    """Top ``n`` genres by distinct items, with the mean vote (2 digits).

    bridge x fact is a shuffle join on ``movie_id`` (only the two needed fact
    columns travel); the genre dimension joins without a hint (a small one is
    broadcast by its size).
    The distinct count is planned as a two-level aggregate keyed by
    (genre, item), so no single genre group is collected whole. Ties on the
    count are broken by genre name.
    """
    f = fact.select("movie_id", "vote_average")
    g = genres.select("genre_id", "genre_name")
    joined = bridge.select("movie_id", "genre_id").join(f, "movie_id").join(g, "genre_id")
    return (
        joined.groupBy("genre_name")
        .agg(
            F.count_distinct("movie_id").alias("nb_items"),
            F.round(F.avg("vote_average"), 2).alias("mean_vote"),
        )
        .orderBy(F.desc("nb_items"), F.asc("genre_name"))
        .limit(n)
    )


def listing(items: DataFrame, exclude_adult: bool = True, exclude_video: bool = True) -> DataFrame:
    """The catalogue predicates of the listing (no adult, no video)."""
    df = items
    if exclude_adult and "adult" in df.columns:
        df = df.filter(~F.coalesce(F.col("adult"), F.lit(False)))
    if exclude_video and "video" in df.columns:
        df = df.filter(~F.coalesce(F.col("video"), F.lit(False)))
    return df


def discover_page(
    items: DataFrame,
    page: int,
    page_size: int = PAGE_SIZE,
    sort_col: str = "popularity",
    id_col: str = "id",
) -> DataFrame:
    """Page ``page`` (1-based) of the listing by ``sort_col`` descending,
    ``id_col`` ascending as tie-break.

    ORDER BY + OFFSET + LIMIT plans as a per-partition top-(offset+limit)
    followed by one merge (TakeOrderedAndProject), not a global sort.
    """
    if page < 1:
        raise ValueError("page is 1-based")
    ordered = listing(items).orderBy(F.desc(sort_col), F.asc(id_col))
    return ordered.offset((page - 1) * page_size).limit(page_size)


def listing_after(
    items: DataFrame,
    after: tuple | None = None,
    page_size: int = PAGE_SIZE,
    sort_col: str = "popularity",
    id_col: str = "id",
) -> DataFrame:
    """T2 by key: the page that follows the row ``after`` = (sort value, id).

    The boundary is a filter, so a deep page costs as much as the first one
    (``discover_page`` merges page x page_size rows).
    """
    df = listing(items)
    if after is not None:
        value, last_id = after
        s = F.col(sort_col)
        if value is None:  # NULLs sort last in descending order
            df = df.filter(s.isNull() & (F.col(id_col) > last_id))
        else:
            df = df.filter((s < value) | ((s == value) & (F.col(id_col) > last_id)) | s.isNull())
    return df.orderBy(F.desc(sort_col), F.asc(id_col)).limit(page_size)


def top_k_popular(
    items: DataFrame,
    max_pages: int,
    page_size: int = PAGE_SIZE,
    sort_col: str = "popularity",
    id_col: str = "id",
) -> DataFrame:
    """The first ``max_pages`` pages of the listing as one top-k."""
    return listing(items).orderBy(F.desc(sort_col), F.asc(id_col)).limit(max_pages * page_size)


def distinct_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """``SELECT DISTINCT a, b WHERE a IS NOT NULL AND b IS NOT NULL``."""
    return df.select(a, b).dropna(subset=[a, b]).distinct()


def row_counts(frames: dict[str, DataFrame], name_col: str = "table_name") -> DataFrame:
    """One (name, n_rows) row per frame, as a UNION ALL of counts."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias(name_col), "n_rows")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, parts)
