"""Staging: typing, trimming, de-duplication and filling.

De-duplication keeps, per key, the row with the greatest ordering struct
(latest ``ingestion_date`` first, then every other column as tie-breaker), so
re-runs always keep the same row. It is a grouped ``max(struct)`` rather than
a ``row_number`` window: the aggregate combines rows map-side before the
shuffle, so a key holding a third of all rows is reduced in every map task
instead of being sorted whole in one reduce task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from reelhouse.functions.expressions import FILL_DEFAULTS, parse_date
from reelhouse.sources.schemas import STAGING_ITEMS

KEY, LISTED = "movie_id", "ingestion_date"
MEASURES = ("popularity", "vote_average", "vote_count")
TRIMMED_COLUMNS = ("title", "original_title", "overview")


def one_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str] = (),
    latest: bool = True,
) -> DataFrame:
    """One row per key, deterministic.

    ``order_by`` columns decide first (greatest when ``latest``, else
    smallest); the remaining columns break ties in their natural order.
    Rows with NULL keys form their own group, as in ``dropDuplicates``.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    ordered = [c for c in order_by if c in others] + [c for c in others if c not in order_by]
    if not ordered:
        return df.select(*keys).distinct()
    packed = F.struct(*[F.col(f"`{c}`") for c in ordered])
    pick = F.max(packed) if latest else F.min(packed)
    return (
        df.groupBy(*keys)
        .agg(pick.alias("_keep"))
        .select(*keys, *[F.col("_keep").getField(c).alias(c) for c in others])
        .select(*df.columns)
    )


def any_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A2 as the reference codes it: an arbitrary row per key."""
    return df.dropDuplicates(list(keys))


def clean_items(raw: DataFrame, dedup: str = "latest", columns: Sequence[str] | None = None) -> DataFrame:
    """Raw listing rows -> one typed, trimmed, filled row per item.

    One projection onto the staging schema: dates that do not parse and
    measures that do not cast become NULL, texts are trimmed; rows without
    key go; the latest row per key stays; NULLs get their defaults.
    ``columns`` names the staging columns a caller needs: only these (with
    the key and the listing date) are read, shuffled and returned.
    """
    kept = [f for f in STAGING_ITEMS.fields if columns is None or f.name in columns or f.name in (KEY, LISTED)]
    if "release_year" in (f.name for f in kept) and not any(f.name == "release_date" for f in kept):
        kept.append(STAGING_ITEMS["release_date"])
    source = {KEY: F.col("id"), "release_date": parse_date("release_date")}
    for name in TRIMMED_COLUMNS:
        source[name] = F.trim(name)
    for name in MEASURES:
        source[name] = F.col(name).try_cast(STAGING_ITEMS[name].dataType)
    stored = [f.name for f in kept if f.name != "release_year"]
    df = raw.where(F.col("id").isNotNull()).select(*[source.get(n, F.col(n)).alias(n) for n in stored])
    if dedup == "latest":
        df = one_per_key(df, [KEY], order_by=[LISTED], latest=True)
    elif dedup == "any":
        df = any_per_key(df, [KEY])
    else:
        raise ValueError(f"unknown dedup mode {dedup!r}")
    year = F.year("release_date")
    df = df.fillna({k: v for k, v in FILL_DEFAULTS.items() if k in stored})
    return df.select(*[year.alias(f.name) if f.name == "release_year" else F.col(f.name) for f in kept])


def clean_lookup(
    raw: DataFrame,
    key: str,
    order_by: Sequence[str] = ("ingestion_date",),
    latest: bool = True,
) -> DataFrame:
    """Drop rows without key, keep one row per key (latest date first)."""
    order = [c for c in order_by if c in raw.columns]
    return one_per_key(raw.filter(F.col(key).isNotNull()), [key], order_by=order, latest=latest)


def observed_cleaning(raw: DataFrame, dedup: str = "latest") -> tuple[DataFrame, Observation, Observation]:
    """A9 inside one job: ``clean_items`` with the raw and the clean row
    counts observed on the way. Both counts are filled by the single action
    that consumes the returned frame (e.g. the staging write)."""
    seen_raw, seen_clean = Observation("raw_rows"), Observation("clean_rows")
    counted = raw.observe(seen_raw, F.count(F.lit(1)).alias("n"))
    cleaned = clean_items(counted, dedup).observe(seen_clean, F.count(F.lit(1)).alias("n"))
    return cleaned, seen_raw, seen_clean


def reject_counts(raw: DataFrame, clean: DataFrame) -> DataFrame:
    """A9 as one frame: n_raw, n_clean, rejected.

    Both counts come from one job: the two inputs are tagged, unioned and
    aggregated once (no cross join of two single-row frames).
    """
    tagged = raw.select(F.lit(1).alias("_raw"), F.lit(0).alias("_clean")).unionByName(
        clean.select(F.lit(0).alias("_raw"), F.lit(1).alias("_clean"))
    )
    return tagged.agg(
        F.sum("_raw").cast("long").alias("n_raw"),
        F.sum("_clean").cast("long").alias("n_clean"),
    ).select("n_raw", "n_clean", (F.col("n_raw") - F.col("n_clean")).alias("rejected"))


def item_reject_counts(raw: DataFrame, key: str = "id") -> DataFrame:
    """A9 for ``clean_items`` in one read of the raw rows.

    Cleaning keeps exactly one row per non-NULL key and drops nothing else,
    so the clean count is the number of distinct non-NULL keys: one
    aggregate (a distinct count, planned as a two-level aggregate keyed by
    the key) gives both counts without reading the raw chain twice.
    """
    return raw.agg(
        F.count(F.lit(1)).alias("n_raw"),
        F.count_distinct(F.col(key)).alias("n_clean"),
    ).select("n_raw", "n_clean", (F.col("n_raw") - F.col("n_clean")).alias("rejected"))

