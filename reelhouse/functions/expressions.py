"""Scalar column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions`` so the
whole projection stays inside whole-stage codegen; nothing here is a UDF.
Thresholds and defaults are arguments whose defaults are the catalogue's.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

ColumnOrName = Column | str

# --- Fixed values of the catalogue --------------------------------------
# Popularity tier: >= 100 high, >= 20 medium, else low.
POPULARITY_HIGH = 100.0
POPULARITY_MEDIUM = 20.0
# Vote tier: >= 7.5 excellent, >= 6.0 good, >= 4.0 average, else poor.
VOTE_EXCELLENT = 7.5
VOTE_GOOD = 6.0
VOTE_AVERAGE = 4.0
# Defaults used when filling NULLs in staging.
FILL_DEFAULTS = {
    "title": "",
    "original_title": "",
    "overview": "",
    "original_language": "xx",
    "popularity": 0.0,
    "vote_average": 0.0,
    "vote_count": 0,
}
# Recent = released in the last 5 years.
RECENT_YEARS = 5
# Calendar range; the end date is exclusive (47,846 days).
CALENDAR_START = "1900-01-01"
CALENDAR_END = "2030-12-31"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """string -> date; empty or invalid text gives NULL (never raises)."""
    return F.try_to_date(_col(c), fmt)


def decade(year: ColumnOrName) -> Column:
    """floor(year / 10) * 10 as int; NULL stays NULL."""
    return (F.floor(_col(year) / 10) * 10).cast("int")


def popularity_tier(
    c: ColumnOrName, high: float = POPULARITY_HIGH, medium: float = POPULARITY_MEDIUM
) -> Column:
    """F8: NULL falls to 'low' (fill NaN before: NaN sorts above every number)."""
    c = _col(c)
    return F.when(c >= high, F.lit("high")).when(c >= medium, F.lit("medium")).otherwise(F.lit("low"))


def vote_tier(
    c: ColumnOrName,
    excellent: float = VOTE_EXCELLENT,
    good: float = VOTE_GOOD,
    average: float = VOTE_AVERAGE,
) -> Column:
    """NULL falls to 'poor'."""
    c = _col(c)
    return (
        F.when(c >= excellent, F.lit("excellent"))
        .when(c >= good, F.lit("good"))
        .when(c >= average, F.lit("average"))
        .otherwise(F.lit("poor"))
    )


def composite_score(
    popularity: ColumnOrName = "popularity",
    vote_count: ColumnOrName = "vote_count",
    vote_average: ColumnOrName = "vote_average",
) -> Column:
    """round(popularity * ln(vote_count + 1) * vote_average / 10, 2) when
    vote_count > 0, else 0.0."""
    p, n, v = _col(popularity), _col(vote_count), _col(vote_average)
    return (
        F.when(n > 0, F.round(p * F.ln(n + F.lit(1)) * (v / F.lit(10.0)), 2))
        .otherwise(F.lit(0.0))
        .cast("double")
    )


def is_recent(year: ColumnOrName, as_of: ColumnOrName | None = None, years: int = RECENT_YEARS) -> Column:
    """year >= year(as_of) - years; NULL year -> false.

    ``as_of`` defaults to ``current_date()``; pass a fixed date for
    reproducible runs.
    """
    if as_of is None:
        ref = F.current_date()
    elif isinstance(as_of, str):
        ref = F.to_date(F.lit(as_of))
    else:
        ref = F.to_date(as_of)
    return F.coalesce(_col(year) >= F.year(ref) - F.lit(years), F.lit(False))


def date_key(d: ColumnOrName) -> Column:
    """integer YYYYMMDD key; NULL date -> NULL key."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def day_of_week_sun0(d: ColumnOrName) -> Column:
    """0 = Sunday .. 6 = Saturday."""
    return (F.dayofweek(_col(d)) - F.lit(1)).cast("int")


def is_weekend(d: ColumnOrName) -> Column:
    """Saturday or Sunday."""
    return F.dayofweek(_col(d)).isin(1, 7)


def calendar_columns(day: ColumnOrName = "date_day") -> list[Column]:
    """F5, F12, F15-F20, F6 over one date column, in the calendar's order."""
    d = _col(day)
    return [
        date_key(d).alias("date_id"),
        d.alias("date_day"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.monthname(d).alias("month_name"),
        F.dayofmonth(d).alias("day_of_month"),
        day_of_week_sun0(d).alias("day_of_week"),
        F.dayname(d).alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
        is_weekend(d).alias("is_weekend"),
        decade(F.year(d)).alias("decade"),
    ]


def explode_distinct(arr: ColumnOrName) -> Column:
    """F21 + A4: one row per distinct non-null element; NULL or empty -> no row.

    De-duplicating inside the array replaces a shuffle on (key, element).
    """
    return F.explode(F.array_distinct(F.array_compact(_col(arr))))


def wall_clock(at: dt.datetime, like: DataType) -> Column:
    """A point of time as a literal of a timestamp column's type, by its wall-clock reading."""
    return F.lit(at.isoformat(sep=" ")).cast(like)
