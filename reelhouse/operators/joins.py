"""Broadcast of sides whose size is known by construction.

Dimension joins carry no hint and run no job while a query is built: Spark
broadcasts a side whose statistics are below ``autoBroadcastJoinThreshold``,
and AQE turns a shuffle join into a broadcast join, or splits its skewed
partitions, from the bytes it measures at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest side that is broadcast by a hint.
BROADCAST_BYTES = 32 * 1024 * 1024


def broadcast_bounded(df: DataFrame, n_rows: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast a side of a known number of rows (e.g. a calendar of
    ``n_rows`` days) when its rows at their default widths fit the bound."""
    width = 8 + sum(_width(f.dataType.simpleString()) for f in df.schema)
    return F.broadcast(df) if n_rows * width <= max_bytes else df


def _width(kind: str) -> int:
    """Bytes a value is taken to have: fixed types as stored, others as a long text."""
    fixed = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "date": 4, "float": 4}
    return fixed.get(kind, 8 if kind in ("bigint", "double", "timestamp", "timestamp_ntz") else 64)
