"""The latest row per key, kept up to date one listing date at a time.

The snapshot is a versioned table (see ``load``) bucketed and sorted by the
key. A new date is reduced to its latest row per key, dealt to the snapshot's
buckets and merged with it by a full outer join: the snapshot itself is read
bucket by bucket and never shuffled, so a date costs a shuffle of its own rows
and one pass over the snapshot, whatever the number of dates before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from reelhouse.operators.clean import one_per_key
from reelhouse.sources import load

BUCKETS = 64


def latest_of_both(snapshot: DataFrame, fresh: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Per key the row that ``one_per_key`` would keep of two frames that hold a row per key."""
    others = [c for c in snapshot.columns if c not in keys]
    ordered = [*order_by, *(c for c in others if c not in order_by)]
    packed = F.struct(*[F.col(f"`{c}`") for c in ordered])
    old, new = snapshot.select(*keys, packed.alias("_old")), fresh.select(*keys, packed.alias("_new"))
    # greatest() passes over the side that has no row.
    both = old.join(new, list(keys), "full_outer").withColumn("_keep", F.greatest("_old", "_new"))
    return both.select(*[F.col(c) if c in keys else F.col("_keep").getField(c).alias(c) for c in snapshot.columns])


def merged(spark: SparkSession, table: str, rows: DataFrame, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> DataFrame:
    """The snapshot with ``rows`` in it; without a snapshot, the latest of ``rows``.

    Rows without a key are left out, as in staging.
    """
    for k in keys:
        rows = rows.filter(F.col(k).isNotNull())
    fresh = one_per_key(rows, keys, order_by).repartition(buckets, *keys)
    current = load.current_version(spark, table)
    return fresh if current is None else latest_of_both(spark.table(current), fresh, keys, order_by)


def merge_latest(
    spark: SparkSession,
    table: str,
    rows: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    buckets: int = BUCKETS,
) -> int:
    """Merge the rows of a date into the snapshot ``table``; return its rows.

    The number of buckets is that of the first call and must stay. A failed
    merge leaves the former snapshot; merging a date again changes nothing.
    """
    obs = Observation(f"merge_{table}")
    out = merged(spark, table, rows, keys, order_by, buckets).observe(obs, F.count(F.lit(1)).alias("n"))
    version = load.version_name(table)
    try:
        out.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    load.publish_version(spark, table, version)
    load.drop_old_versions(spark, table)
    return int(obs.get["n"])
