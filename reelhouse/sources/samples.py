"""Metric samples on disk, by day, with a retention.

Samples lie below ``<path>/day=YYYY-MM-DD/``. A range read filters the day
partitions beside the time, so days outside of it are neither listed nor read.
What is older than the retention goes by whole days: dropping a partition
reads and rewrites nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reelhouse.functions.expressions import wall_clock

DAY = "day"


def write_samples(samples: DataFrame, path: str, ts: str = "ts") -> None:
    """Add samples to their days. Rows are dealt by day and a hash of the time, so that a
    task writes few files and a busy day is written by many tasks."""
    day = F.to_date(ts)
    n = int(samples.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = samples.withColumn(DAY, day).repartition(n, F.col(DAY), F.pmod(F.xxhash64(ts), F.lit(n)))
    dealt.write.mode("append").partitionBy(DAY).parquet(path)


def read_samples(spark: SparkSession, path: str, schema: StructType, since: dt.datetime, until: dt.datetime, ts: str = "ts") -> DataFrame:
    """Samples with since <= ts <= until; only the days in between are read."""
    stored = spark.read.schema(StructType(schema.fields).add(DAY, "date")).parquet(path)
    days = F.col(DAY).between(F.lit(since.date()), F.lit(until.date()))
    first, last = (wall_clock(t, schema[ts].dataType) for t in (since, until))
    return stored.filter(days & F.col(ts).between(first, last)).drop(DAY)


def stored_days(spark: SparkSession, path: str) -> list[dt.date]:
    """The days that have a partition (a listing of folder names, one per day kept)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
    return sorted(dt.date.fromisoformat(n.removeprefix(f"{DAY}=")) for n in names if n.startswith(f"{DAY}="))


def expire_samples(spark: SparkSession, path: str, as_of: dt.datetime, keep: dt.timedelta) -> list[dt.date]:
    """Drop the days whose samples are all older than ``as_of - keep``; return them.

    A day that ends after that instant stays whole: ``read_samples`` cuts it to the range.
    """
    first = (as_of - keep).date()
    gone = [d for d in stored_days(spark, path) if d < first]
    for day in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{DAY}={day}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return gone
