"""Loading curated datasets into fixed-schema tables.

Columns are matched to the target by case-insensitive name: a target column
missing from the source becomes NULL, an extra source column is ignored.
One value that its target type cannot hold aborts the whole load (K9) instead
of loading a NULL, whatever the session's ANSI setting; the table keeps its
former rows until the new ones are written in full.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType


def _strict_cast(name: str, source: DataType, target: DataType) -> Column:
    """Cast that raises on a value it would lose."""
    col = F.col(f"`{name}`")
    if source == target:
        return col
    cast = col.try_cast(target)
    lost = col.isNotNull() & cast.isNull()
    why = F.concat(F.lit(f"column {name} has a value that is no {target.simpleString()}: "), F.to_json(F.struct(col)))
    return F.when(lost, F.raise_error(why).cast(target)).otherwise(cast)


def align_to_schema(df: DataFrame, target: StructType, strict_cast: bool = True) -> DataFrame:
    """K8: project ``df`` onto ``target`` by case-insensitive column name."""
    by_lower = {name.lower(): name for name in df.columns}
    cols = []
    for field in target.fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif strict_cast:
            cols.append(_strict_cast(src, df.schema[src].dataType, field.dataType).alias(field.name))
        else:
            cols.append(F.col(f"`{src}`").try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


_VERSION = "__v"
# Versions kept behind the current one for queries that are still reading them.
KEEP_VERSIONS = 1


def _split(table: str) -> tuple[str, str]:
    namespace, _, name = table.rpartition(".")
    return namespace, name


def table_versions(spark: SparkSession, table: str) -> list[str]:
    """All versions of a table, oldest first (their names begin with the time of the load)."""
    namespace, name = _split(table)
    found = spark.catalog.listTables(namespace or None, f"{name}{_VERSION}*")
    prefix = f"{namespace}." if namespace else ""
    return sorted(f"{prefix}{t.name}" for t in found if not t.isTemporary)


def version_name(table: str) -> str:
    """The name of a new version; later ones sort behind."""
    return f"{table}{_VERSION}{time.time_ns() // 1_000_000:013d}_{uuid.uuid4().hex[:8]}"


def current_version(spark: SparkSession, table: str) -> str | None:
    """The version that the table's view shows; None where there is no such view."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()  # a handful of catalog entries
    return {r["key"]: r["value"] for r in rows}.get("version")


def write_version(spark: SparkSession, df: DataFrame, table: str, target: StructType) -> tuple[str, int]:
    """Write ``df`` aligned to ``target`` as a new, unpublished version; (version, rows).

    The row count is observed on the write itself. A failed write leaves no version.
    """
    obs = Observation(f"load_{table}")
    aligned = align_to_schema(df, target).observe(obs, F.count(F.lit(1)).alias("n"))
    version = version_name(table)
    try:
        aligned.write.format("parquet").saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version, int(obs.get["n"])


def publish_version(spark: SparkSession, table: str, version: str) -> None:
    """Let ``table`` show ``version``: one replacement of its view in the catalog."""
    if spark.catalog.tableExists(table) and current_version(spark, table) is None:
        # A plain table, as written before there were versions, has to make room once.
        spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('version' = '{version}') AS SELECT * FROM {version}")


def drop_old_versions(spark: SparkSession, table: str, keep: int = KEEP_VERSIONS) -> int:
    """Drop versions older than the current one, but for the last ``keep``; return how many.

    Versions newer than the current one may be loads under way and stay; one
    left by a load that died goes once a later load is current.
    """
    current = current_version(spark, table)
    old = [v for v in table_versions(spark, table) if current is not None and v < current]
    gone = old[: max(0, len(old) - keep)]
    for version in gone:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    return len(gone)


def drop_table(spark: SparkSession, table: str) -> None:
    """The table with all its versions."""
    if current_version(spark, table) is not None:
        spark.sql(f"DROP VIEW IF EXISTS {table}")
    for version in table_versions(spark, table):
        spark.sql(f"DROP TABLE IF EXISTS {version}")


def load_table(spark: SparkSession, df: DataFrame, table: str, target: StructType) -> int:
    """Replace ``table`` with ``df`` aligned to ``target``; return rows.

    Written, then published, then old versions dropped: whatever step fails,
    the table shows the former rows or the new ones, whole.
    """
    version, n = write_version(spark, df, table, target)
    publish_version(spark, table, version)
    drop_old_versions(spark, table)
    return n


def load_all(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    targets: dict[str, StructType],
    namespace: str | None = None,
) -> DataFrame:
    """Load every dataset, return a (dataset, n_rows, status) frame."""
    rows = []
    for name, target in targets.items():
        table = f"{namespace}.{name}" if namespace else name
        if name in frames:
            rows.append((name, load_table(spark, frames[name], table, target), "success"))
        else:
            rows.append((name, 0, "skipped"))
    return spark.createDataFrame(rows, "dataset string, n_rows long, status string")
