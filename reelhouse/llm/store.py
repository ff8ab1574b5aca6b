"""Shared-folder tables and small column helpers used by the operators.

Intermediate results are Parquet tables below ``spark.checkpoint.dir``, which
every executor and the driver can read, so a lost executor costs a task retry
and never a recomputation of the whole chain.
"""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.session import scratch_path

# Rows per Arrow batch sent to Python workers; documents can be long, so the
# default of 10,000 rows would make a batch of a few hundred MB.
ARROW_ROWS = 1_000


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder; ``session.release_scratch`` deletes it."""
    return scratch_path(spark, f"llm-{name}")


def write_shared(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and return it as read back (cuts lineage)."""
    path = new_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def local_frame(spark: SparkSession, rows: list[tuple], **types: pa.DataType) -> DataFrame:
    """A few rows of the driver as a frame. They travel as Arrow: a list of rows would
    start Python workers beside those that hold an operator's words and models."""
    cols = list(zip(*rows)) or [()] * len(types)
    return spark.createDataFrame(pa.table({c: pa.array(v, t) for (c, t), v in zip(types.items(), cols)}))


def python_ready(spark: SparkSession) -> None:
    """Prepare a session for Python tasks over whole documents.

    Bounds the rows of an Arrow batch, and lets workers that share this file
    system import the package from where the driver has it (elsewhere it
    comes with ``--py-files``).
    """
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def text_or_empty(col: str | Column) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
