"""Session construction (S10) and shared-folder helpers.

The session is always taken as an argument by the library; this module only
builds one for scripts, tests and the benchmark. Object-store settings come in
as a plain dict (e.g. ``{"spark.hadoop.fs.s3a.endpoint": ...}``) instead of
environment variables, and the session time zone is pinned to UTC.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults that matter at any scale: AQE re-plans joins and coalesces
# shuffle partitions at run time, skew-join splits hot partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Target bytes per task: input splits and post-shuffle partitions.
PARTITION_BYTES = 256 * 1024 * 1024


def sizing_conf(input_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``cores`` cores.

    The initial shuffle partition count is set so that each partition holds
    about ``partition_bytes`` of the input (at least 2 tasks per core); AQE
    then coalesces small ones and splits skewed ones at run time. At 100 TB
    this gives ~400,000 initial partitions, each far below executor memory.
    """
    n = max(2 * cores, -(-int(input_bytes) // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 4),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
    }


# Rows that one task of a run over known tables takes from a shuffle, and bytes from a shuffle or a file:
# a hash table of narrow rows takes some 40 times its compressed bytes.
TASK_ROWS = 200_000
TASK_BYTES = 8 << 20


@contextmanager
def sized(spark: SparkSession, rows: int, task_rows: int = TASK_ROWS, task_bytes: int = TASK_BYTES) -> Iterator[None]:
    """Tasks of a bounded size for the jobs that run inside, however many ``rows`` there are.

    The number of shuffle partitions grows with the rows, and neither a merged
    shuffle partition nor a file split is larger than ``task_bytes``. A session
    that asks for smaller tasks keeps them; its settings come back afterwards.
    """
    bytes_ = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    number = "spark.sql.shuffle.partitions"
    before = {k: spark.conf.get(k, None) for k in (number, *bytes_)}
    spark.conf.set(number, max(int(spark.conf.get(number)), -(-rows // task_rows)))
    for k in bytes_:
        spark.conf.set(k, min(_in_bytes(spark.conf.get(k)), task_bytes))
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _in_bytes(size: str) -> int:
    """A size as Spark writes it ("64MB", "8m", "1024b", "1024")."""
    digits = size.strip().lower().rstrip("b")
    power = "kmgtp".find(digits[-1:]) + 1
    return int(digits[:-1] if power else digits) << 10 * power


def get_spark(
    app_name: str = "reelhouse",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with UTC time and AQE on.

    ``master`` is only set when given: on a cluster spark-submit decides.
    Pass ``sizing_conf(...)`` in ``conf`` to size partitions for the input.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**BASE_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    and the master is local (tests, single-machine runs) a scratch folder is
    created and registered; on a cluster an unset value is an error.
    """
    current = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if current:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
        return current
    if not spark.sparkContext.master.startswith("local"):
        # A machine-local folder is not shared by executors: refuse instead.
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    local = tempfile.mkdtemp(prefix="reelhouse-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/reelhouse/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def scratch_paths() -> list[str]:
    """The folders that ``scratch_path`` named in this process and that were not deleted yet, oldest first."""
    return list(_scratch)


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> int:
    """Delete the folders ``scratch_path`` named in this process (or some of them); returns how many.

    Call it when no frame that reads them is used any more.
    """
    gone = scratch_paths() if paths is None else [p for p in paths if p in _scratch]
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    for p in gone:
        _scratch.remove(p)
        path = hadoop(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(gone)
